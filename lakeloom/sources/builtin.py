"""The two built-in sources: dataset archives and files linked from pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.html import page_files
from ..functions.urls import (
    ARCHIVE_SUFFIX,
    archive_name,
    basename,
    dataset_slug,
    normalize_http_url,
    target_key,
)
from ..operators.landing import FIRST, resolve_conflicts
from ..operators.lists import second_or_first_rows
from ..session import pin
from ..sinks.layer import fits_broadcast
from .registry import SourceSpec, source

# So many listings of one URL meet the page's links in one place.
LISTED = 4096


def _selected(spec: SourceSpec) -> DataFrame:
    if spec.select == "all":
        return spec.urls
    if spec.select != "second_or_first":
        raise ValueError(f"select must be 'all' or 'second_or_first', not {spec.select!r}")
    lists = spec.urls.withColumn("_list", F.lit(0))
    return second_or_first_rows(lists, [*spec.carry, "_list"], ["pos"]).drop("_list")


def _candidate(
    source_type: str, url_pos: Column, link_pos: Column, object_id: Column, key: Column, reason: Column
) -> list[Column]:
    return [
        F.lit(source_type).alias("source_type"),
        url_pos.cast("long").alias("url_pos"),
        link_pos.cast("long").alias("link_pos"),
        F.col("url"),
        object_id.alias("object_id"),
        key.alias("target_key"),
        reason.alias("reason"),
    ]


@source("kaggle")
def archives(spec: SourceSpec) -> DataFrame:
    """One candidate per dataset URL; a URL without a dataset name is set aside."""
    named = _selected(spec).withColumn("slug", dataset_slug(F.col("url")))
    slug = F.col("slug")
    return named.select(
        *_candidate(
            "kaggle",
            F.col("pos"),
            F.lit(0),
            F.concat(slug, F.lit(ARCHIVE_SUFFIX)),
            target_key(spec.folder, archive_name(slug)),
            F.when(slug.isNull(), F.lit("no_dataset_name")),
        ),
        *spec.carry,
    )


@source("crawler")
def crawl(spec: SourceSpec) -> DataFrame:
    """One candidate per matching link of each listed page.

    Only listed pages are parsed: while the listed URLs are measured small they are sent to
    the scan of the pages and leave out the others before their links are looked for;
    beyond that all pages are parsed. Links are taken out before any shuffle, so the text
    of a page is never shuffled, and a page listed by many is parsed once. A page fetched
    more than once counts once. A URL listed many times is dealt out by ``LISTED`` listings,
    each of which meets its own copy of the page's links. Listed texts that are no URL get a
    key of their own: they match no page and do not meet in one task.
    """
    page_url = normalize_http_url(F.col("url"), longest=None)
    no_url = F.concat(F.lit("no url "), F.col("pos").cast("string"))
    listed = _selected(spec).withColumn("_url", F.coalesce(page_url, no_url))
    shares = F.ceil(F.count(F.lit(1)) / LISTED).cast("int").alias("_shares")
    wanted = pin(listed.groupBy("_url").agg(shares), "listed")
    pages = spec.pages.withColumn("_url", page_url).where(F.col("_url").isNotNull())
    few = fits_broadcast(wanted, "_url")
    if few:
        pages = pages.join(F.broadcast(wanted), "_url")
    parsed = pages.select(
        "page_id",
        "_url",
        *(["_shares"] if few else []),
        F.lit(True).alias("_found"),
        page_files(F.col("html"), F.col("_url"), spec.suffix).alias("_files"),
    )
    parsed = resolve_conflicts(parsed, FIRST, key=["_url"], order=["page_id"]).drop("page_id")
    if not few:
        parsed = parsed.join(wanted, "_url")
    parsed = parsed.withColumn("_share", F.explode(F.sequence(F.lit(0), F.col("_shares") - 1))).drop("_shares")
    share = F.pmod(F.xxhash64("pos", *spec.carry), F.col("_shares")).cast("int")
    listed = listed.join(wanted.where("_shares > 1"), "_url", "left").withColumn("_share", F.coalesce(share, F.lit(0)))
    links = (
        listed.join(parsed, ["_url", "_share"], "left")
        .select("pos", "url", *spec.carry, "_found", F.inline_outer("_files"))
        .where(F.col("_found").isNull() | F.col("link_pos").isNotNull())
    )
    reason = F.when(F.col("_found").isNull(), F.lit("page_missing")).when(
        F.col("file_url").isNull(), F.lit("link_unresolvable")
    )
    key = target_key(spec.folder, basename(F.col("file_url")))
    return links.select(
        *_candidate(
            "crawler",
            F.col("pos"),
            F.coalesce(F.col("link_pos"), F.lit(0)),
            F.col("file_url"),
            key,
            reason,
        ),
        *spec.carry,
    )
