"""The ingestion run: settings of one environment, or of all, to landed bronze layers."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from ..functions.urls import normalize_http_url
from ..operators.landing import FIRST, LAST, group_candidates, outcome_counts, resolve_conflicts, with_presence
from ..operators.links import DATA_SUFFIX, file_rows, file_targets
from ..operators.rules import source_gate
from ..schemas import OUTCOMES, RUN_OUTCOMES
from ..session import pin, scratch_path
from ..sinks import SINKS, Layer
from ..sinks.layer import below
from ..sinks.object_sinks import carry_out, decide_groups, new_load_id
from ..sinks.object_sinks import fetched as fetched_names
from ..sources import SOURCES, SourceSpec, candidates


@dataclass(frozen=True)
class Fetched:
    """What was fetched beforehand: pages, and objects in files ``(object_id, length, path)``.

    Objects may also be cells ``(object_id, length, content)``; see ``sinks.parts.staged``.
    """

    pages: DataFrame
    objects: DataFrame


class NotConfigured(ValueError):
    """No valid settings, or settings whose sink cannot run."""


def landing_targets(pages: DataFrame, suffix: str, destination: str) -> DataFrame:
    """Which link of which page each target key comes from, first link first."""
    files = file_targets(file_rows(pages, suffix), destination)
    ordered = files.withColumnRenamed("page_id", "url_pos").withColumn("source_ord", F.lit(0))
    return resolve_conflicts(ordered).drop("source_ord").withColumnRenamed("url_pos", "page_id")


def _url_table(settings: DataFrame, name: str) -> DataFrame:
    """A record's URLs in the form the record is said to hold them in."""
    rows = settings.select(F.posexplode(name).alias("pos", "url"))
    return rows.select(
        F.col("pos").cast("long").alias("pos"),
        F.coalesce(normalize_http_url(F.col("url")), F.col("url")).alias("url"),
    )


def _record(settings: DataFrame, environment: str) -> tuple[Row, dict[str, str | None]]:
    """The few settings that choose the plan: one record, without its URL lists."""
    slim = settings.select("environment", "sink", "destination").take(2)
    if len(slim) != 1:
        raise NotConfigured(f"{len(slim) or 'no'} valid settings for {environment!r}")
    return slim[0], {r.source_type: r.reason for r in source_gate(settings).take(2)}


def ingest(
    settings: DataFrame,
    environment: str,
    fetched: Fetched,
    layer: Layer | None = None,
    base: str = "",
    suffix: str = DATA_SUFFIX,
    select: str = "all",
    load_id: str | None = None,
) -> DataFrame:
    """Run the sources that may run and land what they name.

    ``settings`` are validated records (see ``settings_with_fallback``); without
    a column ``crawler_urls`` only the archive source runs. The
    object sink lands below ``<base>/<bucket_name>`` with keys under the
    destination. The overwriting sink's own path is both its root and the start
    of its keys; the destination does not count. Returns the outcome counts.
    """
    chosen = settings.where(F.col("environment") == environment)
    if "crawler_urls" not in settings.columns:
        chosen = chosen.withColumn("crawler_urls", F.lit(None).cast("array<string>"))
    record, gates = _record(chosen, environment)
    reasons = set(gates.values())
    for fatal in ("sink_missing", "sink_type_unknown", "bucket_name_missing", "path_missing"):
        if fatal in reasons:
            raise NotConfigured(fatal)
    to_objects = record.sink.type == "s3"
    destination = record.destination if to_objects else record.sink.path
    if layer is None:
        folder = record.sink.bucket_name if to_objects else record.sink.path
        layer = Layer(below(base, folder))

    specs = {
        "kaggle": SourceSpec(_url_table(chosen, "kaggle_urls"), destination, select=select),
        "crawler": SourceSpec(
            _url_table(chosen, "crawler_urls"), destination, pages=fetched.pages, suffix=suffix
        ),
    }
    running = [(name, spec) for name, spec in specs.items() if gates[name] is None]
    if not running:
        return chosen.sparkSession.createDataFrame([], OUTCOMES)
    return SINKS[record.sink.type](candidates(running), fetched.objects, layer, load_id)


# Roots are written at the same time, so many of them.
ROOTS_AT_ONCE = 8

# What a run says of a source that did not run: nothing of its list was tried.
NOT_RUN = "not_run"


def _environments(settings: DataFrame, base: str) -> DataFrame:
    """The control table with where each environment lands, numbered in order of environments.

    An environment with several records is not configured, like one without a sink.
    """
    if "crawler_urls" not in settings.columns:
        settings = settings.withColumn("crawler_urls", F.lit(None).cast("array<string>"))
    sink, join = F.col("sink"), "" if base == "" or base.endswith("/") else "/"
    to_objects = sink["type"] == "s3"
    alone = F.count(F.lit(1)).over(Window.partitionBy("environment")) == 1
    placed = settings.withColumn("sink", F.when(alone, sink)).withColumns(
        {
            "mode": F.when(to_objects, F.lit(FIRST)).otherwise(F.lit(LAST)),
            "root": F.when(to_objects, F.concat(F.lit(base + join), sink["bucket_name"])).otherwise(sink["path"]),
            "destination": F.when(to_objects, F.col("destination")).otherwise(sink["path"]),
        }
    )
    return placed.orderBy("environment").withColumn("env_no", F.monotonically_increasing_id())


def _lists(running: DataFrame, source_type: str, column: str, number: int) -> DataFrame:
    """The URLs of one source of all environments in which it runs."""
    rows = running.where(F.col("source_type") == source_type).select(
        (F.col("env_no") * 2 + number).alias("source_ord"), "root", "mode", "destination",
        F.posexplode(column).alias("pos", "url"),
    )
    url = F.coalesce(normalize_http_url(F.col("url")), F.col("url"))
    return rows.withColumns({"pos": F.col("pos").cast("long"), "url": url})


def ingest_all(
    settings: DataFrame,
    fetched: Fetched,
    base: str = "",
    suffix: str = DATA_SUFFIX,
    select: str = "all",
    load_id: str | None = None,
) -> DataFrame:
    """Run the sources of all environments of a control table; rows ``(environment, source_type, status, n)``.

    One plan names what all environments want, so a page listed by many is parsed once. It
    is written down by root, and each root then decides on its own keys and lands them; as
    many loads as roots, some at the same time. Environments that share a root come in
    the order of their names. A source that its settings keep from running has the status
    ``not_run``, counting the URLs of its list; it keeps no other environment from running.
    """
    spark, load_id = settings.sparkSession, load_id or new_load_id()
    environments = pin(_environments(settings, base), "environments")
    gates = source_gate(environments.dropDuplicates(["environment"])).withColumnRenamed("reason", "gate")
    gated = pin(environments.join(gates, "environment"), "gates")
    running = gated.where("gate IS NULL")
    carry = ("source_ord", "root", "mode", "destination")
    kaggle = SourceSpec(_lists(running, "kaggle", "kaggle_urls", 0), F.col("destination"), select=select, carry=carry)
    crawler = SourceSpec(
        _lists(running, "crawler", "crawler_urls", 1), F.col("destination"), pages=fetched.pages, suffix=suffix, carry=carry
    )
    wanted = SOURCES["kaggle"](kaggle).unionByName(SOURCES["crawler"](crawler))
    groups = with_presence(group_candidates(wanted, also=("root", "mode")), fetched_names(fetched.objects))
    path, outcomes = scratch_path(spark, "groups"), scratch_path(spark, "outcomes")
    groups.write.partitionBy("root", "mode").parquet(path)
    groups = spark.read.schema(groups.schema).parquet(path)
    empty = spark.createDataFrame([], "source_ord bigint, source_type string, status string, n bigint")
    empty.write.parquet(f"{outcomes}/load=0")

    def run(number: int, root: str, modes: list[str]) -> None:
        layer = Layer(root)
        for turn, mode in enumerate(modes):
            own = f"{load_id}-{mode}"
            here = groups.where((F.col("root") == root) & (F.col("mode") == mode))
            done = carry_out(decide_groups(here, layer, mode, own), layer, own)
            counts = outcome_counts(done.groups, done.winners, mode, by=("source_ord", "source_type"))
            counts.write.parquet(f"{outcomes}/load={2 * number + turn}")

    roots: dict[str, list[str]] = {}
    for row in running.select("root", "mode").distinct().orderBy("root", "mode").collect():
        roots.setdefault(row.root, []).append(row.mode)
    with ThreadPoolExecutor(ROOTS_AT_ONCE) as pool:
        list(pool.map(run, range(1, len(roots) + 1), roots, roots.values()))
    counted = spark.read.schema(empty.schema).parquet(outcomes)
    ran = counted.join(environments.select("environment", "env_no"), F.floor(F.col("source_ord") / 2) == F.col("env_no"))
    urls = F.when(F.col("source_type") == "kaggle", F.size("kaggle_urls")).otherwise(F.size("crawler_urls"))
    kept = gated.where("gate IS NOT NULL").groupBy("environment", "source_type").agg(
        F.sum(F.greatest(F.coalesce(urls, F.lit(0)), F.lit(0))).cast("long").alias("n")
    )
    columns = [f.name for f in RUN_OUTCOMES]
    return ran.select(*columns).unionByName(kept.withColumn("status", F.lit(NOT_RUN)).select(*columns))
