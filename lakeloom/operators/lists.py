"""Lists of source URLs, as arrays in one row or as rows of a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.urls import parse_url_list

_CHUNK = 4096


def url_rows(df: DataFrame, urls: str, keep: Sequence[str] = ()) -> DataFrame:
    """Rows ``(*keep, pos, url)`` of a list column, text or array, in list order."""
    is_text = df.schema[urls].dataType.typeName() == "string"
    listed = parse_url_list(F.col(urls)) if is_text else F.col(urls)
    rows = df.select(*keep, F.posexplode(listed).alias("pos", "url"))
    return rows.withColumn("pos", F.col("pos").cast("long"))


def second_or_first_rows(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per group the second row in order, or the only one.

    The rank limit runs before the shuffle too, so a task sends at most two rows
    of a group, whatever the group's size.
    """
    ranked = df.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    ).where("_rank <= 2")
    rest = [c for c in df.columns if c not in group]
    picked = ranked.groupBy(*group).agg(F.max_by(F.struct(*rest), "_rank").alias("_row"))
    return picked.select(*group, "_row.*").select(*df.columns)


def join_url_rows(df: DataFrame, group: Sequence[str], pos: str, url: str) -> DataFrame:
    """Rows ``(*group, urls)``: the group's URLs in order, joined by commas.

    Runs of neighbouring positions are joined first, so the sorting of a large
    group is spread over many tasks and only its few pieces meet in one.
    """
    chunk = F.floor(F.col(pos) / _CHUNK).alias("_chunk")
    pieces = df.groupBy(*group, chunk).agg(
        F.expr(f"listagg(`{url}`, ',') WITHIN GROUP (ORDER BY `{pos}`)").alias("_piece")
    )
    return pieces.groupBy(*group).agg(
        F.expr("listagg(_piece, ',') WITHIN GROUP (ORDER BY _chunk)").alias("urls")
    )


def choose_list(df: DataFrame, key: Column, urls: Column, wanted: str) -> DataFrame:
    """The lists of one key (``KAGGLE_URLS`` or ``CRAWLER_URLS``) as comma text."""
    return df.where(key == wanted).withColumn("urls", F.array_join(urls, ","))
