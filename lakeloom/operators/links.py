"""From pages to links to files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.html import page_files, page_links
from ..functions.urls import basename, target_key

# Fixed value: the ending of the files a crawl looks for.
DATA_SUFFIX = ".csv"


def link_rows(pages: DataFrame, suffix: str | None = None) -> DataFrame:
    """Rows ``(page_id, link_pos, href)``; the page text never leaves the scan's task."""
    return pages.select("page_id", F.inline(page_links(F.col("html"), suffix)))


def file_rows(pages: DataFrame, suffix: str | None = DATA_SUFFIX) -> DataFrame:
    """Rows ``(page_id, page_url, link_pos, href, file_url)``."""
    return pages.select(
        "page_id",
        F.col("url").alias("page_url"),
        F.inline(page_files(F.col("html"), F.col("url"), suffix)),
    )


def file_targets(files: DataFrame, destination: str) -> DataFrame:
    """Adds the key each file lands under."""
    return files.withColumn(
        "target_key", target_key(F.lit(destination), basename(F.col("file_url")))
    )
