"""Scans: fetched objects, pages, and CSV / JSON files users upload."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.urls import basename
from ..schemas import PAGES

CORRUPT = "_corrupt_record"


def read_objects(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Rows ``(path, modificationTime, length, content)``, one per file.

    ``content`` is only read by plans that use it, and a filter on ``length``
    keeps other files unread.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def archive_objects(objects: DataFrame) -> DataFrame:
    """Fetched archives as ``(object_id, length, content, path)``.

    An archive lies in a folder named after its owner, so the last two parts of
    its path are the dataset's name and the download ending.
    """
    object_id = F.substring_index("path", "/", -2)
    return objects.select(object_id.alias("object_id"), "length", "content", "path")


def file_names(objects: DataFrame) -> DataFrame:
    return objects.withColumn("name", basename(F.col("path")))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Fetched pages as a table ``(page_id, url, html)``."""
    return spark.read.schema(PAGES).parquet(path)


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def read_csv(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame:
    """Uploaded CSV; a line that does not fit the schema is kept in ``_corrupt_record``."""
    return (
        spark.read.schema(_with_corrupt(schema))
        .options(header="true", mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
        .options(**options)
        .csv(path)
    )


def read_json(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame:
    """Uploaded JSON lines, with the same treatment of lines that do not fit."""
    return (
        spark.read.schema(_with_corrupt(schema))
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
        .options(**options)
        .json(path)
    )
