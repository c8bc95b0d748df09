"""Settings records: from parameters, with a fallback."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.urls import parse_url_list
from .landing import LAST, resolve_conflicts
from .rules import broken_rules, settings_rules

# Parameter name below /<project>/<environment>/ -> field.
PARAMETER_FIELDS = {
    "sink/type": "sink_type",
    "sink/bucket_name": "sink_bucket",
    "kaggle/data_source_urls": "kaggle_urls",
    "crawler/data_source_urls": "crawler_urls",
    "kaggle/username": "kaggle_username",
    "kaggle/key": "kaggle_key",
}


def parameter_rows(parameters: DataFrame, project: str) -> DataFrame:
    """Rows ``(environment, field, value)`` of the project's known parameters."""
    part = F.split("name", "/")
    known = F.create_map(*(F.lit(x) for pair in PARAMETER_FIELDS.items() for x in pair))
    suffix = F.concat_ws("/", F.try_element_at(part, F.lit(4)), F.try_element_at(part, F.lit(5)))
    return parameters.where(
        F.startswith("name", F.lit(f"/{project}/")) & (F.size(part) == 5) & suffix.isin(*PARAMETER_FIELDS)
    ).select(
        F.element_at(part, 3).alias("environment"),
        F.element_at(known, suffix).alias("field"),
        "value",
    )


def parameter_records(parameters: DataFrame, project: str) -> DataFrame:
    """One record per environment; a missing parameter is NULL.

    The secret itself does not travel: it is reduced to whether it is set before
    the shuffle.
    """
    rows = parameter_rows(parameters, project)
    secret = F.when(F.col("value") != "", F.lit("set"))
    rows = rows.withColumn(
        "value", F.when(F.col("field") == "kaggle_key", secret).otherwise(F.col("value"))
    )
    fields = list(PARAMETER_FIELDS.values())
    wide = rows.groupBy("environment").agg(
        *(F.max(F.when(F.col("field") == name, F.col("value"))).alias(name) for name in fields)
    )
    named = F.coalesce(F.col("kaggle_username") != "", F.lit(False))
    return wide.withColumn("has_credentials", named & F.col("kaggle_key").isNotNull()).drop(
        "kaggle_key"
    )


def records_to_settings(records: DataFrame, destination: str) -> DataFrame:
    """Settings as parameters give them: a bucket name at most, never a path."""
    sink = F.struct(
        F.col("sink_type").alias("type"),
        F.col("sink_bucket").alias("bucket_name"),
        F.lit(None).cast("string").alias("path"),
    )
    return records.select(
        "environment",
        F.when(F.col("sink_type").isNotNull(), sink).alias("sink"),
        parse_url_list(F.col("kaggle_urls")).alias("kaggle_urls"),
        parse_url_list(F.col("crawler_urls")).alias("crawler_urls"),
        "has_credentials",
        F.lit(destination).alias("destination"),
    )


def valid_settings(settings: DataFrame, **rules: object) -> DataFrame:
    """Records that break no rule; ``rules`` are the options of ``settings_rules``."""
    return settings.where(F.size(broken_rules(settings_rules(**rules))) == 0)


def settings_with_fallback(primary: DataFrame, fallback: DataFrame, **rules: object) -> DataFrame:
    """Per environment the primary record if all of it is valid, else the fallback one.

    Records are never mixed field by field. An environment for which neither is
    valid has no row. Credentials are no part of a record: set in either, they are
    there. Each input holds an environment once; both go through one shuffle, so
    neither is computed twice.
    """
    both = primary.withColumn("origin", F.lit("primary")).unionByName(
        fallback.withColumn("origin", F.lit("fallback"))
    )
    either = F.max("has_credentials").over(Window.partitionBy("environment"))
    valid = valid_settings(both.withColumn("has_credentials", either), **rules)
    return resolve_conflicts(valid, LAST, key=["environment"], order=["origin"])
