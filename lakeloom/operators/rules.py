"""Row rules: which rules a row breaks, and what goes on from there."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import WHITESPACE
from ..functions.urls import is_http_url

# The allowed names and forms.
ENVIRONMENTS = ("dev", "qc", "prod")
SINK_TYPES = ("s3", "local")
BUCKET_PATTERN = r"^[a-z0-9.-]{3,63}\z"
USERNAME_PATTERN = r"^[a-zA-Z0-9_]{1,50}\z"
KEY_PATTERN = r"^[a-f0-9]{32}\z"
LAKE_PATTERN = r"^[a-zA-Z0-9-]+\z"
HTTPS_PREFIX = r"^https://"
DATASET_SITE_PREFIX = r"^https://www.kaggle.com/"

# What the list rule trims: white space without the four separator controls.
_LIST_TRIM = "".join(c for c in WHITESPACE if not "\x1c" <= c <= "\x1f")


def broken_rules(rules: dict[str, Column]) -> Column:
    """Names of the rules a row breaks, in the given order. NULL breaks a rule."""
    return F.array_compact(
        F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()))
    )


def matches(c: Column, pattern: str) -> Column:
    return F.rlike(c, F.lit(pattern))


def https_list(text: Column, prefix: str = HTTPS_PREFIX) -> Column:
    """Empty text, or every comma-separated element starts like ``prefix``."""
    every = F.forall(
        F.split(text, ","), lambda url: F.rlike(F.btrim(url, F.lit(_LIST_TRIM)), F.lit(prefix))
    )
    return (text == "") | every


def parameter_rules(dataset_prefix: str = HTTPS_PREFIX) -> dict[str, Column]:
    """Rules for rows ``(field, value)``: each holds for all other fields."""
    field, value = F.col("field"), F.col("value")

    def on(name: str, ok: Column) -> Column:
        return (field != name) | ok

    return {
        "sink_type": on("sink_type", value.isin(*SINK_TYPES)),
        "sink_bucket": on("sink_bucket", matches(value, BUCKET_PATTERN)),
        "kaggle_username": on("kaggle_username", matches(value, USERNAME_PATTERN)),
        "kaggle_key": on("kaggle_key", matches(value, KEY_PATTERN)),
        "kaggle_urls": on("kaggle_urls", https_list(value, dataset_prefix)),
        "crawler_urls": on("crawler_urls", https_list(value)),
    }


def settings_rules(
    with_crawler: bool = True, environments: Sequence[str] | None = ENVIRONMENTS
) -> dict[str, Column]:
    """Rules a settings record must meet as a whole. ``environments`` None allows any name."""
    sink = F.col("sink")

    def urls(name: str) -> Column:
        return F.forall(F.col(name), is_http_url)

    name = F.col("environment")
    rules = {
        "environment": name.isNotNull() if environments is None else name.isin(*environments),
        "sink": sink["type"].isin(*SINK_TYPES),
        "sink_bucket_name": (sink["type"] != "s3") | sink["bucket_name"].isNotNull(),
        "sink_path": (sink["type"] != "local") | sink["path"].isNotNull(),
        "kaggle_urls": urls("kaggle_urls"),
        "destination": F.col("destination").isNotNull(),
    }
    if with_crawler:
        rules["crawler_urls"] = urls("crawler_urls")
    return rules


def with_broken_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    return df.withColumn("broken_rules", broken_rules(rules))


def accepted(df: DataFrame, reason: str = "reason") -> DataFrame:
    return df.where(F.col(reason).isNull())


def rejected(df: DataFrame, reason: str = "reason") -> DataFrame:
    return df.where(F.col(reason).isNotNull())


def source_gate(settings: DataFrame) -> DataFrame:
    """Rows ``(environment, source_type, reason)``; a source runs if ``reason`` is NULL.

    A sink without its own field stops both sources; each source then needs
    URLs, and the archive source also its credentials.
    """
    sink = F.col("sink")

    def blank(c: Column) -> Column:
        return F.coalesce(c, F.lit("")) == ""

    def no_urls(name: str) -> Column:
        return F.coalesce(F.size(F.col(name)), F.lit(0)) <= 0

    no_sink = (
        F.when(sink["type"].isNull(), F.lit("sink_missing"))
        .when(~sink["type"].isin(*SINK_TYPES), F.lit("sink_type_unknown"))
        .when((sink["type"] == "s3") & blank(sink["bucket_name"]), F.lit("bucket_name_missing"))
        .when((sink["type"] == "local") & blank(sink["path"]), F.lit("path_missing"))
    )
    no_credentials = ~F.coalesce(F.col("has_credentials"), F.lit(False))
    archive = F.coalesce(
        no_sink,
        F.when(no_urls("kaggle_urls"), F.lit("no_urls")).when(
            no_credentials, F.lit("no_credentials")
        ),
    )
    crawler = F.coalesce(no_sink, F.when(no_urls("crawler_urls"), F.lit("no_urls")))
    gates = F.array(
        F.struct(F.lit("kaggle").alias("source_type"), archive.alias("reason")),
        F.struct(F.lit("crawler").alias("source_type"), crawler.alias("reason")),
    )
    return settings.select("environment", F.inline(gates))
