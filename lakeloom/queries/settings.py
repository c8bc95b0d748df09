"""Rules, parameters, settings and gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import parse_url_list
from ..operators.rules import (
    DATASET_SITE_PREFIX,
    parameter_rules,
    settings_rules,
    source_gate,
    with_broken_rules,
)
from ..operators.settings import (
    parameter_records,
    parameter_rows,
    records_to_settings,
    settings_with_fallback,
)
from .catalog import query
from .derived import ctes, derived

PARAMETER_ROWS_SQL = f"""
{ctes("parameters")},
parameter_rows AS (
    SELECT split_part(name, '/', 3) AS environment,
           CASE split_part(name, '/', 4) || '/' || split_part(name, '/', 5)
               WHEN 'sink/type' THEN 'sink_type' WHEN 'sink/bucket_name' THEN 'sink_bucket'
               WHEN 'kaggle/data_source_urls' THEN 'kaggle_urls'
               WHEN 'crawler/data_source_urls' THEN 'crawler_urls'
               WHEN 'kaggle/username' THEN 'kaggle_username'
               WHEN 'kaggle/key' THEN 'kaggle_key' END AS field, value
    FROM parameters WHERE name LIKE '/lake/%' AND len(string_split(name, '/')) = 5
),
parameter_records AS (
    SELECT environment, max(value) FILTER (field = 'sink_type') AS sink_type,
           max(value) FILTER (field = 'sink_bucket') AS sink_bucket,
           max(value) FILTER (field = 'kaggle_urls') AS kaggle_urls,
           max(value) FILTER (field = 'crawler_urls') AS crawler_urls,
           max(value) FILTER (field = 'kaggle_username') AS kaggle_username,
           coalesce(max(value) FILTER (field = 'kaggle_username'), '') <> ''
               AND coalesce(max(value) FILTER (field = 'kaggle_key'), '') <> '' AS has_credentials
    FROM parameter_rows GROUP BY environment
)"""

# Lists of the given data hold no commas inside URLs and no odd hosts, so a
# plain pattern is enough here.
_URLS_OK = "regexp_matches({0}, '^(\\s*https?://[^/ ,]+[^ ,]*\\s*(,|$))*$')"
SETTINGS_SQL = f"""
{ctes("file_settings")},
primary_settings AS (
    SELECT environment, sink_type, CASE WHEN sink_type IS NOT NULL THEN sink_bucket END AS bucket_name,
           NULL AS path, kaggle_urls, crawler_urls, has_credentials, 'raw' AS destination
    FROM parameter_records
),
file_records AS (
    SELECT stage, environment, sink_type,
           CASE WHEN sink_type IS NOT NULL THEN bucket_name END AS bucket_name,
           CASE WHEN sink_type IS NOT NULL THEN path END AS path,
           kaggle_urls, crawler_urls, has_credentials, destination
    FROM file_settings
)"""


def _valid(name: str) -> str:
    return f"""
    SELECT * FROM {name}
    WHERE sink_type IN ('s3', 'local') AND (sink_type <> 's3' OR bucket_name IS NOT NULL)
      AND (sink_type <> 'local' OR path IS NOT NULL) AND destination IS NOT NULL
      AND {_URLS_OK.format('kaggle_urls')} AND {_URLS_OK.format('crawler_urls')}"""


def file_settings(spark: SparkSession, folder: str) -> DataFrame:
    """Derived file records in the shape of a settings table, with their stage."""
    rows = derived(spark, folder, "file_settings")
    sink = F.struct(F.col("sink_type").alias("type"), "bucket_name", "path")
    return rows.select(
        "stage",
        "environment",
        F.when(F.col("sink_type").isNotNull(), sink).alias("sink"),
        parse_url_list(F.col("kaggle_urls")).alias("kaggle_urls"),
        parse_url_list(F.col("crawler_urls")).alias("crawler_urls"),
        "has_credentials",
        "destination",
    )


@query(f"""
WITH {PARAMETER_ROWS_SQL}
SELECT environment, field, CASE
    WHEN field = 'sink_type' AND value NOT IN ('s3', 'local') THEN field
    WHEN field = 'sink_bucket' AND NOT regexp_full_match(value, '[a-z0-9.-]{{3,63}}') THEN field
    WHEN field = 'kaggle_username' AND NOT regexp_full_match(value, '[a-zA-Z0-9_]{{1,50}}') THEN field
    WHEN field = 'kaggle_key' AND NOT regexp_full_match(value, '[a-f0-9]{{32}}') THEN field
    WHEN field = 'kaggle_urls' AND value <> '' AND len(list_filter(string_split(value, ','),
         lambda x: NOT starts_with(trim(x), 'https://'))) > 0 THEN field
    WHEN field = 'crawler_urls' AND value <> '' AND len(list_filter(string_split(value, ','),
         lambda x: NOT starts_with(trim(x), 'https://'))) > 0 THEN field
    ELSE '' END AS broken,
    CASE WHEN field = 'kaggle_urls' AND value <> '' AND len(list_filter(string_split(value, ','),
         lambda x: NOT starts_with(trim(x), 'https://www.kaggle.com/'))) > 0 THEN field
    ELSE '' END AS broken_for_site
FROM parameter_rows
""")
def parameter_checks(spark: SparkSession, folder: str) -> DataFrame:
    rows = parameter_rows(derived(spark, folder, "parameters"), "lake")
    checked = with_broken_rules(rows, parameter_rules())
    site = {"kaggle_urls": parameter_rules(DATASET_SITE_PREFIX)["kaggle_urls"]}
    checked = with_broken_rules(
        checked.withColumnRenamed("broken_rules", "general"), site
    )
    return checked.select(
        "environment",
        "field",
        F.array_join("general", ",").alias("broken"),
        F.array_join("broken_rules", ",").alias("broken_for_site"),
    )


@query(f"WITH {PARAMETER_ROWS_SQL} SELECT * FROM parameter_records")
def parameter_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return parameter_records(derived(spark, folder, "parameters"), "lake")


@query(f"""
WITH {ctes("file_settings")}
SELECT environment, concat_ws(',',
    CASE WHEN stage NOT IN ('dev', 'qc', 'prod') THEN 'environment' END,
    CASE WHEN sink_type IS NULL OR sink_type NOT IN ('s3', 'local') THEN 'sink' END,
    CASE WHEN sink_type IS NULL OR (sink_type = 's3' AND bucket_name IS NULL)
         THEN 'sink_bucket_name' END,
    CASE WHEN sink_type IS NULL OR (sink_type = 'local' AND path IS NULL) THEN 'sink_path' END,
    CASE WHEN NOT {_URLS_OK.format('kaggle_urls')} THEN 'kaggle_urls' END,
    CASE WHEN destination IS NULL THEN 'destination' END,
    CASE WHEN NOT {_URLS_OK.format('crawler_urls')} THEN 'crawler_urls' END) AS broken
FROM file_settings
""")
def settings_checks(spark: SparkSession, folder: str) -> DataFrame:
    staged = file_settings(spark, folder).withColumnRenamed("environment", "name")
    checked = with_broken_rules(
        staged.withColumnRenamed("stage", "environment"), settings_rules()
    )
    return checked.select(
        F.col("name").alias("environment"), F.array_join("broken_rules", ",").alias("broken")
    )


@query(f"""
WITH {PARAMETER_ROWS_SQL}, {SETTINGS_SQL},
first_choice AS ({_valid('primary_settings')}),
second_choice AS ({_valid('file_records')} AND environment NOT IN
    (SELECT environment FROM first_choice))
SELECT environment, 'primary' AS origin, sink_type, bucket_name, path, destination FROM first_choice
UNION ALL
SELECT environment, 'fallback', sink_type, bucket_name, path, destination FROM second_choice
""")
def settings_fallback(spark: SparkSession, folder: str) -> DataFrame:
    records = parameter_records(derived(spark, folder, "parameters"), "lake")
    chosen = settings_with_fallback(
        records_to_settings(records, "raw"),
        file_settings(spark, folder).drop("stage"),
        environments=None,
    )
    return chosen.select(
        "environment",
        "origin",
        F.col("sink.type").alias("sink_type"),
        "sink.bucket_name",
        "sink.path",
        "destination",
    )


@query(f"""
WITH {ctes("file_settings")},
sinks AS (
    SELECT *, CASE WHEN sink_type IS NULL THEN 'sink_missing'
        WHEN sink_type NOT IN ('s3', 'local') THEN 'sink_type_unknown'
        WHEN sink_type = 's3' AND coalesce(bucket_name, '') = '' THEN 'bucket_name_missing'
        WHEN sink_type = 'local' AND coalesce(path, '') = '' THEN 'path_missing' END AS no_sink
    FROM file_settings
)
SELECT environment, 'kaggle' AS source_type, coalesce(no_sink, CASE WHEN kaggle_urls = ''
    THEN 'no_urls' WHEN NOT has_credentials THEN 'no_credentials' END) AS reason FROM sinks
UNION ALL
SELECT environment, 'crawler', coalesce(no_sink, CASE WHEN crawler_urls = '' THEN 'no_urls' END)
FROM sinks
""")
def source_gates(spark: SparkSession, folder: str) -> DataFrame:
    return source_gate(file_settings(spark, folder))


@query(f"""
WITH {PARAMETER_ROWS_SQL}, {SETTINGS_SQL},
first_choice AS ({_valid('primary_settings')}),
second_choice AS ({_valid('file_records')} AND environment NOT IN
    (SELECT environment FROM first_choice)),
either AS (
    SELECT environment, bool_or(has_credentials) AS has_credentials FROM (
        SELECT environment, has_credentials FROM primary_settings
        UNION ALL SELECT environment, has_credentials FROM file_records) GROUP BY environment
),
chosen AS (
    SELECT environment, sink_type, bucket_name, path, kaggle_urls, crawler_urls FROM first_choice
    UNION ALL
    SELECT environment, sink_type, bucket_name, path, kaggle_urls, crawler_urls FROM second_choice
),
gated AS (
    SELECT *, CASE WHEN sink_type = 's3' AND bucket_name = '' THEN 'bucket_name_missing'
        WHEN sink_type = 'local' AND path = '' THEN 'path_missing' END AS no_sink FROM chosen
)
SELECT environment, 'kaggle' AS source_type, coalesce(no_sink, CASE
    WHEN coalesce(trim(replace(kaggle_urls, ',', '')), '') = '' THEN 'no_urls'
    WHEN NOT coalesce(has_credentials, false) THEN 'no_credentials' END) AS reason
FROM gated JOIN either USING (environment)
UNION ALL
SELECT environment, 'crawler', coalesce(no_sink, CASE
    WHEN coalesce(trim(replace(crawler_urls, ',', '')), '') = '' THEN 'no_urls' END) FROM gated
""")
def fallback_gates(spark: SparkSession, folder: str) -> DataFrame:
    """Which sources run with the chosen record and the credentials of either."""
    records = parameter_records(derived(spark, folder, "parameters"), "lake")
    chosen = settings_with_fallback(
        records_to_settings(records, "raw"),
        file_settings(spark, folder).drop("stage"),
        environments=None,
    )
    return source_gate(chosen)
