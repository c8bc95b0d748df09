"""Rules, gates, parameters, fallback."""

from pyspark.sql import functions as F

from lakeloom.functions.urls import parse_url_list
from lakeloom.operators.lists import choose_list, join_url_rows, second_or_first_rows, url_rows
from lakeloom.operators.rules import (
    DATASET_SITE_PREFIX,
    accepted,
    https_list,
    parameter_rules,
    rejected,
    settings_rules,
    source_gate,
    with_broken_rules,
)
from lakeloom.operators.settings import (
    parameter_records,
    records_to_settings,
    settings_with_fallback,
)
from lakeloom.schemas import PARAMETERS, SETTINGS, SOURCE_URLS

URLS = ["https://www.kaggle.com/datasets/o/n"]


def record(environment="dev", sink=("s3", "bucket", None), kaggle=URLS, crawler=URLS,
           credentials=True, destination="raw/"):
    return (environment, sink, kaggle, crawler, credentials, destination)


def broken(spark, records, **options):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(records)], "i int, " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in SETTINGS.fields))
    rows = with_broken_rules(df, settings_rules(**options)).select("i", "broken_rules").collect()
    return [r.broken_rules for r in sorted(rows, key=lambda r: r.i)]


def test_settings_rules(spark):
    assert broken(spark, [
        record(),
        record(sink=("local", None, "/data")),
        record(sink=("s3", None, "/data")),
        record(sink=("s3", "", None)),
        record(sink=("local", "bucket", None)),
        record(sink=("gcs", "bucket", "/data")),
        record(sink=None),
        record(environment="staging"),
        record(kaggle=[]),
        record(kaggle=None, crawler=["https://ok.org", "ftp://no.org"]),
        record(destination=None),
    ]) == [
        [], [], ["sink_bucket_name"], [], ["sink_path"], ["sink"],
        ["sink", "sink_bucket_name", "sink_path"], ["environment"], [],
        ["kaggle_urls", "crawler_urls"], ["destination"],
    ]
    assert broken(spark, [record(crawler=None)], with_crawler=False) == [[]]
    assert broken(spark, [record(environment="any")], environments=None) == [[]]


def test_parameter_rules(spark):
    cases = [
        ("sink_type", "s3", True), ("sink_type", "S3", False), ("sink_type", None, False),
        ("sink_bucket", "my-bucket.1", True), ("sink_bucket", "ab", False),
        ("sink_bucket", "My-bucket", False), ("sink_bucket", "b" * 63, True),
        ("sink_bucket", "b" * 64, False), ("sink_bucket", "bucket\n", False),
        ("kaggle_username", "a_B9", True), ("kaggle_username", "", False),
        ("kaggle_username", "a-b", False), ("kaggle_username", "u" * 51, False),
        ("kaggle_key", "0123456789abcdef" * 2, True), ("kaggle_key", "A" * 32, False),
        ("kaggle_urls", "", True), ("kaggle_urls", "https://a, https://b", True),
        ("kaggle_urls", "https://a,", False), ("kaggle_urls", "https://a,http://b", False),
        ("crawler_urls", " https://a", True), ("crawler_urls", "x", False),
    ]
    df = spark.createDataFrame([(i, *c[:2]) for i, c in enumerate(cases)],
                               "i int, field string, value string")
    rows = with_broken_rules(df, parameter_rules()).collect()
    got = [r.broken_rules for r in sorted(rows, key=lambda r: r.i)]
    assert got == [[] if ok else [field] for field, _, ok in cases]
    site = spark.createDataFrame([("https://www.kaggle.com/x",), ("https://kaggle.com/x",)], "u string")
    assert [r[0] for r in site.select(https_list(F.col("u"), DATASET_SITE_PREFIX)).collect()] == [
        True, False]


def test_source_gate(spark):
    records = {
        "ok": record(),
        "no_sink": record(sink=None),
        "empty_bucket": record(sink=("s3", "", "/p")),
        "empty_path": record(sink=("local", "b", "")),
        "other": record(sink=("gcs", "b", "/p")),
        "no_urls": record(kaggle=[], crawler=None),
        "no_credentials": record(credentials=False),
        "unset": record(credentials=None),
    }
    df = spark.createDataFrame([(k, *v[1:]) for k, v in records.items()], SETTINGS)
    got = {(r.environment, r.source_type): r.reason for r in source_gate(df).collect()}
    want = {
        "ok": (None, None),
        "no_sink": ("sink_missing",) * 2,
        "empty_bucket": ("bucket_name_missing",) * 2,
        "empty_path": ("path_missing",) * 2,
        "other": ("sink_type_unknown",) * 2,
        "no_urls": ("no_urls",) * 2,
        "no_credentials": ("no_credentials", None),
        "unset": ("no_credentials", None),
    }
    assert got == {(k, s): v[i] for k, v in want.items() for i, s in enumerate(("kaggle", "crawler"))}


def parameters(spark, environment, **values):
    names = {"sink_type": "sink/type", "bucket": "sink/bucket_name",
             "kaggle": "kaggle/data_source_urls", "crawler": "crawler/data_source_urls",
             "user": "kaggle/username", "key": "kaggle/key"}
    rows = [(f"/proj/{environment}/{names[k]}", v, "String") for k, v in values.items()]
    return spark.createDataFrame(rows, PARAMETERS)


FULL = dict(sink_type="s3", bucket="my-bucket", kaggle=URLS[0] + " , ", crawler="https://c.org",
            user="me", key="0" * 32)


def test_parameters_to_settings(spark):
    partial = {k: v for k, v in FULL.items() if k not in ("sink_type", "crawler", "key")}
    rows = parameters(spark, "dev", **FULL).union(parameters(spark, "qc", **partial))
    rows = rows.union(spark.createDataFrame([("/else/dev/sink/type", "x", ""), ("/proj/dev/a", "x", ""),
                                             ("/proj/dev/sink/type/y", "x", "")], PARAMETERS))
    records = parameter_records(rows, "proj")
    assert "kaggle_key" not in records.columns
    got = {r.environment: r for r in records_to_settings(records, "raw").collect()}
    assert set(got) == {"dev", "qc"}
    assert got["dev"].sink.asDict() == {"type": "s3", "bucket_name": "my-bucket", "path": None}
    assert got["dev"].kaggle_urls == URLS and got["dev"].has_credentials
    assert got["qc"].sink is None and got["qc"].crawler_urls is None
    assert not got["qc"].has_credentials


def test_fallback_is_all_or_nothing(spark):
    local = dict(FULL, sink_type="local")  # parameters hold no path, so this cannot validate
    primary = records_to_settings(parameter_records(
        parameters(spark, "dev", **FULL).union(parameters(spark, "qc", **local)), "proj"), "raw")
    fallback = spark.createDataFrame([
        record("dev", sink=("local", None, "/f")),
        record("qc", sink=("local", None, "/f"), kaggle=[]),
        record("prod", sink=("s3", None, None)),
    ], SETTINGS)
    got = {r.environment: r for r in settings_with_fallback(primary, fallback).collect()}
    assert set(got) == {"dev", "qc"}
    assert got["dev"].origin == "primary" and got["dev"].sink.bucket_name == "my-bucket"
    assert got["qc"].origin == "fallback" and got["qc"].kaggle_urls == []
    assert got["qc"].sink.path == "/f" and got["qc"].sink.bucket_name is None


def test_quarantine_splits_whole_input(spark):
    df = spark.range(100).withColumn("reason", F.when(F.col("id") < 30, F.lit("low")))
    assert rejected(df).count() == 30 and accepted(df).count() == 70


def test_list_rows(spark):
    df = spark.createDataFrame([("dev", "kaggle", " a,b,,a"), ("qc", "kaggle", "")], SOURCE_URLS)
    rows = [(r.env, r.pos, r.url) for r in url_rows(df, "urls", ["env"]).collect()]
    assert sorted(rows) == [("dev", 0, "a"), ("dev", 1, "b"), ("dev", 2, "a")]
    arrays = df.withColumn("urls", parse_url_list(F.col("urls")))
    assert sorted(tuple(r) for r in url_rows(arrays, "urls", ["env"]).collect()) == sorted(rows)
    chosen = choose_list(arrays, F.col("env"), F.col("urls"), "dev").collect()
    assert [r.urls for r in chosen] == ["a,b,a"]


def test_group_lists_with_one_large_group(spark):
    """One group holds most rows: 20,000 of 20,004, in scrambled input order."""
    rows = spark.range(20000).select(F.lit("hot").alias("g"), F.col("id").alias("pos"),
                                     F.concat(F.lit("u"), F.col("id")).alias("url"))
    rows = rows.union(spark.createDataFrame([("b", 0, "x"), ("b", 7, "y"), ("b", 9, "z"), ("c", 5, "w")],
                                            "g string, pos long, url string"))
    rows = rows.orderBy(F.hash("url"))
    text = {r.g: r.urls for r in join_url_rows(rows, ["g"], "pos", "url").collect()}
    assert text == {"hot": ",".join(f"u{i}" for i in range(20000)), "b": "x,y,z", "c": "w"}
    picked = {r.g: r.url for r in second_or_first_rows(rows, ["g"], ["pos"]).collect()}
    assert picked == {"hot": "u1", "b": "y", "c": "w"}
