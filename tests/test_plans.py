"""Physical plans: what is read, what is shuffled, what is computed twice."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from lakeloom.operators.landing import group_candidates, resolve_conflicts, skip_landed
from lakeloom.operators.links import file_rows
from lakeloom.schemas import CANDIDATES, OBJECTS, PAGES
from lakeloom.session import pin, scratch_path
from lakeloom.sinks import SINKS, Layer
from lakeloom.sinks.layer import BUCKETS
from lakeloom.sinks.row_sink import land_rows
from lakeloom.sources import SOURCES, SourceSpec
from lakeloom.sources.scans import read_objects
from lakeloom.streaming.arrivals import stream_objects, stream_rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_conflicts_are_reduced_before_the_shuffle(spark):
    rows = spark.createDataFrame([], CANDIDATES)
    text = plan(resolve_conflicts(rows))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_candidates_are_grouped_before_the_shuffle(spark):
    text = plan(group_candidates(spark.createDataFrame([], CANDIDATES)))
    assert "partial_count" in text and "partial_min" in text
    assert "SortAggregate" not in text and text.count("Exchange") == 1


def test_anti_join_reuses_the_partitioning(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.read.parquet(f"{tables}/documents.parquet").select(F.col("lang").alias("target_key"), "doc_id")
        landed = spark.read.parquet(f"{tables}/documents.parquet").select(
            F.col("source").alias("target_key"), "text")
        text = plan(skip_landed(resolve_conflicts(rows, order=["doc_id"]), landed))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 2
    assert "text#" not in text


def test_few_new_keys_do_not_shuffle_the_layer(spark, tables):
    documents = spark.read.parquet(f"{tables}/documents.parquet")
    rows = documents.select(F.col("lang").alias("target_key"))
    landed = documents.select(F.col("source").alias("target_key"))
    text = plan(skip_landed(rows, landed, few=True))
    assert "LeftSemi" in text and "LeftAnti" in text
    semi = next(line for line in text.splitlines() if "LeftSemi" in line)
    assert "BroadcastHashJoin" in semi


def keyed(spark, names, load_id="old"):
    layer = Layer(scratch_path(spark, "keyed"), spark.createDataFrame([], "k string, v long").schema)
    rows = spark.createDataFrame([(n, i) for i, n in enumerate(names)], layer.schema)
    land_rows(rows, layer, load_id, ["k"], ["v"])
    return layer


def test_only_buckets_of_new_keys_are_read(spark):
    layer = keyed(spark, [f"key {i}" for i in range(500)])
    new = pin(spark.createDataFrame([("key 7",), ("fresh",)], "k string"), "new")
    for df in (layer.unlanded(new, ["k"], "new"), layer.latest(spark, "k", only=new)):
        text = plan(df)
        scans = [line for line in text.splitlines() if "FileScan" in line and "_keys" in line]
        assert scans and all("PartitionFilters" in line and "bucket" in line for line in scans)
    assert [r.k for r in layer.unlanded(new, ["k"], "new").collect()] == ["fresh"]
    assert [(r.k, r.v) for r in layer.latest(spark, "k", only=new).collect()] == [("key 7", 7)]
    files = {f.split("bucket=")[1].split("/")[0] for f in layer.keys(spark, ["k"], [3, 5]).inputFiles()}
    assert len(files) == BUCKETS  # before pruning; the plan above reads the named ones
    pruned = layer.keys(spark, ["k"], [3, 5])
    assert {r.bucket for r in pruned.select("bucket").distinct().collect()} == {3, 5}


def test_no_landing_reads_the_layer(spark, tmp_path, monkeypatch):
    """Rows, objects and both streams look keys up in a few buckets and never scan what has landed."""
    layer, asked = keyed(spark, [f"key {i}" for i in range(50)]), []
    keys = Layer.keys

    def seen(self, session, key=("target_key",), buckets=None):
        asked.append(buckets)
        return keys(self, session, key, buckets)

    def forbidden(self, *rest):
        raise AssertionError("the layer was read")

    (tmp_path / "a.json").write_text('{"k": "key 7", "v": 1}\n{"k": "new", "v": 2}\n')
    objects = Layer(scratch_path(spark, "objects"))
    offered = spark.createDataFrame([(0, "s", 0, 0, "u", "o", "k", None)], CANDIDATES)
    stock = spark.createDataFrame([("o", 1, b"x")], OBJECTS)
    with monkeypatch.context() as patched:
        patched.setattr(Layer, "keys", seen)
        patched.setattr(Layer, "read", forbidden)
        land_rows(spark.createDataFrame([("key 1", 1), ("more", 2)], layer.schema), layer, "two", ["k"], ["v"])
        stream_rows(spark, str(tmp_path), layer.schema, layer, ["k"], ["v"], scratch_path(spark, "cp"),
                    "json").awaitTermination()
        SINKS["s3"](offered, stock, objects, "one")
        stream_objects(spark, str(tmp_path), objects, "raw", scratch_path(spark, "cp")).awaitTermination()
    assert len(asked) == 4 and all(buckets is not None and len(buckets) <= 2 for buckets in asked)
    assert sorted(r.k for r in layer.read(spark).where("v < 3 AND k NOT LIKE 'key%'").collect()) == ["more", "new"]
    assert layer.read(spark).count() == 52 and objects.read(spark).count() == 2


def test_a_load_counts_once_its_keys_are_written(spark):
    layer = keyed(spark, ["a", "b"])
    layer.write(spark.createDataFrame([("c", 1), ("a", 2)], layer.schema), "died")
    assert sorted(r.k for r in layer.read(spark).collect()) == ["a", "b"]
    land_rows(spark.createDataFrame([("c", 5), ("b", 6)], layer.schema), layer, "next", ["k"], ["v"])
    land_rows(spark.createDataFrame([("c", 1), ("d", 2)], layer.schema), layer, "died", ["k"], ["v"])
    assert sorted((r.k, r.v) for r in layer.read(spark).collect()) == [("a", 0), ("b", 1), ("c", 5), ("d", 2)]


def test_bytes_are_not_read_for_names(spark, tables):
    scan = plan(read_objects(spark, tables, "*.parquet").where("length > 10").select("path"))
    assert "content" not in scan and "PushedFilters: [GreaterThan(length,10)" in scan.replace("IsNotNull(length), ", "")


def test_only_listed_pages_are_parsed(spark, tables):
    pages = spark.read.parquet(f"{tables}/pages.parquet")
    urls = pages.limit(3).selectExpr("page_id pos", "url")
    text = plan(SOURCES["crawler"](SourceSpec(urls, "raw", pages=pages, suffix="er")))
    parse = text.index("regexp_extract_all(lambda")
    assert "BroadcastHashJoin [_url" in text[parse:] and "Inner" in text[parse:]


def test_a_url_listed_very_often_is_dealt_out(spark):
    """A hundred thousand listings of one page of ten links: a million candidates, no task with a tenth of them."""
    page = "".join(f"<a href=f{k}.csv>" for k in range(10))
    pages = spark.createDataFrame([(1, "http://h/p", page), (2, "http://h/q", "<a href=one.csv>")], PAGES)
    listed = spark.range(100_000).selectExpr("id pos", "'http://h/p' url")
    listed = listed.unionByName(spark.createDataFrame([(-1, "http://h/q"), (-2, "http://h/gone")], "pos long, url string"))
    rows = SOURCES["crawler"](SourceSpec(listed, "raw", pages=pages))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        rows = SOURCES["crawler"](SourceSpec(listed, "raw", pages=pages))
        tasks = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
        found = {(r.target_key, r.reason): r["count"] for r in rows.groupBy("target_key", "reason").count().collect()}
    finally:
        for name in ("autoBroadcastJoinThreshold", "adaptive.coalescePartitions.enabled"):
            spark.conf.unset(f"spark.sql.{name}")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert found == {**{(f"raw/f{k}.csv", None): 100_000 for k in range(10)}, ("raw/one.csv", None): 1, (None, "page_missing"): 1}
    assert max(tasks) < sum(tasks) / 4 and len(tasks) > 10


def test_links_are_extracted_once(spark, tables):
    pages = spark.read.parquet(f"{tables}/pages.parquet")
    text = plan(file_rows(pages, ".csv"))
    assert text.count("regexp_extract_all(lambda") == 2  # the links and, in them, references
    assert "Python" not in text


@pytest.mark.parametrize("name", ["gold_revenue", "gold_daily_events", "silver_documents",
                                  "first_link_per_key", "source_union", "parameter_pivot"])
def test_no_products_no_python(spark, tables, name):
    text = plan(contract.queries()[name](spark, tables))
    assert not re.search("Cartesian|NestedLoop|Python|ArrowEval", text)


def test_gold_scans_only_its_columns(spark, tables):
    text = plan(contract.queries()["gold_revenue"](spark, tables))
    assert "FileScan parquet [l_orderkey" in text and "l_comment" not in text and "l_tax" not in text
    assert re.search(r"partial_sum\(\(cast\(l_extendedprice", text)


def test_hot_group_reaches_one_task_as_few_rows(spark):
    """Half a million rows of one key: the shuffle moves a handful of rows."""
    rows = spark.range(0, 500_000, 1, 8).selectExpr(
        "'hot' target_key", "id source_ord", "id url_pos", "id link_pos")
    path = scratch_path(spark, "hot")
    df = resolve_conflicts(rows)
    df.write.parquet(path)
    assert spark.read.parquet(path).first().source_ord == 0
