"""Conflicts, sources, sinks, whole runs."""

import pytest
from pyspark.sql import functions as F

from lakeloom.operators.landing import FIRST, LAST, resolve_conflicts, skip_landed
from lakeloom.plans.ingest import Fetched, NotConfigured, ingest, ingest_all
from lakeloom.schemas import CANDIDATES, OBJECTS, PAGES, SETTINGS
from lakeloom.session import pin, scratch_path, shared_dir
from lakeloom.sinks import SINKS, Layer, layer_root, sink
from lakeloom.sinks import layer as layers
from lakeloom.sinks import object_sinks
from lakeloom.sinks.object_sinks import rewrite
from lakeloom.sinks.row_sink import land_rows
from lakeloom.sources import SOURCES, SourceSpec, candidates, source
from lakeloom.sources.scans import archive_objects, file_names, read_csv, read_json, read_objects


def candidate(order, key, object_id=None, reason=None, source_type="crawler"):
    return (*order[:1], source_type, *order[1:], "http://p", object_id or f"o-{key}", key, reason)


def offer(spark, *rows):
    return spark.createDataFrame([*rows], CANDIDATES)


def stock(spark, **bodies):
    rows = [(k, len(v), v.encode()) for k, v in bodies.items()]
    return spark.createDataFrame(rows, OBJECTS)


def table(layer, spark):
    return {r.target_key: r.content.decode() for r in layer.read(spark).collect()}


def counts(outcomes):
    return {(r.source_type, r.status): r.n for r in outcomes.collect()}


def test_first_and_last(spark):
    rows = offer(spark, candidate((1, 0, 5), "k"), candidate((0, 9, 9), "k"), candidate((1, 0, 4), "k"),
                 candidate((1, 2, 0), "u"))
    for mode, want in ((FIRST, (0, 9, 9)), (LAST, (1, 0, 5))):
        got = {r.target_key: (r.source_ord, r.url_pos, r.link_pos)
               for r in resolve_conflicts(rows, mode).collect()}
        assert got == {"k": want, "u": (1, 2, 0)}
    with pytest.raises(ValueError):
        resolve_conflicts(rows, "any")


def test_modes_agree_on_unique_keys(spark):
    rows = spark.range(1000).select(F.col("id").alias("target_key"), F.rand(1).alias("o"))
    first = resolve_conflicts(rows, FIRST, order=["o"])
    last = resolve_conflicts(rows, LAST, order=["o"])
    assert first.exceptAll(last).isEmpty() and first.count() == 1000


def test_skip_landed(spark):
    rows = spark.range(10).select(F.col("id").alias("target_key"))
    landed = rows.where("target_key < 7")
    for few in (False, True):
        left = skip_landed(rows, landed, few=few)
        assert sorted(r.target_key for r in left.collect()) == [7, 8, 9]


def test_object_sink(spark):
    layer = Layer(scratch_path(spark, "b"))
    rows = offer(
        spark,
        candidate((0, 0, 0), "a.zip", "za", source_type="kaggle"),
        candidate((0, 1, 0), None, None, "no_dataset_name", "kaggle"),
        candidate((1, 0, 0), "a.zip", "other"),
        candidate((1, 0, 1), "b.csv", "gone"),
        candidate((1, 0, 2), "b.csv", "b2"),
        candidate((1, 1, 0), "b.csv", "b2"),
        candidate((1, 2, 0), None, None, "page_missing"),
    )
    objects = stock(spark, za="ZIP", other="not me", b2="bee", unused="x")
    got = counts(SINKS["s3"](rows, objects, layer, "one"))
    assert got == {
        ("kaggle", "landed"): 1, ("kaggle", "rejected"): 1, ("crawler", "landed"): 1,
        ("crawler", "skipped_exists"): 2, ("crawler", "failed"): 2,
    }
    assert sum(got.values()) == rows.count()
    assert table(layer, spark) == {"a.zip": "ZIP", "b.csv": "bee"}
    types = {r.target_key: (r.content_type, r.length) for r in layer.read(spark).collect()}
    assert types == {"a.zip": ("application/zip", 3), "b.csv": ("text/csv", 3)}

    # Landing again adds nothing; a repeated load id leaves the same table.
    again = counts(SINKS["s3"](rows, objects, layer, "two"))
    assert not any(status == "landed" for _, status in again)
    assert again[("crawler", "skipped_exists")] == 3
    repeated = counts(SINKS["s3"](rows, objects, layer, "one"))
    assert repeated == got and layer.read(spark).count() == 2


def test_large_loads_take_the_other_join(spark):
    """Beyond the broadcast bound, or with broadcasts off, the same table results."""
    rows = offer(spark, *(candidate((0, i, 0), f"k{i % 40}", f"o{i}") for i in range(100)))
    objects = stock(spark, **{f"o{i}": f"body {i}" for i in range(0, 100, 3)})
    objects = objects.union(stock(spark, o0="x"))
    tables = []
    for bound, threshold in ((layers.BROADCAST_BYTES, None), (10, None), (10, "-1")):
        layer = Layer(scratch_path(spark, "b"))
        kept, layers.BROADCAST_BYTES = layers.BROADCAST_BYTES, bound
        try:
            if threshold:
                spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            SINKS["s3"](rows, objects, layer)
        finally:
            layers.BROADCAST_BYTES = kept
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        tables.append(table(layer, spark))
    assert tables[0] == tables[1] == tables[2]
    first = {}
    for i in range(0, 100, 3):
        first.setdefault(f"k{i % 40}", f"body {i}")
    assert tables[0] == first


def test_crawl_of_repeated_pages_and_invalid_urls(spark):
    pages = spark.createDataFrame(
        [(2, "http://h/p", "<a href=late.csv>"), (1, "http://H/p", "<a href=a.csv><a href=b.csv>"),
         (3, "not a url", "<a href=x.csv>"), (4, "http://h/empty", "<p>")], PAGES)
    urls = spark.createDataFrame(
        [(0, "http://h/p"), (1, "http://h:80/p"), (2, "junk"), (3, "junk"), (4, "http://h/empty")],
        "pos long, url string")
    rows = SOURCES["crawler"](SourceSpec(urls, "raw", pages=pages)).collect()
    got = sorted((r.url_pos, r.link_pos, r.target_key, r.reason) for r in rows if r.target_key)
    assert got == [(p, i, f"raw/{n}.csv", None) for p in (0, 1) for i, n in enumerate("ab")]
    missing = sorted((r.url_pos, r.reason) for r in rows if not r.target_key)
    assert missing == [(2, "page_missing"), (3, "page_missing")]


def test_object_fetched_twice_lands_once(spark):
    layer = Layer(scratch_path(spark, "b"))
    rows = offer(spark, candidate((0, 0, 0), "k", "o"), candidate((0, 0, 1), "l", "p"))
    objects = stock(spark, o="long body", p="p").union(stock(spark, o="short")).union(
        stock(spark, o="long body"))
    SINKS["s3"](rows, objects, layer)
    assert layer.read(spark).count() == 2
    assert table(layer, spark) == {"k": "long body", "l": "p"}


def test_items_tell_what_became_of_each(spark):
    layer = Layer(scratch_path(spark, "b"))
    rows = offer(spark, candidate((0, 0, 0), "k", "a"), candidate((0, 1, 0), "k", "a"),
                 candidate((0, 2, 0), "k", "b"), candidate((0, 3, 0), "l", "gone"),
                 candidate((0, 4, 0), None, "none", "page_missing"))
    objects = stock(spark, a="A", b="B")
    for mode, want in (
        (FIRST, {("k", "a", "landed", 1), ("k", "a", "skipped_exists", 1), ("k", "b", "skipped_exists", 1)}),
        (LAST, {("k", "a", "landed", 2), ("k", "b", "landed", 1)}),
    ):
        decision = object_sinks.decide(rows, objects, layer, mode, "x")
        items = decision.items().collect()
        got = {(r.target_key, r.object_id, r.status, r.n) for r in items}
        assert got == want | {("l", "gone", "failed", 1), (None, "none", "failed", 1)}
        assert sum(r.n for r in items) == 5
        totals = {}
        for r in items:
            totals[(r.source_type, r.status)] = totals.get((r.source_type, r.status), 0) + r.n
        assert totals == counts(decision.counts())


def test_overwriting_sink(spark):
    layer = Layer(scratch_path(spark, "l"))
    rows = offer(spark, candidate((0, 0, 0), "k", "a"), candidate((0, 0, 1), "k", "b"),
                 candidate((0, 0, 2), "k", "gone"), candidate((0, 1, 0), "u", "u"))
    got = counts(SINKS["local"](rows, stock(spark, a="A", b="B", u="U"), layer, "1"))
    assert got == {("crawler", "landed"): 3, ("crawler", "failed"): 1}
    assert table(layer, spark) == {"k": "B", "u": "U"}
    SINKS["local"](rows, stock(spark, a="new"), layer, "2")
    newest = {r.target_key: r.content.decode() for r in layer.latest(spark).collect()}
    assert newest == {"k": "new", "u": "U"}
    fresh = rewrite(layer, Layer(scratch_path(spark, "l")), spark)
    assert table(fresh, spark) == newest
    with pytest.raises(ValueError):
        rewrite(layer, layer, spark)


def test_hot_key_and_hot_object(spark):
    """A third of all candidates share one object, another third one key."""
    n = 30000
    ids = spark.range(n)
    third = F.col("id") % 3
    rows = ids.select(
        F.lit(0).alias("source_ord"), F.lit("crawler").alias("source_type"),
        F.col("id").alias("url_pos"), F.lit(0).cast("long").alias("link_pos"), F.lit("u").alias("url"),
        F.when(third == 0, "hot").otherwise(F.concat(F.lit("o"), "id")).alias("object_id"),
        F.when(third == 0, "h").when(third == 1, "popular").otherwise(F.concat(F.lit("k"), "id"))
        .alias("target_key"), F.lit(None).cast("string").alias("reason"))
    objects = rows.select("object_id").distinct().select(
        "object_id", F.lit(1).cast("long").alias("length"), F.lit(b"x").alias("content"))
    layer = Layer(scratch_path(spark, "hot"))
    got = counts(SINKS["s3"](rows, objects, layer))
    assert got == {("crawler", "landed"): n // 3 + 2, ("crawler", "skipped_exists"): 2 * n // 3 - 2}
    assert layer.read(spark).count() == n // 3 + 2


def test_land_rows_is_repeatable(spark):
    layer = Layer(scratch_path(spark, "rows"), spark.range(1).schema)
    land_rows(spark.range(5).union(spark.range(3)), layer, "a", ["id"], ["id"])
    land_rows(spark.range(8), layer, "b", ["id"], ["id"])
    land_rows(spark.range(8), layer, "b", ["id"], ["id"])
    assert sorted(r.id for r in layer.read(spark).collect()) == list(range(8))
    assert layer.read(spark, besides="a").count() == 3


def test_rows_without_a_key_all_land(spark):
    schema = spark.createDataFrame([], "k string, v long").schema
    layer = Layer(scratch_path(spark, "rows"), schema)
    rows = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", 4)], schema)
    land_rows(rows, layer, "1", ["k"], ["v"])
    assert {(r.k, r.v) for r in layer.read(spark).collect()} == {(None, 1), (None, 2), ("a", 3)}


def test_layer_names(spark):
    assert layer_root("data-lake", "bronze", "s3a://x/") == "s3a://x/data-lake-bronze"
    assert layer_root("data-lake", "silver", "/lakes") == "/lakes/data-lake-silver"
    assert layer_root("data-lake", "gold", "s3a://") == "s3a://data-lake-gold"
    assert layer_root("data-lake", "gold") == "data-lake-gold"
    for bad in (("a_b", "bronze"), ("", "bronze"), ("a", "tin"), ("a\n", "gold")):
        with pytest.raises(ValueError):
            layer_root(*bad)
    with pytest.raises(ValueError):
        Layer("x").load_path("../y", 1)


def test_loads_count_in_the_order_they_were_written(spark):
    layer = Layer(scratch_path(spark, "l"))
    rows = offer(spark, candidate((0, 0, 0), "k", "a"))
    for load_id in ("load-9", "load-10", "a"):
        SINKS["local"](rows, stock(spark, a=load_id), layer, load_id)
    newest = [r.content.decode() for r in layer.latest(spark).collect()]
    assert newest == ["a"]
    # A load that runs again keeps its place.
    SINKS["local"](rows, stock(spark, a="again"), layer, "load-9")
    assert [r.content.decode() for r in layer.latest(spark).collect()] == ["a"]


PAGE = "<a href=one.csv>1</a><a href='/two.csv'>2</a><a href=no.txt>n</a><a href=one.csv>again</a>"


def fetched(spark):
    pages = spark.createDataFrame([
        (1, "https://site.org/list/", PAGE),
        (2, "https://Other.org", "<a href='https://site.org/x/two.csv'>"),
    ], PAGES)
    objects = stock(spark, **{
        "own/data.zip": "archive", "https://site.org/list/one.csv": "1",
        "https://site.org/two.csv": "2", "https://site.org/x/two.csv": "22"})
    return Fetched(pages, objects)


def settings(spark, sink=("s3", "bucket", None), credentials=True):
    kaggle = ["https://www.kaggle.com/datasets/first/one", "HTTPS://www.Kaggle.com/datasets/own/data/x",
              "https://example.org/nothing"]
    crawler = ["https://SITE.org/list/", "https://other.org/", "https://missing.org"]
    return spark.createDataFrame([("dev", sink, kaggle, crawler, credentials, "raw/dev")], SETTINGS)


def test_run_into_object_layer(spark):
    base = scratch_path(spark, "run")
    out = counts(ingest(settings(spark), "dev", fetched(spark), base=base))
    assert out == {
        ("kaggle", "landed"): 1, ("kaggle", "failed"): 1, ("kaggle", "rejected"): 1,
        ("crawler", "landed"): 2, ("crawler", "skipped_exists"): 2, ("crawler", "failed"): 1}
    assert table(Layer(f"{base}/bucket"), spark) == {
        "raw/dev/own_data.zip": "archive", "raw/dev/one.csv": "1", "raw/dev/two.csv": "2"}


def test_run_selecting_one_archive(spark):
    base = scratch_path(spark, "run")
    out = counts(ingest(settings(spark), "dev", fetched(spark), base=base, select="second_or_first"))
    assert {k: v for k, v in out.items() if k[0] == "kaggle"} == {("kaggle", "landed"): 1}


def test_run_into_overwriting_layer(spark):
    path = scratch_path(spark, "run")
    out = counts(ingest(settings(spark, ("local", None, path), False), "dev", fetched(spark)))
    assert out == {("crawler", "landed"): 4, ("crawler", "failed"): 1}
    assert table(Layer(path), spark) == {f"{path}/one.csv": "1", f"{path}/two.csv": "22"}


def test_run_without_a_crawler(spark):
    base = scratch_path(spark, "run")
    out = counts(ingest(settings(spark).drop("crawler_urls"), "dev", fetched(spark), base=base))
    assert {source for source, _ in out} == {"kaggle"} and out[("kaggle", "landed")] == 1
    none = ingest(settings(spark, credentials=False).drop("crawler_urls"), "dev", fetched(spark), base=base)
    assert none.isEmpty()


def by_environment(outcomes):
    return {(r.environment, r.source_type, r.status): r.n for r in outcomes.collect()}


def test_run_over_all_environments(spark):
    """Two environments share a bucket, one overwrites, one has no sink, one is there twice."""
    base = scratch_path(spark, "run")
    one = settings(spark).drop("environment")
    named = lambda name, rows: rows.withColumn("environment", F.lit(name)).select("environment", *one.columns)
    local = settings(spark, ("local", None, f"{base}/local"), False).drop("environment")
    no_sink = settings(spark, None).drop("environment")
    control = named("dev", one)
    for name, rows in (("prod", one), ("qc", local), ("none", no_sink), ("twice", one), ("twice", local)):
        control = control.unionByName(named(name, rows))
    got = by_environment(ingest_all(control, fetched(spark), base=base, load_id="x"))
    first = {("kaggle", "landed"): 1, ("kaggle", "failed"): 1, ("kaggle", "rejected"): 1,
             ("crawler", "landed"): 2, ("crawler", "skipped_exists"): 2, ("crawler", "failed"): 1}
    second = {("kaggle", "skipped_exists"): 1, ("kaggle", "failed"): 1, ("kaggle", "rejected"): 1,
              ("crawler", "skipped_exists"): 4, ("crawler", "failed"): 1}
    over = {("kaggle", "not_run"): 3, ("crawler", "landed"): 4, ("crawler", "failed"): 1}
    none = {("kaggle", "not_run"): 3, ("crawler", "not_run"): 3}
    want = {"dev": first, "prod": second, "qc": over, "none": none, "twice": {k: 2 * n for k, n in none.items()}}
    assert got == {(name, *key): n for name, counted in want.items() for key, n in counted.items()}
    assert table(Layer(f"{base}/bucket"), spark) == {
        "raw/dev/own_data.zip": "archive", "raw/dev/one.csv": "1", "raw/dev/two.csv": "2"}
    assert table(Layer(f"{base}/local"), spark) == {f"{base}/local/one.csv": "1", f"{base}/local/two.csv": "22"}
    # The same run as one environment alone.
    alone = scratch_path(spark, "run")
    single = {(k[1], k[2]): n for k, n in by_environment(ingest_all(named("dev", one), fetched(spark), base=alone)).items()}
    assert single == counts(ingest(settings(spark), "dev", fetched(spark), base=f"{alone}-2"))
    assert ingest_all(control.where("environment = 'none'"), fetched(spark), base=alone).count() == 2


def test_run_refuses_bad_settings(spark):
    with pytest.raises(NotConfigured):
        ingest(settings(spark), "prod", fetched(spark))
    with pytest.raises(NotConfigured, match="bucket_name_missing"):
        ingest(settings(spark, ("s3", "", None)), "dev", fetched(spark))


def test_registries_take_new_members(spark):
    @source("static")
    def static(spec):
        return offer(spark, candidate((0, 0, 0), "k")).drop("source_ord")

    seen = []

    @sink("count")
    def count(rows, objects, layer, load_id=None):
        seen.append(rows.count())
        return rows.groupBy("source_type").count()

    try:
        spec = SourceSpec(spark.range(0).selectExpr("id pos", "'' url"), "raw")
        rows = candidates([("static", spec), ("static", spec)])
        assert sorted(r.source_ord for r in rows.collect()) == [0, 1]
        SINKS["count"](rows, None, None)
        assert seen == [2]
    finally:
        SOURCES.pop("static"), SINKS.pop("count")


def test_scans(spark):
    path = scratch_path(spark, "files")
    rows = spark.createDataFrame([("own", "abc"), ("two", "de")], "owner string, body string")
    rows.write.partitionBy("owner").text(path)
    objects = read_objects(spark, path, "*.txt")
    assert sorted(r.length for r in objects.collect()) == [3, 4]
    assert read_objects(spark, path, "*.zip").count() == 0
    names = [r.name for r in file_names(objects).collect()]
    assert all(n.startswith("part-") and "/" not in n for n in names)
    assert all(r.object_id.count("/") == 1 for r in archive_objects(objects).collect())

    csv = scratch_path(spark, "csv")
    spark.createDataFrame([("k,v",), ("1,x",), ("two,y",), ("3",)], "l string").coalesce(1).write.text(csv)
    schema = spark.createDataFrame([], "k int, v string").schema
    got = {(r.k, r.v, r._corrupt_record) for r in read_csv(spark, csv, schema).collect()}
    assert got == {(1, "x", None), (None, "y", "two,y"), (3, None, "3")}
    json = scratch_path(spark, "json")
    spark.createDataFrame([('{"k":1,"v":"x"}',), ("{bad",)], "l string").write.text(json)
    assert {(r.k, r._corrupt_record) for r in read_json(spark, json, schema).collect()} == {
        (1, None), (None, "{bad")}


def test_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_dir(spark) == named.rstrip("/")
    assert pin(spark.range(3), "x").count() == 3


class _Conf:
    def get(self, name, default=None):
        return "hdfs://x/warehouse" if name == "spark.sql.warehouse.dir" else default


class _Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class _Session:
    def __init__(self, *context):
        self.conf, self.sparkContext = _Conf(), _Context(*context)


def test_shared_folder_is_the_sessions():
    assert shared_dir(_Session("spark://host:7077", "hdfs://x/cp/")) == "hdfs://x/cp"
    for master in ("spark://host:7077", "local-cluster[2,1,1024]", "local[2]"):
        assert shared_dir(_Session(master)) == "hdfs://x/warehouse/lakeloom-scratch"
