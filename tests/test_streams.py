"""A stream over files lands what one batch would, and repeats are harmless."""

import os

from pyspark.sql import functions as F

from lakeloom.session import scratch_path
from lakeloom.sinks.layer import Layer
from lakeloom.sinks.row_sink import land_rows
from lakeloom.streaming.arrivals import batch_load_id, stream_objects, stream_rows


def write(spark, path, rows, fmt="json"):
    df = spark.createDataFrame(rows, "k string, v long").coalesce(1)
    df.write.mode("append").format(fmt).save(path)


def run(spark, folder, layer, checkpoint, **options):
    schema = spark.createDataFrame([], "k string, v long").schema
    query = stream_rows(spark, folder, schema, layer, ["k"], ["v"], checkpoint, "json", **options)
    query.awaitTermination()
    return sorted((r.k, r.v) for r in layer.read(spark).collect())


def test_rows_over_several_batches(spark):
    folder, checkpoint = scratch_path(spark, "in"), scratch_path(spark, "cp")
    layer = Layer(scratch_path(spark, "out"), spark.createDataFrame([], "k string, v long").schema)
    write(spark, folder, [("a", 2), ("a", 1), ("b", 5)])
    assert run(spark, folder, layer, checkpoint) == [("a", 1), ("b", 5)]
    write(spark, folder, [("a", 0), ("c", 7)])
    assert run(spark, folder, layer, checkpoint) == [("a", 1), ("b", 5), ("c", 7)]
    assert run(spark, folder, layer, checkpoint) == [("a", 1), ("b", 5), ("c", 7)]

    # Started over, the stream reads every file again and adds nothing.
    fresh = scratch_path(spark, "cp")
    assert run(spark, folder, layer, fresh) == [("a", 1), ("b", 5), ("c", 7)]


def test_repeated_batch_replaces_its_load(spark):
    schema = spark.createDataFrame([], "k string, v long").schema
    layer = Layer(scratch_path(spark, "out"), schema)
    folder, checkpoint = scratch_path(spark, "in"), scratch_path(spark, "cp")
    write(spark, folder, [("a", 1), ("b", 2)])
    first = spark.createDataFrame([("a", 1)], schema)
    # What a batch that died half-way through its write left behind.
    layer.write(first, batch_load_id("rows", checkpoint, 0))
    assert run(spark, folder, layer, checkpoint) == [("a", 1), ("b", 2)]


def test_stream_equals_batch(spark, tables):
    events = spark.read.parquet(f"{tables}/events.parquet")
    streamed = Layer(scratch_path(spark, "s"), events.schema)
    landed = Layer(scratch_path(spark, "b"), events.schema)
    stream_rows(spark, tables, events.schema, streamed, ["user_id"], ["event_id"],
                scratch_path(spark, "cp"), pathGlobFilter="events.parquet").awaitTermination()
    land_rows(events, landed, "0", ["user_id"], ["event_id"])
    a, b = (x.read(spark).drop("load_id", "load_seq") for x in (streamed, landed))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and not a.isEmpty()


def test_objects(spark):
    folder, checkpoint = scratch_path(spark, "in"), scratch_path(spark, "cp")
    layer = Layer(scratch_path(spark, "out"))
    outcomes = Layer(scratch_path(spark, "counts"), spark.createDataFrame([], "status string, n long").schema)

    def go():
        stream_objects(spark, folder, layer, "raw/", checkpoint, glob="*.txt", max_files=2,
                       outcomes=outcomes).awaitTermination()
        return layer.read(spark)

    rows = spark.createDataFrame([(i, f"body {i}") for i in range(5)], "i int, t string")
    rows.repartition(5, "i").write.partitionBy("i").text(folder)
    got = go()
    names = got.count()
    assert names == 5
    assert got.select(F.countDistinct("target_key")).first()[0] == names
    assert got.where("target_key NOT LIKE 'raw/i=%/part-%'").isEmpty()
    assert got.where(F.length("content") != F.col("length")).isEmpty()
    assert got.select("load_id").distinct().count() >= 2
    total = outcomes.read(spark).groupBy().sum("n").first()[0]
    assert total == 5
    assert go().count() == names
    assert batch_load_id("s", "c", 9) < batch_load_id("s", "c", 10)


def test_objects_of_one_name_and_names_like_patterns(spark, tmp_path):
    bodies = {"a/d.csv": "1", "b/d.csv": "2", "a[1].csv": "3", "x{y}*?.csv": "4", "p q%20.csv": "5"}
    for name, body in bodies.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(body)
    layer = Layer(scratch_path(spark, "out"))
    stream_objects(spark, str(tmp_path), layer, "raw", scratch_path(spark, "cp")).awaitTermination()
    got = {r.target_key: r.content.decode() for r in layer.read(spark).collect()}
    assert got == {f"raw/{name}": body for name, body in bodies.items()}


def test_rows_do_not_depend_on_the_size_of_batches(spark, tmp_path):
    for at, (name, value) in enumerate((("z", 5), ("m", 1), ("a", 3))):
        file = tmp_path / f"{name}.json"
        file.write_text(f'{{"k": "a", "v": {value}}}\n')
        os.utime(file, (1000 + at, 1000 + at))
    for size in (1, 2, 1000):
        layer = Layer(scratch_path(spark, "out"), spark.createDataFrame([], "k string, v long").schema)
        assert run(spark, str(tmp_path), layer, scratch_path(spark, "cp"), max_files=size) == [("a", 5)]


def test_csv_arrivals(spark):
    folder = scratch_path(spark, "in")
    schema = spark.createDataFrame([], "k string, v long, _corrupt_record string").schema
    layer = Layer(scratch_path(spark, "out"), schema)
    lines = spark.createDataFrame([("k,v",), ("a,1",), ("a,2",), ("b,many",)], "l string")
    lines.coalesce(1).write.text(folder)
    stream_rows(spark, folder, schema, layer, ["k"], ["v"], scratch_path(spark, "cp"), "csv",
                header="true").awaitTermination()
    got = {(r.k, r.v, r._corrupt_record) for r in layer.read(spark).collect()}
    assert got == {("a", 1, None), ("b", None, "b,many")}


def test_stream_that_keeps_looking(spark):
    schema = spark.createDataFrame([], "k string, v long").schema
    layer, folder = Layer(scratch_path(spark, "out"), schema), scratch_path(spark, "in")
    write(spark, folder, [("a", 1)])
    query = stream_rows(spark, folder, schema, layer, ["k"], ["v"], scratch_path(spark, "cp"),
                        "json", every="1 second")
    try:
        query.processAllAvailable()
        write(spark, folder, [("a", 0), ("b", 2)])
        query.processAllAvailable()
    finally:
        query.stop()
    assert sorted((r.k, r.v) for r in layer.read(spark).collect()) == [("a", 1), ("b", 2)]
