"""Objects of any length land in parts, whole, from streams and from sinks; bytes stay in the tasks."""

import os
from hashlib import sha256

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lakeloom.queries import QUERIES
from lakeloom.schemas import CANDIDATES
from lakeloom.session import scratch_path
from lakeloom.sinks import SINKS, Layer, parts
from lakeloom.sinks.object_sinks import rewrite
from lakeloom.sinks.parts import cut, file_digests, read_parts, references, staged
from lakeloom.sources.scans import read_objects
from lakeloom.streaming.arrivals import stream_objects


def bodies(rows):
    """Each object from its parts, which must be numbered from 0 without a gap."""
    out = {}
    for r in sorted(rows.collect(), key=lambda r: (r.target_key, r.part_no)):
        have = out.setdefault(r.target_key, [])
        assert r.part_no == len(have) and sha256(r.content).hexdigest() == r.sha256
        have.append(bytes(r.content))
    return {k: b"".join(v) for k, v in out.items()}


def test_a_file_above_two_gigabytes_lands(spark, tmp_path):
    length = 2_000_000_001
    (tmp_path / "in").mkdir()
    with open(tmp_path / "in" / "long %20;?.bin", "wb") as f:
        f.truncate(length)
        f.seek(1_500_000_000)
        f.write(b"here")
    (tmp_path / "in" / "short.bin").write_bytes(b"short")
    layer = Layer(str(tmp_path / "out"))
    outcomes = Layer(scratch_path(spark, "counts"), spark.createDataFrame([], "status string, n long").schema)
    stream_objects(spark, str(tmp_path / "in"), layer, "raw", scratch_path(spark, "cp"),
                   outcomes=outcomes).awaitTermination()
    got = {r.target_key: r for r in layer.keys(spark).collect()}
    assert set(got) == {"raw/long %20;?.bin", "raw/short.bin"}
    assert {(r.status, r.n) for r in outcomes.read(spark).collect()} == {("landed", 2)}
    long = layer.read(spark).where("target_key LIKE '%long%'")
    row = long.agg(F.sum(F.octet_length("content")), F.count("part_no"), F.max("part_no"),
                   F.max(F.octet_length("content"))).first()
    n = -(-length // parts.PART_BYTES)
    assert tuple(row) == (length, n, n - 1, parts.PART_BYTES) and got["raw/long %20;?.bin"].parts == n
    at, within = divmod(1_500_000_000, parts.PART_BYTES)
    content = long.where(F.col("part_no") == at).first().content
    assert content[within : within + 5] == b"here\0"


def test_arriving_objects_longer_than_a_cell(spark, tmp_path):
    """Files above the length that a cell of Spark's own reader may have are compared too."""
    (tmp_path / "long.parquet").write_bytes(os.urandom(parts.PART_BYTES + 1))
    (tmp_path / "short.parquet").write_bytes(b"short")
    name = "spark.sql.sources.binaryFile.maxLength"
    spark.conf.set(name, 1000)
    try:
        got = {tuple(r) for r in QUERIES["arriving_objects"](spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset(name)
    assert got == {(f"raw/{k}.parquet", "application/octet-stream", True) for k in ("long", "short")}


def test_row_groups_of_objects_hold_few_parts(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "long").write_bytes(os.urandom(6 * parts.PART_BYTES))
    stream_objects(spark, str(tmp_path / "in"), Layer(str(tmp_path / "out")), "raw", scratch_path(spark, "cp")).awaitTermination()
    groups = []
    for file in (tmp_path / "out").glob("load_seq=*/*/*.parquet"):
        found = pq.ParquetFile(file).metadata
        groups += [found.row_group(k).total_byte_size for k in range(found.num_row_groups)]
    assert sum(groups) > 6 * parts.PART_BYTES and max(groups) < 2.5 * parts.PART_BYTES


def test_digests_of_files_as_they_lie(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(parts, "PART_BYTES", 10)
    monkeypatch.setattr(parts, "TASK_BYTES", 100)
    monkeypatch.setattr(parts, "OPEN_BYTES", 0)
    given = {"one": b"x", "just": b"0123456789" * 30, "more %20": bytes(range(256)) * 3, "empty": b""}
    for k, body in given.items():
        (tmp_path / k).write_bytes(body)
    listed = [(f"file:{tmp_path}/{k}", len(body)) for k, body in given.items()]
    (tmp_path / "changed").write_bytes(b"y" * 25)
    listed.append((f"file:{tmp_path}/changed", 21))
    got = {r.path: r.sha256 for r in file_digests(spark.createDataFrame(listed, "path string, length bigint")).collect()}
    for path, _ in listed:
        body = open(path[5:], "rb").read()
        each = [sha256(body[i : i + 10]).hexdigest() for i in range(0, len(body), 10)] or [sha256(b"").hexdigest()]
        assert got.pop(path) == (each[0] if len(each) == 1 else sha256("".join(each).encode()).hexdigest())
    assert not got


def test_sinks_land_objects_in_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(parts, "PART_BYTES", 10)
    monkeypatch.setattr(parts, "TASK_BYTES", 100_000)
    given = {"a": b"short", "b": bytes(range(256)) * 5, "c": b"just as long as two ", "e": b""}
    for name, body in given.items():
        (tmp_path / f"{name}.zip").write_bytes(body)
    scanned = read_objects(spark, str(tmp_path), "*.zip")
    objects = scanned.select(F.substring_index("path", "/", -1).alias("object_id"), "length", "content", "path")
    # Spark's own listing leaves out files without bytes.
    cells = [("t", 14, b"a cell, though", None), ("n", None, None, None), ("e.zip", 0, None, f"file:{tmp_path}/e.zip")]
    table = spark.createDataFrame(cells, objects.schema)
    names = [f"{k}.zip" for k in given] + ["t", "n"]
    rows = spark.createDataFrame([(0, "k", n, 0, "u", o, f"{o}.out", None) for n, o in enumerate(names)], CANDIDATES)
    want = {**{f"{k}.zip.out": v for k, v in given.items()}, "t.out": b"a cell, though"}
    for sink in ("s3", "local"):
        layer = Layer(str(tmp_path / sink))
        for _ in range(2):  # a load that runs again leaves the same
            outcome = {(r.status, r.n) for r in SINKS[sink](rows, objects.unionByName(table), layer, "one").collect()}
            assert outcome == {("landed", 5), ("failed", 1)} and bodies(layer.latest(spark)) == want
        for r in layer.keys(spark).collect():
            whole = want[r.target_key]
            pieces = [whole[i : i + 10] for i in range(0, len(whole), 10)] or [b""]
            listed = [sha256(p).hexdigest() for p in pieces]
            digest = listed[0] if len(listed) == 1 else sha256("".join(listed).encode()).hexdigest()
            assert (r.length, r.parts, r.sha256) == (len(whole), len(pieces), digest)
        fresh = rewrite(layer, Layer(str(tmp_path / f"{sink}-fresh")), spark)
        assert bodies(fresh.read(spark)) == want

    # Fetched twice, the longer one lands.
    (tmp_path / "more").mkdir()
    (tmp_path / "more" / "a.zip").write_bytes(b"longer than the other")
    layer = Layer(str(tmp_path / "twice"))
    SINKS["s3"](rows, objects.unionByName(read_objects(spark, str(tmp_path / "more")).select(
        F.lit("a.zip").alias("object_id"), "length", "content", "path")), layer)
    assert bodies(layer.read(spark))["a.zip.out"] == b"longer than the other"


def test_bytes_are_in_no_scan_join_or_exchange(spark, tmp_path):
    for n in range(3):
        (tmp_path / f"{n}.zip").write_bytes(b"x" * n)
    scanned = read_objects(spark, str(tmp_path), "*.zip").withColumnRenamed("path", "object_id")
    objects = scanned.withColumn("path", F.col("object_id"))
    refs = references(objects)
    written = read_parts(refs.withColumn("target_key", F.col("object_id")))
    text = written._jdf.queryExecution().executedPlan().toString()
    above, tree, below = text.partition("MapInArrow")
    below = "\n".join(line for line in below.splitlines()[1:] if "ReadSchema" not in line or "content" in line)
    assert tree and "content" not in below and "Exchange" not in above
    assert "Exchange" in below


def test_stretches_go_to_one_task_each(spark, monkeypatch):
    monkeypatch.setattr(parts, "PART_BYTES", 10)
    monkeypatch.setattr(parts, "TASK_BYTES", 100)
    cells = spark.range(1000).select(F.col("id").cast("string").alias("object_id"), F.lit(b"0123456789").alias("content"))
    refs = staged(cells.coalesce(1)).withColumnRenamed("object_id", "target_key")
    rows = cut(refs).repartition(64, "path", "stretch").withColumn("task", F.spark_partition_id())
    per = rows.groupBy("path", "stretch").agg(F.countDistinct("task").alias("tasks"), F.count("task").alias("n"))
    assert {(r.tasks, r.n) for r in per.collect()} == {(1, 10)}


def offered(spark, *rows):
    return spark.createDataFrame([(0, "k", n, 0, "u", o, key, None) for n, (key, o) in enumerate(rows)], CANDIDATES)


@pytest.mark.parametrize("sink", ["s3", "local"])
def test_what_cannot_be_read_fails_alone(spark, tmp_path, monkeypatch, sink):
    """The rest lands, the failed one is counted, and its key goes to the next candidate."""
    monkeypatch.setattr(parts, "PART_BYTES", 4)
    for name in ("good", "other", "shrunk", "gone"):
        (tmp_path / name).write_bytes(name.encode() * 3)
    rows = [(n, len(n) * 3, f"file:{tmp_path}/{n}") for n in ("good", "other", "shrunk", "gone")]
    objects = spark.createDataFrame(rows, "object_id string, length long, path string")
    (tmp_path / "shrunk").write_bytes(b"less")
    os.unlink(tmp_path / "gone")
    pairs = [("k", "good"), ("k", "gone"), ("k", "gone"), ("l", "other"), ("m", "shrunk"), ("n", "shrunk"), ("n", "good")]
    if sink == "s3":
        pairs = [("k", "gone"), ("k", "gone"), ("k", "good"), ("l", "other"), ("m", "shrunk"), ("n", "shrunk"), ("n", "good")]
    layer = Layer(scratch_path(spark, "out"))
    got = {r.status: r.n for r in SINKS[sink](offered(spark, *pairs), objects, layer, "one").collect()}
    # What a later writer of the key replaces is not tried, so not known to fail.
    assert got == ({"landed": 3, "failed": 4} if sink == "s3" else {"landed": 4, "failed": 3})
    assert bodies(layer.read(spark)) == {"k": b"good" * 3, "l": b"other" * 3, "n": b"good" * 3}
    assert {r.target_key for r in layer.keys(spark).collect()} == {"k", "l", "n"}
    # The object is there again: a later load lands what failed, and only that.
    (tmp_path / "shrunk").write_bytes(b"shrunk" * 3)
    if sink == "s3":
        again = {r.status: r.n for r in SINKS[sink](offered(spark, *pairs), objects, layer, "two").collect()}
        assert again["landed"] == 1 and bodies(layer.read(spark))["m"] == b"shrunk" * 3


def test_a_stream_goes_on_after_a_file_it_cannot_read(spark, tmp_path, monkeypatch):
    for name in ("a", "b", "c"):
        (tmp_path / name).write_bytes(name.encode())
    part = parts._Files.part

    def broken(self, path, *rest):
        if path.endswith("/b"):
            raise OSError("no such disk")
        return part(self, path, *rest)

    monkeypatch.setattr(parts._Files, "part", broken)
    layer = Layer(scratch_path(spark, "out"))
    outcomes = Layer(scratch_path(spark, "counts"), spark.createDataFrame([], "status string, n long").schema)
    stream_objects(spark, str(tmp_path), layer, "raw", scratch_path(spark, "cp"), outcomes=outcomes).awaitTermination()
    assert {(r.status, r.n) for r in outcomes.read(spark).collect()} == {("landed", 2), ("failed", 1)}
    assert set(bodies(layer.read(spark))) == {"raw/a", "raw/c"}
