"""Bytes of objects, read by the tasks that write them.

Plans carry names only: an object is a file, or a stretch of one, named by ``path`` and
``start``. What lands is cut into parts of ``PART_BYTES``. Parts are dealt to tasks by
their bytes; a task opens the files of its own parts and writes rows
``(target_key, part_no, content)``. So an object of any length has one form, no cell is
longer than a part, and bytes are in no scan, join or exchange.

An object that cannot be read, or is not as long as listed, ends no task: its part carries
the error, and the object counts as failed.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterable, Iterator
from hashlib import sha256
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

# Functions that run inside tasks are shipped by value: executors need the public libraries only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PART_BYTES = 8 * 1024 * 1024
# A task is dealt stretches of files of about this length, next to each other.
TASK_BYTES = 64 * 1024 * 1024
# Opening a file costs as much as reading so many bytes.
OPEN_BYTES = 64 * 1024
# Rows of short objects leave a task together.
BATCH_BYTES = 4 * 1024 * 1024

REFERENCES = "object_id string, length bigint, path string, start bigint, sha256 string"
PARTS = "target_key string, length bigint, part_no int, content binary, sha256 string, error string"


def resolved(spark: SparkSession, folder: str) -> str:
    """The folder's own place, without mount points only Hadoop knows."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.resolvePath(path).toString().rstrip("/")


def made(spark: SparkSession, folder: str) -> str:
    """The folder, made if it is not there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    return resolved(spark, folder)


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark writes it, without escapes, and the path there."""
    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        rest = rest if colon else path
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    return fs.FileSystem.from_uri(f"{scheme}:{quote(rest, safe='/:@')}")


def _batch(rows: list[tuple], form: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), form)], schema=form)


def _form(*fields: tuple[str, pa.DataType]) -> pa.Schema:
    return pa.schema(list(fields))


def staged(cells: DataFrame, folder: str | None = None) -> DataFrame:
    """Objects given as cells ``(object_id, length, content)``, written to files by the tasks that hold them.

    A task appends its cells to one file; rows name the stretch of it an object takes. A
    null cell is left out. An attempt that runs again writes a file of its own.
    """
    spark = cells.sparkSession
    folder = made(spark, folder or scratch_path(spark, "cells"))
    form = _form(("object_id", pa.string()), ("length", pa.int64()), ("path", pa.string()),
                 ("start", pa.int64()), ("sha256", pa.string()))

    def put(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path = None, f"{folder}/{uuid.uuid4().hex}"
        try:
            for batch in batches:
                rows = []
                for name, value in zip(batch.column("object_id"), batch.column("content"), strict=True):
                    content = value.as_buffer()
                    if out is None:
                        system, place = locate(path)
                        out = system.open_output_stream(place, compression=None)
                    rows.append((name.as_py(), len(content), path, out.tell(), sha256(content).hexdigest()))
                    out.write(content)
                if rows:
                    yield _batch(rows, form)
        finally:
            if out is not None:
                out.close()

    some = cells.where(F.col("content").isNotNull()).select("object_id", "content")
    return some.mapInArrow(put, REFERENCES)


def references(objects: DataFrame) -> DataFrame:
    """Rows ``(object_id, length, path, start, sha256)``; objects given as cells are written to files.

    ``start`` is NULL for a whole file, whose length is then checked when it is read.
    """
    whole = objects
    for name, kind in (("path", "string"), ("start", "bigint"), ("sha256", "string")):
        if name not in objects.columns:
            whole = whole.withColumn(name, F.lit(None).cast(kind))
    names = ["object_id", "length", "path", "start", "sha256"]
    if "content" not in objects.columns:
        return whole.select(*names)
    if "path" not in objects.columns:
        return staged(objects)
    files = whole.where(F.col("path").isNotNull()).select(*names)
    # A scan of files would read their bytes to find that no cell is without a path.
    if whole.where(F.col("path").isNull()).select("object_id").isEmpty():
        return files
    return files.unionByName(staged(whole.where(F.col("path").isNull())))


def one_each(refs: DataFrame) -> DataFrame:
    """Of an object fetched more than once the longest, then the one first by digest and place."""
    order = [F.desc("length"), F.col("sha256"), F.col("path"), F.col("start")]
    place = F.row_number().over(Window.partitionBy("object_id").orderBy(*order))
    return refs.withColumn("_place", place).where("_place = 1").drop("_place")


def _mounts(rows: DataFrame) -> dict[str, str]:
    """Folders below mount points only Hadoop knows, and their own places."""
    parent = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    mounted = rows.where("path LIKE 'viewfs:%'").select(parent.alias("folder")).distinct()
    return {r.folder: resolved(rows.sparkSession, r.folder) for r in mounted.toLocalIterator()}


class _Files:
    """The file read last stays open; parts of one file come one after another."""

    def __init__(self, mounts: dict[str, str]):
        self.mounts, self.path, self.file = mounts, None, None

    def open(self, path: str):
        if path != self.path:
            self.close()
            above, _, name = path.rpartition("/")
            system, place = locate(f"{self.mounts.get(above, above)}/{name}")
            self.file, self.path = system.open_input_file(place), path
        return self.file

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
        self.path = self.file = None

    def part(self, path: str, start: int | None, length: int, part_no: int) -> bytes:
        file = self.open(path)
        if start is None and file.size() != length:
            raise OSError(f"{path} was listed with {length} bytes and has {file.size()}")
        at = part_no * PART_BYTES
        size = min(PART_BYTES, length - at)
        content = file.read_at(size, (start or 0) + at)
        if len(content) != size:
            raise OSError(f"{path} ends before {size} bytes from {(start or 0) + at}")
        return content


def cut(chosen: DataFrame) -> DataFrame:
    """A row for each part of the objects ``(target_key, length, path, start)``; an empty one has one part."""
    last = F.greatest(F.floor((F.col("length") - 1) / PART_BYTES), F.lit(0)).cast("int")
    parts = chosen.select("target_key", "length", "path", "start", F.explode(F.sequence(F.lit(0), last)).alias("part_no"))
    at = F.coalesce("start", F.lit(0)) + F.col("part_no").cast("long") * PART_BYTES
    return parts.withColumn("stretch", F.floor(at / TASK_BYTES))


def dealt(chosen: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The parts of a written table of names, stretches of ``TASK_BYTES`` to one task each; its mounts."""
    total, mounted = chosen.agg(F.sum(F.col("length") + OPEN_BYTES), F.max(F.col("path").like("viewfs:%"))).first()
    tasks = max(-(-(total or 0) // TASK_BYTES), 1)
    mounts = _mounts(chosen) if mounted else {}
    parts = cut(chosen).repartition(tasks, "path", "stretch").sortWithinPartitions("path", "start", "part_no")
    return parts.drop("stretch"), mounts


def read_parts(chosen: DataFrame) -> DataFrame:
    """Rows ``(target_key, length, part_no, content, sha256, error)`` of a written table of names.

    Stretches of ``TASK_BYTES`` of a file go to one task, which opens the file once. An
    object has the parts 0, 1, ...; where one could not be read, ``error`` says why.
    """
    parts, mounts = dealt(chosen)
    form = _form(("target_key", pa.string()), ("length", pa.int64()), ("part_no", pa.int32()),
                 ("content", pa.binary()), ("sha256", pa.string()), ("error", pa.string()))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, rows, held = _Files(mounts), [], 0
        for batch in batches:
            for row in batch.to_pylist():
                named = (row["target_key"], row["length"], row["part_no"])
                content = digest = error = None
                for _ in range(2):  # a file that could not be read is opened once more
                    try:
                        content = files.part(row["path"], row["start"], row["length"], row["part_no"])
                        digest, error = sha256(content).hexdigest(), None
                        break
                    except (OSError, pa.ArrowException) as wrong:
                        files.close()
                        error = f"{type(wrong).__name__}: {wrong}"[:1000]
                rows.append((*named, content, digest, error))
                held += len(content or b"") + OPEN_BYTES // 16
                if held >= BATCH_BYTES:
                    yield _batch(rows, form)
                    rows, held = [], 0
        files.close()
        if rows:
            yield _batch(rows, form)

    return parts.mapInArrow(read, PARTS)


def digests(parts: DataFrame) -> DataFrame:
    """Rows ``(target_key, length, parts, sha256, error)``: each object by its parts, no byte read.

    ``sha256`` is the digest of the digests of an object's parts in order, so it is
    the same however parts were dealt out; for one part it is that part's own.
    """
    listed = F.array_sort(F.collect_list(F.struct("part_no", "sha256")))
    joined = F.array_join(F.transform(listed, lambda p: p["sha256"]), "")
    rows = parts.groupBy("target_key").agg(
        F.max("length").alias("length"),
        F.count(F.lit(1)).cast("int").alias("parts"),
        F.when(F.count(F.lit(1)) == 1, F.max("sha256")).otherwise(F.sha2(joined, 256)).alias("sha256"),
        F.max("error").alias("error"),
    )
    return rows


def file_digests(files: DataFrame) -> DataFrame:
    """Rows ``(path, sha256)`` of the files ``(path, length)`` as they lie, of any length.

    A reading of its own, to compare with what has landed: parts are read one by one, each up to
    where it or the file ends, and only their digests leave a task. ``sha256`` is made as in
    :func:`digests`. A file that cannot be read ends the task.
    """
    parts, mounts = dealt(files.select(F.col("path").alias("target_key"), "length", "path", F.lit(None).cast("long").alias("start")))
    form = _form(("target_key", pa.string()), ("length", pa.int64()), ("part_no", pa.int32()),
                 ("sha256", pa.string()), ("error", pa.string()))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = _Files(mounts)
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                file = opened.open(row["path"])
                file.seek(row["part_no"] * PART_BYTES)
                digest = sha256(file.read(PART_BYTES)).hexdigest()
                rows.append((row["target_key"], row["length"], row["part_no"], digest, None))
            if rows:
                yield _batch(rows, form)
        opened.close()

    found = parts.mapInArrow(read, "target_key string, length bigint, part_no int, sha256 string, error string")
    return digests(found).select(F.col("target_key").alias("path"), "sha256")
