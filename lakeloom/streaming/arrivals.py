"""Arrival-triggered bronze: files are landed as they turn up in a folder.

Each micro-batch writes its own load, named after the batch, so a batch that is
run again after a failure replaces what its first try left. No state store is
needed: what has landed is read from the layer.

Files count by arrival: modification time, then path. Spark hands them out in the
same order, so what lands does not depend on how many files a batch holds, but for
files of one instant that fall into different batches.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.urls import target_key
from ..operators.landing import resolve_conflicts
from ..operators.split import split
from ..plans.gold import Totals, add_to_gold
from ..plans.silver import Conformed, upsert
from ..schemas import FILES
from ..session import pin
from ..sinks.layer import Layer
from ..sinks.object_sinks import commit, write_objects
from ..sinks.row_sink import land_rows
from ..sources.scans import CORRUPT

# Lines set aside: the file they are from, and their text.
QUARANTINED = T.StructType([T.StructField("file", T.StringType()), T.StructField("line", T.StringType())])


def batch_load_id(name: str, checkpoint: str, batch_id: int) -> str:
    """The name of a batch's load.

    Batches are counted from zero for each checkpoint. So that a stream started
    over with a new one replaces nothing, its loads have other names.
    """
    return f"{name}-{sha256(checkpoint.encode()).hexdigest()[:12]}-{batch_id:012d}"


def _start(
    rows: DataFrame,
    land: Callable[[DataFrame, int], None],
    name: str,
    checkpoint: str,
    every: str | None,
) -> StreamingQuery:
    writer = rows.writeStream.queryName(name).foreachBatch(land)
    writer = writer.option("checkpointLocation", checkpoint)
    timed = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return timed.start()


def stream_rows(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    layer: Layer,
    key: Sequence[str],
    order: Sequence[str],
    checkpoint: str,
    file_format: str = "parquet",
    name: str = "rows",
    max_files: int = 1000,
    every: str | None = None,
    quarantine: Layer | None = None,
    **options: str,
) -> StreamingQuery:
    """Land the rows of CSV, JSON or parquet files, one row per key.

    The file that arrived first wins, then the row first in ``order``. Runs over what has
    arrived and stops, or looks again ``every`` so often. With ``quarantine``, a layer of
    ``QUARANTINED`` rows, lines that do not fit the schema are set aside there with the file
    they are from; a batch is parsed once and written by verdict, and a repeated batch
    replaces its load in both layers.
    """
    if quarantine is not None:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **options}
    rows = (
        spark.readStream.schema(schema)
        .format(file_format)
        .option("maxFilesPerTrigger", max_files)
        .options(**options)
        .load(folder)
        .select(
            "*",
            F.col("_metadata.file_modification_time").alias("_arrived"),
            F.col("_metadata.file_path").alias("_file"),
        )
    )
    by_arrival = ("_arrived", "_file", *order)

    def land(batch: DataFrame, batch_id: int) -> None:
        load_id = batch_load_id(name, checkpoint, batch_id)
        if quarantine is not None:
            done = split(batch, F.col(CORRUPT).isNull(), "lines")
            bad = done.quarantine.select(F.col("_file").alias("file"), F.col(CORRUPT).alias("line"))
            quarantine.write(bad, load_id)
            batch = done.valid.drop(CORRUPT)
        land_rows(batch, layer, load_id, key, by_arrival)

    return _start(rows, land, name, checkpoint, every)


def stream_silver(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    table: Conformed,
    silver: Layer,
    quarantine: Layer,
    checkpoint: str,
    file_format: str = "parquet",
    name: str = "silver",
    max_files: int = 1000,
    every: str | None = None,
    gold: Sequence[tuple[Totals, Layer]] = (),
    **options: str,
) -> StreamingQuery:
    """Carry arriving rows on to a silver layer, and its changes on to gold totals.

    A batch's rows are conformed, set aside or upserted by key; what that puts into
    the silver table and what it replaces there is added to and taken from each of ``gold``. The
    tables equal those of one batch over all files, however many files a batch holds.
    """
    rows = (
        spark.readStream.schema(schema)
        .format(file_format)
        .option("maxFilesPerTrigger", max_files)
        .options(**options)
        .load(folder)
    )

    def carry(batch: DataFrame, batch_id: int) -> None:
        load_id = batch_load_id(name, checkpoint, batch_id)
        change = upsert(batch, table, silver, quarantine, load_id)
        for totals, layer in gold:
            add_to_gold(change.put, change.replaced, totals, layer, load_id)

    return _start(rows, carry, name, checkpoint, every)


def watched_root(spark: SparkSession, folder: str) -> str:
    """The part of the watched folder without wildcards, as paths of its files begin."""
    fixed = re.split(r"[^/]*[*?\[{\\]", folder, maxsplit=1)[0] or "."
    path = spark._jvm.org.apache.hadoop.fs.Path(fixed)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(path).toString().rstrip("/")


def stream_objects(
    spark: SparkSession,
    folder: str,
    layer: Layer,
    destination: str,
    checkpoint: str,
    name: str = "objects",
    glob: str = "*",
    max_files: int = 1000,
    every: str | None = None,
    outcomes: Layer | None = None,
) -> StreamingQuery:
    """Land whole files under ``destination``, by their path below ``folder``, unread.

    The stream carries names only. The bytes of a batch's winners, at most
    ``max_files`` of them, are read once, by the tasks that write them. A file that
    cannot be read is failed and ends no batch. With ``outcomes``, a table
    ``(status, n)``, each batch also records what became of its files.
    """
    names = (
        spark.readStream.schema(FILES)
        .format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files)
        .load(folder)
        .select("path", "modificationTime", "length")
    )

    below = F.substr(F.col("path"), F.lit(len(watched_root(spark, folder)) + 2))

    def land(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        load_id = batch_load_id(name, checkpoint, batch_id)
        key = target_key(F.lit(destination), below)
        layer.open_keys(session)
        arrived = pin(batch.withColumn("target_key", key), "arrivals")
        first = resolve_conflicts(arrived, order=("modificationTime", "path"))
        # All of this is bounded by max_files, like the file list the stream itself holds.
        fresh = layer.unlanded(first, ["target_key"], load_id)
        chosen = pin(fresh.select("target_key", "length", "path", F.lit(None).cast("long").alias("start")), "fresh")
        written, _ = write_objects(chosen, layer, load_id)
        commit(written, layer, load_id)
        if outcomes is not None:
            outcomes.write(_batch_counts(arrived, written), load_id)

    return _start(names, land, name, checkpoint, every)


def _batch_counts(arrived: DataFrame, written: DataFrame) -> DataFrame:
    one, skipped = F.lit(1).cast("long"), F.lit("skipped_exists")
    # A file that was written, or that failed, is not among those skipped.
    status = F.when(F.col("error").isNull(), F.lit("landed")).otherwise(F.lit("failed"))
    moves = F.array(
        F.struct(status.alias("status"), one.alias("n")),
        F.struct(skipped.alias("status"), (-one).alias("n")),
    )
    rows = arrived.select(skipped.alias("status"), one.alias("n")).unionByName(written.select(F.inline(moves)))
    return rows.groupBy("status").agg(F.sum("n").alias("n")).where("n > 0")
