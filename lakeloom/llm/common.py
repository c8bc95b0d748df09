"""Helpers the operators share: reading tables, hashing words, components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import pin

# Odd multipliers that spread a 64-bit value over all its bits.
SPREAD = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)

# A task works on texts in pieces of about this many bytes.
PIECE_BYTES = 2 << 20
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def unused(df: DataFrame, stem: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    return next(name for k in range(len(taken) + 1) if (name := f"{stem}{k or ''}").lower() not in taken)


def own(df: DataFrame) -> list[Column]:
    """The columns of a table, whatever characters their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def texts(docs: DataFrame, *columns: str | Column) -> DataFrame:
    """The named columns and the text as UTF-8 bytes; a null text is empty."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(*columns, text.alias("text"))


def pieces(
    batches: Iterable[pa.RecordBatch], column: str = "text", size: int = PIECE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a piece holds a few MiB of text, or one longer text."""
    for batch in batches:
        sizes = np.diff(offsets(batch.column(column)))
        done = 0
        while done < len(sizes):
            total = np.cumsum(sizes[done:])
            n = max(int(np.searchsorted(total, size, "right")), 1)
            yield batch.slice(done, n)
            done += n


@contextmanager
def small_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """What is written meanwhile goes to Python in batches of about ``size`` bytes, unless the session names a size.

    Spark's own batches of long texts are tens of MiB, held by the JVM while they grow and twice in Python.
    """
    if spark.conf.get(BATCH_CONF, None) is not None:
        yield
        return
    spark.conf.set(BATCH_CONF, size)
    try:
        yield
    finally:
        spark.conf.unset(BATCH_CONF)


def offsets(column: pa.Array) -> np.ndarray:
    """Where each value of a binary column starts, and where the last one ends."""
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    raw = np.frombuffer(column.buffers()[1], dtype=kind)
    return raw[column.offset : column.offset + len(column) + 1].astype(np.int64)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * MIX
        x = (x ^ (x >> np.uint64(29))) * SPREAD
        return x ^ (x >> np.uint64(32))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` consecutive word hashes."""
    count = max(len(words) - n + 1, 0)
    out = np.full(count, np.uint64(n))
    with np.errstate(over="ignore"):
        for i in range(n):
            out = mixed(out * SPREAD + words[i : i + count])
    return out


def lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from one flat array."""
    ends = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, type=kind))


def components(edges: DataFrame, label: str = "edges") -> DataFrame:
    """Rows ``(node, component)`` for every node of the edges ``(a, b)``.

    Alternating large and small stars: each round ties a node to the smallest
    neighbour of its neighbours, until every edge leads to the smallest node of
    its component. Rounds grow with the logarithm of the longest chain; each is
    written to the shared folder, so lineage stays short. The minimum of a
    popular node is combined before the shuffle and its join can be split.
    """

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())

    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = pin(pairs.distinct(), label)
    before = state(current)
    while before[0]:
        both = current.union(current.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(small, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        following = pin(moved.union(small.select("a", F.col("m").alias("b"))).distinct(), label)
        after = state(following)
        current = following
        if after == before:
            break
        before = after
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots).distinct()
