"""Embeddings whitened by the leading eigenvectors of their covariance.

Entries become whole numbers ``x = floor(64 c) + OFFSET``. Sums are exact, so a vector's
distance from the mean is known as the whole number ``n x - S`` before anything is rounded.
The covariance is summed in tasks from centred vectors; the driver holds one matrix of the
vectors' length squared, and its leading eigenpairs come from ``spectrum``.

Nulls, empty vectors, ties: a vector that is null or holds a null or non-finite entry makes
no rows and counts for nothing, nor does an empty one, nor one whose length is not the
table's own, which is the length most vectors have (of equally many, the longest). Rows
that repeat a vec_id, or have none, are vectors of their own. With fewer dimensions there
are fewer components. A component without variance has ``whitened`` null and is left out
of ``identity_error``, which is null where none has any. Where a deviation or an entry is
too large for a long, the job fails and says so. An empty table makes no rows. Other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import pin
from .spectrum import EPS, leading

COMPONENTS = 32
SCALE = 64.0
OFFSET = 1_000_000
SCHEMA = (
    "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


def matrix(column: pa.Array) -> np.ndarray:
    """The lists of a column, all of one length, as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def whole(vectors: DataFrame) -> DataFrame:
    """Rows ``(vec_id, x)``: the vectors of the table's own length, as whole numbers."""
    finite = F.forall("embedding", lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    rows = vectors.where(finite & (F.size("embedding") > 0)).select("vec_id", "embedding")
    lengths = rows.groupBy(F.size("embedding").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    if most is not None:
        rows = rows.where(F.size("embedding") == most.length)
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * SCALE) + F.lit(OFFSET).cast("long"))
    return rows.select("vec_id", x.alias("x"))


def covariance(rows: DataFrame, column: str, n: int, centred: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The covariance of a list column; a task sums products of centred vectors into one matrix."""

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                y = centred(matrix(batch.column(column)))
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            i, j = (k.ravel().astype(np.int32) for k in np.indices(total.shape))
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], ["i", "j", "value"])

    parts = rows.select(column).mapInArrow(fold, "i int, j int, value double")
    cells = parts.groupBy("i", "j").agg(F.sum("value").alias("value")).toPandas()
    d = int(cells["i"].max()) + 1
    out = np.zeros((d, d))
    out[cells["i"], cells["j"]] = cells["value"] / n
    return (out + out.T) / 2


def sums(rows: DataFrame, column: str, kind: str) -> list:
    """The sum of each place of a list column, combined in the tasks."""
    places = rows.select(F.posexplode(column).alias("i", "c"))
    totals = places.groupBy("i").agg(F.sum(F.col("c").cast(kind)).alias("total")).collect()
    return [row.total for row in sorted(totals)]


def exact_squares(z: np.ndarray) -> np.ndarray:
    """The sum of squares of each row of whole numbers; never one that wrapped around."""
    if z.size and float(np.abs(z).max()) ** 2 * z.shape[1] >= 2.0**63:
        found = [sum(int(v) ** 2 for v in row) for row in z]
        if max(found) >= 2**63:
            raise OverflowError("a deviation is too large for a long")
        return np.array(found, np.int64)
    return (z * z).sum(axis=1)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Rows ``(vec_id, component, n, deviation, whitened, explained, identity_error)``."""
    spark = vectors.sparkSession
    kind = vectors.schema["vec_id"].dataType.simpleString()
    rows = pin(whole(vectors), "whole-vectors")
    n = rows.count()
    if not n:
        return spark.createDataFrame([], f"vec_id {kind}, {SCHEMA}")
    total = np.array([int(t) for t in sums(rows, "x", "decimal(38,0)")], np.int64)
    if n * (float(np.abs(total).max()) / n + 1) >= 2.0**62:
        raise OverflowError("a sum is too large for a long")

    def scaled(x: np.ndarray) -> np.ndarray:
        if float(np.abs(x).max()) * n >= 2.0**62:
            raise OverflowError("an entry is too large for a long")
        return x * n - total

    spread = covariance(rows, "x", n, lambda x: scaled(x) / n)
    trace = float(np.trace(spread))
    values, axes = leading(spread, components)
    varies = values > 8 * len(spread) * EPS * trace
    project = axes / np.sqrt(np.where(varies, values, np.inf))

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                z = scaled(matrix(batch.column("x")))
                w = (z / n) @ project
                ends = pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1])
                lists = pa.ListArray.from_arrays(ends, pa.array(w.ravel()))
                columns = [batch.column("vec_id"), pa.array(exact_squares(z)), lists]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "deviation", "w"])

    white = pin(rows.mapInArrow(apply, f"vec_id {kind}, deviation bigint, w array<double>"), "whitened")
    error = None
    if varies.any():
        mean = np.array(sums(white, "w", "double")) / n
        away = covariance(white, "w", n, lambda w: w - mean)[np.ix_(varies, varies)] - np.eye(int(varies.sum()))
        error = float(np.abs(away).max())
    table = [
        (k + 1, bool(varies[k]), float(max(values[k], 0.0) / trace) if trace else 0.0) for k in range(len(values))
    ]
    named = F.array(*(F.struct(*(F.lit(v) for v in row)) for row in table))
    named = named.cast("array<struct<component:int,varies:boolean,explained:double>>")
    each = white.select("vec_id", "deviation", F.inline(F.arrays_zip("w", named.alias("named"))))
    return each.select(
        "vec_id",
        "named.component",
        F.lit(n).cast("long").alias("n"),
        "deviation",
        F.when(F.col("named.varies"), F.col("w")).alias("whitened"),
        "named.explained",
        F.lit(error).cast("double").alias("identity_error"),
    )
