"""Layer paths and the landed table of a layer.

A landed table is plain parquet below one root, one folder
``load_seq=.../load_id=...`` per load. Loads are numbered as they are first
written; ids are names and need not sort. A load only ever writes its own folder
and replaces it as a whole, so a load that is run again after a failure leaves
the same table, at the same place in the order, as one that ran once. A layer
has one writer at a time.

Below ``_keys`` lies a second, narrow table: the keys each load has landed, in folders
by a bucket of the key's hash. What is there already is looked up in the buckets of the
new keys alone. A load's keys are written after its rows and commit it: rows of a load
without keys, which a failure left behind, are not read.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.urls import target_key
from ..operators.landing import skip_landed
from ..operators.rules import LAKE_PATTERN
from ..schemas import LANDED
from ..session import LONG_ROWS

# The layers of a lake.
LAYERS = ("bronze", "silver", "gold")

# Fixed value of the layout: another number would look for a key in another bucket.
BUCKETS = 32

# Up to this size, names and overhead together, new keys are sent to the scan of old ones.
BROADCAST_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD = 64

# A row may hold a whole file: check the size of pages and row groups often.
WRITE_OPTIONS = {
    "parquet.page.size.row.check.min": "8",
    "parquet.block.size.row.check.min": "8",
}


def below(base: str, name: str) -> str:
    """``name`` in the folder ``base``, which may be a bare scheme (``s3a://``) or empty."""
    return base + name if base == "" or base.endswith("/") else f"{base}/{name}"


def layer_root(lake: str, layer: str, base: str = "") -> str:
    """``<base>/<lake>-<layer>``."""
    if not re.search(LAKE_PATTERN.replace(r"\z", r"\Z"), lake):
        raise ValueError(f"a lake name has letters, digits and hyphens only, not {lake!r}")
    if layer not in LAYERS:
        raise ValueError(f"layer must be one of {LAYERS}, not {layer!r}")
    return below(base, f"{lake}-{layer}")


def layer_path(lake: Column, layer: Column, prefix: Column, name: Column) -> Column:
    """``<lake>-<layer>/<prefix>/<name>`` per row, NULL for an invalid lake or layer."""
    valid = F.rlike(lake, F.lit(LAKE_PATTERN)) & layer.isin(*LAYERS)
    path = F.concat(lake, F.lit("-"), layer, F.lit("/"), target_key(prefix, name))
    return F.when(valid, path)


def _named(load_id: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", load_id):
        raise ValueError(f"load_id has letters, digits, '_', '.' and '-' only, not {load_id!r}")
    return load_id


# What the keys of an object layer say besides the key.
_KEY_FIELDS = [
    T.StructField("content_type", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("parts", T.IntegerType()),
    T.StructField("sha256", T.StringType()),
]


def bucket_of(key: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).cast("int")


def escaped(path: str) -> str:
    """The path as a pattern that only it fits."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def fits_broadcast(rows: DataFrame, *names: str) -> bool:
    """Whether the named columns are small enough to be sent to every task.

    Measured on the rows themselves; never true when broadcasts are switched off.
    """
    threshold = rows.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if threshold.strip().startswith("-"):
        return False
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in names), F.lit(ROW_OVERHEAD))
    return (rows.agg(F.sum(width)).first()[0] or 0) <= BROADCAST_BYTES


@dataclass(frozen=True)
class Layer:
    """A landed table; ``schema`` is that of its rows, without ``load_seq`` and ``load_id``."""

    root: str
    schema: T.StructType = LANDED

    def load_path(self, load_id: str, load_seq: int) -> str:
        return f"{self.root}/load_seq={load_seq}/load_id={_named(load_id)}"

    def keys_path(self, load_id: str, load_seq: int) -> str:
        return f"{self.root}/_keys/load_seq={load_seq}/load_id={_named(load_id)}"

    def _loads(self, spark: SparkSession, below: str) -> dict[str, int]:
        """The loads that have a folder there, by id. Folders are listed, no file is opened."""
        pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{escaped(below)}/load_seq=*/load_id=*")
        system = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
        named = re.compile(r"load_seq=(\d+)/load_id=([^/]+)$")
        found = (named.search(status.getPath().toString()) for status in system.globStatus(pattern) or [])
        return {match[2]: int(match[1]) for match in found if match}

    def load_seq(self, spark: SparkSession, load_id: str) -> int:
        """The number of a load: the one it has, or the next."""
        known = self._loads(spark, self.root)
        return known.get(load_id) or max(known.values(), default=0) + 1

    def _uncommitted(self, spark: SparkSession) -> list[str]:
        """Loads with rows and no keys, in a layer that keeps keys: what failures left."""
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_keys")
        if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            return []
        return sorted(self._loads(spark, self.root).keys() - self._loads(spark, f"{self.root}/_keys").keys())

    def _scan(self, spark: SparkSession, path: str, fields: list[T.StructField]) -> DataFrame:
        folders = [T.StructField("load_seq", T.LongType()), T.StructField("load_id", T.StringType())]
        schema = T.StructType([*fields, *folders])
        try:
            return spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)

    def read(self, spark: SparkSession, besides: str | None = None) -> DataFrame:
        """All landed rows, but for those of load ``besides``, whose files stay unread.

        Parts of an object that failed on its way are not landed.
        """
        rows = self._scan(spark, self.root, self.schema.fields)
        left = [*self._uncommitted(spark), *([] if besides is None else [besides])]
        if left:
            rows = rows.where(~F.col("load_id").isin(left))
        if "error" in self.schema.names:
            attempt = ["load_seq", "load_id", "attempt", "target_key"]
            broken = rows.where("error IS NOT NULL").select(*attempt).distinct()
            rows = rows.where("error IS NULL").join(broken, attempt, "left_anti").drop("error", "attempt")
        return rows

    def keys(self, spark: SparkSession, key: Sequence[str] = ("target_key",), buckets: Sequence[int] | None = None) -> DataFrame:
        """Rows ``(*key, ..., bucket, load_seq, load_id)`` of what has landed, of some buckets or of all."""
        typed = {f.name: f for f in [*self.schema.fields, *_KEY_FIELDS]}
        more = [f for f in _KEY_FIELDS if "error" in self.schema.names]
        names = dict.fromkeys([*key, *(f.name for f in more)])
        fields = [typed[name] for name in names]
        rows = self._scan(spark, f"{self.root}/_keys", [*fields, T.StructField("bucket", T.IntegerType())])
        return rows if buckets is None else rows.where(F.col("bucket").isin(list(buckets)))

    def unlanded(self, rows: DataFrame, key: Sequence[str], load_id: str, few: bool | None = None) -> DataFrame:
        """The rows whose key no other load has landed; only the buckets of their keys are read.

        ``rows`` is read for its keys first, so it should be a written table or a plain scan.
        """
        spark = rows.sparkSession
        touched = rows.select(bucket_of(key).alias("bucket")).distinct()
        landed = self.keys(spark, key, sorted(r.bucket for r in touched.collect()))
        few = fits_broadcast(rows, *key) if few is None else few
        return skip_landed(rows, landed.where(F.col("load_id") != load_id), key, few=few)

    def latest(
        self, spark: SparkSession, key: str | Sequence[str] = "target_key", only: DataFrame | None = None
    ) -> DataFrame:
        """The newest row of each key, by the number of its load; with ``only``, of its keys alone.

        Keys are ranked where they lie in buckets. Rows that a later load replaced are
        then left out by key, so content is not shuffled while those are few.
        """
        buckets, key = None, [key] if isinstance(key, str) else list(key)
        rows = self.read(spark)
        if only is not None:
            touched = only.select(bucket_of(key).alias("bucket")).distinct()
            buckets = sorted(r.bucket for r in touched.collect())
            rows = rows.join(only.select(*key).distinct(), key, "left_semi")
        landed = self.keys(spark, key, buckets).select(*key, "load_seq")
        newest = landed.groupBy(*key).agg(F.max("load_seq").alias("_newest"), F.count(F.lit(1)).alias("_n"))
        replaced = landed.join(newest.where("_n > 1"), key).where(F.col("load_seq") != F.col("_newest"))
        return rows.join(replaced.select(*key, "load_seq"), [*key, "load_seq"], "left_anti")

    def write(self, rows: DataFrame, load_id: str, mode: str = "overwrite") -> str:
        """Write the rows of one load, replacing what an earlier try of it left; where they lie."""
        columns = [F.col(f.name).cast(f.dataType) for f in self.schema.fields]
        path = self.load_path(load_id, self.load_seq(rows.sparkSession, load_id))
        options = LONG_ROWS if "content" in self.schema.names else WRITE_OPTIONS
        rows.select(*columns).write.mode(mode).options(**options).parquet(path)
        return path

    def open_keys(self, spark: SparkSession) -> None:
        """From now on a load counts only once its keys are written."""
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_keys")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)

    def commit(self, keys: DataFrame, load_id: str, key: Sequence[str] = ("target_key",)) -> None:
        """Write the keys a load has landed, a folder for each bucket; the load's rows count from then on."""
        path = self.keys_path(load_id, self.load_seq(keys.sparkSession, load_id))
        rows = keys.withColumn("bucket", bucket_of(key)).repartition("bucket")
        rows.write.mode("overwrite").partitionBy("bucket").parquet(path)
