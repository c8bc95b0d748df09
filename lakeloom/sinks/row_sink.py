"""Sink for table rows that carry their own key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.landing import FIRST, resolve_conflicts, skip_landed
from .layer import Layer, bucket_of


def land_rows(
    rows: DataFrame, layer: Layer, load_id: str, key: Sequence[str], order: Sequence[str]
) -> None:
    """Write the first row of each key that no other load holds.

    A row without a full key cannot be told from another: all of them land,
    unsorted and without a shuffle. The layer is not touched by its own plan: keys are
    looked up in the buckets of the new ones, those of this load are left out of the
    check, which also makes a repeated load write the same rows again.
    """
    spark = rows.sparkSession
    layer.open_keys(spark)
    whole = reduce(and_, (F.col(c).isNotNull() for c in key))
    touched = rows.where(whole).select(bucket_of(key).alias("bucket")).distinct()
    landed = layer.keys(spark, key, sorted(r.bucket for r in touched.collect()))
    first = resolve_conflicts(rows.where(whole), FIRST, key, order)
    fresh = skip_landed(first, landed.where(F.col("load_id") != load_id), key)
    path = layer.write(fresh.unionByName(rows.where(~whole)), load_id)
    written = spark.read.schema(layer.schema).parquet(path)
    layer.commit(written.where(whole).select(*key), load_id, key)
