"""One pass over an input whose rows go two ways."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

VALID, QUARANTINE = "valid", "quarantine"


@dataclass(frozen=True)
class Split:
    """Rows written once, in a folder for each verdict, and how many went where."""

    valid: DataFrame
    quarantine: DataFrame
    n_valid: int
    n_quarantine: int


def split(rows: DataFrame, holds: Column, label: str = "split") -> Split:
    """Write each row where it belongs; a verdict that is NULL sets a row aside.

    The input is read and its rules are evaluated once. Rows are counted as they are
    written, without another job.
    """
    spark, path, seen = rows.sparkSession, scratch_path(rows.sparkSession, label), Observation()
    verdict = F.when(holds, F.lit(VALID)).otherwise(F.lit(QUARANTINE))
    marked = rows.withColumn("verdict", verdict)
    marked = marked.observe(
        seen, F.count_if(F.col("verdict") == VALID).alias(VALID), F.count_if(F.col("verdict") != VALID).alias(QUARANTINE)
    )
    marked.write.partitionBy("verdict").parquet(path)
    schema = T.StructType([*rows.schema.fields, T.StructField("verdict", T.StringType())])
    written = spark.read.schema(schema).parquet(path)
    valid, quarantine = (written.where(F.col("verdict") == v).drop("verdict") for v in (VALID, QUARANTINE))
    return Split(valid, quarantine, seen.get[VALID], seen.get[QUARANTINE])
