"""Session defaults and the shared working folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# For tables with rows of some MiB. A page is packed and unpacked as a whole, and Spark reads a row
# group's cells into one array that doubles as it grows. So both hold about 8 MiB, as packed.
LONG_ROWS = {
    "parquet.block.size": str(8 * 1024 * 1024),
    "parquet.page.size.row.check.min": "1",
    "parquet.page.size.row.check.max": "2",
}


def build_session(app: str = "lakeloom", cpus: str | int = "*") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    shuffle = 8 if cpus == "*" else max(int(cpus), 1)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("LAKELOOM_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    That is the checkpoint folder, or else one in the warehouse, which a session
    always names and all executors read and write.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None)
    context = spark.sparkContext
    if named:
        if not context.getCheckpointDir():
            context.setCheckpointDir(named)
        return named.rstrip("/")
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    context.setCheckpointDir(f"{warehouse}/lakeloom-scratch")
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def pin(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` once, with ``options`` for its files, and go on from the written table.

    Later reads do not recompute the plan above, survive lost executors, and
    see the file sizes, so the optimizer broadcasts the table only when it is
    really small.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
