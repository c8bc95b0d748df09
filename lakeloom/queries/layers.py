"""Silver and gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.gold import daily_event_totals, days_of, read_gold, revenue_by_region, supplier_returns, user_days
from ..plans.silver import Conformed, distinct_texts, quarantine_schema, refine, silver_schema, write_silver
from ..session import scratch_path
from ..sinks.layer import Layer
from ..streaming.arrivals import stream_silver
from .catalog import query, table
from .derived import ctes, derived

SILVER_ORDERS_SQL = f"""
{ctes("raw_orders")},
conformed AS (
    SELECT try_cast(trim(o_orderkey) AS BIGINT) AS o_orderkey,
           try_cast(trim(o_custkey) AS BIGINT) AS o_custkey,
           upper(trim(o_orderstatus)) AS o_orderstatus,
           try_cast(trim(o_totalprice) AS DECIMAL(18, 2)) AS o_totalprice,
           try_cast(nullif(trim(o_orderdate), '') AS DATE) AS o_orderdate,
           trim(o_orderpriority) AS o_orderpriority, sent
    FROM raw_orders
),
checked AS (
    SELECT *, concat_ws(',', CASE WHEN o_totalprice IS NULL THEN 'o_totalprice_missing' END,
                        CASE WHEN o_orderdate IS NULL THEN 'o_orderdate_missing' END,
                        CASE WHEN o_totalprice IS NULL OR o_totalprice >= 400000
                             THEN 'price_below_400k' END) AS broken
    FROM conformed
),
valid AS (
    SELECT * FROM checked WHERE broken = ''
    QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY sent) = 1
)"""

_SILVER_COLUMNS = """o_orderkey, o_custkey, o_orderstatus, o_totalprice::DOUBLE AS o_totalprice,
    o_orderdate, o_orderpriority, sent::BIGINT AS sent"""


def _orders() -> Conformed:
    """Orders with typed columns; very large amounts are set aside for review."""
    return Conformed(
        columns={
            "o_orderkey": "bigint",
            "o_custkey": "bigint",
            "o_orderstatus": "string",
            "o_totalprice": "decimal(18,2)",
            "o_orderdate": "date",
            "o_orderpriority": "string",
            "sent": "int",
        },
        key=["o_orderkey"],
        order=["sent"],
        required=["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"],
        upper=["o_orderstatus"],
        rules={"price_below_400k": F.col("o_totalprice") < 400000},
    )


def _plain(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {"o_totalprice": F.col("o_totalprice").cast("double"), "sent": F.col("sent").cast("long")}
    )


@query(f"WITH {SILVER_ORDERS_SQL} SELECT {_SILVER_COLUMNS} FROM valid")
def silver_orders(spark: SparkSession, folder: str) -> DataFrame:
    valid, _ = refine(derived(spark, folder, "raw_orders"), _orders())
    return _plain(valid)


@query(f"WITH {SILVER_ORDERS_SQL} SELECT {_SILVER_COLUMNS}, broken FROM checked WHERE broken <> ''")
def silver_orders_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    _, quarantine = refine(derived(spark, folder, "raw_orders"), _orders())
    return _plain(quarantine.withColumn("broken", F.array_join("broken_rules", ","))).drop(
        "broken_rules"
    )


@query(f"""
WITH {SILVER_ORDERS_SQL}
SELECT 'valid' AS verdict, {_SILVER_COLUMNS}, NULL AS broken FROM valid
UNION ALL SELECT 'quarantine', {_SILVER_COLUMNS}, broken FROM checked WHERE broken <> ''
""")
def silver_orders_written(spark: SparkSession, folder: str) -> DataFrame:
    """Both results as they were written, from one pass over the input."""
    path = scratch_path(spark, "silver")
    write_silver(derived(spark, folder, "raw_orders"), _orders(), path)
    rows = spark.read.parquet(path)
    broken = F.when(F.col("broken_rules").isNotNull(), F.array_join("broken_rules", ",")).alias("broken")
    return _plain(rows).select("verdict", *_orders().columns, broken)


@query(f"""
WITH {SILVER_ORDERS_SQL}
SELECT 'valid' AS verdict, {_SILVER_COLUMNS}, NULL AS broken FROM valid
UNION ALL SELECT 'quarantine', {_SILVER_COLUMNS}, broken FROM checked WHERE broken <> ''
""")
def arriving_silver(spark: SparkSession, folder: str) -> DataFrame:
    """Raw orders in files that arrive a few at a time, copies before and after what they repeat."""
    table, path = _orders(), scratch_path(spark, "raw")
    raw = derived(spark, folder, "raw_orders")
    raw.repartition(5).write.parquet(path)
    silver = Layer(scratch_path(spark, "silver"), silver_schema(table))
    aside = Layer(scratch_path(spark, "aside"), quarantine_schema(table))
    stream_silver(
        spark, path, raw.schema, table, silver, aside, scratch_path(spark, "stream"), max_files=2
    ).awaitTermination()
    names = list(table.columns)
    valid = silver.latest(spark, table.key).select(F.lit("valid").alias("verdict"), *names, F.lit(None).alias("broken"))
    broken = F.array_join("broken_rules", ",").alias("broken")
    return _plain(valid.unionByName(aside.read(spark).select(F.lit("quarantine").alias("verdict"), *names, broken)))


@query("""
SELECT doc_id, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS text, lang, source, n_chars, sha256(trim(text, ' ' || chr(9) || chr(10) || chr(13)))
       AS text_sha256
FROM documents
QUALIFY row_number() OVER (PARTITION BY trim(text, ' ' || chr(9) || chr(10) || chr(13))
                           ORDER BY doc_id) = 1
""")
def silver_documents(spark: SparkSession, folder: str) -> DataFrame:
    return distinct_texts(table(spark, folder, "documents"), "doc_id", "text")


@query("""
SELECT r_name, c_mktsegment, strftime(o_orderdate, '%Y-%m') AS order_month,
       sum(l_extendedprice::DECIMAL(18, 2) * (1 - l_discount::DECIMAL(4, 2)))::DOUBLE AS revenue,
       count(*) AS n_lines, count(DISTINCT o_orderkey) AS n_orders
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY ALL
""")
def gold_revenue(spark: SparkSession, folder: str) -> DataFrame:
    names = ("lineitem", "orders", "customer", "nation", "region")
    totals = revenue_by_region(*(table(spark, folder, name) for name in names))
    return totals.withColumn("revenue", F.col("revenue").cast("double"))


@query("""
SELECT ts::DATE AS event_day, event_type, count(*) AS n_events,
       count(DISTINCT user_id) AS n_users, sum(value::DECIMAL(18, 2))::DOUBLE AS total_value
FROM events GROUP BY ALL
""")
def gold_daily_events(spark: SparkSession, folder: str) -> DataFrame:
    totals = daily_event_totals(table(spark, folder, "events"))
    return totals.withColumn("total_value", F.col("total_value").cast("double"))


@query("""
SELECT ts::DATE AS event_day, event_type, count(*) AS n_events,
       count(DISTINCT user_id) AS n_users, sum(value::DECIMAL(18, 2))::DOUBLE AS total_value
FROM events GROUP BY ALL
""")
def arriving_gold(spark: SparkSession, folder: str) -> DataFrame:
    """The same daily totals, kept as sums that each batch of arriving events adds to."""
    events = table(spark, folder, "events")
    path = scratch_path(spark, "raw")
    events.repartition(5).write.parquet(path)
    kinds = {f.name: f.dataType.simpleString() for f in events.schema}
    conformed = Conformed(kinds, key=["event_id"], order=["ts"], required=["event_id", "ts"])
    totals, gold = user_days(), Layer(scratch_path(spark, "gold"), _user_days_schema())
    silver = Layer(scratch_path(spark, "silver"), silver_schema(conformed))
    aside = Layer(scratch_path(spark, "aside"), quarantine_schema(conformed))
    stream_silver(
        spark, path, events.schema, conformed, silver, aside, scratch_path(spark, "stream"), max_files=2,
        gold=[(totals, gold)],
    ).awaitTermination()
    days = days_of(read_gold(spark, totals, gold))
    return days.withColumn("total_value", F.col("total_value").cast("double"))


def _user_days_schema() -> T.StructType:
    return T.StructType.fromDDL("event_day date, event_type string, user_id bigint, n bigint, total decimal(38,2)")


@query("""
SELECT n_name, (sum(l_quantity::DECIMAL(18, 2)) FILTER (l_returnflag = 'R'))::DOUBLE AS returned,
       (sum(l_quantity::DECIMAL(18, 2)) FILTER (l_returnflag <> 'R'))::DOUBLE AS kept
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
GROUP BY ALL
""")
def gold_supplier_returns(spark: SparkSession, folder: str) -> DataFrame:
    totals = supplier_returns(
        *(table(spark, folder, name) for name in ("lineitem", "supplier", "nation"))
    )
    return totals.withColumns({c: F.col(c).cast("double") for c in ("returned", "kept")})
