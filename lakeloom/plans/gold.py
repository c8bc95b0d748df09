"""Silver to gold: curated totals for analysis. The definitions are our own.

Money is summed as decimals, so totals do not depend on the order of rows.
Every total is reduced on the key of the next join first: a key with a third of
all rows is a handful of rows per task before anything is shuffled, and the join
reuses the partitioning of the reduction. Which side of a join is broadcast is
left to the optimizer, which goes by table size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.layer import Layer

MONEY = "decimal(18,2)"


def _line_revenue() -> Column:
    """Price less discount, wide enough for amounts up to 10^16."""
    price = F.col("l_extendedprice").cast(MONEY)
    rate = F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)")
    return price * rate


def revenue_by_region(
    lineitem: DataFrame, orders: DataFrame, customer: DataFrame, nation: DataFrame, region: DataFrame
) -> DataFrame:
    """Revenue and orders per region, market segment and order month."""
    lines = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(_line_revenue()).alias("revenue"), F.count(F.lit(1)).alias("n_lines")
    )
    month = F.date_format("o_orderdate", "yyyy-MM").alias("order_month")
    by_customer = (
        orders.select("o_orderkey", "o_custkey", month)
        .join(lines, "o_orderkey")
        .groupBy(F.col("o_custkey").alias("c_custkey"), "order_month")
        .agg(
            F.sum("revenue").alias("revenue"),
            F.sum("n_lines").alias("n_lines"),
            F.count(F.lit(1)).alias("n_orders"),
        )
    )
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "r_name"
    )
    return (
        by_customer.join(
            customer.select("c_custkey", "c_nationkey", "c_mktsegment"), "c_custkey"
        )
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("r_name", "c_mktsegment", "order_month")
        .agg(*(F.sum(c).alias(c) for c in ("revenue", "n_lines", "n_orders")))
    )


@dataclass(frozen=True)
class Totals:
    """Sums per group that can be added up: columns of groups, and what is summed in them."""

    groups: dict[str, Column]
    sums: dict[str, Column]

    def of(self, rows: DataFrame, sign: int = 1) -> DataFrame:
        """The groups of some rows with their sums and ``n``, the number of rows."""
        one = F.lit(sign).cast("long")
        columns = [c.alias(name) for name, c in self.groups.items()]
        sums = [F.sum(c * F.lit(sign).cast("decimal(1,0)")).cast("decimal(38,2)").alias(name) for name, c in self.sums.items()]
        return rows.groupBy(*columns).agg(F.sum(one).alias("n"), *sums)

    def added(self, partials: DataFrame) -> DataFrame:
        """The groups of sums, added up."""
        sums = [F.sum(name).cast("decimal(38,2)").alias(name) for name in self.sums]
        return partials.groupBy(*self.groups).agg(F.sum("n").alias("n"), *sums)


def add_to_gold(put: DataFrame, replaced: DataFrame, totals: Totals, gold: Layer, load_id: str) -> None:
    """Store what a change of a silver table adds to its totals: new rows less those they replace.

    A load holds one row for each group the batch touches. A batch that runs again replaces
    its load, so nothing is added twice.
    """
    partials = totals.added(totals.of(put).unionByName(totals.of(replaced, -1)))
    gold.open_keys(put.sparkSession)
    gold.write(partials, load_id)
    gold.commit(partials.sparkSession.createDataFrame([], "n bigint"), load_id, ["n"])


def read_gold(spark: SparkSession, totals: Totals, gold: Layer) -> DataFrame:
    """The totals as they stand: stored sums of all loads added up, without groups whose rows are all gone."""
    return totals.added(gold.read(spark)).where("n <> 0")


def fold_gold(spark: SparkSession, totals: Totals, gold: Layer, fresh: Layer, load_id: str = "folded") -> Layer:
    """Write the totals as one load of another, empty root, from which a stream can go on."""
    if fresh.root == gold.root:
        raise ValueError("a layer cannot be folded onto the path it is read from")
    fresh.open_keys(spark)
    fresh.write(read_gold(spark, totals, gold), load_id)
    fresh.commit(spark.createDataFrame([], "n bigint"), load_id, ["n"])
    return fresh


def user_days() -> Totals:
    """Events per day, type and user; users can be counted from these, whenever they came."""
    groups = {"event_day": F.to_date("ts"), "event_type": F.col("event_type"), "user_id": F.col("user_id")}
    return Totals(groups, {"total": F.coalesce(F.col("value").cast(MONEY), F.lit(0).cast(MONEY))})


def daily_event_totals(events: DataFrame) -> DataFrame:
    """Events, their users and summed value per day and type.

    Users are counted from one row per user, day and type, which also spreads a
    day or type that holds most events.
    """
    day = F.to_date("ts").alias("event_day")
    per_user = events.groupBy(day, "event_type", "user_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast(MONEY)).alias("total")
    )
    return days_of(per_user)


def days_of(per_user: DataFrame) -> DataFrame:
    """Totals per day and type from those per day, type and user."""
    return per_user.groupBy("event_day", "event_type").agg(
        F.sum("n").alias("n_events"),
        F.count("user_id").alias("n_users"),
        F.sum("total").alias("total_value"),
    )


def supplier_returns(lineitem: DataFrame, supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """Returned and kept quantity per nation of the supplier."""
    returned = F.col("l_returnflag") == "R"
    quantity = F.col("l_quantity").cast(MONEY)
    per_supplier = lineitem.groupBy("l_suppkey").agg(
        F.sum(F.when(returned, quantity)).alias("returned"),
        F.sum(F.when(~returned, quantity)).alias("kept"),
    )
    return (
        per_supplier.join(
            supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")
        )
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name")
        .agg(F.sum("returned").alias("returned"), F.sum("kept").alias("kept"))
    )
