"""Silver and gold on authored rows."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators.split import split
from lakeloom.plans.gold import (
    Totals,
    add_to_gold,
    daily_event_totals,
    fold_gold,
    read_gold,
    revenue_by_region,
    supplier_returns,
)
from lakeloom.plans.silver import (
    Conformed,
    checked,
    distinct_texts,
    quarantine_schema,
    refine,
    silver_schema,
    upsert,
    write_silver,
)
from lakeloom.session import scratch_path
from lakeloom.sinks.layer import Layer
from lakeloom.streaming.arrivals import stream_silver

RAW = [
    (" 1 ", " ab ", "2.50", "2024-01-02"),
    ("1", "AB", "9", "2024-01-01"),
    ("1", "AB", "9", "2024-01-01"),
    ("2", "", "-1", "2024-01-01"),
    ("x", "c", "1", "2024-01-01"),
    ("3", "d", "1", "not a day"),
    ("4", "e", "cheap", "2024-02-30"),
    (None, None, None, None),
    ("5", "f", None, "2024-01-05"),
]


def raw(spark):
    return spark.createDataFrame(RAW, "id string, name string, price string, day string")


def table():
    return Conformed(
        columns={"id": "bigint", "name": "string", "price": "decimal(10,2)", "day": "date"},
        key=["id"],
        order=["day", "name"],
        required=["id", "day"],
        upper=["name"],
        rules={"price_positive": F.coalesce(F.col("price") > 0, F.lit(True))},
    )


def test_refine(spark):
    valid, quarantine = refine(raw(spark), table())
    got = {r.id: (r.name, r.price, r.day) for r in valid.collect()}
    assert got == {
        1: ("AB", Decimal("9.00"), datetime.date(2024, 1, 1)),
        5: ("F", None, datetime.date(2024, 1, 5)),
    }
    reasons = sorted(tuple(r.broken_rules) for r in quarantine.collect())
    assert reasons == [
        ("day_missing",), ("day_missing",), ("id_missing",), ("id_missing", "day_missing"),
        ("price_positive",)]
    assert checked(raw(spark), table()).count() == len(RAW)


def test_write_silver(spark):
    path = scratch_path(spark, "silver")
    assert write_silver(raw(spark), table(), path) == {"valid": 4, "quarantine": 5}
    got = {r.verdict: r["count"] for r in spark.read.parquet(path).groupBy("verdict").count().collect()}
    assert got == {"valid": 2, "quarantine": 5}


def test_distinct_texts_with_one_hot_text(spark):
    rows = spark.range(9000).select(
        F.col("id").alias("doc"),
        F.when(F.col("id") % 3 == 0, F.lit(" same text\n")).otherwise(F.col("id").cast("string")).alias("t"))
    got = distinct_texts(rows, "doc", "t")
    assert got.count() == 6001
    assert [r.doc for r in got.where("t = 'same text'").collect()] == [0]


def test_gold_totals(spark):
    lineitem = spark.createDataFrame(
        [(1, 10, 1.0, 100.0, 0.1, "R"), (1, 10, 2.0, 50.0, 0.0, "N"), (2, 11, 3.0, 10.0, 0.05, "A"),
         (9, 11, 4.0, 1.0, 0.0, "R")],
        "l_orderkey long, l_suppkey long, l_quantity double, l_extendedprice double, "
        "l_discount double, l_returnflag string")
    day = datetime.datetime(2024, 3, 31)
    orders = spark.createDataFrame([(1, 7, day), (2, 7, day), (3, 7, day)],
                                   "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz")
    customer = spark.createDataFrame([(7, 0, "BUILDING")], "c_custkey long, c_nationkey int, c_mktsegment string")
    nation = spark.createDataFrame([(0, "N0", 5)], "n_nationkey int, n_name string, n_regionkey int")
    region = spark.createDataFrame([(5, "ASIA")], "r_regionkey int, r_name string")
    got = revenue_by_region(lineitem, orders, customer, nation, region).collect()
    assert [(r.r_name, r.c_mktsegment, r.order_month, float(r.revenue), r.n_lines, r.n_orders) for r in got] == [
        ("ASIA", "BUILDING", "2024-03", 149.5, 3, 2)]
    supplier = spark.createDataFrame([(10, 0), (11, 0)], "s_suppkey long, s_nationkey int")
    got = supplier_returns(lineitem, supplier, nation).collect()
    assert [(r.n_name, float(r.returned), float(r.kept)) for r in got] == [("N0", 5.0, 5.0)]
    events = spark.createDataFrame([(day, 1, "view", 0.1), (day, 1, "view", 0.2), (day, 2, "view", 0.3)],
                                   "ts timestamp_ntz, user_id long, event_type string, value double")
    got = daily_event_totals(events).collect()
    assert [(r.n_events, r.n_users, float(r.total_value)) for r in got] == [(3, 2, 0.6)]


def test_texts_that_repeat_with_their_id_and_null_texts(spark):
    rows = [(2, "a "), (1, "a"), (1, "a"), (3, "b"), (3, "b"), (3, "c"), (4, None), (5, None), (None, "d"), (None, "d")]
    got = distinct_texts(spark.createDataFrame(rows, "id long, t string"), "id", "t").collect()
    assert sorted(((r.id, r.t) for r in got), key=repr) == sorted(
        [(1, "a"), (3, "b"), (3, "c"), (4, None), (None, "d")], key=repr)


def test_texts_are_in_no_exchange_of_the_ranking(spark, tables):
    documents = spark.read.parquet(f"{tables}/documents.parquet")
    text = distinct_texts(documents, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" in text and "Exchange hashpartitioning" not in text


def batches(spark, folder, *parts):
    for at, rows in enumerate(parts):
        df = spark.createDataFrame(rows, "k string, v string, sent string, amount string")
        df.coalesce(1).write.mode("append").json(folder)


BATCHES = [
    [("1", "x", "2", "10"), ("2", "y", "5", "7"), ("2", "y", "9", "8"), ("3", "", "1", "1")],
    [("1", "X ", "1", "20"), ("2", "z", "6", "9"), ("4", "w", "1", "3"), ("bad", "w", "1", "3")],
    [("1", "q", "3", "30"), ("2", "first", "4", "1"), ("5", "w", "2", "2"), (None, "w", "1", "4")],
]


def silver_of(spark, folder, size, scratch):
    table = Conformed(
        {"k": "bigint", "v": "string", "sent": "int", "amount": "decimal(18,2)"}, ["k"], ["sent"], required=["v"], upper=["v"])
    totals = Totals({"v": F.col("v")}, {"total": F.col("amount")})
    gold = Layer(scratch("gold"), T.StructType.fromDDL("v string, n bigint, total decimal(38,2)"))
    silver = Layer(scratch("silver"), silver_schema(table))
    aside = Layer(scratch("aside"), quarantine_schema(table))
    schema = T.StructType.fromDDL("k string, v string, sent string, amount string")
    cp = scratch("cp")

    def go():
        stream_silver(spark, folder, schema, table, silver, aside, cp, "json", max_files=size,
                      gold=[(totals, gold)]).awaitTermination()

    go()
    rows = {(r.k, r.v, r.sent, float(r.amount)) for r in silver.latest(spark, "k").collect()}
    sums = {(r.v, r.n, float(r.total)) for r in read_gold(spark, totals, gold).collect()}
    folded = fold_gold(spark, totals, gold, Layer(scratch("gold"), gold.schema))
    assert {(r.v, r.n, float(r.total)) for r in read_gold(spark, totals, folded).collect()} == sums
    return rows, aside.read(spark).count(), sums


@pytest.mark.parametrize("size", [1, 1000])
def test_silver_and_gold_do_not_depend_on_the_size_of_batches(spark, scratch, size):
    """A row that comes late and is first in order replaces, and gold gives back what it replaced."""
    folder = scratch("in")
    batches(spark, folder, *BATCHES)
    rows, aside, sums = silver_of(spark, folder, size, scratch)
    assert rows == {(1, "X", 1, 20.0), (2, "FIRST", 4, 1.0), (4, "W", 1, 3.0), (5, "W", 2, 2.0)}
    assert aside == 3
    assert sums == {("X", 1, 20.0), ("FIRST", 1, 1.0), ("W", 2, 5.0)}


def test_a_batch_that_runs_again_changes_nothing(spark, scratch):
    table = Conformed({"k": "bigint", "sent": "int"}, ["k"], ["sent"])
    totals = Totals({"k": F.col("k") % 2}, {})
    gold = Layer(scratch("gold"), T.StructType.fromDDL("k bigint, n bigint"))
    silver, aside = Layer(scratch("silver"), silver_schema(table)), Layer(scratch("aside"), quarantine_schema(table))

    def run(load_id, *rows):
        change = upsert(spark.createDataFrame([*rows], "k string, sent int"), table, silver, aside, load_id)
        add_to_gold(change.put, change.replaced, totals, gold, load_id)
        put, replaced = (sorted((r.k, r.sent) for r in df.collect()) for df in (change.put, change.replaced))
        return put, replaced, change.n_valid, change.n_quarantine

    run("a", ("1", 5), ("2", 5), ("x", 1))
    again = run("b", ("1", 3), ("2", 7), ("3", 1))
    assert again == ([(1, 3), (3, 1)], [(1, 5)], 3, 0)
    assert run("b", ("1", 3), ("2", 7), ("3", 1)) == again
    assert sorted((r.k, r.sent) for r in silver.latest(spark, "k").collect()) == [(1, 3), (2, 5), (3, 1)]
    assert sorted((r.k, r.n) for r in read_gold(spark, totals, gold).collect()) == [(0, 1), (1, 2)]
    assert aside.read(spark).count() == 1


def test_split_reads_its_input_once(spark):
    done = split(spark.range(10).withColumn("v", F.when(F.col("id") > 2, F.col("id"))), F.col("v") < 8)
    assert (done.n_valid, done.n_quarantine) == (5, 5)
    assert sorted(r.id for r in done.valid.collect()) == [3, 4, 5, 6, 7]
    assert sorted(r.id for r in done.quarantine.collect()) == [0, 1, 2, 8, 9]
