"""Bronze to silver: cleaned and conformed tables.

What "cleaned and conformed" means here is our own definition: values are
trimmed and cast to a declared type, rows that break a rule are set aside with
the names of the rules, and of the valid rows each key is kept once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import null_if_empty, strip
from ..operators.landing import FIRST, LAST, resolve_conflicts
from ..operators.rules import broken_rules
from ..operators.split import QUARANTINE, VALID, Split, split
from ..session import pin
from ..sinks.layer import Layer, bucket_of


@dataclass(frozen=True)
class Conformed:
    """A silver table: column -> type, key, order among rows of a key, and rules.

    A required column must have a value of its type, and so must the key.
    ``rules`` see conformed columns.
    """

    columns: dict[str, str]
    key: Sequence[str]
    order: Sequence[str]
    required: Sequence[str] = ()
    upper: Sequence[str] = ()
    rules: dict[str, Column] = field(default_factory=dict)


def conform_value(c: Column, kind: str, upper: bool = False) -> Column:
    """Text trimmed, empty as NULL; any other type by cast, NULL where it does not fit.

    The cast itself ignores white space around a number or date.
    """
    if kind != "string":
        return c.try_cast(kind)
    text = null_if_empty(strip(c.cast("string")))
    return F.upper(text) if upper else text


def _conform(bronze: DataFrame, table: Conformed) -> DataFrame:
    return bronze.select(
        *(
            conform_value(F.col(name), kind, name in table.upper).alias(name)
            for name, kind in table.columns.items()
        )
    )


def _rules(table: Conformed) -> dict[str, Column]:
    names = dict.fromkeys([*table.required, *table.key])
    required = {f"{name}_missing": F.col(name).isNotNull() for name in names}
    return {**required, **table.rules}


def checked(bronze: DataFrame, table: Conformed) -> DataFrame:
    """All rows conformed, with the rules each one breaks; one pass, no shuffle."""
    return _conform(bronze, table).withColumn("broken_rules", broken_rules(_rules(table)))


def refine(bronze: DataFrame, table: Conformed) -> tuple[DataFrame, DataFrame]:
    """``(valid, quarantine)``: rows of the table, and rows set aside with reasons.

    Rows are told apart by a plain condition; the names of broken rules are only
    collected for those that break one.
    """
    rules = _rules(table)
    holds = reduce(and_, (F.coalesce(ok, F.lit(False)) for ok in rules.values()), F.lit(True))
    rows = _conform(bronze, table)
    quarantine = rows.where(~holds).withColumn("broken_rules", broken_rules(rules))
    return resolve_conflicts(rows.where(holds), FIRST, table.key, table.order), quarantine


def distinct_texts(documents: DataFrame, id_column: str, text: str) -> DataFrame:
    """One row per distinct trimmed text: the one with the lowest id.

    Ids and digests alone are ranked, combined in the tasks, so a text copied a million
    times is one row per task and no text is in that shuffle. Copies are then left out by
    id: while those are few, texts go from scan to result without a shuffle.
    """
    cleaned = documents.withColumn(text, strip(F.col(text))).withColumn("text_sha256", F.sha2(F.col(text), 256))
    name = [id_column, "text_sha256"]
    names = pin(cleaned.groupBy(*name).agg(F.count(F.lit(1)).alias("_n")), "digests")
    # A text that is NULL has no digest; it is a text like any other.
    first = names.groupBy(F.col("text_sha256").alias("_digest")).agg(F.min(id_column).alias("_first"))
    ranked = names.join(first, F.col("text_sha256").eqNullSafe(F.col("_digest"))).drop("_digest")
    stays = F.col(id_column).eqNullSafe(F.col("_first"))
    copies = pin(ranked.where(~stays | (F.col("_n") > 1)).select(*name, stays.alias("_stays")), "copies")
    rows = _besides(cleaned, copies, name, "left_anti")
    again = copies.where("_stays")
    if again.isEmpty():
        return rows
    repeated = _besides(cleaned, again, name, "left_semi")
    others = [c for c in repeated.columns if c not in (*name, text)]
    return rows.unionByName(resolve_conflicts(repeated, FIRST, name, others or name))


def _besides(rows: DataFrame, names: DataFrame, name: list[str], how: str) -> DataFrame:
    """The rows whose columns ``name`` are among those of ``names``, or are not; NULL is a value."""
    named = names.select(*(F.col(c).alias(f"_of_{c}") for c in name))
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in name))
    return rows.join(named, same, how)


def write_silver(bronze: DataFrame, table: Conformed, path: str) -> dict[str, int]:
    """Write folders ``verdict=valid`` and ``verdict=quarantine``; how many input rows went each way.

    The input is read once; of the valid rows, written by then, each key is kept once.
    """
    done = divide(bronze, table)
    names = F.lit(None).cast("array<string>")
    valid = resolve_conflicts(done.valid.drop("broken_rules"), FIRST, table.key, table.order)
    rows = (
        valid.withColumn("broken_rules", names)
        .withColumn("verdict", F.lit(VALID))
        .unionByName(done.quarantine.withColumn("verdict", F.lit(QUARANTINE)))
    )
    rows.write.partitionBy("verdict").parquet(path)
    return {VALID: done.n_valid, QUARANTINE: done.n_quarantine}


def divide(bronze: DataFrame, table: Conformed) -> Split:
    """All rows conformed and written once by verdict; those set aside with the rules they break."""
    rows = checked(bronze, table)
    return split(rows, F.size("broken_rules") == 0, "conformed")


@dataclass(frozen=True)
class Change:
    """What a batch did to a silver table: rows it put there and rows those replaced."""

    put: DataFrame
    replaced: DataFrame
    n_valid: int
    n_quarantine: int


def upsert(bronze: DataFrame, table: Conformed, silver: Layer, quarantine: Layer, load_id: str) -> Change:
    """Add a batch to a silver layer: of each key the row first in the table's order stays, whenever it came.

    The keys of the layer also hold each row's place in the order, so a batch is compared
    with the keys in its own buckets; rows are only read of keys that are replaced. Of
    equal rows the one that came first stays. A batch that runs again replaces what its
    first try left in both layers and makes the same change.
    """
    spark, key, order = bronze.sparkSession, list(table.key), list(table.order)
    done = divide(bronze, table)
    for layer in (silver, quarantine):
        layer.open_keys(spark)
    quarantine.write(done.quarantine, load_id)
    quarantine.commit(spark.createDataFrame([], "n bigint"), load_id, ["n"])
    first = pin(resolve_conflicts(done.valid.drop("broken_rules"), FIRST, key, order), "first")
    touched = sorted(r.bucket for r in first.select(bucket_of(key).alias("bucket")).distinct().collect())
    known = silver.keys(spark, [*key, *order], touched).where(F.col("load_id") != load_id)
    newest = resolve_conflicts(known, LAST, key, ["load_seq"])
    held = F.struct(*(F.col(c) for c in order))
    compared = first.join(newest.select(*key, held.alias("_held"), F.col("load_seq").alias("_in")), key, "left")
    better = F.col("_held").isNull() | (held < F.col("_held"))
    put = pin(compared.where(better).select(*first.columns, "_in"), "put")
    olds = put.where("_in IS NOT NULL").select(*key, F.col("_in").alias("load_seq"))
    loads = [r.load_seq for r in olds.select("load_seq").distinct().collect()]
    rows = silver.read(spark, besides=load_id).where(F.col("load_seq").isin(loads))
    replaced = pin(rows.join(olds, [*key, "load_seq"], "left_semi").select(*first.columns), "replaced")
    silver.write(put.drop("_in"), load_id)
    silver.commit(put.select(*dict.fromkeys([*key, *order])), load_id, key)
    return Change(put.drop("_in"), replaced, done.n_valid, done.n_quarantine)


def silver_schema(table: Conformed) -> T.StructType:
    """The schema of a silver layer."""
    return T.StructType([T.StructField(name, T.DataType.fromDDL(kind)) for name, kind in table.columns.items()])


def quarantine_schema(table: Conformed) -> T.StructType:
    """The schema of the layer of rows set aside."""
    return silver_schema(table).add("broken_rules", T.ArrayType(T.StringType()))
