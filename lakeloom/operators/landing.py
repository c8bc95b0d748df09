"""Which candidate a key goes to, and what became of the others."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ORDER = ("source_ord", "url_pos", "link_pos")

FIRST, LAST = "first", "last"

# What is said of candidates whose object was fetched and could not be read.
UNREADABLE = "unreadable"

# Reasons that mean "could not be fetched"; every other reason rejects the row.
FETCH_REASONS = ("page_missing", UNREADABLE)


def resolve_conflicts(
    df: DataFrame,
    mode: str = FIRST,
    key: Sequence[str] = ("target_key",),
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """One row per key: the first or the last in order.

    ``row_number() = 1`` is also applied before the shuffle, so each task sends
    one row of a key however popular the key is.
    """
    if mode not in (FIRST, LAST):
        raise ValueError(f"mode must be {FIRST!r} or {LAST!r}, not {mode!r}")
    columns = [F.col(c).asc() if mode == FIRST else F.col(c).desc() for c in order]
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*columns))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def skip_landed(
    candidates: DataFrame,
    landed: DataFrame,
    key: Sequence[str] = ("target_key",),
    few: bool = False,
) -> DataFrame:
    """Candidates whose key is not in ``landed``, of which only the keys are read.

    After :func:`resolve_conflicts` the candidates are already partitioned by
    the key and hold it once. ``few`` is for candidates whose size was checked:
    their keys go to the scan of ``landed``, and only what they hit is shuffled,
    not the keys of the whole layer.
    """
    keys = landed.select(*key)
    if few:
        keys = keys.join(F.broadcast(candidates.select(*key)), list(key), "left_semi")
    return candidates.join(keys, list(key), "left_anti")


def union_sources(*sources: DataFrame) -> DataFrame:
    """All candidates, each source numbered by its place."""
    numbered = (df.withColumn("source_ord", F.lit(i)) for i, df in enumerate(sources))
    return reduce(DataFrame.unionByName, numbered)


def group_candidates(candidates: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Candidates of one source, key, object and reason as one row; columns ``also`` tell groups apart too.

    Counts and ends of order are combined before the shuffle: a file linked from
    a third of all pages is one row per task, and so are all rows set aside for
    one reason. The two positions are one number, so that rows are combined by
    hash; a struct would have to be sorted first.
    """
    page = F.col("url_pos").cast("decimal(19,0)") * F.lit(10**10).cast("decimal(11,0)")
    at = page + F.col("link_pos").cast("decimal(10,0)")
    return candidates.groupBy(
        *also, "source_ord", "source_type", "target_key", "object_id", "reason"
    ).agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("first_at"), F.max(at).alias("last_at"))


def with_presence(groups: DataFrame, fetched: DataFrame) -> DataFrame:
    """Adds where the object lies, ``(length, path, start)``, and ``copies``, NULL if it was not fetched.

    ``fetched`` names each object once.
    """
    return groups.join(fetched.withColumn("copies", F.lit(1)), "object_id", "left")


def set_aside(groups: DataFrame, broken: DataFrame) -> DataFrame:
    """The groups ``(source_ord, source_type, target_key, object_id)`` of ``broken`` no longer compete."""
    place = ["source_ord", "source_type", "target_key", "object_id"]
    marked = groups.join(broken.select(*place, F.lit(True).alias("_broken")).distinct(), place, "left")
    reason = F.when(F.col("_broken") & F.col("reason").isNull(), F.lit(UNREADABLE)).otherwise(F.col("reason"))
    return marked.withColumn("reason", reason).drop("_broken")


def _competing(groups: DataFrame) -> DataFrame:
    return groups.where(F.col("reason").isNull() & (F.col("copies") > 0))


def pick_winners(groups: DataFrame, mode: str) -> DataFrame:
    """Per key the group whose object is stored; absent objects do not compete."""
    order = ("source_ord", "first_at" if mode == FIRST else "last_at")
    return resolve_conflicts(_competing(groups), mode, order=order)


def _status(mode: str) -> Column:
    """What becomes of a group's candidates, but for the one that wins."""
    reason = F.col("reason")
    return (
        F.when(reason.isin(*FETCH_REASONS), F.lit("failed"))
        .when(reason.isNotNull(), F.lit("rejected"))
        .when(F.col("copies").isNull(), F.lit("failed"))
        .otherwise(F.lit("skipped_exists" if mode == FIRST else "landed"))
    )


def outcome_counts(
    groups: DataFrame, winners: DataFrame, mode: str = FIRST, by: Sequence[str] = ("source_type",)
) -> DataFrame:
    """Rows ``(*by, status, n)`` over all candidates.

    Everything is summed from counts; no candidate is joined back to its key. In
    mode ``last`` each present candidate is written in its turn, so all of them
    count as landed.
    """
    rows = groups.select(*by, _status(mode).alias("status"), "n")
    if mode == FIRST:
        # A winner moves one of its group's candidates from skipped to landed.
        one = F.lit(1).cast("long")
        moves = F.array(
            F.struct(F.lit("landed").alias("status"), one.alias("n")),
            F.struct(F.lit("skipped_exists").alias("status"), (-one).alias("n")),
        )
        rows = rows.unionByName(winners.select(*by, F.inline(moves)))
    return rows.groupBy(*by, "status").agg(F.sum("n").alias("n")).where("n > 0")


def outcome_items(groups: DataFrame, winners: DataFrame, mode: str = FIRST) -> DataFrame:
    """Rows ``(source_type, target_key, object_id, reason, status, n)``.

    A winner is found by all that names its group, not by its key alone: a group
    is there once, so no popular key gathers in one task.
    """
    name = ["source_type", "target_key", "object_id"]
    rest = F.col("n")
    if mode == FIRST:
        won = winners.select("source_ord", *name, F.lit(1).cast("long").alias("won"))
        groups = groups.join(won, ["source_ord", *name], "left")
        rest = F.col("n") - F.coalesce(F.col("won"), F.lit(0))
    else:
        groups = groups.withColumn("won", F.lit(0).cast("long"))
    parts = F.array(
        F.struct(F.lit("landed").alias("status"), F.col("won").alias("n")),
        F.struct(_status(mode).alias("status"), rest.alias("n")),
    )
    return groups.select(*name, "reason", F.inline(parts)).where("n > 0")
