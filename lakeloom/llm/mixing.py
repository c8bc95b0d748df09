"""Mixing sources to target weights by Pareto order sampling.

Sizes are words. Each source's target is its weight's share of all words, stopped at
``CAP`` times what the source holds; what that leaves is shared anew by weight. Of a
source with target ``t`` and size ``s`` each document is taken the whole part of ``t / s``
times for certain. What words are left are drawn: a document is taken once more with a
probability ``p`` in proportion to its size, up to 1, such that the words expected are those
left. For that, documents are ranked by random odds over inclusion odds, ``(u / (1 - u)) /
(p / (1 - p))``, and the smallest are taken until the source's remaining words are as near
to reached as whole documents allow. ``u`` is a hash of the row, so reruns agree.

Probabilities follow from the counts of each size, of which a source has no more than its
longest text has words. The cut is found without sorting a source: ranks are counted in
``BINS`` bins with map-side sums. Ranges of ``RANGE`` bins are accumulated, then the bins of the range that
holds the cut, and only the bin that holds the cut is ordered. With more rows a bin holds more, but always one part in ``BINS`` of a source.

Nulls, empty texts, ties: a null text has size 0; documents of size 0 count
nothing and are taken only as whole copies. A null source is a source of its own, last in order. Equal rows share their fate,
as their hash is the same. Without any words all targets are 0. Columns other than doc_id,
text and source are only carried.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import pin
from .common import own, unused

WEIGHTS = (1.0, 2.0, 3.0)
CAP = 3
BINS = 1 << 16
RANGE = 1 << 8
WORD = r"[^\x20\x09-\x0D]+"


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Rows ``(nameless, name, source_size, target)`` from ``(nameless, name, source_size)``.

    Sources are numbered in order by partition and place, not in one task. Each round
    stops at least one more source or ends.
    """
    spark = sources.sparkSession
    ordered = sources.orderBy("nameless", "name").select(
        "*",
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("place"),
    )
    ordered = pin(ordered, "sources")
    before, firsts = 0, []
    for part, n in sorted((r[0], r[1]) for r in ordered.groupBy("part").count().collect()):
        firsts.append((part, before))
        before += n
    first = spark.createDataFrame(firsts, "part int, first bigint")
    cycle = F.element_at(
        F.array(*map(F.lit, weights)), ((F.col("first") + F.col("place")) % len(weights) + 1).cast("int")
    )
    weighed = pin(ordered.join(first, "part").withColumn("weight", cycle), "weighed")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    share, n_stopped = 0.0, -1
    while True:
        stopped = F.col("weight") * share > F.col("source_size") * cap
        taken, weight, n = weighed.agg(
            F.sum(F.when(stopped, F.col("source_size") * cap)),
            F.sum(F.when(~stopped, F.col("weight"))),
            F.count(F.when(stopped, 1)),
        ).first()
        if n == n_stopped or not weight:
            break
        share, n_stopped = (total - (taken or 0)) / weight, n
    target = F.least(F.col("weight") * share, (F.col("source_size") * cap).cast("double"))
    return weighed.select("nameless", "name", "source_size", target.alias("target"))


def _crossing(counted: DataFrame, at: str) -> DataFrame:
    """Per source the value of ``at`` where the sizes reach ``left``, and their sum before it."""
    source = ["nameless", "name"]
    upto = F.col("before") + F.sum("n").over(Window.partitionBy(*source).orderBy(at))
    reached = counted.withColumn("upto", upto).where("upto >= left AND upto - n < left")
    return reached.groupBy(*source).agg(
        F.min(at).alias(f"cut_{at}"), F.min_by(F.col("upto") - F.col("n"), at).alias("before")
    )


def per_word(known: DataFrame, source: list[str]) -> DataFrame:
    """Rows ``(*source, a_word)``: the inclusion probability a word brings, where words are left.

    Documents too long for it are certain. The longest that are not, and what is left without
    the certain ones, give the probability: expected words are those left.
    """
    sizes = known.where("left > 0 AND size > 0").groupBy(*source, "left", "size").agg(F.count(F.lit(1)).alias("n"))
    longer = Window.partitionBy(*source).orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    shorter = Window.partitionBy(*source).orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    size = F.col("size").cast("double")
    certain = F.coalesce(F.sum(F.col("n") * size).over(longer), F.lit(0.0))
    squares = F.sum(F.col("n") * size * size).over(shorter)
    rows = sizes.select(*source, "size", ((F.col("left") - certain) / squares).alias("a_word"))
    fits = rows.where(F.col("a_word") * F.col("size") <= 1)
    return fits.groupBy(*source).agg(F.max_by("a_word", "size").alias("a_word"))


def mixed(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, cap: int = CAP, seed: int = 17, bins: int = BINS
) -> DataFrame:
    """Rows ``(doc_id, digest, nameless, name, size, source_size, target, copies)``, one per row of ``docs``."""
    text = F.coalesce("text", F.lit(""))
    digest = F.xxhash64(text, F.lit(seed)).alias("digest")
    sized = docs.select(
        "doc_id",
        digest,
        F.col("source").isNull().alias("nameless"),
        F.coalesce("source", F.lit("")).alias("name"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("size"),
    )
    sized = pin(sized, "sized")
    source = ["nameless", "name"]
    shares = targets(sized.groupBy(*source).agg(F.sum("size").alias("source_size")), weights, cap)
    shares = pin(shares, "targets")

    expected = F.col("target") / F.col("source_size")
    bits = F.xxhash64("doc_id", "digest", F.lit(seed)).bitwiseAND(F.lit((1 << 52) - 1))
    u = (bits + F.lit(0.5)) / F.lit(float(1 << 52))
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    known = sized.join(shares, source).withColumns(
        {"whole": F.when(F.col("source_size") > 0, F.least(F.floor(expected), F.lit(cap))).otherwise(0), "u": u}
    )
    known = known.withColumn("left", F.col("target") - F.col("whole") * F.col("source_size"))
    # Where no words are left there is no probability a word brings.
    p = F.when(F.col("a_word").isNotNull(), F.least(F.col("a_word") * F.col("size"), F.lit(1.0)))
    known = known.join(pin(per_word(known, source), "a-word"), source, "left").withColumn("p", F.coalesce(p, F.lit(0.0)))
    # Ranks from 0 up are brought between 0 and 1; a certain document comes first.
    rank = F.when(F.col("p") >= 1, F.lit(0.0)).when(F.col("p") > 0, odds)
    known = known.withColumn("rank", rank).withColumn("bin", F.floor(F.col("rank") / (1 + F.col("rank")) * bins))
    open_rows = known.where("rank IS NOT NULL")
    counted = open_rows.groupBy(*source, "left", "bin").agg(F.sum("size").alias("n"))
    counted = pin(counted.withColumn("range", F.floor(F.col("bin") / RANGE)), "bins")
    ranges = counted.groupBy(*source, "left", "range").agg(F.sum("n").alias("n"))
    wide = _crossing(ranges.withColumn("before", F.lit(0).cast("bigint")), "range")
    cut = pin(_crossing(counted.join(wide, source).where("range = cut_range"), "bin"), "cut")
    inside = open_rows.join(cut, source).where("bin = cut_bin")
    ranked = inside.groupBy(*source, "rank", "left", "before").agg(F.sum("size").alias("n"))
    order = Window.partitionBy(*source).orderBy("rank")
    ranked = ranked.withColumn("upto", F.col("before") + F.sum("n").over(order))
    # The document that crosses the line is taken if that ends nearer to it.
    near = F.col("upto") - F.col("left") <= F.col("left") - (F.col("upto") - F.col("n"))
    last = ranked.where((F.col("upto") <= F.col("left")) | near).groupBy(*source).agg(F.max("rank").alias("last"))
    lines = pin(cut.join(last, source, "left"), "lines")
    chosen = (F.col("bin") < F.col("cut_bin")) | ((F.col("bin") == F.col("cut_bin")) & (F.col("rank") <= F.col("last")))
    # Without a line all open documents together do not reach what is left.
    more = F.when(F.col("rank").isNull(), False).when(F.col("cut_bin").isNull(), True).otherwise(chosen)
    copies = F.col("whole") + F.when(F.coalesce(more, F.lit(False)), 1).otherwise(0)
    return known.join(lines, source, "left").select(
        "doc_id", "digest", *source, "size", "source_size", "target", copies.cast("int").alias("copies")
    )


def sample(docs: DataFrame, seed: int = 17, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    key = F.xxhash64(F.coalesce("text", F.lit("")), F.lit(seed))
    taken, copy = unused(docs, "_taken"), unused(docs, "_copy")
    rows = mixed(docs, seed=seed, **options).where("copies > 0")
    rows = rows.select(F.struct("doc_id", "digest", "copies").alias(taken)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(f"{taken}.doc_id")) & (key == F.col(f"{taken}.digest"))
    copies = F.explode(F.sequence(F.lit(1), F.col(f"{taken}.copies"))).alias(copy)
    return docs.join(rows, same).select(*own(docs), copies).drop(copy)
