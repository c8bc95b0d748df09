"""MinHash near-duplicates by an inverted join over signature coordinates.

Every distinct text gets a signature of ``COORDINATES`` minima and is posted
under each (coordinate, value) pair. Two texts are candidates if they collide in
at least ``MATCHES`` coordinates. Postings are ordered from rare to popular; two
texts that collide so often must meet in the rarest ``COORDINATES - MATCHES + 1``
of each (prefix merging), so the popular lists are never read: for the pairs that
meet, their collisions are counted in the signatures (skip merging). Every
candidate is confirmed on the full shingle sets.

No list is expanded into its pairs. Each list first names three pivots, one of them
the member whose lists are the longest, and only (pivot, member) pairs are checked;
the links found tie a group of copies together however large it is. Documents of
lists that still hold several components then meet by their rarest shingles, which
is exact (``_rest``). Pairs left out are tied already or cannot be similar enough.

A pair at the similarity limit collides in 26 of 32 coordinates on average and in
fewer than 13 with a probability of 2e-7.

Nulls, empty texts, ties: a text that is null, empty or white space has no
shingles and links with nothing. Equal shingle sets are one class, signed once.
Rows that repeat a doc_id count as one document: a link of one is a link of all.
A row without a doc_id links with nothing, has no component and is kept. Other
columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import pin
from .common import components, gram_hashes, lists, mixed, pieces, texts, word_hashes

COORDINATES = 32
MATCHES = 13
SIMILARITY = 80  # percent

SIGNED = "doc_id bigint, n_shingles bigint, digest binary, signature array<bigint>"
SETS = "node bigint, shingles array<bigint>"


def shingle_sets(batch: pa.RecordBatch, n: int) -> list[np.ndarray]:
    """The sorted, distinct shingle hashes of each text; a shorter text is one shingle."""
    found = [text.lower().split() for text in batch.column("text").to_pylist()]
    hashes = word_hashes([w for words in found for w in words])
    grams = gram_hashes(hashes, n)
    sets, start = [], 0
    for words in found:
        if len(words) >= n:
            sets.append(np.unique(grams[start : start + len(words) - n + 1]))
        else:
            sets.append(gram_hashes(hashes[start : start + len(words)], len(words))[: len(words)])
        start += len(words)
    return sets


def minima(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """A row of minima per non-empty set; each coordinate orders hashes its own way."""
    seeds = mixed(np.arange(1, coordinates + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), coordinates), np.uint64)
    with np.errstate(over="ignore"):
        for j, seed in enumerate(seeds):
            x = (flat ^ seed) * np.uint64(0xD6E8FEB86659FD93)
            x ^= x >> np.uint64(32)
            x *= np.uint64(0x9E3779B97F4A7C15)
            out[:, j] = np.minimum.reduceat(x, starts)
    return out


def signed(docs: DataFrame, words: int = 4, coordinates: int = COORDINATES) -> DataFrame:
    """Rows ``(doc_id, n_shingles, digest, signature)``; no digest without shingles."""

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sets = shingle_sets(batch, words)
            sizes = np.array([len(s) for s in sets])
            full = [s for s in sets if len(s)]
            flat = minima(full, coordinates).ravel() if full else np.empty(0, np.uint64)
            digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            lengths = np.where(sizes > 0, coordinates, 0)
            columns = [
                batch.column("doc_id"),
                pa.array(sizes, pa.int64()),
                pa.array(digests, pa.binary()),
                lists(flat.view(np.int64), lengths, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "digest", "signature"])

    return texts(docs, F.col("doc_id").cast("bigint").alias("doc_id")).mapInArrow(sign, SIGNED)


def _sets(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """The full shingle sets of the documents named in ``nodes``."""

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sets = shingle_sets(batch, words)
            flat = np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64)
            lengths = np.array([len(s) for s in sets])
            columns = [batch.column("node"), lists(flat, lengths, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["node", "shingles"])

    named = texts(docs, F.col("doc_id").cast("bigint").alias("node"))
    return named.join(nodes, "node", "left_semi").mapInArrow(build, SETS)


def _candidates(pairs: DataFrame, classes: DataFrame, matches: int, similarity: int) -> DataFrame:
    """The pairs ``(a, b)`` whose signatures collide often enough and whose sizes allow a link."""
    one = classes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("signature").alias("s_a"))
    two = classes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("signature").alias("s_b"))
    least = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * similarity
    collide = F.size(F.array_intersect("s_a", "s_b")) >= matches
    return pairs.join(one, "a").join(two, "b").where(least).where(collide).select("a", "b").distinct()


def _links(sets: DataFrame, pairs: DataFrame, similarity: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("s_a"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("s_b"))
    both = F.size(F.array_intersect("s_a", "s_b"))
    joined = pairs.join(one, "a").join(two, "b")
    sized = joined.select("a", "b", both.alias("both"), (F.size("s_a") + F.size("s_b")).alias("total"))
    enough = F.lit(100) * F.col("both") >= F.lit(similarity) * (F.col("total") - F.col("both"))
    return sized.where(enough).select("a", "b")


def _rest(sets: DataFrame, prefix: DataFrame, tied: DataFrame, similarity: int) -> DataFrame:
    """Pairs ``(a, b)`` that pivots left open: they share a list but no component.

    Documents of lists that still hold several components are posted under their
    shingles, rare ones first. A pair that is similar enough must meet in a
    shingle so early that the rest of both sets can still hold the overlap it
    needs. A near copy whose own shingles take up that room meets nobody, so a
    large group around one text does not unfold into its pairs. Within a list,
    the largest component is paired with the others only.
    """
    needed = lambda total: F.ceil(F.lit(similarity) * total / F.lit(100.0 + similarity))
    own = F.coalesce("component", "node")
    members = pin(
        prefix.join(tied, "node", "left").select("node", "bucket", own.alias("component")), "members"
    )
    mixed_lists = members.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    open_nodes = members.join(mixed_lists.where("x <> y").select("bucket"), "bucket")
    open_nodes = open_nodes.select("node", "component").distinct()

    posted = sets.join(open_nodes, "node").select(
        "node", "component", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle")
    )
    lists_ = posted.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("length"),
        F.min("n").alias("least"),
        (F.min("component") < F.max("component")).alias("open"),
    )
    by_node = Window.partitionBy("node").orderBy("length", "shingle")
    placed = posted.join(lists_, "shingle").withColumn("place", F.row_number().over(by_node))
    smallest = F.greatest("least", F.ceil(F.col("n") * similarity / 100))
    early = F.lit(1) + F.col("n") - F.col("place") >= needed(F.col("n") + smallest)
    placed = pin(
        placed.where(F.col("open") & early).select("shingle", "node", "component", "n", "place"), "early"
    )

    sizes = placed.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("length"))
    largest = sizes.groupBy("shingle").agg(
        F.max(F.struct("length", "component"))["component"].alias("most"), F.count(F.lit(1)).alias("kinds")
    )
    strays = placed.join(largest.where("kinds > 1").drop("kinds"), "shingle").where("component <> most")
    strays = strays.select(
        "shingle", "most", *(F.col(c).alias(f"_{c}") for c in ("node", "component", "n", "place"))
    )
    meets = F.expr("component <> _component AND (component = most OR _node < node)")
    room = F.lit(1) + F.least(F.col("n") - F.col("place"), F.col("_n") - F.col("_place"))
    enough = room >= needed(F.col("n") + F.col("_n"))
    pairs = strays.join(placed, "shingle").where(meets & enough)
    return pairs.select(F.least("node", "_node").alias("a"), F.greatest("node", "_node").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame,
    words: int = 4,
    similarity: int = SIMILARITY,
    coordinates: int = COORDINATES,
    matches: int = MATCHES,
) -> DataFrame:
    """Rows ``(doc_id, n_shingles, component_id, kept)``, one per row of ``docs``."""
    signatures = pin(signed(docs, words, coordinates), "signatures")
    some = signatures.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    grouped = some.groupBy("digest").agg(F.min("doc_id").alias("least"))
    named = some.join(grouped, "digest").select(
        F.col("least").alias("node"), "digest", "signature", F.col("n_shingles").alias("n"), "doc_id"
    )
    classes = pin(named.where("doc_id = node").dropDuplicates(["node", "digest"]).drop("doc_id"), "classes")

    postings = classes.select("node", F.explode("signature").alias("bucket"))
    shared = postings.groupBy("bucket").agg(F.count(F.lit(1)).alias("length")).where("length > 1")
    by_node = Window.partitionBy("node")
    ranked = postings.join(shared, "bucket").select(
        "node",
        "bucket",
        F.row_number().over(by_node.orderBy("length", "bucket")).alias("place"),
        F.count(F.lit(1)).over(by_node).alias("n"),
        F.sum("length").over(by_node).alias("weight"),
    )
    kept = ranked.where(F.col("n") - F.col("place") >= matches - 1)
    prefix = pin(kept.select("node", "bucket", "weight"), "prefix")

    pivots = prefix.groupBy("bucket").agg(
        F.array_distinct(
            F.array(
                F.min("node"),
                F.max(F.struct("weight", "node"))["node"],
                F.min_by("node", F.xxhash64("node")),
            )
        ).alias("pivots")
    )
    met = prefix.join(pivots, "bucket").select("node", F.explode("pivots").alias("pivot"))
    met = met.where("node <> pivot").select(
        F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")
    )
    tested = pin(_candidates(met.distinct(), classes, matches, similarity), "candidates")
    sets = pin(_sets(docs, prefix.select("node").distinct(), words), "sets")
    links = pin(_links(sets, tested, similarity), "links")
    tied = pin(components(links), "tied")

    more = pin(_rest(sets, prefix, tied, similarity).join(tested, ["a", "b"], "left_anti"), "rest")
    if not more.isEmpty():
        edges = tied.select(F.col("node").alias("a"), F.col("component").alias("b"))
        tied = components(edges.union(_links(sets, more, similarity)))

    roots = grouped.join(tied, F.col("least") == F.col("node"), "left").select(
        "digest", F.coalesce("component", "least").alias("root")
    )
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return signatures.join(roots, "digest", "left").select(
        "doc_id",
        "n_shingles",
        own.alias("component_id"),
        F.coalesce(own == F.col("doc_id"), F.lit(True)).alias("kept"),
    )
