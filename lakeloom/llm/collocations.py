"""Phrases whose words go together more often than chance, by best-first growth.

A phrase grows to the right from its first word. Whatever it grows into, its lowest cut
scores at most ``1000 n / f(first word)``, as a cut's rest is at least as frequent as the
phrase. So first words are taken in order of that bound, rarest first, in rounds of a
growing share of the text; a round counts pairs, keeps those of ``LEAST`` and more, and
grows them word by word. Each candidate found has a lowest and a highest score that follow
from counts at hand. As soon as a language has ``TOP`` surviving candidates, the lowest
score of the last of them is a line: first words whose bound lies below it are never grown,
and only candidates whose highest score reaches it have their rests counted exactly. Bounds
equal to the line stay in, so ties are settled too.

Tasks cut texts into words once and write them as blocks of places in the block's own
vocabulary. The words of all blocks meet by a shuffle, once; the frequent ones are named
by the first of their places, and everything after that counts these numbers, not strings
or hashes. Pairs and windows are counted
within a block before they are shuffled. Scores are decimals of 38 digits: exact up to
10^14 occurrences of a phrase and 10^16 words of a language.

Nulls, empty texts, ties: a null text is empty, a null language is ``und``. Rows count as
often as they occur, whatever their doc_id. Equal scores are ordered by count, then by the
phrase's bytes. A language with fewer survivors returns all. An empty table makes no rows.
Other columns are not looked at. A long text is cut at a separator every few MiB; one
without any is a single stretch, held by its task.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import LONG_ROWS, pin
from .common import SPREAD, lists, mixed, small_batches, texts

LEAST = 100
TOP = 2000
LONGEST = 5
BLOCK_BYTES = 12 << 20
# Text is split into words, and sent to Python, in steps of about this many bytes.
STEP_BYTES = 1 << 20
# So many windows or pairs of a block are made rows at a time.
STEP_ROWS = 1 << 17
# The shares of a language's text that its grown first words cover, round by round.
SHARES = (1 / 8, 1.0)
# Up to so many pairs are sent to the tasks that look for them; more are joined by a shuffle.
SENT_PAIRS = 1_000_000

SEPARATORS = b".,;:!?\n\x0b\x0c\r"
CUT = re.compile(rb"[.,;:!?\n-\r]")
UPPER = bytes(range(ord("A"), ord("Z") + 1))
FOLD = bytes.maketrans(UPPER + SEPARATORS + b"\t", UPPER.lower() + b"\n" * len(SEPARATORS) + b" ")
# A word's number: the task, the block in it, the place in the block's vocabulary.
BLOCK_BITS, PLACE_BITS = 16, 25
# No byte of UTF-8: stands between pieces.
BREAK = b"\xff"

WORDS = [f"w{k}" for k in range(1, LONGEST + 1)]


def stretches(text: bytes) -> Iterator[bytes]:
    """The text, cut after a separator every few MiB."""
    start = 0
    while len(text) - start > BLOCK_BYTES:
        found = CUT.search(text, start + BLOCK_BYTES)
        if not found:
            break
        yield text[start : found.end()]
        start = found.end()
    yield text[start:]


def coded(parts: list[bytes]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words as places in their vocabulary, -1 between pieces; the vocabulary; its counts."""
    split, step, size = [], [], 0
    for k, part in enumerate(parts, 1):
        step.append(part)
        size += len(part)
        if size >= STEP_BYTES or k == len(parts):
            words = b"\n".join(step).translate(FOLD).replace(b"\n", b" " + BREAK + b" ").split()
            split.append(pa.array([BREAK, *words], pa.binary()))
            step, size = [], 0
    found = pa.chunked_array(split, pa.binary()).dictionary_encode().unify_dictionaries()
    codes = np.concatenate([c.indices.to_numpy() for c in found.chunks])[1:] - 1
    vocabulary = found.chunk(0).dictionary[1:].cast(pa.string())
    return codes, vocabulary, np.bincount(codes[codes >= 0], minlength=len(vocabulary))


def blocks(docs: DataFrame) -> DataFrame:
    """Rows ``(lang, block, codes, words, counts)`` of all texts."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[bytes]] = {}
        held, done, task = 0, 0, TaskContext.get().partitionId()

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal done
            for lang, parts in waiting.items():
                codes, vocabulary, counts = coded(parts)
                if len(vocabulary):
                    if done >> BLOCK_BITS or len(vocabulary) >> PLACE_BITS:
                        raise OverflowError("more blocks in a task, or words in a block, than can be numbered")
                    row = [
                        pa.array([lang]),
                        pa.array([task << BLOCK_BITS | done]),
                        lists(codes, [len(codes)], pa.int32()),
                        pa.ListArray.from_arrays([0, len(vocabulary)], vocabulary),
                        lists(counts, [len(counts)], pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(row, ["lang", "block", "codes", "words", "counts"])
                    done += 1
            waiting.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
                for part in stretches(text.as_py()):
                    waiting.setdefault(lang.as_py(), []).append(part)
                    held += len(part)
                    if held >= BLOCK_BYTES:
                        yield from flush()
                        held = 0
        yield from flush()

    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    form = "lang string, block bigint, codes array<int>, words array<string>, counts array<bigint>"
    return texts(docs, lang).mapInArrow(cut, form)


def frequent(cut: DataFrame) -> DataFrame:
    """Rows ``(block, at, own, id, lang, word, f)`` of the words that can be part of a candidate.

    A word is in a block's vocabulary once, so a popular one has as many rows as blocks.
    """
    places = cut.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "entry"))
    own = F.shiftleft("block", PLACE_BITS).bitwiseOR(F.col("at").cast("long")) + 1
    rows = places.select("block", "at", own.alias("own"), "lang", F.col("entry.words").alias("word"), "entry.counts")
    same = Window.partitionBy("lang", "word")
    rows = rows.withColumns({"f": F.sum("counts").over(same), "id": F.min("own").over(same)})
    return rows.where(F.col("f") >= LEAST).drop("counts")


def numbered(cut: DataFrame, known: DataFrame) -> DataFrame:
    """Rows ``(lang, codes, ids, fs)``: blocks of frequent words only, 0 where others or a break were."""
    known = known.groupBy("block").agg(F.collect_list(F.struct("at", "id", "f")).alias("known"))

    def renumber(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                codes = batch.column("codes")[k].values.to_numpy()
                at, ids, fs = (c.to_numpy() for c in batch.column("known")[k].values.flatten())
                place = np.zeros(int(codes.max()) + 2, np.int32)
                place[at] = np.arange(1, len(at) + 1)
                codes = place[codes]
                kept = np.ones(len(codes), bool)
                kept[1:] = (codes[1:] > 0) | (codes[:-1] > 0)
                codes = codes[kept]
                row = [
                    batch.column("lang").slice(k, 1),
                    lists(codes, [len(codes)], pa.int32()),
                    lists(ids, [len(ids)], pa.int64()),
                    lists(fs, [len(fs)], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(row, ["lang", "codes", "ids", "fs"])

    form = "lang string, codes array<int>, ids array<bigint>, fs array<bigint>"
    return cut.select("block", "lang", "codes").join(known, "block").drop("block").mapInArrow(renumber, form)


def read_block(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A block's codes, and id and count by code; code 0 has neither."""
    codes = batch.column("codes")[k].values.to_numpy().astype(np.int64)
    ids, fs = (np.concatenate(([0], batch.column(c)[k].values.to_numpy())) for c in ("ids", "fs"))
    return codes, ids, fs


def pair_counts(encoded: DataFrame, turn: DataFrame) -> DataFrame:
    """Rows ``(w1, w2, n)``: pairs whose first word is in its language's turn, by block."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, high = (batch.column(c).to_pylist() for c in ("low", "high"))
            for k in range(batch.num_rows):
                codes, ids, fs = read_block(batch, k)
                first = fs[codes[:-1]]
                here = (first > low[k]) & (first <= high[k]) & (codes[1:] > 0)
                keys, n = np.unique(codes[:-1][here] * len(ids) + codes[1:][here], return_counts=True)
                for start in range(0, len(keys), STEP_ROWS):
                    some = keys[start : start + STEP_ROWS]
                    row = [ids[some // len(ids)], ids[some % len(ids)], n[start : start + STEP_ROWS].astype(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in row], ["w1", "w2", "n"])

    return encoded.join(turn, "lang").mapInArrow(count, "w1 bigint, w2 bigint, n bigint")


def pair_keys(w1: np.ndarray, w2: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(mixed(w1.astype(np.uint64)) * SPREAD + w2.astype(np.uint64))


def windows(encoded: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows ``(prev, w1, ..., w5, n)`` of all places where one of the pairs ``(w1, w2)`` is.

    Few pairs are sent to the tasks as hashes, which leaves out almost all other places;
    the join that follows is exact.
    """
    sent = None
    if pairs.count() <= SENT_PAIRS:
        few = pairs.toPandas()
        sent = np.sort(pair_keys(few["w1"].to_numpy(np.int64), few["w2"].to_numpy(np.int64)))

    def wanted(w1: np.ndarray, w2: np.ndarray) -> np.ndarray:
        if sent is None:
            return np.ones(len(w1), bool)
        if not len(sent):
            return np.zeros(len(w1), bool)
        keys = pair_keys(w1, w2)
        return sent[np.minimum(np.searchsorted(sent, keys), len(sent) - 1)] == keys

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                codes, ids, _ = read_block(batch, k)
                at = np.flatnonzero((codes[:-1] > 0) & (codes[1:] > 0))
                keys, which = np.unique(codes[at] * len(ids) + codes[at + 1], return_inverse=True)
                here = wanted(ids[keys // len(ids)], ids[keys % len(ids)])[which]
                # Places of a pair lie next to each other, so that a step counts all but a few of its windows.
                at = at[here][np.argsort(which[here], kind="stable")]
                padded = np.concatenate(([0], codes, np.zeros(LONGEST, np.int64)))
                for start in range(0, len(at), STEP_ROWS):
                    rows = padded[at[start : start + STEP_ROWS, None] + np.arange(LONGEST + 1)]
                    for place in range(2, LONGEST + 1):
                        rows[:, place] *= rows[:, place - 1] > 0
                    rows, n = np.unique(rows, axis=0, return_counts=True)
                    columns = [pa.array(ids[rows[:, i]]) for i in range(LONGEST + 1)]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(n.astype(np.int64))], ["prev", *WORDS, "n"])

    form = ", ".join(f"{c} bigint" for c in ("prev", *WORDS, "n"))
    return encoded.select("codes", "ids", "fs").mapInArrow(cut, form).join(pairs.select("w1", "w2"), ["w1", "w2"])


def grown(around: DataFrame) -> DataFrame:
    """Rows ``(phrase, a, survives)`` of all candidates that begin with the pairs in the windows.

    A longer candidate holds all occurrences of a phrase exactly if every occurrence has the
    same word before it, or every one the same word after it.
    """
    found = []
    for size in range(2, LONGEST + 1):
        begins = WORDS[:size]
        following = F.col(WORDS[size]) if size < LONGEST else F.lit(0).cast("long")
        counted = around.groupBy(*begins).agg(
            F.sum("n").alias("a"),
            *(f(c).alias(f"{name}_{side}") for name, f in (("min", F.min), ("max", F.max))
              for side, c in (("prev", F.col("prev")), ("next", following))),
        )
        counted = counted.where(F.col("a") >= LEAST)
        always = [(F.col(f"min_{s}") > 0) & (F.col(f"min_{s}") == F.col(f"max_{s}")) for s in ("prev", "next")]
        survives = F.lit(True) if size == LONGEST else ~(always[0] | always[1])
        found.append(counted.select(F.array(*begins).alias("phrase"), "a", survives.alias("survives")))
        if size < LONGEST:
            around = around.where(F.col(WORDS[size]) > 0).join(counted.select(*begins), begins, "left_semi")
    return reduce(DataFrame.unionByName, found)


def score(a: Column, n: Column, left: Column, rest: Column) -> Column:
    """``floor(1000 a n / (l r))``, exact."""
    over = a.cast("decimal(15,0)") * F.lit(1000).cast("decimal(4,0)") * n.cast("decimal(17,0)")
    under = left.cast("decimal(17,0)") * rest.cast("decimal(17,0)")
    return F.call_function("div", over, under)


def cuts(found: DataFrame, words: DataFrame, totals: DataFrame, counted: DataFrame) -> DataFrame:
    """A row for each cut of the candidates ``found``; ``counted`` has all that are prefixes of them."""
    each = found.select("phrase", F.posexplode("phrase").alias("at", "id")).join(words.select("id", "lang", "f"), "id")
    fs = F.transform(F.array_sort(F.collect_list(F.struct("at", "f"))), lambda x: x["f"])
    known = each.groupBy("phrase").agg(fs.alias("fs"), F.first("lang").alias("lang"))
    rows = found.join(known, "phrase").join(totals, "lang")
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.size("phrase") - 1)).alias("k"))
    rows = rows.withColumns(
        {
            "left": F.slice("phrase", F.lit(1), F.col("k")),
            "rest": F.slice("phrase", F.col("k") + 1, F.size("phrase")),
            "rest_fs": F.slice("fs", F.col("k") + 1, F.size("fs")),
        }
    )
    lefts = words.select(F.array("id").alias("left"), F.col("f").alias("l"))
    return rows.join(lefts.unionByName(counted.select(F.col("phrase").alias("left"), F.col("a").alias("l"))), "left")


def bounded(found: DataFrame, words: DataFrame, totals: DataFrame) -> DataFrame:
    """Rows ``(phrase, a, lang, low, high)``: between what the score of each survivor lies."""
    rows = cuts(found.where("survives"), words, totals, found)
    least = F.when(F.size("rest") == 1, F.col("rest_fs")[0]).otherwise(F.col("a"))
    rows = rows.select(
        "phrase", "a", "lang",
        score(F.col("a"), F.col("n"), F.col("l"), F.array_min("rest_fs")).alias("low"),
        score(F.col("a"), F.col("n"), F.col("l"), least).alias("high"),
    )
    return rows.groupBy("phrase", "a", "lang").agg(F.min("low").alias("low"), F.min("high").alias("high"))


def lines(bounds: DataFrame, top: int) -> DataFrame:
    """Rows ``(lang, line)``: the lowest score of the last of ``top``, where there are so many."""
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("low")))
    return bounds.select("lang", "low", place.alias("place")).where(F.col("place") == top).select(
        "lang", F.col("low").alias("line")
    )


def turns(words: DataFrame) -> DataFrame:
    """Rows ``(lang, share, most)``: first words of at most ``most`` occurrences cover the share."""
    step = F.floor(F.log2("f") * 4).alias("step")
    steps = words.groupBy("lang", step).agg(F.sum("f").alias("mass"), F.max("f").alias("most"))
    upto = Window.partitionBy("lang").orderBy("step")
    share = F.sum("mass").over(upto) / F.sum("mass").over(Window.partitionBy("lang"))
    place = F.row_number().over(upto)
    return steps.select("lang", "most", F.when(place == 1, F.lit(0.0)).otherwise(share).alias("share"))


def rests(needed: DataFrame, encoded: DataFrame) -> DataFrame:
    """Rows ``(rest, r)``: all occurrences of the phrases ``needed``, of two words and more."""
    pairs = pin(needed.select(F.col("rest")[0].alias("w1"), F.col("rest")[1].alias("w2")).distinct(), "rest-pairs")
    around = pin(windows(encoded, pairs), "rest-windows")
    sizes = [
        around.where(F.col(WORDS[size - 1]) > 0)
        .groupBy(F.array(*WORDS[:size]).alias("rest"))
        .agg(F.sum("n").alias("r"))
        .join(needed.where(F.size("rest") == size), "rest", "left_semi")
        for size in range(2, LONGEST)
    ]
    return reduce(DataFrame.unionByName, sizes)


def phrases(docs: DataFrame, top: int = TOP) -> DataFrame:
    """Rows ``(lang, rank, phrase, a, l, r, n, score)``: each language's first ``top``."""
    with small_batches(docs.sparkSession, STEP_BYTES):
        return ranked(docs, top)


def ranked(docs: DataFrame, top: int) -> DataFrame:
    """The phrases; what is left to run when this returns needs no Python."""
    spark = docs.sparkSession
    cut = pin(blocks(docs), "blocks", **LONG_ROWS)
    size = F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y)
    totals = pin(cut.groupBy("lang").agg(F.sum(size).alias("n")), "totals")
    known = pin(frequent(cut), "frequent")
    words = pin(known.where("own = id").select("id", "lang", "word", "f"), "words")
    encoded = pin(numbered(cut, known), "numbered", **LONG_ROWS)
    steps = pin(turns(words), "turns")

    found = spark.createDataFrame([], "phrase array<bigint>, a bigint, survives boolean")
    bounds = spark.createDataFrame([], "phrase array<bigint>, a bigint, lang string, low bigint, high bigint")
    done = totals.select("lang", "n", F.lit(0).cast("long").alias("upto"), F.lit(None).cast("bigint").alias("line"))
    for share in (*SHARES, 1.0):
        # A language with a line grows all that can still reach it, another one a larger share.
        within = F.max(F.when(F.col("share") <= share, F.col("most"))).alias("most")
        most = steps.groupBy("lang").agg(within, F.max("most").alias("all"))
        reach = F.call_function("div", F.col("n").cast("decimal(17,0)") * F.lit(1000), F.col("line").cast("decimal(19,0)"))
        high = F.when(F.col("line") > 0, F.least(reach, "all")).otherwise(F.col("most"))
        state = pin(done.join(most, "lang").select("lang", "n", F.col("upto").alias("low"), high.alias("high")), "state")
        turn = state.where("high > low")
        if turn.isEmpty():
            break
        counts = pair_counts(encoded, turn.select("lang", "low", "high"))
        pairs = counts.groupBy("w1", "w2").agg(F.sum("n").alias("a")).where(F.col("a") >= LEAST)
        around = pin(windows(encoded, pin(pairs, "pairs")), "windows")
        found = found.unionByName(pin(grown(around), "grown"))
        bounds = pin(bounded(found, words, totals), "bounds")
        upto = F.greatest("low", "high").alias("upto")
        done = pin(state.select("lang", "n", upto).join(lines(bounds, top), "lang", "left"), "done")

    line = F.coalesce("line", F.lit(0))
    close = bounds.join(done.select("lang", "line"), "lang").where(F.col("high") >= line).select("phrase", "a")
    exact = pin(cuts(close, words, totals, found), "cuts")
    counted = words.select(F.array("id").alias("rest"), F.col("f").alias("r")).unionByName(
        found.select(F.col("phrase").alias("rest"), F.col("a").alias("r"))
    )
    needed = pin(exact.select("rest").distinct().join(counted, "rest", "left_anti"), "needed")
    scored = exact.join(counted.unionByName(rests(needed, encoded)), "rest")
    value = score(F.col("a"), F.col("n"), F.col("l"), F.col("r"))
    lowest = F.min(F.struct(value.alias("score"), "k", "l", "r")).alias("cut")
    chosen = scored.groupBy("lang", "phrase", "a", "n").agg(lowest)
    each = chosen.select("phrase", F.posexplode("phrase").alias("at", "id")).join(words.select("id", "word"), "id")
    text = F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"])
    spelled = each.groupBy("phrase").agg(F.array_join(text, " ").alias("spelled"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "spelled")
    rows = chosen.join(spelled, "phrase").select("lang", F.col("spelled"), "a", "cut.l", "cut.r", "n", "cut.score")
    rows = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return rows.select(
        "lang", F.col("rank").cast("long").alias("rank"), F.col("spelled").alias("phrase"), "a", "l", "r", "n", "score"
    )


SQL = r"""
WITH pieces AS (
    SELECT lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM (SELECT coalesce(lang, 'und') AS lang, text FROM documents)
),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists WHERE len(w) > 0),
starts AS (
    SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3, w[i + 3] AS w4, w[i + 4] AS w5 FROM places
),
f AS (
    SELECT lang, [w1] AS p, count(*) AS f FROM starts GROUP BY ALL
    UNION ALL SELECT lang, [w1, w2], count(*) FROM starts WHERE w2 IS NOT NULL GROUP BY ALL
    UNION ALL SELECT lang, [w1, w2, w3], count(*) FROM starts WHERE w3 IS NOT NULL GROUP BY ALL
    UNION ALL SELECT lang, [w1, w2, w3, w4], count(*) FROM starts WHERE w4 IS NOT NULL GROUP BY ALL
    UNION ALL SELECT lang, [w1, w2, w3, w4, w5], count(*) FROM starts WHERE w5 IS NOT NULL GROUP BY ALL
),
c AS (SELECT lang, p, f AS a FROM f WHERE f >= 100 AND len(p) > 1),
held AS (
    SELECT lang, p[1:len(p) - 1] AS p, a FROM c WHERE len(p) > 2
    UNION SELECT lang, p[2:], a FROM c WHERE len(p) > 2
),
alive AS (SELECT * FROM c ANTI JOIN held USING (lang, p, a)),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE len(p) = 1 GROUP BY lang),
cut AS (SELECT lang, p, a, unnest(range(1, len(p))) AS k FROM alive),
scored AS (
    SELECT cut.lang, cut.p, k, a, n, x.f AS l, y.f AS r,
           (1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS score
    FROM cut JOIN n ON n.lang = cut.lang
    JOIN f AS x ON x.lang = cut.lang AND x.p = cut.p[1:k]
    JOIN f AS y ON y.lang = cut.lang AND y.p = cut.p[k + 1:]
),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank,
       array_to_string(p, ' ') AS phrase, a, l, r, n, score::BIGINT AS score
FROM lowest QUALIFY rank <= 2000
"""
