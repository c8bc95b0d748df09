"""Substring dedup with automata of recurring phrases.

1. Anchors. Of the runs of ``GRAM`` words in each ``WINDOW - GRAM + 1`` consecutive
   places the smallest hash is kept. Two texts that share ``WINDOW`` words keep the same
   run, so a window that recurs has an anchor that recurs.
2. Phrases. Each text is cut to the windows whose anchor recurs. Their hashes are
   grouped; a window that also starts in a smaller document is a confirmed phrase there,
   and the smallest such document owns it.
3. Automata. Documents meet their confirmed phrases. A task takes a few MiB of documents,
   compiles the phrases into Aho-Corasick automata of at most ``PATTERNS`` patterns over
   its own word numbers and streams the documents through them, which finds every
   occurrence. A word covered by a match that belongs to a smaller document goes.

Popular keys are thinned before the shuffle: of the documents of one piece that hold the
same anchor or window, only the smallest asks for the rest of the table; the others are
settled in the piece and travel under a key of their own.

Nulls, empty texts, ties: a null or empty text has no words; with fewer than ``WINDOW``
words nothing is removed. Equal texts are judged once: the smallest id owns the text, in
all others every word goes that a window covers. Rows that repeat a doc_id with one text
are one document; rows of one id with two texts are judged text by text, and do not remove
from each other. A row without a
doc_id is left whole and removes nothing. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import pin
from .common import gram_hashes, mixed, pieces, word_hashes

WINDOW = 13
GRAM = 4
PATTERNS = 50_000


def smallest_runs(words: np.ndarray, window: int, gram: int) -> np.ndarray:
    """The smallest hash of a run of ``gram`` words in each window."""
    grams = gram_hashes(words, gram)
    span = window - gram + 1
    least = grams[: max(len(grams) - span + 1, 0)].copy()
    for i in range(1, span):
        np.minimum(least, grams[i : i + len(least)], out=least)
    return least


def settle(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which rows of a piece ask the whole table, the smallest id of each key, and whether it is alone.

    ``keys`` and ``ids`` are of one row per occurrence. The rows of the smallest id of a key ask.
    """
    order = np.lexsort((ids, keys))
    k, i = keys[order], ids[order]
    first = np.concatenate(([True], k[1:] != k[:-1])) if len(k) else np.empty(0, bool)
    group = np.cumsum(first) - 1
    least, most = i[first], i[np.concatenate((first[1:], [True]))] if len(k) else i
    owner = np.empty(len(ids), np.int64)
    alone = np.empty(len(ids), bool)
    owner[order] = least[group]
    alone[order] = (least == most)[group]
    return ids == owner, owner, alone


def own_keys(keys: np.ndarray, ids: np.ndarray, ask: np.ndarray) -> np.ndarray:
    """Keys of the rows that ask; the others get a key nobody shares."""
    with np.errstate(over="ignore"):
        alone = mixed(keys + mixed(ids.view(np.uint64)))
    return np.where(ask, keys, alone).view(np.int64)


def _recurring_anchors(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """Rows ``(doc_id, digest, found)``: the anchors of a text that other documents hold too."""

    def post(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            prints, lengths = [np.empty(0, np.uint64)], []
            for text in batch.column("text").to_pylist():
                found = np.unique(smallest_runs(word_hashes(text.split()), window, gram))
                prints.append(found)
                lengths.append(len(found))
            ids = np.repeat(batch.column("doc_id").to_numpy(zero_copy_only=False), lengths)
            digests = np.repeat(batch.column("digest").to_numpy(), lengths)
            keys = np.concatenate(prints)
            ask, _, alone = settle(keys, ids)
            columns = [
                pa.array(own_keys(keys, ids, ask)),
                pa.array(ids),
                pa.array(digests),
                pa.array(keys.view(np.int64)),
                pa.array(~alone),
            ]
            keep = pa.array(ask | ~alone)
            yield pa.RecordBatch.from_arrays(columns, ["key", "doc_id", "digest", "anchor", "shared"]).filter(keep)

    rows = docs.where("doc_id IS NOT NULL").mapInArrow(
        post, "key bigint, doc_id bigint, digest bigint, anchor bigint, shared boolean"
    )
    same = Window.partitionBy("key")
    seen = rows.select(
        "doc_id",
        "digest",
        "anchor",
        (F.max("shared").over(same) | (F.min("doc_id").over(same) < F.max("doc_id").over(same))).alias("recurs"),
    )
    return seen.where("recurs").groupBy("doc_id", "digest").agg(F.collect_set("anchor").alias("found"))


def _phrases(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """Rows ``(doc_id, digest, phrases)``: places of windows that a smaller document holds, and their owners."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            starts, phrases, lengths = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], []
            for text, found in zip(
                batch.column("text").to_pylist(), batch.column("found").to_pylist(), strict=True
            ):
                held = np.empty(0, np.int64)
                if found is not None:
                    words = word_hashes(text.split())
                    known = np.array(found, np.int64).view(np.uint64)
                    held = np.flatnonzero(np.isin(smallest_runs(words, window, gram), known))
                    phrases.append(gram_hashes(words, window)[held])
                starts.append(held)
                lengths.append(len(held))
            ids = np.repeat(batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False), lengths)
            digests = np.repeat(batch.column("digest").to_numpy(), lengths)
            keys = np.concatenate(phrases)
            ask, owner, _ = settle(keys, ids)
            columns = [
                pa.array(own_keys(keys, ids, ask)),
                pa.array(ids),
                pa.array(digests),
                pa.array(np.concatenate(starts).astype(np.int32)),
                pa.array(owner),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["key", "doc_id", "digest", "start", "owner"])

    cuts = rows.mapInArrow(cut, "key bigint, doc_id bigint, digest bigint, start int, owner bigint")
    least = F.min("owner").over(Window.partitionBy("key"))
    owned = cuts.select("doc_id", "digest", "start", least.alias("owner")).where("owner < doc_id")
    return owned.groupBy("doc_id", "digest").agg(F.collect_list(F.struct("start", "owner")).alias("phrases"))


def removed_words(
    batch: pa.RecordBatch, window: int, patterns: int
) -> tuple[list[list[bytes]], list[np.ndarray]]:
    """The words of each text, and which of them a phrase of a smaller document covers."""
    texts = [text.split() for text in batch.column("text").to_pylist()]
    ids = batch.column("doc_id").to_pylist()
    gone = [np.zeros(len(words), bool) for words in texts]
    numbers: dict[bytes, int] = {}
    phrases = batch.column("phrases").to_pylist()
    coded = [
        tuple(numbers.setdefault(w, len(numbers)) for w in words) if own else ()
        for words, own in zip(texts, phrases, strict=True)
    ]
    owners: dict[tuple[int, ...], int] = {}

    def stream() -> None:
        automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for phrase, owner in owners.items():
            automaton.add_word(phrase, owner)
        automaton.make_automaton()
        for n, code in enumerate(coded):
            for end, owner in automaton.iter(code) if code else ():
                if owner < ids[n]:
                    gone[n][end - window + 1 : end + 1] = True
        owners.clear()

    for code, own in zip(coded, phrases, strict=True):
        for phrase in own or ():
            words = code[phrase["start"] : phrase["start"] + window]
            owners[words] = min(owners.get(words, phrase["owner"]), phrase["owner"])
            if len(owners) >= patterns:
                stream()
    if owners:
        stream()
    return texts, gone


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, patterns: int = PATTERNS) -> DataFrame:
    """Rows ``(doc_id, n_words, n_removed, kept_sha256, kept)``, one per row of ``docs``.

    ``kept`` is what is left of the text, its words joined by one space.
    """

    def mark(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts, gone = removed_words(batch, window, patterns)
            for n, copy in enumerate(batch.column("copy").to_pylist()):
                if copy and len(texts[n]) >= window:
                    gone[n][:] = True
            left = [
                b" ".join(w for w, g in zip(words, lost, strict=True) if not g) if lost.any() else b" ".join(words)
                for words, lost in zip(texts, gone, strict=True)
            ]
            columns = [
                batch.column("doc_id"),
                pa.array([len(words) for words in texts], pa.int64()),
                pa.array([int(lost.sum()) for lost in gone], pa.int64()),
                pa.array([sha256(x).hexdigest() for x in left]),
                pa.array(left, pa.binary()),
            ]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
            yield pa.RecordBatch.from_arrays(columns, names)

    text = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text)
    # Of the rows of one id, the digest tells the text; where ids have one text each, it is 0 and takes no room.
    digest, one = F.xxhash64("text"), ["doc_id", "digest"]
    texts = source.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(digest).alias("x"), F.max(digest).alias("y"))
    single = texts.where("x <> y").isEmpty()
    source = source.withColumn("digest", F.lit(0).cast("bigint") if single else digest)
    exact = source.where("doc_id IS NOT NULL").select(*one, F.unhex(F.sha2("text", 256)).alias("sha"))
    least = exact.groupBy("sha").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"))
    copies = exact.join(least.where("owner < last"), "sha").where("owner < doc_id")
    copies = pin(copies.select(*one).distinct(), "copies")
    found = _recurring_anchors(source, window, gram).join(copies, one, "left_anti")

    # Both joins use the same shuffle of the texts.
    cut = source.join(found.hint("merge"), one, "left").select(*one, "text", "found")
    phrases = _phrases(cut, window, gram)
    own = source.join(phrases.hint("merge"), one, "left").join(
        copies.withColumn("copy", F.lit(True)), one, "left"
    )
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept binary"
    return own.select("doc_id", "text", "phrases", "copy").mapInArrow(mark, schema)


# The same by comparing windows.
SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
e AS (SELECT doc_id, word, i, [word, {", ".join(f"lead(word, {k}) OVER p" for k in range(1, WINDOW))}] AS l,
             lead(i, {WINDOW - 1}) OVER p AS last
      FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d)
      WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
g AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY array_to_string(l, ' ')) AS owner
      FROM e WHERE last IS NOT NULL),
r AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + {WINDOW - 1})) AS i FROM g WHERE owner < doc_id),
k AS (SELECT e.doc_id, count(r.i) AS n_removed,
             string_agg(word, ' ' ORDER BY e.i) FILTER (WHERE r.i IS NULL) AS kept
      FROM e LEFT JOIN r USING (doc_id, i) GROUP BY e.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
