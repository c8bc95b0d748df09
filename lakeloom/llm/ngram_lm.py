"""A trigram model in an Elias-Fano trie, learned and queried by tasks.

Level 1 holds the vocabulary: sorted word hashes in Elias-Fano form with exact counts.
A word's place is its number. Level 2 holds, for each context, its successors: the
sequence ``context * V + successor``, so a search is relative to the context, monotone
pointers from contexts to their successors, and for each successor its discounted
probability ``(n - d) / n(context)`` in 8 bits on a logarithmic scale. The model
interpolates: ``p(w | c) = discounted + d * distinct(c) / n(c) * p1(w)``, where ``p1``
adds one to each count. An unknown context leaves ``p1``. Level 3 is of the same form: a
context is the place of a bigram in level 2, which also holds exact counts as a monotone
sequence of their sums, and ``p(w | b, c)`` interpolates with ``p(w | c)``; its pointers are
from each place of a bigram to where its successors end. A context that was not seen, and
the first token of a text, leave ``p(w | c)``.

All levels are cut into files: level 1 by ranges of hashes, levels 2 and 3 by ranges of
contexts with about ``SHARD_TOKENS`` tokens each; a popular context is cut by
successors. Once level 1 is there, texts are written as the numbers of their words, so they
are cut and hashed twice in all. Bigrams and trigrams are counted per task first and travel
as sorted blocks. A scoring task maps the files it needs into memory and asks for the
distinct bigrams and trigrams of ``PIECE_TOKENS`` tokens at a time; sorted keys are cut at
the files' first keys. What holds for a context, which is the front part of a key, is asked
once for its keys. Nothing but file names passes through the driver.

Nulls, empty texts, ties: a null or empty text is the end token alone. Rows that repeat
a doc_id are counted and scored each. A row without a doc_id is trained on. Without
training rows every score is that of unknown words. Other columns are not looked at.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import pin, scratch_path
from .common import offsets, pieces, word_hashes
from .elias_fano import EliasFano, encode, load, save

DISCOUNT = 0.75
SHARD_TOKENS = 2_000_000
PIECE_TOKENS = 400_000
HELD = 400_000  # distinct keys a task counts before it passes them on
END = np.uint64(xxhash.xxh3_64_intdigest(b" end"))


def tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of all texts and of the end, sorted, which of them each token is, tokens per text.

    Each text is closed by the end. Texts are bytes to Arrow here, whatever they hold.
    """
    column = batch.column("text")
    kind = pa.large_string() if pa.types.is_large_binary(column.type) else pa.string()
    texts = pc.ascii_trim_whitespace(pc.ascii_lower(column.view(kind)))
    split = pc.ascii_split_whitespace(texts)
    counts = np.diff(split.offsets.to_numpy()).astype(np.int64)
    words = split.flatten()
    bare = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    if bare.any():
        # An empty text is split into one empty word.
        words = words.filter(pa.array(np.repeat(~bare, counts)))
        counts[bare] = 0
    counts += 1
    coded = words.dictionary_encode()
    hashes = np.append(word_hashes(coded.dictionary.view(column.type).to_numpy(zero_copy_only=False)), END)
    which = np.full(int(counts.sum()), len(hashes) - 1)
    keep = np.ones(len(which), bool)
    keep[np.cumsum(counts) - 1] = False
    which[keep] = coded.indices.to_numpy()
    order = np.argsort(hashes)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return hashes[order], place[which], counts


def add_up(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts. The lists are emptied, so that memory is free early."""
    flat = np.concatenate(keys)
    keys.clear()
    n = np.concatenate(counts)
    counts.clear()
    order = np.argsort(flat, kind="stable")
    flat = flat[order]
    n = n[order]
    del order
    first = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
    return flat[first], np.add.reduceat(n, first)


class Tally:
    """Counts keys until there are many."""

    def __init__(self):
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        self.add_counted(*np.unique(keys, return_counts=True))

    def add_counted(self, distinct: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(distinct)
        self.counts.append(counts)
        self.size += len(distinct)
        if self.size > 2 * HELD:
            merged = add_up(self.keys, self.counts)
            self.keys, self.counts, self.size = [merged[0]], [merged[1]], len(merged[0])

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        found = add_up(self.keys, self.counts) if self.size else (np.empty(0, np.uint64), np.empty(0, np.int64))
        self.__init__()
        return found


def parts(keys: np.ndarray, firsts: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The files that sorted keys fall into, by the files' first keys, and the keys of each."""
    cuts = [*np.searchsorted(keys, firsts), len(keys)]
    for k in range(len(firsts)):
        if cuts[k] < cuts[k + 1]:
            yield k, slice(cuts[k], cuts[k + 1])


class Vocabulary:
    """Level 1: files ``(path, first hash, words before)`` in order."""

    def __init__(self, files: list[tuple[str, int, int]], size: int):
        self.files, self.size = files, size
        self.firsts = np.array([f[1] for f in files], np.uint64)
        self.open: dict[int, tuple[EliasFano, np.ndarray, int]] = {}

    def file(self, k: int) -> tuple[EliasFano, np.ndarray, int]:
        if k not in self.open:
            arrays = load(self.files[k][0])
            self.open[k] = EliasFano(arrays), arrays["count"], int(arrays["last"][0])
        return self.open[k]

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and count of sorted hashes; an unknown word has the number ``size`` and count 0."""
        numbers, counts = np.full(len(hashes), self.size, np.int64), np.zeros(len(hashes), np.int64)
        cuts = [*np.searchsorted(hashes, self.firsts), len(hashes)]
        for k, (_, first, before) in enumerate(self.files):
            part = slice(cuts[k], cuts[k + 1])
            if part.start < part.stop:
                level, count, last = self.file(k)
                asked = hashes[part] - np.uint64(first)
                inside = asked <= np.uint64(last - first)
                place, equal = level.successor(np.where(inside, asked, 0))
                known = equal & inside
                numbers[part] = np.where(known, place + before, self.size)
                counts[part][known] = count[place[known]]
        return numbers, counts


class Successors:
    """Level 2: files ``(path, first key, bigrams before)`` in order of keys ``context * width + successor``."""

    def __init__(self, files: list[tuple[str, int, int]], width: int):
        self.files, self.width = files, np.uint64(width)
        self.firsts = np.array([f[1] for f in files], np.uint64)
        self.open: dict[int, tuple] = {}

    def _file(self, k: int) -> tuple:
        if k not in self.open:
            arrays = load(self.files[k][0])
            self.open[k] = (
                EliasFano(arrays), EliasFano(arrays, "pointer_"), arrays["code"], arrays["book"],
                arrays["context"], int(arrays["last"][0]), EliasFano(arrays, "upto_"),
            )
        return self.open[k]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Discounted probabilities of sorted keys and their places, 0 and -1 where a bigram was not seen."""
        out, places = np.zeros(len(keys)), np.full(len(keys), -1)
        for k, part in parts(keys, self.firsts):
            level, _, code, book, _, last, _ = self._file(k)
            asked = keys[part]
            asked = asked[: np.searchsorted(asked, np.uint64(last), "right")]
            place, equal = level.successor(asked - self.firsts[k])
            at = part.start + np.flatnonzero(equal)
            out[at] = book[code[place[equal]]]
            places[at] = place[equal] + self.files[k][2]
        return out, places

    def counts(self, places: np.ndarray) -> np.ndarray:
        """How often each of the sorted places of bigrams was counted."""
        out = np.zeros(len(places), np.int64)
        cuts = [*np.searchsorted(places, [f[2] for f in self.files]), len(places)]
        for k, (_, _, before) in enumerate(self.files):
            part = slice(cuts[k], cuts[k + 1])
            if part.start < part.stop:
                out[part] = self._file(k)[6].gaps(places[part] - before)
        return out

    def distinct(self, contexts: np.ndarray) -> np.ndarray:
        """How many successors each of the sorted contexts has, over all files that hold a part."""
        out = np.zeros(len(contexts), np.int64)
        for k in range(len(self.files)):
            lo = np.searchsorted(contexts, np.int64(self.firsts[k] // self.width))
            hi = np.searchsorted(contexts, np.int64(self.firsts[k + 1] // self.width), "right") if k + 1 < len(
                self.files
            ) else len(contexts)
            if lo < hi:
                _, pointers, _, _, listed, _, _ = self._file(k)
                asked = contexts[lo:hi]
                place = np.minimum(np.searchsorted(listed, asked), len(listed) - 1)
                same = listed[place] == asked
                # Pointers are kept as a monotone sequence: entry i is where the successors of context i end.
                out[lo:hi][same] += pointers.gaps(place[same])
        return out


class Trigrams:
    """Level 3: files ``(path, first key)`` in order of keys ``place of the bigram * width + successor``."""

    def __init__(self, files: list[tuple[str, int]], width: int):
        self.files, self.width = files, np.uint64(width)
        self.firsts = np.array([f[1] for f in files], np.uint64)
        self.open: dict[int, tuple] = {}

    def _file(self, k: int) -> tuple:
        if k not in self.open:
            arrays = load(self.files[k][0])
            self.open[k] = (
                EliasFano(arrays), EliasFano(arrays, "pointer_"), arrays["code"], arrays["book"], int(arrays["last"][0])
            )
        return self.open[k]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Discounted probabilities of sorted keys, 0 where not seen."""
        out = np.zeros(len(keys))
        for k, part in parts(keys, self.firsts):
            level, _, code, book, last = self._file(k)
            asked = keys[part]
            asked = asked[: np.searchsorted(asked, np.uint64(last), "right")]
            place, equal = level.successor(asked - self.firsts[k])
            out[part.start + np.flatnonzero(equal)] = book[code[place[equal]]]
        return out

    def distinct(self, places: np.ndarray) -> np.ndarray:
        """How many successors each of the sorted bigrams has, over all files that hold a part."""
        out = np.zeros(len(places), np.int64)
        contexts = (self.firsts // self.width).astype(np.int64)
        los = np.searchsorted(places, contexts)
        his = [*np.searchsorted(places, contexts[1:], "right"), len(places)]
        for k, lo in enumerate(los):
            if lo < (hi := his[k]):
                # Entry i of the pointers is where the successors of the file's bigram i end.
                pointers = self._file(k)[1]
                asked = places[lo:hi] - contexts[k]
                asked = asked[: np.searchsorted(asked, pointers.n)]
                out[lo : lo + len(asked)] += pointers.gaps(asked)
        return out


def pointers_at(sequence: EliasFano, i: np.ndarray) -> np.ndarray:
    """Entries of an Elias-Fano sequence."""
    return sequence.at(i)


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ones of sorted values, and which of them each value is."""
    first = np.ones(len(values), bool)
    first[1:] = values[1:] != values[:-1]
    return values[first], np.cumsum(first) - 1


def planes(values: np.ndarray) -> bytes:
    """The bytes of all values by significance, without the highest ones that are zero in all; before them, how many are kept."""
    width = max((int(values.max(initial=0)).bit_length() + 7) // 8, 1)
    rows = values.view(np.uint8).reshape(len(values), -1)[:, :width].T
    return bytes([width]) + np.ascontiguousarray(rows).tobytes()


def from_planes(data: bytes, kind: type) -> np.ndarray:
    rows = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    out = np.zeros((rows.shape[1], np.dtype(kind).itemsize), np.uint8)
    out[:, : data[0]] = rows.T
    return out.view(kind).ravel()


def _source(docs: DataFrame, folds: int, fold: int) -> DataFrame:
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    held = F.coalesce(remainder == fold, F.lit(False))
    return docs.select("doc_id", held.alias("held_out"), text.alias("text"))


def numbers(docs: DataFrame, files: list[tuple[str, int, int]], size: int) -> DataFrame:
    """Rows ``(doc_id, held_out, numbers)``: each text as the numbers of its tokens, 4 or 8 bytes each."""
    kind = number_kind(size)

    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(files, size)
        for batch in pieces(batches, size=4 * PIECE_TOKENS):
            hashes, which, counts = tokens(batch)
            found = vocabulary.find(hashes)[0].astype(kind)[which]
            ends = np.concatenate(([0], np.cumsum(counts))) * kind.itemsize
            column = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(found)]
            )
            columns = [batch.column("doc_id"), batch.column("held_out"), column.cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "numbers"])

    form = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, numbers binary"
    return pin(docs.mapInArrow(number, form), "numbers")


def number_kind(size: int) -> np.dtype:
    return np.dtype(np.int32 if size < 2**31 - 1 else np.int64)


def numbered(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    return pieces(batches, "numbers", PIECE_TOKENS * number_kind(size).itemsize)


def learn_vocabulary(train: DataFrame, folder: str) -> DataFrame:
    """Count the words and write level 1; one row per file."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()

        def rows() -> pa.RecordBatch:
            keys, counts = tally.take()
            # Signed values in the order of the hashes.
            order = (keys ^ np.uint64(1 << 63)).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(order), pa.array(counts)], ["word", "n"])

        for batch in pieces(batches):
            hashes, which, _ = tokens(batch)
            tally.add_counted(hashes, np.bincount(which, minlength=len(hashes)))
            if tally.size > HELD:
                yield rows()
        yield rows()

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        if table.num_rows:
            signed = table.column("word").to_numpy()
            words = np.ascontiguousarray(signed).view(np.uint64) ^ np.uint64(1 << 63)
            n = table.column("n").to_numpy()
            first, last = int(words[0]), int(words[-1])
            path = f"{folder}/{uuid.uuid4().hex}.level1"
            arrays = encode(words - np.uint64(first), last - first + 1)
            save(path, arrays | {"count": n, "last": np.array([last], np.uint64)})
            # Where level 2 is cut: after so many tokens, a popular context in several parts.
            upto = np.cumsum(n)
            steps = np.arange(SHARD_TOKENS, int(upto[-1]), SHARD_TOKENS)
            place = np.searchsorted(upto, steps, "left")
            share = (steps - (upto[place] - n[place])) / n[place]
            row = [[path], [int(signed[0])], [len(words)], [int(upto[-1])], [place.tolist()], [share.tolist()]]
            names = ["path", "first", "words", "tokens", "place", "share"]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in row], schema=pa.schema(
                list(zip(names, [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64())]))
            ))

    counted = train.select("text").mapInArrow(count, "word bigint, n bigint")
    total = pin(counted.groupBy("word").agg(F.sum("n").alias("n")), "words")
    files = total.repartitionByRange("word").sortWithinPartitions("word").mapInArrow(
        write, "path string, first bigint, words bigint, tokens bigint, place array<bigint>, share array<double>"
    )
    return pin(files, "level1")


def blocks(tally: Tally, cuts: np.ndarray) -> pa.RecordBatch:
    """What a task counted, as one sorted block of keys for each shard; keys as steps, which are small."""
    keys, counts = tally.take()
    at = [*np.searchsorted(keys, cuts), len(keys)]
    parts = [(k, slice(at[k], at[k + 1])) for k in range(len(cuts)) if at[k] < at[k + 1]]
    columns = [
        pa.array([k for k, _ in parts], pa.int32()),
        pa.array([planes(np.diff(keys[p], prepend=np.uint64(0))) for _, p in parts], pa.binary()),
        pa.array([planes(counts[p]) for _, p in parts], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["shard", "keys", "counts"])


def merged(shard: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The keys and counts of all blocks of a shard."""
    keys = [np.cumsum(from_planes(x, np.uint64), dtype=np.uint64) for x in shard["keys"]]
    return add_up(keys, [from_planes(x, np.int64) for x in shard["counts"]])


def coded(n: np.ndarray, totals: np.ndarray, discount: float) -> dict[str, np.ndarray]:
    """Discounted probabilities in 8 bits on a logarithmic scale."""
    log = n - discount
    log /= totals
    np.log10(log, out=log)
    low, high = log.min(), log.max()
    step = max(high - low, 1e-9)
    log -= low
    log /= step
    log *= 255
    return {
        "code": np.rint(log, out=log).astype(np.uint8),
        "book": 10 ** (low + np.arange(256) / 255 * step),
    }


def learn(docs: DataFrame, folder: str, discount: float) -> dict:
    """Learn from the rows that are not held out; what a scoring task needs to know."""
    spark = docs.sparkSession
    train = docs.where("NOT held_out")
    rows = learn_vocabulary(train, folder).orderBy("first").collect()
    files, before = [], 0
    size = sum(r.words for r in rows)
    width = size + 1
    cuts = [0]
    for r in rows:
        files.append((r.path, (r.first & 0xFFFFFFFFFFFFFFFF) ^ (1 << 63), before))
        cuts += [int((p + before) * width + s * size) for p, s in zip(r.place, r.share, strict=True)]
        before += r.words
    cuts = np.unique(np.array(cuts, np.uint64))
    started = train.count()
    total = sum(r.tokens for r in rows)
    texts = numbers(docs, files, size)
    train = texts.where("NOT held_out")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for batch in numbered(batches, size):
            tally.add(bigrams(batch, size)[0])
            if tally.size > HELD:
                yield blocks(tally, cuts)
        yield blocks(tally, cuts)

    def build(shard: pd.DataFrame) -> pd.DataFrame:
        keys, n = merged(shard)
        first, last = int(cuts[shard["shard"].iloc[0]]), int(keys[-1])
        context = (keys // np.uint64(width)).astype(np.int64)
        listed, ends = np.unique(context, return_index=True)
        ends = np.concatenate((ends[1:], [len(keys)]))
        totals = context_counts(Vocabulary(files, size), listed, started)
        codes = coded(n, np.repeat(totals, np.diff(np.concatenate(([0], ends)))), discount)
        pointers = encode(ends.astype(np.uint64), len(keys) + 1)
        upto = np.cumsum(n)
        sums = encode(upto.astype(np.uint64), int(upto[-1]) + 1)
        arrays = encode(keys - np.uint64(first), last - first + 1)
        path = f"{folder}/{uuid.uuid4().hex}.level2"
        save(
            path,
            arrays
            | {f"pointer_{k}": v for k, v in pointers.items()}
            | {f"upto_{k}": v for k, v in sums.items()}
            | codes
            | {"context": listed, "last": np.array([last], np.uint64)},
        )
        # Where level 3 is cut, as level 2 is.
        steps = np.arange(SHARD_TOKENS, int(upto[-1]), SHARD_TOKENS)
        place = np.searchsorted(upto, steps, "left")
        share = (steps - (upto[place] - n[place])) / n[place]
        return pd.DataFrame(
            {"shard": [shard["shard"].iloc[0]], "path": [path], "n": [len(keys)], "place": [place], "share": [share]}
        )

    counted = train.select("numbers").mapInArrow(count, "shard int, keys binary, counts binary")
    built = "shard int, path string, n bigint, place array<bigint>, share array<double>"
    level2 = pin(counted.groupBy("shard").applyInPandas(build, built), "level2")
    second, places, above = [], 0, [0]
    for r in level2.orderBy("shard").collect():
        second.append((r.path, int(cuts[r.shard]), places))
        # A cut after every SHARD_TOKENS tokens and after each file.
        above += [(p + places) * width + int(s * size) for p, s in zip(r.place, r.share, strict=True)]
        places += r.n
        above.append(places * width)
    third = learn_trigrams(train, folder, discount, second, size, np.unique(np.array(above, np.uint64)))
    return {
        "files": files, "size": size, "tokens": total, "started": started, "texts": texts,
        "successors": second, "trigrams": third, "discount": discount,
    }


def learn_trigrams(
    train: DataFrame, folder: str, discount: float, second: list, size: int, cuts: np.ndarray
) -> list[tuple[str, int]]:
    """Count the trigrams and write level 3; its files."""
    width = size + 1

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        successors, tally = Successors(second, width), Tally()
        for batch in numbered(batches, size):
            keys, *_, counts = bigrams(batch, size)
            distinct, where = np.unique(keys, return_inverse=True)
            tally.add(trigrams(keys, successors.find(distinct)[1][where], counts, width)[1])
            if tally.size > HELD:
                yield blocks(tally, cuts)
        yield blocks(tally, cuts)

    def build(shard: pd.DataFrame) -> pd.DataFrame:
        keys, n = merged(shard)
        first, last = int(cuts[shard["shard"].iloc[0]]), int(keys[-1])
        contexts, where = runs((keys // np.uint64(width)).astype(np.int64))
        path = f"{folder}/{uuid.uuid4().hex}.level3"
        codes = coded(n, Successors(second, width).counts(contexts)[where], discount)
        arrays = encode(keys - np.uint64(first), last - first + 1)
        ends = np.cumsum(np.bincount((contexts - first // width)[where]))
        del contexts, where
        pointers = encode(ends.astype(np.uint64), len(keys) + 1)
        save(
            path,
            arrays
            | {f"pointer_{k}": v for k, v in pointers.items()}
            | codes
            | {"last": np.array([last], np.uint64)},
        )
        return pd.DataFrame({"shard": [shard["shard"].iloc[0]], "path": [path]})

    counted = train.select("numbers").mapInArrow(count, "shard int, keys binary, counts binary")
    level3 = pin(counted.groupBy("shard").applyInPandas(build, "shard int, path string"), "level3")
    return [(r.path, int(cuts[r.shard])) for r in level3.orderBy("shard").collect()]


def trigrams(keys: np.ndarray, places: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Where tokens with a known bigram before them stand, and the keys of their trigrams.

    ``keys`` and ``places`` are of the bigram that ends at each token; a first token has none before.
    """
    inner = np.ones(len(keys), bool)
    inner[np.cumsum(counts) - counts] = False
    at = np.flatnonzero(inner)
    at = at[places[at - 1] >= 0]
    return at, places[at - 1].astype(np.uint64) * np.uint64(width) + keys[at] % np.uint64(width)


def context_counts(vocabulary: Vocabulary, contexts: np.ndarray, started: int) -> np.ndarray:
    """How often each sorted word was counted; the number ``size`` stands for a text's start, ``started`` times there."""
    out = np.full(len(contexts), started, np.int64)
    befores = [f[2] for f in vocabulary.files] + [vocabulary.size]
    for k, (_, _, before) in enumerate(vocabulary.files):
        lo, hi = np.searchsorted(contexts, [before, befores[k + 1]])
        if lo < hi:
            out[lo:hi] = vocabulary.file(k)[1][contexts[lo:hi] - before]
    return out


def bigrams(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, ...]:
    """Keys of all bigrams of numbered texts, contexts, the unknown among them, numbers, tokens per text.

    The context of a first word is the start, numbered ``size``; an unknown context has no key.
    """
    column, kind = batch.column("numbers"), number_kind(size)
    at = offsets(column)
    number = np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[-1]].view(kind).astype(np.int64)
    counts = np.diff(at) // kind.itemsize
    context = np.concatenate(([0], number[:-1]))
    unknown = context == size
    firsts = np.cumsum(counts) - counts
    context[firsts] = size
    unknown[firsts] = False
    keys = context.astype(np.uint64) * np.uint64(size + 1) + number.astype(np.uint64)
    return keys, context, unknown, number, counts


def score(docs: DataFrame, folds: int = 7, fold: int = 2, discount: float = DISCOUNT) -> DataFrame:
    """Rows ``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``."""
    spark = docs.sparkSession
    source = _source(docs, folds, fold)
    model = learn(source, scratch_path(spark, "ngrams"), discount)
    size, total, texts = model["size"], model["tokens"], model.pop("texts")

    def rate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(model["files"], size)
        successors = Successors(model["successors"], size + 1)
        level3 = Trigrams(model["trigrams"], size + 1)
        for batch in numbered(batches, size):
            keys, context, unknown, number, counts = bigrams(batch, size)
            distinct, where = np.unique(keys, return_inverse=True)
            found, places = successors.find(distinct)
            # What holds for a context is asked once for its bigrams, which lie together.
            contexts, place = runs((distinct // np.uint64(size + 1)).astype(np.int64))
            followed = context_counts(vocabulary, contexts, model["started"])
            rest = discount * successors.distinct(contexts) / np.maximum(followed, 1)
            # A token is the context of the next one, and the last of each text is the end.
            lasts = np.cumsum(counts) - 1
            n = np.roll(followed[place][where], -1)
            n[number == size] = 0
            n[lasts] = context_counts(vocabulary, number[lasts[:1]], 0)
            p1 = (n + 1) / (total + size + 1)
            seen = np.where(unknown, 0.0, found[where])
            places = np.where(unknown, -1, places[where])
            rest = np.where(rest > 0, rest, 1.0)[place][where]
            p = seen + np.where(unknown, 1.0, rest) * p1
            at, keys = trigrams(keys, places, counts, size + 1)
            distinct, where = np.unique(keys, return_inverse=True)
            known, place = runs((distinct // np.uint64(size + 1)).astype(np.int64))
            rest = discount * level3.distinct(known) / np.maximum(successors.counts(known), 1)
            p[at] = level3.find(distinct)[where] + np.where(rest > 0, rest, 1.0)[place][where] * p[at]
            firsts = np.cumsum(counts) - counts
            sums = [np.add.reduceat(x, firsts) for x in ((n > 0).astype(np.int64), np.log10(p1), np.log10(p))]
            columns = [
                batch.column("doc_id"),
                batch.column("held_out"),
                pa.array(counts),
                pa.array(sums[0]),
                pa.array(np.full(len(counts), total, np.int64)),
                pa.array(sums[1]),
                pa.array(sums[2]),
            ]
            yield pa.RecordBatch.from_arrays(
                columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(
        rate,
        f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double",
    )
