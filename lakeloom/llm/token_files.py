"""Token ids in files of fixed-width bits.

Each id takes the least number of bits that hold the vocabulary, lowest bit first,
without gaps inside a block of ``BLOCK`` ids. A file is: the blocks, then an Arrow stream
of ``(doc_id, n_tokens)``, then an Arrow stream of the blocks' offsets, then a trailer of
little-endian 64-bit integers (bits, block size, ids, place of the first and of the second
stream) and the mark ``BITPACK1``. A block unpacks in one numpy step, and the offsets give
any document without reading the rest of its file.

Documents are range-partitioned and sorted by doc_id, so files follow each other in that
order. Text is split at ASCII white space, which the tokenizer drops, and between a letter
and a mark, where its pattern cuts; ASCII letters are put in lower case, as it folds them,
but in pieces that could hold a special token. So few distinct words are left, which Arrow
numbers; each one of a task is encoded once. The ids are those of the whole text.

Nulls, empty texts, ties: a null text is empty and has only the end id. Rows without a
doc_id come first. Rows that repeat a doc_id are each written, ordered by their text's
hash. An empty table makes no rows. Other columns are not looked at.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import pin, scratch_path
from .common import pieces, small_batches
from .files import create, open_file

# Letters that are small and composed, and letters in every version of Unicode: neither the
# normalizer nor the pattern changes a word of them, so the merges alone are asked.
PLAIN_LETTERS = "abcdefghijklmnopqrstuvwxyz\u00df" + "".join(map(chr, [*range(0xE0, 0xF7), *range(0xF8, 0x100)]))
PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
# Stands after each text; no byte of UTF-8, so no word.
AFTER = b"\xff"

BLOCK = 1 << 16
PIECE_BYTES = 2 << 20
# Text of about so many bytes goes to a task, which has few words to encode that it has not
# met before; of less text, no more than so many bytes while cores are idle.
TASK_BYTES, IDLE_BYTES = 64 << 20, 4 << 20
END = 2
CACHED_WORDS = 500_000
# So many new words are asked of the library at once, and so many words turned into ids.
ASKED_WORDS, SLICE_WORDS = 4096, 1 << 16
MARK = b"BITPACK1"


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    planes = (ids[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(planes.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    planes = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little")
    weights = np.uint32(1) << np.arange(bits, dtype=np.uint32)
    return planes.reshape(n, bits).astype(np.uint32) @ weights


class Writer:
    def __init__(self, uri: str, bits: int):
        self.file, self.bits = create(uri), bits
        self.rest, self.n = np.empty(0, np.uint32), 0
        self.docs: list[pa.RecordBatch] = []
        self.offsets: list[int] = []

    def _put(self, ids: np.ndarray) -> None:
        self.offsets.append(self.file.tell())
        self.file.write(pack(ids, self.bits))

    def add(self, doc_ids: pa.Array, lengths: np.ndarray, ids: np.ndarray) -> None:
        # A copy: a column of a batch that was sent keeps the whole batch in memory, with its texts.
        doc_ids = doc_ids.take(pa.array(np.arange(len(doc_ids))))
        self.docs.append(
            pa.RecordBatch.from_arrays([doc_ids, pa.array(lengths, pa.int64())], ["doc_id", "n_tokens"])
        )
        self.n += len(ids)
        ids = np.concatenate((self.rest, ids))
        whole = len(ids) // BLOCK * BLOCK
        for start in range(0, whole, BLOCK):
            self._put(ids[start : start + BLOCK])
        self.rest = ids[whole:]

    def close(self) -> None:
        if len(self.rest):
            self._put(self.rest)
        at = [self.file.tell()]
        with pa.ipc.new_stream(self.file, self.docs[0].schema) as out:
            for batch in self.docs:
                out.write_batch(batch)
        at.append(self.file.tell())
        blocks = pa.RecordBatch.from_arrays([pa.array(self.offsets, pa.int64())], ["offset"])
        with pa.ipc.new_stream(self.file, blocks.schema) as out:
            out.write_batch(blocks)
        self.file.write(np.array([self.bits, BLOCK, self.n, *at], "<i8").tobytes() + MARK)
        self.file.close()


class Reader:
    """Random access to one file."""

    def __init__(self, uri: str):
        self.file = open_file(uri)
        size = self.file.size()
        tail = self.file.read_at(48, size - 48)
        if tail[40:] != MARK:
            raise ValueError(f"not a token file: {uri}")
        self.bits, self.block, self.n, docs_at, blocks_at = np.frombuffer(tail[:40], "<i8").tolist()
        docs = pa.ipc.open_stream(self.file.read_at(blocks_at - docs_at, docs_at)).read_all()
        blocks = pa.ipc.open_stream(self.file.read_at(size - 48 - blocks_at, blocks_at)).read_all()
        self.doc_ids = docs.column("doc_id").combine_chunks()
        self.lengths = docs.column("n_tokens").to_numpy()
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)))
        self.offsets = [*blocks.column("offset").to_pylist(), docs_at]

    def ids(self, start: int, end: int) -> np.ndarray:
        """The ids from ``start`` up to ``end``; only their blocks are read."""
        first, last = start // self.block, -(-end // self.block)
        parts = [np.empty(0, np.uint32)]
        for k in range(first, last):
            data = self.file.read_at(self.offsets[k + 1] - self.offsets[k], self.offsets[k])
            parts.append(unpack(data, min(self.block, self.n - k * self.block), self.bits))
        return np.concatenate(parts)[start - first * self.block : end - first * self.block]

    def document(self, place: int) -> np.ndarray:
        return self.ids(int(self.starts[place]), int(self.starts[place + 1]))


def bytes_shown() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


def encoder(path: str, end: int) -> Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]:
    """A function from texts to (ids, number of ids of each text), the end id included."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    merge = tokenizer.model.tokenize
    shown = bytes_shown()
    letters = {ord(c): "".join(shown[b] for b in c.encode()) for c in PLAIN_LETTERS}

    def alone(word: bytes) -> list[int]:
        return [token.id for token in merge(word.decode().translate(letters))]

    def whole(words: list[bytes]) -> Iterator[list[int]]:
        for at in range(0, len(words), ASKED_WORDS):
            some = [w.decode() for w in words[at : at + ASKED_WORDS]]
            yield from (e.ids for e in tokenizer.encode_batch_fast(some, add_special_tokens=False))

    probes = [c.encode() for c in PLAIN_LETTERS] + [PLAIN_LETTERS.encode()]
    direct = [alone(p) for p in probes] == list(whole(probes))
    # The empty word, which splitting leaves at the ends, has no ids.
    places = {AFTER: 0, b"": 1}
    flat, sizes = np.array([end], np.uint32), np.array([1, 0])

    def encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        nonlocal flat, sizes
        if len(places) > CACHED_WORDS:
            places.clear()
            places.update({AFTER: 0, b"": 1})
            flat, sizes = flat[:1], sizes[:2]
        data = b"".join(text + b" " + AFTER + b" " for text in texts)
        if b"<|" not in data:
            data = data.lower()
        apart = pc.replace_substring_regex(pa.array([data], pa.large_binary()), "([A-Za-z])([.,;:!?])", "\\1 \\2")
        # Only ASCII is looked at, so the mark between the texts need not be UTF-8.
        split = pc.ascii_split_whitespace(apart.cast(pa.large_string(), safe=False))
        words = split.flatten().dictionary_encode()
        names = words.dictionary.cast(pa.large_binary()).to_pylist()
        fresh = [w for w in names if w not in places]
        if fresh:
            plain = [w for w in fresh if PLAIN.fullmatch(w)] if direct else []
            rest = list(set(fresh).difference(plain))
            places.update(zip([*plain, *rest], range(len(places), len(places) + len(fresh)), strict=True))
            ids, more = array("I"), array("q")
            for found in chain(map(alone, plain), whole(rest)):
                ids.extend(found)
                more.append(len(found))
            flat, sizes = np.concatenate((flat, np.array(ids, np.uint32))), np.concatenate((sizes, more))
        starts = np.cumsum(sizes) - sizes
        picked = np.fromiter(map(places.__getitem__, names), np.int64, len(names))[words.indices.to_numpy()]
        parts = []
        for k in range(0, len(picked), SLICE_WORDS):
            some = picked[k : k + SLICE_WORDS]
            lengths = sizes[some]
            ends = np.cumsum(lengths)
            parts.append(flat[np.arange(ends[-1]) - np.repeat(ends - lengths - starts[some], lengths)])
        after = np.cumsum(sizes[picked])[picked == 0]
        return np.concatenate(parts), np.diff(np.concatenate(([0], after)))

    return encode


def write(docs: DataFrame, folder: str, tokenizer: str, end: int = END) -> DataFrame:
    """Write the files; rows ``(part, path, n_docs, n_tokens)``, one per file, in doc_id order by part."""
    from tokenizers import Tokenizer

    bits = max(Tokenizer.from_file(tokenizer).get_vocab_size() - 1, end).bit_length()

    def put(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, out, path, n_docs = encoder(tokenizer, end), None, "", 0
        for batch in pieces(batches, size=PIECE_BYTES):
            if out is None:
                path = f"{folder}/{uuid.uuid4().hex}.tokens"
                out = Writer(path, bits)
            ids, lengths = encode(batch.column("text").to_pylist())
            out.add(batch.column("doc_id"), lengths, ids)
            n_docs += batch.num_rows
        if out is not None:
            out.close()
            row = [[TaskContext.get().partitionId()], [path], [n_docs], [out.n]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in row], ["part", "path", "n_docs", "n_tokens"])

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.cast("binary").alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cores = docs.sparkSession.sparkContext.defaultParallelism
    tasks = max(-(-total // TASK_BYTES), min(cores, -(-total // IDLE_BYTES)), 1)
    ordered = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    manifest = ordered.mapInArrow(put, "part bigint, path string, n_docs bigint, n_tokens bigint")
    with small_batches(docs.sparkSession, 2 * PIECE_BYTES):
        return pin(manifest, "manifest")


def read(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Rows ``(doc_id, start, n_tokens, ids_crc32)`` read from the files of a manifest.

    The driver holds one row per file to number their first ids.
    """
    files, start = [], 0
    for row in manifest.orderBy("part").collect():
        files.append((row.path, start))
        start += row.n_tokens

    def get(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(*(batch.column(c).to_pylist() for c in ("path", "start")), strict=True):
                file = Reader(path)
                done = 0
                while done < len(file.lengths):
                    upto = max(int(np.searchsorted(file.starts, file.starts[done] + 16 * BLOCK, "right")) - 1, done + 1)
                    ids = file.ids(int(file.starts[done]), int(file.starts[upto])).astype("<u4")
                    cuts = file.starts[done : upto + 1] - file.starts[done]
                    sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                    columns = [
                        file.doc_ids[done:upto],
                        pa.array(file.starts[done:upto] + base, pa.int64()),
                        pa.array(file.lengths[done:upto], pa.int64()),
                        pa.array(sums, pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])
                    done = upto

    listed = spark.createDataFrame(files, "path string, start bigint")
    spread = listed.repartition(max(len(files), 1))
    return spread.mapInArrow(get, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def packed(docs: DataFrame, tokenizer: str, end: int = END, folder: str | None = None) -> DataFrame:
    """Write all documents and read them back; ``folder`` defaults to a new shared one."""
    spark = docs.sparkSession
    return read(spark, write(docs, folder or scratch_path(spark, "tokens"), tokenizer, end))
