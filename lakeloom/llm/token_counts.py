"""Token counts by the whole-token shortcut of a byte-level BPE.

Offline, on the driver, each vocabulary string is encoded alone: where the result is the one
token of that string, a pre-token equal to it counts 1 without a merge. Tasks cut a text
into pre-tokens with the tokenizer's own pattern, count those that are proven, and give
only the others to the library, each distinct one of a task once.

The cut is proven too: a pre-token never goes from a character that is no white space to
one that is, so a long text is cut at such places and never held as one list of
pre-tokens. The pattern's classes follow the Unicode version of whoever applies it.
Characters whose class differs between the oldest and the newest version at hand are
odd; a stretch of text with one goes to the library as it is.

Nulls, empty texts, ties: a null or empty text has no bytes and no tokens. Every row is
counted for itself, whether its doc_id is null or repeated. An empty table makes no rows.
Other columns are not looked at.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import offsets, pieces, texts

LIMIT = 512
# Fixed value: the pattern of the byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# A stretch of text has about so many characters, and a task remembers so many of pre-tokens.
STRETCH = 1 << 20
REMEMBERED = 1 << 26


def supported(path: str) -> dict:
    """The tokenizer's file, if the shortcut holds for what it says."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    cut = spec["pre_tokenizer"] or {}
    plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
    model = spec["model"]
    merges = model["type"] == "BPE" and not model.get("dropout")
    added = all(not t["lstrip"] and not t["rstrip"] and not t["single_word"] for t in spec["added_tokens"])
    if spec["normalizer"] or not (plain and merges and added):
        raise ValueError(f"no byte-level BPE without normalizer, prefix space and dropout: {path}")
    return spec


def tokenizer_of(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary, the other way round."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def whole_tokens(path: str) -> list[str]:
    """The vocabulary strings that, encoded alone, are one token: their own."""
    spec, tokenizer, letters = supported(path), tokenizer_of(path), byte_letters()
    cut = regex.compile(PATTERN)
    ids, strings = [], []
    for token, number in spec["model"]["vocab"].items():
        try:
            text = bytes(letters[c] for c in token).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if cut.fullmatch(text):
            ids.append(number)
            strings.append(text)
    encoded = tokenizer.encode_batch_fast(strings, add_special_tokens=False)
    return [s for s, number, e in zip(strings, ids, encoded, strict=True) if e.ids == [number]]


def odd_characters() -> str:
    """All characters whose kind depends on the Unicode version."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    now = bytearray(0x110000)
    for kind, pattern in enumerate((r"\p{L}", r"\p{N}", r"\s"), start=1):
        for c in regex.findall(pattern, every):
            now[ord(c)] = kind
    old, kinds = unicodedata.ucd_3_2_0.category, {"L": 1, "N": 2, "Z": 3}
    spaces = {*range(9, 14), 0x85}
    then = (3 if ord(c) in spaces else kinds.get(old(c)[0], 0) for c in every)
    return "".join(c for c, kind in zip(every, then, strict=True) if kind != now[ord(c)])


def counter(path: str, whole: list[str], odd: str, added: list[str]) -> Callable[[str], int]:
    """A function from a text to its number of tokens."""
    tokenizer = tokenizer_of(path)
    cut, edge, strange = regex.compile(PATTERN), regex.compile(r"(?<=\S)(?=\s)"), frozenset(odd)
    longest_first = sorted(filter(None, added), key=len, reverse=True)
    special = regex.compile("|".join(map(regex.escape, longest_first))) if longest_first else None
    counts = dict.fromkeys(whole, 1)
    proven, held = len(counts), 0

    def merged(words: list[str]) -> None:
        nonlocal held
        if held > REMEMBERED:
            for word in list(counts)[proven:]:
                del counts[word]
            held = 0
        encoded = tokenizer.encode_batch_fast(words, add_special_tokens=False)
        counts.update((w, len(e.ids)) for w, e in zip(words, encoded, strict=True))
        held += sum(map(len, words))

    def stretch(text: str) -> int:
        if not (text.isascii() or strange.isdisjoint(text)):
            return len(tokenizer.encode(text, add_special_tokens=False).ids)
        words = cut.findall(text)
        try:
            return sum(map(counts.__getitem__, words))
        except KeyError:
            merged([w for w in dict.fromkeys(words) if w not in counts])
            return sum(map(counts.__getitem__, words))

    def plain(text: str) -> int:
        total, start = 0, 0
        while start < len(text):
            found = edge.search(text, start + STRETCH) if len(text) - start > STRETCH else None
            end = found.start() if found else len(text)
            total += stretch(text[start:end] if start or end < len(text) else text)
            start = end
        return total

    def count(text: str) -> int:
        if special is None or not special.search(text):
            return plain(text)
        parts = special.split(text)
        return len(parts) - 1 + sum(map(plain, parts))

    return count


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """Rows ``(doc_id, n_bytes, n_tokens, over_limit)``, one for each document."""
    added = [t["content"] for t in supported(tokenizer)["added_tokens"]]
    whole, odd = whole_tokens(tokenizer), odd_characters()

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(tokenizer, whole, odd, added)
        for batch in pieces(batches):
            column = batch.column("text")
            found = [tokens(value.as_py().decode()) for value in column]
            sizes = pa.array(np.diff(offsets(column)), pa.int64())
            rows = [batch.column("doc_id"), sizes, pa.array(found, pa.int64())]
            yield pa.RecordBatch.from_arrays(rows, ["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = texts(docs, "doc_id").mapInArrow(count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
