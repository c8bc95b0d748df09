"""Token counts against the library's own on whole texts."""

import random

import pytest
import regex

from lakeloom.llm import token_counts
from lakeloom.llm.common import load
from lakeloom.llm.queries import QUERIES, byte_vocabulary

ODD = [
    None,
    "",
    " ",
    "\n\n \t x　  y  ",
    "don't I'LL we've they're 'tis x's",
    "<|endoftext|>",
    "a<|endoftext|>b <|endoftext|><|endoftext|> <|endoftext",
    "x" * 3000 + " " * 700 + "y" * 9,
    "\x1c\x1d a\x1eb\x85c d",
    "日本語 テスト, ½ ² Ⅷ ٣ and 12345",
    "՘֋౜ \U0001f9ff \U0001fae8 á ​﻿",
    "_under_score __init__ a_1",
]
DOCS = "doc_id bigint, text string, n_tokens string, n_bytes int, counts int"


def tokens(text):
    encoded = token_counts.tokenizer_of(byte_vocabulary()).encode(text or "", add_special_tokens=False)
    return len(encoded.ids)


def test_odd_texts(spark, monkeypatch):
    rng = random.Random(5)
    points = [c for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    wild = ["".join(chr(rng.choice(points)) for _ in range(200)) for _ in range(20)]
    mixed = ["".join(rng.choice(["a", "É", "7", " ", "\n", "!", "'s", " ", "_", "中"]) for _ in range(500)) for _ in range(20)]
    rows = [(k, t, "n", 1, 1) for k, t in enumerate([*ODD, *wild, *mixed])]
    rows += [rows[4], (None, "no id", "n", 1, 1)]
    docs = spark.createDataFrame(rows, DOCS)
    for stretch in (token_counts.STRETCH, 40):
        monkeypatch.setattr(token_counts, "STRETCH", stretch)
        got = sorted(tuple(r) for r in token_counts.count_tokens(docs, byte_vocabulary(), limit=100).fillna(-1).collect())
        want = [(-1 if k is None else k, len((t or "").encode()), tokens(t), tokens(t) > 100) for k, t, *_ in rows]
        assert got == sorted(want)
    assert token_counts.count_tokens(spark.createDataFrame([], DOCS), byte_vocabulary()).collect() == []


def test_table(spark, tables):
    texts = {r.doc_id: r.text for r in load(spark, tables, "documents").collect()}
    for r in QUERIES["op12_token_counts"](spark, tables).collect():
        n = tokens(texts[r.doc_id])
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 512)


def test_words_forgotten_and_found_again(monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 10)
    path = byte_vocabulary()
    count = token_counts.counter(path, token_counts.whole_tokens(path), "", [])
    texts = [f"zqxj{k} wvvut{k % 3} the end" for k in range(30)] * 2
    assert [count(t) for t in texts] == [tokens(t) for t in texts]


def test_whole_tokens_are_proven():
    path = byte_vocabulary()
    whole = token_counts.whole_tokens(path)
    cut = regex.compile(token_counts.PATTERN)
    rng = random.Random(1)
    assert len(whole) > 49_000 and all(cut.fullmatch(w) for w in whole)
    assert all(tokens(w) == 1 for w in rng.sample(whole, 300))


def test_characters_that_are_not_odd_are_cut_alike():
    odd = set(token_counts.odd_characters())
    points = (c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c) not in odd)
    text = "".join(f"a{chr(c)}1{chr(c)}!{chr(c)}b\n" for c in points if c < 0x3500 or c % 41 == 0)
    pre = token_counts.tokenizer_of(byte_vocabulary()).pre_tokenizer
    assert [at for _, at in pre.pre_tokenize_str(text)] == [m.span() for m in regex.finditer(token_counts.PATTERN, text)]


def test_other_tokenizers_are_refused(tmp_path):
    from lakeloom.llm.queries import word_vocabulary

    with pytest.raises(ValueError):
        token_counts.whole_tokens(word_vocabulary())
