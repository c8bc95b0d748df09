"""op10_ngram_lm against a trigram model of dictionaries."""

from __future__ import annotations

import zlib
from collections import Counter
from math import log10

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from lakeloom.llm import elias_fano, ngram_lm
from lakeloom.llm.common import load


def expected(rows) -> dict:
    """``(n_tokens, n_known, base_score, score)`` of each id, by plain counts; no rounding."""
    held, d = {}, ngram_lm.DISCOUNT
    texts = [(k, [*(t or "").encode().lower().split(), "</s>"]) for k, t in rows]
    for k, _ in texts:
        held[k] = k is not None and zlib.crc32(str(k).encode()) % 7 == 2
    one, two, three = Counter(), Counter(), Counter()
    for k, words in texts:
        if not held[k]:
            one.update(words)
            two.update(zip(["<s>", *words], words, strict=False))
            three.update(zip(["<s>", *words], words, words[1:], strict=False))
    total, size = sum(one.values()), len(one)
    firsts, after, seconds, behind = Counter(), Counter(), Counter(), Counter()
    for (c, _), n in two.items():
        firsts[c] += n
        after[c] += 1
    for (b, c, _), n in three.items():
        seconds[b, c] += n
        behind[b, c] += 1
    out = {}
    for k, words in texts:
        base = score = 0.0
        for i, w in enumerate(words):
            c = words[i - 1] if i else "<s>"
            p = p1 = (one[w] + 1) / (total + size + 1)
            if firsts[c]:
                p = max(two[c, w] - d, 0) / firsts[c] + d * after[c] / firsts[c] * p
            b = (words[i - 2] if i > 1 else "<s>", c)
            if i and seconds[b]:
                p = max(three[*b, w] - d, 0) / seconds[b] + d * behind[b] / seconds[b] * p
            base, score = base + log10(p1), score + log10(p)
        out[k] = (len(words), sum(one[w] > 0 for w in words), base, score)
    return out


@pytest.mark.parametrize("shard", [ngram_lm.SHARD_TOKENS, 700])
def test_scores_equal_plain_counts(spark, tables, monkeypatch, shard):
    """Also with levels cut into many files, where a popular context lies in several."""
    monkeypatch.setattr(ngram_lm, "SHARD_TOKENS", shard)
    documents = load(spark, tables, "documents").select("doc_id", "text")
    odd = [(10**9 + i, "the " * 3000 + f"of end{i}") for i in range(3)] + [(10**9 + 9, None), (10**9 + 10, "")]
    rows = [(r.doc_id, r.text) for r in documents.collect()] + odd
    want = expected(rows)
    got = ngram_lm.score(documents.unionByName(spark.createDataFrame(odd, documents.schema))).collect()
    assert len(got) == len(rows) and sum(r.held_out for r in got) > 0
    for r in got:
        n_tokens, n_known, base, score = want[r.doc_id]
        assert (r.n_tokens, r.n_known) == (n_tokens, n_known)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        # 8 bits a probability: half a step of 255 over the range of their logarithms.
        assert r.score == pytest.approx(score, abs=0.012 * n_tokens)


@pytest.mark.parametrize("n,universe", [(3000, 3100), (3000, 1 << 40), (200_000, 1 << 20)])
def test_gaps_equal_differences(n, universe):
    """Entries that repeat, runs of ones longer than a word, and far gaps."""
    rng = np.random.default_rng(n)
    values = np.sort(np.concatenate((rng.integers(0, universe, n), np.full(300, universe - 1)))).astype(np.uint64)
    sequence = elias_fano.EliasFano(elias_fano.encode(values, universe))
    at = np.unique(rng.integers(0, len(values), n))
    want = np.diff(values.astype(np.int64), prepend=0)
    assert (sequence.at(at) == values[at].astype(np.int64)).all()
    assert (sequence.gaps(at) == want[at]).all() and sequence.gaps(np.array([0]))[0] == want[0]


def test_level_3_keeps_how_many_successors_a_bigram_has(tmp_path):
    """Contexts without successors, and one whose successors lie in two files."""
    width, files = 10, []
    for k, (first, keys) in enumerate([(0, [12, 15, 41, 42]), (43, [43, 47, 49, 80])]):
        values = np.array(keys, np.uint64) - np.uint64(first)
        contexts = np.array(keys) // width - first // width
        arrays = elias_fano.encode(values, keys[-1] - first + 1)
        ends = elias_fano.encode(np.cumsum(np.bincount(contexts)).astype(np.uint64), len(keys) + 1)
        arrays |= {f"pointer_{name}": a for name, a in ends.items()}
        arrays |= {"code": np.zeros(len(keys), np.uint8), "book": np.ones(256), "last": np.array([keys[-1]], np.uint64)}
        elias_fano.save(f"file:{tmp_path}/{k}", arrays)
        files.append((f"file:{tmp_path}/{k}", first))
    level = ngram_lm.Trigrams(files, width)
    assert level.distinct(np.arange(12)).tolist() == [0, 2, 0, 0, 5, 0, 0, 0, 1, 0, 0, 0]
    assert level.find(np.arange(12, 100, dtype=np.uint64)).nonzero()[0].tolist() == [0, 3, 29, 30, 31, 35, 37, 68]


@pytest.mark.parametrize("kind", [pa.binary(), pa.large_binary()])
def test_words_are_those_of_bytes(kind):
    """Spaces that are no ASCII, bytes that are no UTF-8, texts without words."""
    texts = [b"", b" \t", b"A\x0bb\x1cC \xff\xc2\xa0D", "É x É".encode(), b"b a\r\nb"]
    batch = pa.RecordBatch.from_arrays([pa.array([b"left out", *texts], kind)], ["text"]).slice(1)
    hashes, which, counts = ngram_lm.tokens(batch)
    words = [[*text.lower().split(), b" end"] for text in texts]
    assert counts.tolist() == [len(w) for w in words]
    assert hashes[which].tolist() == [xxhash.xxh3_64_intdigest(w) for ws in words for w in ws]
    assert (np.diff(hashes.astype(object)) > 0).all() and len(set(which.tolist())) == len(hashes)


def test_planes_leave_zero_bytes_out():
    for values in ([1, 1, 2], [255, 0], [1 << 20, 5], [(1 << 63) - 1, 0]):
        array = np.array(values, np.int64)
        packed = ngram_lm.planes(array)
        assert (ngram_lm.from_planes(packed, np.int64) == array).all()
        assert len(packed) == 1 + len(values) * max((max(values).bit_length() + 7) // 8, 1)
