"""Collocations against all phrases counted one by one."""

import random
import re
import tracemalloc
from collections import Counter, defaultdict

import pytest

from lakeloom.llm import collocations
from lakeloom.llm.common import BATCH_CONF

DOCS = "doc_id bigint, text string, lang string, n bigint, word string, block int, phrase string"


def brute(rows, top):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", lower):
            words = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, 6):
                f[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        longest = Counter()
        for p, a in counts.items():
            for part in (p[1:], p[:-1]):
                longest[part] = max(longest[part], a)
        found = []
        for p, a in counts.items():
            if len(p) > 1 and a >= 100 and longest[p] < a:
                cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
                value, k = min(cuts)
                found.append((-value, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (value, a, p, left, rest) in enumerate(sorted(found)[:top], start=1):
            out.append((lang, rank, p.decode(), -a, left, rest, n[lang], -value))
    return sorted(out)


def rows():
    rng = random.Random(2)
    common = [f"c{k}" for k in range(12)]
    fixed = ["new york city hall", "Ñandú É x", "a a a a a a a", "to be or not to be", "one\ttwo three four five six"]
    made = []
    for k in range(600):
        words = rng.choices(common, weights=range(12, 0, -1), k=40)
        for phrase in rng.sample(fixed, 2):
            words.insert(rng.randrange(len(words)), phrase)
        text = "".join(w + rng.choice([" ", " ", " ", "  ", ". ", "\n", ";"]) for w in words)
        made.append((k, text, rng.choice(["en", "en", "de", None, "und"]), 1, "w", 2, "p"))
    odd = [None, "", " ,;\n", "x" * 10000, "the the " * 300, "UPPER É " * 150]
    made += [(1000 + k, t, "en", 1, "w", 2, "p") for k, t in enumerate(odd)]
    return [*made, made[0], (None, "no id " * 120, None, 1, "w", 2, "p")]


@pytest.mark.parametrize("top, sent", [(7, 0), (2000, 1000)])
def test_against_all_phrases(spark, top, sent, monkeypatch):
    """Once with pairs joined by a shuffle and a line that cuts growth short, once with all."""
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 30_000)
    monkeypatch.setattr(collocations, "SENT_PAIRS", sent)
    got = sorted(tuple(r) for r in collocations.phrases(spark.createDataFrame(rows(), DOCS), top).collect())
    assert got == brute(rows(), top) and {r[0] for r in got} == {"en", "de", "und"}


def test_in_small_steps(spark, monkeypatch):
    """Steps cut texts, pairs and windows of a block; what is found stays."""
    for name, value in (("BLOCK_BYTES", 30_000), ("STEP_BYTES", 500), ("STEP_ROWS", 50), ("SENT_PAIRS", 0)):
        monkeypatch.setattr(collocations, name, value)
    got = sorted(tuple(r) for r in collocations.phrases(spark.createDataFrame(rows(), DOCS), 7).collect())
    assert got == brute(rows(), 7) and spark.conf.get(BATCH_CONF, None) is None


def test_words_of_a_block_are_not_held_at_once():
    parts = [b"some of the words, and more " * 4000] * 80
    tracemalloc.start()
    codes, vocabulary, counts = collocations.coded(parts)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert vocabulary.to_pylist() == ["some", "of", "the", "words", "and", "more"]
    assert counts.tolist() == [320_000] * 6 and (codes < 0).sum() == 320_000 + 79
    assert codes[:8].tolist() == [0, 1, 2, 3, -1, 4, 5, 0]
    # Words held at once take sixteen times the text, each being an object.
    assert most < 8 * sum(map(len, parts))


def test_no_rows(spark):
    assert collocations.phrases(spark.createDataFrame([], DOCS)).collect() == []


def test_exact_beyond_64_bits(spark):
    big = spark.createDataFrame([(10**13, 10**15, 3 * 10**14, 7 * 10**13)], "a bigint, n bigint, l bigint, r bigint")
    got = big.select(collocations.score(*(big[c] for c in "anlr")).alias("s")).first().s
    assert got == 1000 * 10**13 * 10**15 // (3 * 10**14 * 7 * 10**13)


def test_long_text_is_cut_at_separators(monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 10)
    text = b"one two three, four five. " * 5 + b"no separator at all in here"
    assert b"".join(collocations.stretches(text)) == text
    assert all(s.strip()[-1:] in b",." for s in list(collocations.stretches(text))[:-1])
