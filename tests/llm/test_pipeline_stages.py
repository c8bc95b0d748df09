"""What each stage of the pipeline must keep, by brute force."""

from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline
from lakeloom.llm import mixing, toxicity
from lakeloom.llm.common import load

DOCS = "doc_id bigint, text string, lang string, source string"


def made(spark, rows):
    return spark.createDataFrame([(k, t, "en", s) for k, t, s in rows], DOCS)


def kept(stage, spark, docs, tables) -> Counter:
    return Counter((r.doc_id, r.text) for r in stage(spark, docs, tables).collect())


def similar(a: str, b: str, n: int) -> bool:
    x, y = ({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} for w in (a.split(), b.split()))
    return 100 * len(x & y) >= 80 * len(x | y)


def test_near_duplicates_that_stay(spark, tables):
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(100)]
    between = [*base[:30], "x", *base[31:70], "y", *base[71:]]
    near = [*base[:50], "z", *base[51:]]
    clean = [" ".join(f"v{rng.randrange(10**6)}" for _ in range(60)) for _ in range(20)]
    # Two words changed: similar by runs of four words and not by runs of five.
    while not similar(" ".join(base), " ".join(between), 4) or similar(" ".join(base), " ".join(between), 5):
        base, between = base[:-1], between[:-1]
        near = near[:-1]
    texts = [" ".join(base), " ".join(between), " ".join(near), " ".join(base), *clean, "", None]
    rows = [(k, t, "s") for k, t in enumerate(texts)]
    rows += [rows[0], rows[5], (None, texts[0], "s"), (None, texts[0], "s")]
    root = list(range(len(texts)))
    for _ in texts:
        for a, x in enumerate(texts):
            for b, y in enumerate(texts):
                if x and y and similar(x, y, 5):
                    root[a] = root[b] = min(root[a], root[b])
    want = Counter((k, texts[k]) for k in range(len(texts)) if root[k] == k)
    want[None, texts[0]] = 2
    assert (1, texts[1]) in want and (2, texts[2]) not in want and (3, texts[3]) not in want
    assert kept(corpus_pipeline.drop_near_duplicates, spark, made(spark, rows), tables) == want


def test_clean_documents_stay(spark, tables):
    """Decontamination drops what holds a passage of the benchmark, toxicity what is predicted, and no more."""
    items = [r.text for r in load(spark, tables, "benchmark").orderBy("item_id").limit(5).collect()]
    clean = [(k, f"q{k} " * 40, "s") for k in range(30)]
    leaked = [(100 + k, f"before {t} after", "s") for k, t in enumerate(items)]
    docs = made(spark, [*clean, *leaked, (None, "no id", "s")])
    want = Counter((k, t) for k, t, _ in clean) + Counter({(None, "no id"): 1})
    assert kept(corpus_pipeline.drop_contaminated, spark, docs, tables) == want

    whole = load(spark, tables, "documents")
    labels = load(spark, tables, "labels").where(~toxicity.held_out())
    predicted = {r.doc_id: r.predicted for r in toxicity.score(whole, toxicity.learn(whole, labels)).collect()}
    want = Counter((r.doc_id, r.text) for r in whole.collect() if not predicted[r.doc_id])
    assert 0 < sum(want.values()) < len(predicted)
    assert kept(corpus_pipeline.drop_toxic, spark, whole, tables) == want


def test_mix_and_tokens_hold_every_document(spark, tables):
    whole = load(spark, tables, "documents")
    copies = {r.doc_id: r.copies for r in mixing.mixed(whole).collect()}
    mix = corpus_pipeline.mix(spark, whole, tables)
    taken = Counter(r.doc_id for r in mix.collect())
    assert taken == Counter({k: n for k, n in copies.items() if n})
    packed = corpus_pipeline.tokens(spark, mix, tables).collect()
    assert Counter(r.doc_id for r in packed) == taken
