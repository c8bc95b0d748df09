"""What the methods promise: one chain over a text, odds by size, stages that carry any column."""

from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from lakeloom.llm import mixing, toxicity


def test_marginals_are_those_of_the_whole_chain(monkeypatch):
    rng = np.random.default_rng(4)
    chain = toxicity.Chain(*(rng.standard_normal(toxicity.BINS) for _ in range(3)), rng.standard_normal((2, 2)))
    words = [f"w{k}" for k in range(50)]
    model = toxicity.Model({w.encode(): float(rng.normal(0, 3)) for w in words}, chain, np.zeros(4))
    texts = [" ".join(rng.choice(words, n)).encode() for n in (0, 1, 2, 63, 64, 65, 128, 129, 400, 1000)]
    found = {}
    for segment in (1, 7, 64, 5000):
        monkeypatch.setattr(toxicity, "SEGMENT", segment)
        found[segment], lengths = model.tag(texts)
    for segment in (1, 7, 64):
        assert np.abs(found[segment] - found[5000]).max() < 1e-12
    assert lengths.tolist() == [0, 1, 2, 63, 64, 65, 128, 129, 400, 1000]
    # And those are the marginals by definition, on a text of a few words.
    odds, lengths = model.tokens([b"w1 w2 w3 w4 w5"])
    bins = toxicity.bin_of(odds)
    emission = chain.emissions(bins, *toxicity.neighbours(bins, lengths))
    total, toxic = 0.0, np.zeros(5)
    for tags in np.ndindex(*[2] * 5):
        weight = np.exp(sum(emission[t] for t in range(5) if tags[t]) + sum(chain.moves[a, b] for a, b in zip(tags, tags[1:])))
        total += weight
        toxic += weight * np.array(tags)
    assert np.abs(model.tag([b"w1 w2 w3 w4 w5"])[0] - toxic / total).max() < 1e-12


def brute_probabilities(sizes, left):
    """The probability in proportion to size, those above 1 certain, with the words left expected."""
    low, high = 0.0, 1.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if sum(min(1, middle * s) * s for s in sizes) < left else (low, middle)
    return [min(1, low * s) for s in sizes]


@pytest.fixture(scope="module")
def many(spark):
    rows, k = [], 0
    for source, groups in {"a": {5: 3000, 20: 2000, 50: 500, 20000: 1}, "b": {1: 2000, 40: 1000}, "c": {10: 300}}.items():
        for size, n in groups.items():
            for _ in range(n):
                rows.append((k, " ".join(["w"] * size) + f" d{k}", source))
                k += 1
    rows += [(k, None, "b"), (k + 1, "", "b")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string")


def test_inclusion_rates_follow_the_probabilities(many):
    """Documents of one source and size are taken as often as their probability says."""
    sources = defaultdict(list)
    for r in mixing.mixed(many, weights=(1.0, 1.4, 0.5)).collect():
        sources[r.name].append(r)
    seen = 0
    for rows in sources.values():
        target, total = rows[0].target, rows[0].source_size
        whole = min(int(target // total), mixing.CAP)
        p = dict(zip([r.size for r in rows], brute_probabilities([r.size for r in rows], target - whole * total)))
        assert abs(sum(r.size * r.copies for r in rows) - target) <= max(r.size for r in rows) / 2 + 1
        for size, chance in p.items():
            taken = [r.copies - whole for r in rows if r.size == size]
            assert set(taken) <= {0, 1}
            if len(taken) > 200:
                spread = 5 * (chance * (1 - chance) / len(taken)) ** 0.5
                assert abs(np.mean(taken) - chance) <= spread + 0.01, (size, chance, np.mean(taken))
                seen += 0.05 < chance < 0.95
    assert seen >= 3


CLASH = ["_place", "_copy", "_id", "_digest", "copies", "_scored_text", "_taken", "node", "a.b", "words", "Rank"]


def test_stages_carry_any_column(spark, tables):
    names = ", ".join(f"`{c}` int" for c in CLASH)
    rows = [(k, f"text {k} with some words of its own {k * 7}", "en", "s", *range(len(CLASH))) for k in range(20)]
    docs = spark.createDataFrame([*rows, rows[0], (None, "no id", "en", None, *range(len(CLASH)))],
                                 f"doc_id bigint, text string, lang string, source string, {names}")
    empty = spark.createDataFrame([], docs.schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, tables)
        assert out.columns == docs.columns, name
        assert {r["_id"] for r in out.collect()} == {2} and {r["a.b"] for r in out.collect()} == {8}
        assert stage(spark, empty, tables).collect() == []
    assert corpus_pipeline.STAGES[-1][1](spark, docs, tables).count() == docs.count()
