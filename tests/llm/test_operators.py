"""The corpus operators on odd rows, against brute force, and against their SQL."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from lakeloom.llm import (
    decontaminate,
    elias_fano,
    line_dedup,
    minhash_dedup,
    mixing,
    ngram_lm,
    substring_dedup,
    token_files,
    toxicity,
    vector_dedup,
    warc,
)
from lakeloom.llm.common import components, load
from lakeloom.llm.queries import QUERIES, SQL, word_vocabulary
from tests.oracle import connect, oracle_rows, spark_rows

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, bucket int"


def words(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def rows() -> list[tuple]:
    base = words(1, 200)
    near = base[:198] + ["x", "y"]
    texts = {
        1: " ".join(base),
        2: " ".join(base),
        3: " ".join(near),
        4: "",
        5: None,
        6: " \t\n ",
        7: "one two",
        8: "ONE  two",
        9: " ".join(words(2, 30_000)),
        10: "line a\nline b\nline c\nline d\nline a\nline b\nline c",
        11: "É " + " ".join(base[50:70]) + " ñ",
        12: "<|endoftext|> don't, stop now 12",
    }
    made = [(k, t, "en", "a" if k % 3 else None, 1, "extra", 7) for k, t in texts.items()]
    return [*made, made[0], (None, "no id at all", None, "b", None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def by_id(df) -> dict:
    return {r.doc_id: r for r in df.collect()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, tables, name):
    got = spark_rows(QUERIES[name](spark, tables))
    assert got == oracle_rows(connect(tables), SQL[name])


def test_near_duplicates(docs, empty):
    got = minhash_dedup.near_duplicates(docs)
    assert got.count() == len(rows())
    found = by_id(got)
    assert [found[k].component_id for k in (1, 2, 3, 7, 8)] == [1, 1, 1, 7, 7]
    assert [found[k].n_shingles for k in (4, 5, 6, 7)] == [0, 0, 0, 1]
    assert found[4].kept and found[5].kept and found[None].kept and found[None].component_id is None
    assert minhash_dedup.near_duplicates(empty).count() == 0


def test_near_duplicates_brute_force(spark):
    """Chains and groups of near copies, one of them large, and texts just below the limit."""
    rng, texts = random.Random(3), []
    for group, size in ((1, 60), (2, 5), (3, 2)):
        base = words(group + 100, 80)
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randrange(5)):
                text[rng.randrange(80)] = f"z{rng.randrange(10**6)}"
            texts.append(" ".join(text))
    rng.shuffle(texts)
    sets = []
    for text in texts:
        w = text.split()
        sets.append({tuple(w[i : i + 4]) for i in range(len(w) - 3)})
    root = list(range(len(texts)))
    for _ in range(len(texts)):
        for a in range(len(texts)):
            for b in range(a):
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    root[a] = root[b] = min(root[a], root[b])
        if all(root[r] == r for r in root):
            break
    made = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = by_id(minhash_dedup.near_duplicates(made))
    assert [found[k].component_id for k in range(len(texts))] == root


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def test_decontaminate(spark, docs, empty):
    base = words(1, 200)
    items = [(1, " ".join(base[50:62])), (2, "one two"), (3, None), (4, ""), (None, "stop now"), (1, "two")]
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id bigint, text string, words string")
    found = by_id(decontaminate.decontaminate(docs, bench))
    assert (found[1].n_hit, found[1].n_items, found[11].n_hit) == (12, 1, 12)
    assert (found[7].n_hit, found[8].n_hit, found[7].n_items) == (2, 2, 2)
    assert (found[12].n_hit, found[12].n_items, found[12].contaminated) == (2, 0, True)
    assert (found[5].n_words, found[5].n_hit, found[None].contaminated) == (0, 0, False)
    assert decontaminate.decontaminate(docs, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.decontaminate(empty, bench).count() == 0


def test_substrings(docs, empty):
    got = substring_dedup.remove_repeats(docs)
    assert got.count() == len(rows())
    found = by_id(got)
    assert [found[k].n_removed for k in (1, 2, 3, 4, 5, 7, 8, 11)] == [0, 200, 198, 0, 0, 0, 0, 20]
    assert found[11].kept.decode() == "É ñ" and found[None].n_removed == 0
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_substrings_in_small_automata(docs):
    some = substring_dedup.remove_repeats(docs, patterns=7).drop("kept")
    assert spark_rows(some) == spark_rows(substring_dedup.remove_repeats(docs).drop("kept"))


def test_lines(docs, empty):
    found = by_id(line_dedup.remove_repeated_lines(docs))
    assert (found[10].n_lines, found[10].n_removed, found[10].kept) == (7, 3, "line a\nline b\nline c\nline d")
    assert (found[5].n_lines, found[5].n_removed) == (1, 0)
    assert line_dedup.remove_repeated_lines(empty).count() == 0


@pytest.mark.parametrize("bits", [1, 5, 8, 13, 16, 17, 31, 32])
def test_bits(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001, dtype=np.uint32)
    data = token_files.pack(ids, bits)
    assert len(data) == (1001 * bits + 7) // 8
    assert (token_files.unpack(data, 1001, bits) == ids).all()


def test_token_files(spark, docs, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(word_vocabulary())
    manifest = token_files.write(docs, corpus_pipeline.scratch_path(spark, "tokens"), word_vocabulary())
    got = token_files.read(spark, manifest).orderBy("start").collect()
    assert len(got) == len(rows()) and got[0].doc_id is None
    texts = {r[0]: r[1] or "" for r in rows()}
    start = 0
    for row in got:
        ids = [*tokenizer.encode(texts[row.doc_id], add_special_tokens=False).ids, 2]
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    path = manifest.orderBy("part").first().path
    file = token_files.Reader(path)
    assert file.document(0).tolist() == file.ids(0, file.n)[: file.lengths[0]].tolist()
    assert token_files.packed(empty, word_vocabulary()).count() == 0


def test_toxicity(spark, tables, docs, empty):
    documents, labels = load(spark, tables, "documents"), load(spark, tables, "labels")
    model = toxicity.learn(documents, labels.where(~toxicity.held_out()))
    found = by_id(toxicity.score(docs, model))
    assert len(found) == len(rows()) - 1 and all(0 <= r.score <= 1 for r in found.values())
    assert found[4].score == found[5].score and found[4].predicted == 0 and found[4].spans == []
    assert toxicity.accepted(docs, model).columns == docs.columns
    assert toxicity.score(empty, model).count() == 0
    assert toxicity.learn(documents, labels.limit(0)) is None
    assert toxicity.score(docs, None).where("score <> 0").count() == 0


def test_toxicity_held_out(spark, tables):
    folder = tables.replace("sf0.001", "sf0.1")
    scored = QUERIES["op7_toxicity"](spark, folder).where("held_out")
    both = scored.join(load(spark, folder, "labels"), "doc_id").select("toxic", "score", "predicted").toPandas()
    ranks, toxic = both["score"].rank(), both["toxic"] == 1
    auc = (ranks[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (~toxic).sum())
    assert auc > 0.93
    assert both.predicted[toxic].mean() > 0.85 and both.predicted[~toxic].mean() < 0.03


def test_marginals_sum_over_all_taggings():
    rng = np.random.default_rng(1)
    emission, moves = rng.normal(size=(1, 6)), rng.normal(size=(2, 2))
    total, toxic = 0.0, np.zeros(6)
    for code in range(64):
        tags = [code >> t & 1 for t in range(6)]
        energy = sum(emission[0, t] * tags[t] for t in range(6))
        weight = np.exp(energy + sum(moves[a, b] for a, b in zip(tags, tags[1:], strict=False)))
        total += weight
        toxic += weight * np.array(tags)
    got, _ = toxicity.marginals(emission, np.ones((1, 6), bool), moves)
    assert np.allclose(got[0], toxic / total)


def test_mixing(spark, tables, docs, empty):
    got = mixing.mixed(docs)
    assert got.count() == len(rows()) and got.where("copies > 3").isEmpty()
    assert mixing.mixed(empty).count() == 0 and mixing.sample(empty).count() == 0
    whole = load(spark, tables, "documents")
    mix = mixing.mixed(whole)
    sums = mix.selectExpr("name", "target", "size * copies AS n").groupBy("name", "target").sum("n").collect()
    biggest = mix.selectExpr("max(size)").first()[0]
    assert all(abs(r["sum(n)"] - r.target) <= biggest for r in sums)
    assert spark_rows(mix) == spark_rows(mixing.mixed(whole.repartition(3)))
    assert mixing.sample(whole).count() == mix.selectExpr("sum(copies)").first()[0]


def test_targets(spark):
    """Stopped sources pass on what they cannot take."""
    sizes = [("a", 10), ("b", 1000), ("c", 1), ("d", 500)]
    shares = spark.createDataFrame([(False, *s) for s in sizes], "nameless boolean, name string, source_size bigint")
    found = {r.name: r.target for r in mixing.targets(shares).collect()}
    assert found["a"] == 30 and found["c"] == 3
    assert abs(found["b"] / found["d"] - 2) < 1e-9 and abs(sum(found.values()) - 1511) < 1e-6


def test_warc(spark):
    page = "<p>" + "x" * 200
    made = [(1, "u", page), (2, "u\r\nv", page), (3, None, "small"), (4, "u", "small"), (5, "u", None)]
    made += [(2, "u", page), (None, "u", page), (6, "u", "é" * 300_000)]
    pages = spark.createDataFrame([(*m, 1) for m in made], "page_id bigint, url string, html string, digest int")
    got = sorted((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes) for r in warc.archived(pages).collect())
    kinds = [(g[0], g[1], g[2]) for g in got]
    assert kinds == [
        (0, "response", None), (1, "response", None), (2, "revisit", 1), (2, "revisit", 1),
        (3, "response", None), (4, "response", None), (5, "response", None), (6, "response", None),
    ]
    assert got[-1][3] == 600_000
    assert warc.archived(pages.limit(0)).count() == 0


@pytest.mark.parametrize("n,universe", [(0, 10), (1, 1), (1000, 1 << 20), (5000, 6000), (300, 1 << 62)])
def test_elias_fano(n, universe):
    rng = np.random.default_rng(n)
    values = np.unique(rng.integers(0, universe, n, dtype=np.uint64))
    sequence = elias_fano.EliasFano(elias_fano.encode(values, universe))
    asked = np.sort(np.concatenate((values, rng.integers(0, universe, 200, dtype=np.uint64))))
    place, equal = sequence.successor(asked)
    assert (place == np.searchsorted(values, asked)).all()
    assert (equal == np.isin(asked, values)).all()
    if n:
        assert (ngram_lm.pointers_at(sequence, np.arange(len(values))) == values.astype(np.int64)).all()


def test_ngrams(spark, tables, docs, empty):
    got = ngram_lm.score(docs)
    assert got.count() == len(rows())
    assert by_id(got)[4].n_tokens == 1 and by_id(got)[5].score == by_id(got)[4].score
    assert ngram_lm.score(empty).count() == 0
    whole = ngram_lm.score(load(spark, tables, "documents")).where("held_out")
    assert whole.selectExpr("sum(score) > sum(base_score)").first()[0]


def test_vectors(spark, tables):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(400, 16))
    near = base[:100] + rng.normal(size=(100, 16)) * 0.02
    made = [(k, v.tolist(), k % 3 + 0, "x") for k, v in enumerate(base)]
    made += [(1000 + k, v.tolist(), k % 3, "x") for k, v in enumerate(near)]
    made += [(2000, base[0].tolist(), 0, "x"), (2001, None, 0, "x"), (2002, [0.0] * 16, 0, "x"), (2003, [], 0, "x")]
    made += [(2004, [float("nan")] * 16, 0, "x"), (2005, base[0].tolist(), None, "x"), (None, base[0].tolist(), 0, "x")]
    made += [(2006, [None] + [1.0] * 15, 0, "x"), (2007, [1.0], 0, "x")]
    schema = "vec_id bigint, embedding array<double>, label int, family string"
    vectors = spark.createDataFrame(made, schema)
    found = {r.vec_id: r for r in vector_dedup.near_duplicates(vectors).collect()}
    assert len(found) == len(made)
    assert found[2000].component_id == 0 and found[0].n_links >= 1
    assert all(found[k].n_links == 0 and found[k].component_id == k for k in range(2001, 2008))
    true = found_links = 0
    for k in range(100):
        cosine = base[k] @ near[k] / np.linalg.norm(base[k]) / np.linalg.norm(near[k])
        true += cosine >= 0.98
        found_links += found[1000 + k].component_id == k
    assert found_links >= 0.9 * true > 50
    assert vector_dedup.near_duplicates(vectors.limit(0)).count() == 0
    judged = vector_dedup.near_duplicates(vectors)
    assert vector_dedup.recall(vectors.where("embedding IS NOT NULL"), judged) >= 0.9


def test_pipeline(spark, tables, docs):
    assert corpus_pipeline.run(spark, tables).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, tables).columns == docs.columns
