"""op4_substring_dedup judges rows of one id text by text."""

from __future__ import annotations

from lakeloom.llm import substring_dedup


def test_one_id_with_two_texts(spark):
    base, other = [f"a{i}" for i in range(40)], [f"b{i}" for i in range(60)]
    mixed = [*other[:20], *base[5:25], *other[20:]]
    rows = [(1, base), (2, base), (2, other), (3, mixed[:10] + base[:14]), (3, other[30:] + [f"c{i}" for i in range(9)])]
    made = spark.createDataFrame([(k, " ".join(w)) for k, w in rows], "doc_id bigint, text string")
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept.decode()) for r in substring_dedup.remove_repeats(made).collect())
    want = []
    for k, words in rows:
        gone = set()
        for i in range(len(words) - 12):
            for j, text in rows:
                window = words[i : i + 13]
                if j < k and any(text[p : p + 13] == window for p in range(len(text) - 12)):
                    gone |= set(range(i, i + 13))
        want.append((k, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    assert got == sorted(want)
    assert [n for _, _, n, _ in sorted(want)].count(0) == 2
