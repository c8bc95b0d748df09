"""op3_vector_dedup on a label with many more centres than a vector joins."""

from __future__ import annotations

import numpy as np

from lakeloom.llm import vector_dedup


def test_recall_with_many_centres(spark):
    rng, n, d = np.random.default_rng(3), 9000, 32
    base = rng.normal(size=(50, d))[rng.integers(0, 50, n // 4)] + 0.9 * rng.normal(size=(n // 4, d))
    x = np.repeat(base, 4, 0)
    noise = np.repeat(rng.uniform(0.01, 0.2, n // 4), 4)[:, None] * np.linalg.norm(x, axis=1, keepdims=True)
    x = (x + rng.normal(size=x.shape) * noise / np.sqrt(d))[rng.permutation(n)]
    assert n / vector_dedup.PER_CENTRE > 4 * vector_dedup.OVERLAP
    schema = "vec_id bigint, embedding array<double>, label int"
    rows = spark.createDataFrame([(k, v.tolist(), 1) for k, v in enumerate(x)], schema).repartition(8)
    got = {r.vec_id: r.n_links for r in vector_dedup.near_duplicates(rows).collect()}
    unit, true, found = x / np.linalg.norm(x, axis=1, keepdims=True), 0, 0
    for k in range(0, n, 100):
        links = int((unit @ unit[k] >= vector_dedup.SIMILARITY).sum()) - 1
        true += links
        found += min(links, got[k])
    assert true > 100 and found >= 0.9 * true
