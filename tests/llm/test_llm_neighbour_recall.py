"""Recall of the default factor on vectors of few intrinsic dimensions, which shards tell apart."""

import numpy as np

from aerolith.llm import neighbours


def recall(spark, n, **kwargs):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(n, 8)) @ rng.normal(size=(8, 16))
    vectors = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = neighbours.nearest(vectors, vectors.filter("vec_id % 100 = 0"), **kwargs).collect()
    got = {(r["query_id"], r["vec_id"]) for r in got}
    want = set()
    for q in range(0, n, 100):
        score = x @ x[q]
        score[q] = -np.inf
        want |= {(q, int(v)) for v in np.argsort(-score)[:20]}
    return len(got & want) / len(want)


def test_recall_on_structured_vectors(spark):
    assert recall(spark, 20_000) >= 0.995
