"""Repeated rows and many equal vectors."""

import tracemalloc

import numpy as np

from aerolith.llm import neighbours


def test_repeated_rows_count_once(spark):
    x = np.random.default_rng(6).normal(size=(200, 4))
    once = [(i, v.tolist()) for i, v in enumerate(x)]
    queries = [once[i] for i in (0, 5, 9)]
    schema = "vec_id long, embedding array<double>"
    found = lambda data, asked: sorted(tuple(r) for r in neighbours.nearest(
        spark.createDataFrame(data, schema), spark.createDataFrame(asked, schema), k=5, factor=1.0, shards_deep=2
    ).collect())
    want = found(once, queries)
    assert len(want) == 15
    best = [once[r[2]] for r in want if r[1] == 1]
    assert found(once + best * 30, queries + queries * 9) == want


def test_equal_vectors_keep_memory_bounded():
    n, k = 20_000, 5
    x, ids = np.ones((n, 4)), np.random.default_rng(7).permutation(n)
    queries = np.random.default_rng(8).normal(size=(2500, 4)) + 2
    best = neighbours.Nearest(queries, np.arange(2500) % 3, k, np.full(2500, np.inf))
    lengths = np.einsum("ij,ij->i", queries, queries) + 4.0
    tracemalloc.start()
    best.offer(np.arange(2500), x[:9000], ids[:9000], lengths)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6  # 2500 x 9000 scores are 180 MB
    root = neighbours.build(x, np.arange(n), np.random.default_rng(0), 256)
    neighbours.thin_copies(root, x, ids, k)
    assert sorted(ids[root.rows]) == list(range(k + 1))


def test_vectors_of_other_lengths_and_too_long_ones(spark):
    rows = [(i, [float(i + 1), 1.0]) for i in range(30)] + [(40, [1.0]), (41, [1.0, 2.0, 3.0]), (42, [1e200, 1e200]), (43, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, df.filter("vec_id % 20 = 0"), k=3).collect()
    assert {r.query_id for r in got} == {0, 20}
    assert sorted((r.rank, r.vec_id) for r in got if r.query_id == 0) == [(1, 29), (2, 28), (3, 27)]
