"""Vector codes and hard negatives against brute force, and on odd tables."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolith.llm import codes, negatives
from aerolith.llm.vectors import whole_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, whole string"


def brute_codes(whole, parts, entries, rounds):
    """By the definition, in whole numbers; rows in order of id."""
    n, dims = whole.shape
    x = whole.reshape(n, parts, dims // parts)
    books = x[:entries].transpose(1, 0, 2).copy()

    def assign():
        away = ((x[:, :, None, :] - books[None]) ** 2).sum(-1)
        return away.argmin(-1), away.min(-1)

    for _ in range(rounds):
        code, _ = assign()
        for p in range(parts):
            for e in range(books.shape[1]):
                own = x[code[:, p] == e, p]
                if len(own):
                    books[p, e] = own.sum(0) // len(own)
    code, away = assign()
    text = ",".join(str(v) for p in books for e in p for v in e)
    return ["".join(f"{c:02x}" for c in row) for row in code], away.sum(1), hashlib.sha256(text.encode()).hexdigest()


def clustered(n, dims, seed):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(0, 0.5, (12, dims))
    return (centres[rnd.integers(0, 12, n)] + rnd.normal(0, 0.05, (n, dims))).astype(np.float32)


@pytest.mark.parametrize("rounds, entries, listed", [(0, 64, 8), (2, 64, 8), (5, 32, 3), (6, 16, 15), (3, 5, 1)])
def test_codes_are_those_of_the_definition(spark, rounds, entries, listed):
    x = clustered(700, 32, rounds)
    x[100:160] = x[7]  # many equal vectors, also among the first
    x[3] = x[1]
    rows = [(i, v.tolist(), i % 3, "") for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {r.vec_id: r for r in codes.compress(df, 16, entries, rounds, listed).collect()}
    text, error, digest = brute_codes(np.floor(x.astype(float) * 256).astype(int), 16, entries, rounds)
    assert [got[i].code for i in range(len(x))] == text
    assert [got[i].error for i in range(len(x))] == error.tolist()
    assert {r.codebooks_sha256 for r in got.values()} == {digest}
    for label in range(3):
        assert {got[i].label_error for i in range(label, len(x), 3)} == {int(error[label::3].sum())}


def test_bounds_spare_work_and_adapt():
    """After a small move most parts need no look, and few bounds are kept."""
    x = codes.cut(np.floor(clustered(500, 32, 1).astype(float) * 256).astype(np.int64), 16)
    books = np.ascontiguousarray(x[:64].transpose(1, 0, 2))
    found = codes.Assigned.empty(500, 16, 8)
    for part in range(16):
        found.look_everywhere(np.arange(500), part, x, books[part])
    moved = books + 1
    found.moved(codes.above(((moved - books) ** 2).sum(-1)))
    need = found.verify(x, moved)
    assert (need == 0).mean() > 0.5 and (need > 8).mean() < 0.3
    for part in range(16):
        away = ((x[:, part, None] - moved[part]) ** 2).sum(-1)
        assert (found.code[:, part] == away.argmin(1)).all()
    kept = found.adapted(np.full_like(need, 3), 2)
    assert kept.near.shape[2] == 3 and kept.lower.shape[2] == 4
    # Every bound that is kept holds.
    for part in range(16):
        away = np.sqrt(((x[:, part, None] - moved[part]) ** 2).sum(-1)) * 8
        for j in range(3):
            listed = np.take_along_axis(away, kept.near[:, part, j : j + 1], 1)[:, 0]
            assert (kept.lower[:, part, j] <= listed).all()
        np.put_along_axis(away, kept.near[:, part], np.inf, 1)
        np.put_along_axis(away, kept.code[:, part, None], np.inf, 1)
        assert (kept.lower[:, part, -1] <= away.min(1)).all()


def odd_vectors(spark):
    rows = [
        (1, [0.5, -0.25, 0.0, 1.0], 1, "x"), (1, [0.5, -0.25, 0.0, 1.0], 1, "x"), (2, [0.1, 0.1, 0.1, 0.1], None, "y"),
        (3, None, 1, None), (4, [0.1, None, 0.2, 0.3], 2, ""), (5, [float("nan"), 0.0, 0.0, 0.0], 2, ""),
        (6, [float("inf"), 0.0, 0.0, 0.0], 2, ""), (None, [0.5, 0.5, 0.5, 0.5], 1, "z"), (7, [1.0, 2.0], 1, "short"),
        (8, [0.0, 0.0, 0.0, 0.0], 2, ""), (9, [-0.5, 0.5, 0.5, 1.0], None, ""), (10, [], 3, ""), (1, [0.25, 0.0, 0.0, 1.0], 0, ""),
        (50, [0.5, 0.0, 0.25, 1.0], 1, ""), (11, [3e9, 0.0, 0.0, 0.0], 1, ""),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_codes_of_odd_vectors(spark):
    df = odd_vectors(spark)
    got = codes.compress(df, 2, 3, 2).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0) for r in got) == [(False, i) for i in (1, 1, 1, 2, 8, 9, 50)] + [(True, 0)]
    unlabelled = [r for r in got if r.vec_id in (2, 9)]
    assert {r.label_error for r in unlabelled} == {sum(r.error for r in unlabelled)}
    assert codes.compress(df.limit(0)).collect() == []
    nameless = codes.compress(df.filter("vec_id IS NULL")).collect()
    assert [(r.code, r.error) for r in nameless] == [(None, None)]
    # Three components do not divide by two parts: the last is filled up.
    three = df.filter("vec_id IN (1, 2)").withColumn("embedding", F.slice("embedding", 1, 3))
    assert {len(r.code) for r in codes.compress(three, 2, 2, 1).collect()} == {4}


def brute_negatives(rows, asked, k=5, n=3, low=50, high=95):
    out = set()
    for a in (r for r in rows if asked(r[0])):
        scored = [(-int(np.dot(a[2], r[2])), r[0], r[1]) for r in rows if r[0] != a[0]]
        for score, who, _ in sorted(s for s in scored if s[2] == a[1])[:k]:
            fits = sorted(s for s in scored if s[2] != a[1] and low * -score <= 100 * -s[0] <= high * -score)
            out |= {(a[0], who, i + 1, s[1], -score, -s[0]) for i, s in enumerate(fits[:n])}
    return out


@pytest.mark.parametrize("block_rows", [16, 2048])
def test_negatives_are_those_of_brute_force(spark, block_rows):
    x = clustered(900, 12, 5)
    x[300:420] = x[50]  # one very common vector
    label = np.random.default_rng(2).integers(-2, 4, 900)
    rows = [(i * 5, v.tolist(), int(c), "") for i, (v, c) in enumerate(zip(x, label))]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = negatives.hard_negatives(whole_vectors(df, "label"), F.col("vec_id") % 50 == 0, block_rows=block_rows)
    whole = np.floor(x.astype(float) * 256).astype(int)
    want = brute_negatives([(r[0], r[2], w) for r, w in zip(rows, whole)], lambda i: i % 50 == 0)
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == want and want


def test_zone_maps_leave_blocks_unread(spark):
    """On structured vectors most blocks are ruled out by their bounds."""
    x = clustered(4000, 8, 9)
    rows = [(i, v.tolist(), i % 2, "") for i, v in enumerate(x)]
    whole = whole_vectors(spark.createDataFrame(rows, SCHEMA), "label")
    own = whole.select("vec_id", F.col("label").cast("long").alias("label"), "whole")
    library = negatives.build_library(own, 8, 64)
    anchors = own.filter("vec_id % 100 = 0").withColumns({
        "floors": F.array(F.aggregate("whole", F.lit(0), lambda s, v: s + v * v).cast("long") * 9 / 10).cast("array<long>"),
        "ceilings": F.array(F.lit(2**62)),
    })
    bounds = negatives._bounds(True, 8)
    visits = anchors.withColumn("slice", F.lit(0)).groupBy("slice").cogroup(
        library.zones.withColumn("slice", F.lit(0)).groupBy("slice")
    ).applyInArrow(bounds, "anchor_id long, slice int, shelf int, block long, upper double")
    assert visits.select("anchor_id", "block").distinct().count() < 0.4 * 40 * library.n_zones


def test_curve_visits_neighbours():
    """Each cell once, and always the next one beside the last."""
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(2**bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        place = negatives.along_curve(cells, bits)
        assert sorted(place) == list(range(len(cells)))
        walk = cells[np.argsort(place)]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_negatives_of_odd_vectors(spark):
    df = odd_vectors(spark)
    rows = whole_vectors(df, "label")
    got = {tuple(r) for r in negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0).collect()}
    # Of the rows with id 1 that with the smallest label stands; 2 and 9 have no label.
    whole = {1: (0, [64, 0, 0, 256]), 8: (2, [0, 0, 0, 0]), 50: (1, [128, 0, 64, 256])}
    assert got == brute_negatives([(i, c, v) for i, (c, v) in whole.items()], lambda i: i % 50 == 0)
    assert negatives.hard_negatives(rows.limit(0), F.col("vec_id") % 50 == 0).collect() == []
    assert negatives.hard_negatives(rows, F.lit(False)).collect() == []
