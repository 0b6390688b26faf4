"""Exact percentiles, against numpy."""

import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from aerolith.operators.percentile import rank_percentile

from jobs import no_jobs

SCHEMA = "k string, v double"


def expected(rows, q):
    groups = {}
    for k, v in rows:
        if v is not None:
            groups.setdefault(k, []).append(v)
    return {k: float(np.percentile(v, q * 100)) for k, v in groups.items()}


def check(got, want):
    assert got.keys() == want.keys()
    for key, value in want.items():
        assert math.isclose(got[key], value, rel_tol=1e-12, abs_tol=1e-12), key


def skewed_rows():
    rnd = random.Random(7)
    rows = [("big", rnd.lognormvariate(0, 6)) for _ in range(3000)]
    rows += [("big", -rnd.lognormvariate(0, 6)) for _ in range(1500)]
    rows += [("copies", 42.5)] * 2000
    rows += [("tiny range", 1.0 + i * 2**-52) for i in range(500)]
    rows += [("one", 3.0), (None, 5.0), (None, 6.0), ("even", 1.0), ("even", 2.0), ("null", None)]
    rows += [("zeros", x) for x in (0.0, 0.0, -1e-300, 1e300, 5e-324)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("q", [0.0, 0.5, 0.95, 1.0])
def test_narrowing_is_exact(spark, q):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    got = {r.k: r.p for r in rank_percentile(df, ["k"], "v", q, "p").collect()}
    check(got, expected(rows, q))


def test_no_job_while_building_and_no_null_groups(spark):
    df = spark.createDataFrame(skewed_rows(), SCHEMA)
    with no_jobs(spark):
        result = rank_percentile(df, ["k"], "v", 0.5, "p")
    assert "null" not in {r.k for r in result.collect()}


def test_infinite_values(spark):
    rows = [("a", float("inf")), ("a", float("-inf")), ("a", 1.0), ("a", 2.0), ("a", 3.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert rank_percentile(df, ["k"], "v", 0.5, "p").first().p == 2.0
    assert rank_percentile(df, ["k"], "v", 1.0, "p").first().p == float("inf")


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.floats(allow_nan=False, allow_infinity=False, width=32), min_size=1, max_size=40),
    st.sampled_from([0.25, 0.5, 0.9]),
)
def test_any_values(spark, values, q):
    rows = [("k", float(v)) for v in values]
    got = rank_percentile(spark.createDataFrame(rows, SCHEMA), ["k"], "v", q, "p").first().p
    want = expected(rows, q)["k"]
    assert math.isclose(got, want, rel_tol=1e-9, abs_tol=1e-9 * max(map(abs, values)))
