"""What the physical plans must and must not hold."""

import re

import pytest

from aerolith.operators import daily as D
from aerolith.plans import warehouse as W
from workload import roles
from workload.queries import QUERIES
from jobs import no_jobs

SF_DIR = "/root/testdata/sf0.001"
# These run jobs of their own while they are built; what they return only reads the result.
STORED = [n for n in QUERIES if n.startswith(("sink_", "stream_", "scan_"))] + [
    "mart_slice", "seed_csv", "climate_job", "quality_report", "mart_by_quarter", "mart_by_zone",
    "refresh_facts", "stress_bucketed", "namespace_tables",
]


def plan_of(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


def exchanges(plan):
    return re.findall(r"Exchange (?!.*BroadcastMode)(\w+)", plan)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(STORED)))
def test_no_cross_joins_no_python_no_single_partition_rows(spark, name):
    plan = plan_of(spark, name)
    for node in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "ExistingRDD"):
        assert node not in plan
    # Only one-row aggregates may end in a single partition.
    if name != "row_count":
        assert "Exchange SinglePartition" not in plan


@pytest.mark.parametrize(
    "name, count",
    [
        ("union_sources", 0), ("unit_normalise", 0), ("hourly_payload", 0), ("batch_daily", 1),
        # Days and medians count before they bring anything together: more exchanges, of less.
        ("dedupe_latest", 1), ("daily_rollup", 2), ("fct_weather", 2), ("fct_air", 9),
        ("air_daily_deduped", 9), ("percentile_large_groups", 6),
        ("pivot_pollutants", 9), ("stress_score", 12), ("corr_rain", 12), ("monthly_normals", 3),
        ("rolling_30d", 2), ("heat_waves", 2), ("heat_waves_calendar", 2), ("heat_episodes", 2),
    ],
)
def test_number_of_shuffles(spark, name, count):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert len(exchanges(plan_of(spark, name))) == count
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_copies_are_dropped_before_the_exchange(spark):
    plan = plan_of(spark, "dedupe_latest")
    assert re.search(r"Exchange hashpartitioning.*\n.*WindowGroupLimit.*Partial", plan)
    # The daily roll-up drops them too, then sends partial aggregates.
    days = plan_of(spark, "daily_rollup")
    assert re.search(r"Exchange hashpartitioning.*\n.*WindowGroupLimit.*Partial", days)
    assert re.search(r"Exchange hashpartitioning.*\n.*Aggregate.*partial_avg", days)


def test_nothing_runs_while_a_plan_is_built(spark):
    staged = W.stage_weather(*roles.weather_feeds(spark, SF_DIR))
    air = W.stage_air(roles.air(spark, SF_DIR))
    with no_jobs(spark):
        D.weather_daily_latest(staged), D.air_daily(air), D.air_daily(air, dedupe=True)


def test_medians_share_one_reading_of_the_feed(spark):
    """One scan for the counted values, which totals and buckets share, and one for the figures."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert plan_of(spark, "air_daily_median").count("FileScan") <= 2
        assert plan_of(spark, "percentile_large_groups").count("FileScan") == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_scans_read_only_what_is_used(spark):
    plan = QUERIES["fct_weather"](spark, SF_DIR).select("city_id", "max_temperature_c")
    text = plan._jdf.queryExecution().executedPlan().toString()
    line = next(t for t in text.splitlines() if "FileScan" in t and "l_shipdate" in t)
    assert "PushedFilters: [IsNotNull(l_linestatus), EqualTo(l_linestatus,F)]" in line
    batch = QUERIES["batch_daily"](spark, SF_DIR).select("max_temperature_c")
    text = batch._jdf.queryExecution().executedPlan().toString()
    assert "l_tax" not in text and "l_discount" not in text
