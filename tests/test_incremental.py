"""Marts brought up to date by one landing, co-partitioned marts, slices and rejected documents."""

import glob
import os
from datetime import date, datetime

from aerolith.operators import daily as D
from aerolith.plans import batch, incremental, reports, warehouse as W
from aerolith.sources import payloads, scan, sinks
from pyspark.sql import functions as F
from test_models import air, air_row, weather, weather_row

FACTS = ["fct_weather_daily", "fct_air_quality_daily", "fct_environmental_stress"]


def hour(month, value, city="BOG", ingested=datetime(2024, 6, 1)):
    return weather_row(city, datetime(2024, month, 5, 7), ingested, temperature_2m=value, apparent_temperature=value)


def reading(month, value, city="BOG", sensor=1):
    return air_row(value, city, sensor=sensor, day=f"2024-{month:02}-05")


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(path + "/**/*.parquet", recursive=True)}


def rows(spark, root, name):
    return sorted(map(str, spark.read.parquet(f"{root}/{name}").collect()))


def test_refresh_equals_rebuild_and_leaves_other_months(spark, path):
    old_hours = [hour(m, 20.0 + m, c) for m in (1, 2, 3) for c in ("BOG", "MDE")]
    old_air = [reading(m, 10.0 * m, c) for m in (1, 2, 3) for c in ("BOG", "MDE")]
    new_hours = [hour(2, 35.0, "MDE", datetime(2024, 7, 1)), hour(4, 30.0)]
    new_air = [reading(2, 90.0, "MDE", 2), reading(5, 7.0), air_row(3.0, day="no day")]
    cities, none = scan.read_cities(spark), weather(spark)
    batch.build_warehouse(spark, weather(spark, *old_hours), none, air(spark, *old_air), cities, path("marts"))
    before = files(path("marts"))
    hist, readings = weather(spark, *old_hours, *new_hours), air(spark, *old_air, *new_air)
    done = incremental.refresh_warehouse(
        spark, hist, none, readings, path("marts"), weather(spark, *new_hours), air(spark, *new_air)
    )
    assert done == dict(zip(FACTS, (2, 3, 4)))
    batch.build_warehouse(spark, hist, none, readings, cities, path("anew"))
    for name in FACTS:
        assert rows(spark, path("marts"), name) == rows(spark, path("anew"), name), name
    after = files(path("marts"))
    untouched = {f for f in before if "dim_cities" in f or "month=1/" in f or "month=3/" in f}
    assert untouched and all(after.get(f) == before[f] for f in untouched)
    assert not [f for f in after if "month=2/" in f and f in before]
    # Nothing landed: nothing is written.
    assert incremental.refresh_warehouse(spark, hist, none, readings, path("marts"), none) == {
        "fct_weather_daily": 0, "fct_environmental_stress": 0
    }
    assert files(path("marts")) == after


def test_a_month_that_loses_all_rows_goes(spark, path):
    cities, none = scan.read_cities(spark), weather(spark)
    batch.build_warehouse(spark, weather(spark, hour(1, 20.0)), none, air(spark, reading(1, 5.0), reading(2, 5.0)), cities, path("marts"))
    # The landing replaced the only reading of February with one that is impossible.
    now = air(spark, reading(1, 5.0), reading(2, -1.0))
    incremental.refresh_warehouse(spark, weather(spark, hour(1, 20.0)), none, now, path("marts"), None, air(spark, reading(2, -1.0)))
    left = spark.read.parquet(path("marts") + "/fct_air_quality_daily").collect()
    assert [r.observation_month for r in left] == [1]


def test_bucketed_facts_join_without_an_exchange(spark, path):
    sinks.ensure_namespace(spark, "bucketed", path("db"))
    dim = W.dim_cities(scan.read_cities(spark))
    hist = weather(spark, *[hour(m, 20.0 + m, c) for m in (1, 2, 3) for c in ("BOG", "MDE")])
    readings = air(spark, *[reading(m, 10.0 * m, c) for m in (1, 2, 3) for c in ("BOG", "MDE")])
    facts = {"weather": W.weather_mart(hist, weather(spark), dim), "air": W.air_mart(readings, dim)}
    for name, df in facts.items():
        sinks.write_bucketed(df, f"bucketed.{name}", D.CITY_DAY, 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stress = W.fct_stress(spark.table("bucketed.weather"), spark.table("bucketed.air"))
        assert "Exchange" not in stress._jdf.queryExecution().executedPlan().toString()
        want = W.fct_stress(facts["weather"], facts["air"]).collect()
        assert sorted(map(str, stress.collect())) == sorted(map(str, want))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE bucketed CASCADE")


def test_attributes_of_months_prune_folders(spark, path):
    dim = W.dim_cities(scan.read_cities(spark))
    readings = air(spark, *[reading(m, 10.0 * m, c) for m in range(1, 13) for c in ("BOG", "CTG")])
    sinks.write_mart(W.air_mart(readings, dim), path("air"), ["city_id"])
    reports.calendar(spark, "2023-11-15", "2025-02-01").write.parquet(path("months"))
    months = spark.read.parquet(path("months"))
    assert months.count() == 16 and months.filter("days = 29").count() == 1
    spring = reports.slice_by_months(spark.read.parquet(path("air")), months.filter("quarter = 2"))
    assert "dynamicpruning" in spring._jdf.queryExecution().executedPlan().toString()
    assert sorted({r.observation_month for r in spring.collect()}) == [4, 5, 6]
    zone = reports.slice_by_cities(spark.read.parquet(path("air")), dim.filter("climate_zone = 'tierra_caliente'"))
    assert {r.city_id for r in zone.collect()} == {"CTG"} and zone.count() == 12


def test_documents_are_told_apart(spark):
    texts = [
        '{"hourly": {"time": []}}', '{"hourly": {"time": ["2024-03-05T07:00"], "rain": [1.0]}, "more": 1}',
        None, "", "  ", "not json", '{"hourly": {"time": [', '{"hourly": {"time": null}}', '{"hourly": 3}', "[]", "7",
        '{"hourly": {"time": "x"}}',
    ]
    docs = spark.createDataFrame([("BOG", t, i) for i, t in enumerate(texts)], "city_id string, payload string, n int")
    good, bad = payloads.told_apart(docs, "hourly.time")
    assert sorted(r.n for r in good.collect()) == [0, 1] and good.columns == docs.columns
    reasons = {r.n: r.reason for r in bad.collect()}
    assert reasons == {
        2: "empty", 3: "empty", 4: "empty", 5: "not JSON", 6: "not JSON", 7: "no hourly.time", 8: "no hourly.time",
        9: "no hourly.time", 10: "no hourly.time", 11: "hourly.time is no array",
    }
    # A document that is told apart as good is read, one that is not gives no hour.
    cities = scan.read_cities(spark)
    assert payloads.hourly_rows(good, cities, F.current_timestamp()).count() == 1
    assert payloads.hourly_rows(bad, cities, F.current_timestamp()).count() == 0


def test_each_touched_day_once(spark):
    found = incremental.touched_days(spark, air(spark, reading(1, 1.0), reading(1, 2.0), air_row(3.0, day="no day")))
    days = {(r.city_id, r.observation_date, r.observation_month) for r in found.collect()}
    assert found.count() == 2 and days == {("BOG", date(2024, 1, 5), 1), ("BOG", None, None)}
