"""Hand-built cases for staging, deduplication, daily grain and marts."""

import hashlib
from datetime import date, datetime

import pytest

from aerolith import fixed, schemas
from aerolith.functions import columns as C
from aerolith.operators import daily as D
from aerolith.plans import warehouse as W
from aerolith.sources import scan
from pyspark.sql import functions as F

DAY = date(2024, 3, 5)
HOUR = datetime(2024, 3, 5, 7)


def weather_row(city="BOG", ts=HOUR, ingested=datetime(2024, 3, 6), name="Bogota", **measures):
    values = [measures.get(m) for m in fixed.HOURLY_MEASURES]
    return (city, name, 4.7, -74.1, 2640, *values, ts, ingested)


def weather(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.weather_raw())


def air_row(value, city="BOG", name="Bogota", sensor=1, pollutant="pm25", units="µg/m³",
            day="2024-03-05", count=10, ingested=datetime(2024, 3, 6)):
    return (city, name, 1, "Centro", sensor, pollutant, units, day, value, None, None, None, count, ingested)


def air(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.AIR_RAW)


def staged(spark, *rows, daily=()):
    return W.stage_weather(weather(spark, *rows), weather(spark, *daily))


def test_staging_tags_feeds_and_keeps_contract(spark):
    df = staged(spark, weather_row(), daily=[weather_row("MDE")])
    assert df.columns == [
        "city_id", "city_name", "latitude", "longitude", "elevation_m", "observation_ts",
        *fixed.HOURLY_MEASURES.values(), "source_kind", "ingested_at",
    ]
    assert {(r.city_id, r.source_kind) for r in df.collect()} == {
        ("BOG", "historical"), ("MDE", "daily"),
    }


def test_stream_branch_fills_what_sensors_do_not_send(spark):
    event = dict.fromkeys(schemas.STREAM_LANDED.names)
    event |= {
        "city_id": "BOG", "city_name": "Bogota", "observed_ts": "2024-03-05T07:15",
        "temperature_c": 14.5, "pressure_hpa": 1013.0, "consumed_at": datetime(2024, 3, 5, 8),
    }
    stream = spark.createDataFrame([tuple(event.values())], schemas.STREAM_LANDED)
    df = W.stage_weather(weather(spark), weather(spark), stream)
    row = df.first()
    assert (row.source_kind, row.temperature_c, row.pressure_msl_hpa) == ("streaming", 14.5, 1013.0)
    assert row.observation_ts == datetime(2024, 3, 5, 7, 15)
    assert row.rain_mm is None and row.elevation_m is None


def test_latest_row_wins_and_ties_are_settled(spark):
    df = staged(
        spark,
        weather_row(temperature_2m=10.0, ingested=datetime(2024, 3, 6)),
        weather_row(temperature_2m=11.0, ingested=datetime(2024, 3, 8)),
        weather_row("MDE", temperature_2m=20.0),
        daily=[weather_row("MDE", temperature_2m=21.0), weather_row("CLO", temperature_2m=9.0)],
    )
    got = {r.city_id: (r.temperature_c, r.source_kind) for r in D.weather_latest(df).collect()}
    assert got == {"BOG": (11.0, "historical"), "MDE": (21.0, "daily"), "CLO": (9.0, "daily")}


def test_one_exchange_roll_up_equals_two_steps(spark):
    rows = [
        weather_row(ts=datetime(2024, 3, 5, h), temperature_2m=float(h), precipitation=0.5,
                    ingested=datetime(2024, 3, 6 + h % 2))
        for h in range(24)
    ]
    rows += [weather_row(ts=datetime(2024, 3, 5, 3), temperature_2m=99.0, ingested=datetime(2024, 4, 1))]
    df = staged(spark, *rows)
    one = D.weather_daily_latest(df).collect()
    two = D.weather_daily(D.weather_latest(df)).collect()
    assert one == two and len(one) == 1
    assert one[0].hour_count == 24 and one[0].max_temperature_c == 99.0
    # The row that replaces 03:00 has no precipitation.
    assert one[0].total_precipitation_mm == 11.5


def test_nanoseconds_round_down_before_1970_too(spark):
    df = spark.createDataFrame([(1_709_622_000_123_456_789,), (-1,), (-1001,)], "n bigint")
    got = [r.us for r in df.select(F.unix_micros(C.nanos_to_timestamp("n")).alias("us")).collect()]
    assert got == [1_709_622_000_123_456, -1, -2]


def test_readings_are_normalised_and_impossible_ones_dropped(spark):
    df = W.stage_air(
        air(
            spark,
            air_row(12.0),
            air_row(None),
            air_row(-0.5),
            air_row(1.5, pollutant="co", units="ppm"),
            air_row(30.0, pollutant="no2", units="ppb"),
            air_row(30.0, pollutant="o3", units="µg/m³"),
            air_row(0.0, pollutant="pm10", day="not a day"),
        )
    )
    got = {(r.parameter_name, r.normalised_value, r.observation_date) for r in df.collect()}
    assert got == {
        ("pm25", 12.0, DAY), ("co", 1500.0, DAY), ("no2", 30.0, DAY), ("o3", None, DAY),
        ("pm10", 0.0, None),
    }


def test_air_daily_median_and_counts(spark):
    df = W.stage_air(
        air(
            spark,
            air_row(10.0, sensor=1), air_row(20.0, sensor=2), air_row(1000.0, sensor=3),
            air_row(30.0, sensor=3, name="Bogota D.C."),
            air_row(5.0, city="CLO", name="Cali"),
        )
    )
    got = {(r.city_id, r.city_name): r for r in D.air_daily(df).collect()}
    assert set(got) == {("BOG", "Bogota"), ("BOG", "Bogota D.C."), ("CLO", "Cali")}
    for name in ("Bogota", "Bogota D.C."):
        row = got["BOG", name]
        assert (row.median_value, row.mean_value, row.min_value, row.max_value) == (25.0, 265.0, 10.0, 1000.0)
        assert (row.sensor_count, row.total_measurements) == (3, 40)


def test_landings_that_overlap_count_twice_unless_deduped(spark):
    df = W.stage_air(
        air(
            spark,
            air_row(10.0, sensor=1),
            air_row(14.0, sensor=1, ingested=datetime(2024, 3, 7)),
            air_row(30.0, sensor=2),
        )
    )
    kept = D.air_daily(df).first()
    deduped = D.air_daily(df, dedupe=True).first()
    assert (kept.median_value, kept.total_measurements, kept.sensor_count) == (14.0, 30, 2)
    assert (deduped.median_value, deduped.total_measurements, deduped.sensor_count) == (22.0, 20, 2)


def test_dimension_bounds(spark):
    seed = [
        (str(e), "n", "d", 0.0, 0.0, e, p, "UTC")
        for e, p in [(499, 599_999), (500, 600_000), (999, 1_999_999), (1000, 2_000_000),
                     (1999, 1), (2000, 1), (2999, 1), (3000, 1), (None, None)]
    ]
    got = {
        r.elevation_m: (r.climate_zone, r.population_tier)
        for r in W.dim_cities(spark.createDataFrame(seed, schemas.CITIES)).collect()
    }
    assert [got[e][0] for e in (499, 500, 999, 1000, 1999, 2000, 2999, 3000, None)] == [
        "tierra_caliente", "tierra_templada", "tierra_templada", "tierra_fria", "tierra_fria",
        "tierra_muy_fria", "tierra_muy_fria", "paramo", "paramo",
    ]
    assert [got[e][1] for e in (499, 500, 999, 1000, None)] == [
        "medium", "large", "large", "metropolitan", "metropolitan",
    ]


def test_surrogate_key_text(spark):
    row = spark.range(1).select(
        C.surrogate_key(F.lit("BOG"), F.lit(DAY)).alias("a"),
        C.surrogate_key(F.lit(None).cast("string"), F.lit("")).alias("b"),
    ).first()
    assert row.a == hashlib.md5(b"BOG-2024-03-05").hexdigest()
    assert row.b == hashlib.md5(b"_dbt_utils_surrogate_key_null_-").hexdigest()


def test_weather_fact_flags_and_unknown_city(spark):
    rows = [
        weather_row(temperature_2m=32.0, precipitation=20.0, wind_gusts_10m=40.0),
        weather_row("XXX", name="Nowhere", temperature_2m=5.0, precipitation=20.1),
    ]
    dim = W.dim_cities(scan.read_cities(spark))
    fact = W.fct_weather(D.weather_daily_latest(staged(spark, *rows)), dim)
    got = {r.city_id: r for r in fact.collect()}
    bog, lost = got["BOG"], got["XXX"]
    assert (bog.is_hot_day, bog.is_heavy_rain_day, bog.is_cold_day, bog.is_windy_day) == (True, False, False, True)
    assert (bog.climate_zone, bog.observation_day_of_week, bog.is_complete_day) == ("tierra_muy_fria", 3, False)
    assert (lost.is_cold_day, lost.is_heavy_rain_day, lost.is_windy_day) == (True, True, None)
    assert lost.department is None and lost.temperature_range_c == 0.0


def test_guideline_is_on_the_median_and_never_null(spark):
    rows = [(p, m) for p, limit in fixed.GUIDELINES.items() for m in (float(limit), limit + 0.1, None)]
    df = spark.createDataFrame([*rows, ("bc", 1e9)], "p string, m double")
    got = df.select("p", "m", C.exceeds_guideline("p", "m").alias("x")).collect()
    assert all(r.x is (r.p != "bc" and r.m is not None and r.m > fixed.GUIDELINES[r.p]) for r in got)


@pytest.mark.parametrize(
    "apparent, pm25, o3, no2, score",
    [
        (None, None, None, None, 0.0),
        (28.0, None, None, None, 0.0),
        (20.0, 10.0, None, None, 12.0),
        (33.0, None, 50.0, 10.0, 30.0),
        (60.0, 500.0, 500.0, 500.0, 100.0),
        (None, -5.0, None, None, 0.0),
    ],
)
def test_stress_score(spark, apparent, pm25, o3, no2, score):
    df = spark.createDataFrame(
        [(apparent, pm25, o3, no2)], "apparent double, pm25 double, o3 double, no2 double"
    )
    inputs = {name: name for name in ("pm25", "o3", "no2")}
    assert df.select(C.stress_score("apparent", inputs).alias("s")).first().s == pytest.approx(score)


def test_stress_fact_keeps_every_weather_day(spark):
    dim = W.dim_cities(scan.read_cities(spark))
    hist = weather(
        spark,
        weather_row(apparent_temperature=20.0),
        weather_row("CLO", name="Cali", apparent_temperature=33.0),
    )
    readings = air(
        spark, air_row(10.0), air_row(40.0, pollutant="no2", units="ppb"), air_row(9.0, city="SMR")
    )
    weather_fact = W.weather_mart(hist, weather(spark), dim)
    got = {r.city_id: r for r in W.fct_stress(weather_fact, W.air_mart(readings, dim)).collect()}
    assert set(got) == {"BOG", "CLO"}
    assert (got["BOG"].pm25, got["BOG"].no2, got["BOG"].o3, got["BOG"].pollutants_measured) == (10.0, 40.0, None, 2)
    assert got["BOG"].environmental_stress_score == pytest.approx(27.0)
    assert got["CLO"].pollutants_measured is None
    assert got["CLO"].environmental_stress_score == pytest.approx(15.0)
