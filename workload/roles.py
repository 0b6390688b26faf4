"""The driver's tables in the roles the library expects. Every role covers its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from aerolith.fixed import HOURLY_MEASURES

# Two of the 27 city numbers have no row in `nation`: cities the dimension does not know.
CITY = "concat('C', l_suppkey % 27)"
CITY_NAME = "concat('City ', l_suppkey % 27, case when l_partkey % 997 = 0 then ' (old)' else '' end)"

# Written so that Spark and DuckDB read the same text the same way.
WEATHER_EXPR = {
    "city_id": CITY,
    "city_name": CITY_NAME,
    "latitude": "cast(l_suppkey % 27 as double)",
    "longitude": "cast(-60 - l_suppkey % 27 as double)",
    "elevation_m": "cast((l_suppkey % 27) * 150 as bigint)",
    "temperature_2m": "case when l_orderkey % 97 = 0 then null else l_extendedprice / cast(2797 as double) end",
    "relative_humidity_2m": "l_quantity * 2 + 3",
    "dew_point_2m": "l_extendedprice / cast(2797 as double) - 5",
    "apparent_temperature": "l_extendedprice / cast(2503 as double)",
    "precipitation": "round(l_tax * 100)",
    "rain": "round(l_discount * 100)",
    "pressure_msl": "1000 + l_quantity",
    "surface_pressure": "cast(900 + l_linenumber as double)",
    "cloud_cover": "round(l_discount * 1000)",
    "wind_speed_10m": "l_quantity",
    "wind_direction_10m": "cast(l_orderkey % 360 as double)",
    "wind_gusts_10m": "l_quantity + l_linenumber",
    "shortwave_radiation": "cast(l_partkey % 1000 as double)",
}
HOUR = "(l_orderkey + l_linenumber) % 6 * 4"
LANDED_AFTER_DAYS = "l_partkey % 50"

POLLUTANT = (
    "case l_partkey % 7 when 0 then 'pm25' when 1 then 'pm10' when 2 then 'o3' when 3 then 'no2'"
    " when 4 then 'so2' when 5 then 'co' else 'bc' end"
)
UNITS = (
    "case when l_orderkey % 11 = 0 then 'ug/m3' when l_partkey % 7 in (0, 1, 6) then 'µg/m³'"
    " when l_partkey % 7 = 5 then 'ppm' else 'ppb' end"
)
READING = (
    "case when l_orderkey % 89 = 0 then null when l_orderkey % 83 = 0 then -1"
    " else l_extendedprice / cast(997 as double) * (l_suppkey % 27 + 1) / cast(27 as double) end"
)
AIR_EXPR = {
    "city_id": CITY,
    "city_name": CITY_NAME,
    "location_id": "l_suppkey % 100",
    "location_name": "concat('Station ', l_suppkey % 100)",
    "sensor_id": "l_suppkey",
    "parameter_name": POLLUTANT,
    "parameter_units": UNITS,
    "value": READING,
    "min_value": "l_extendedprice / cast(1994 as double)",
    "max_value": "l_extendedprice / cast(499 as double)",
    "avg_value": "l_extendedprice / cast(997 as double)",
    "measurement_count": "cast(l_linenumber as bigint)",
}

NATION_CITY_EXPR = {
    "city_id": "concat('C', n_nationkey)",
    "name": "n_name",
    "department": "concat('Region ', n_regionkey)",
    "latitude": "cast(n_nationkey as double)",
    "longitude": "cast(-60 - n_nationkey as double)",
    "elevation_m": "cast(n_nationkey * 150 as bigint)",
    "population": "cast((n_nationkey + 1) * 100000 as bigint)",
    "timezone": "'UTC'",
}
SUPPLIER_CITY_EXPR = {
    "city_id": "concat('S', s_suppkey)",
    "name": "s_name",
    "department": "concat('Region ', s_nationkey)",
    "latitude": "cast(s_suppkey % 120 as double)",
    "longitude": "cast(s_suppkey % 200 as double)",
    "elevation_m": "cast(floor(s_acctbal) as bigint)",
    "population": "cast(s_suppkey * 30011 as bigint)",
    "timezone": "case when s_suppkey % 13 = 0 then null else 'UTC' end",
}

# Events as hourly readings of five cities: for the storage layouts, which hold a month of days.
EVENT_CITY = "lpad(cast(user_id % 5 as string), 3, '0')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _select(df: DataFrame, exprs: dict[str, str], *more) -> DataFrame:
    return df.select(*[F.expr(text).alias(name) for name, text in exprs.items()], *more)


def _landed_at() -> F.Column:
    return F.expr(f"l_shipdate + make_dt_interval(cast({LANDED_AFTER_DAYS} as int))").alias(
        "ingested_at"
    )


def _weather(lines: DataFrame) -> DataFrame:
    hour = F.expr(f"l_shipdate + make_dt_interval(0, cast({HOUR} as int))")
    return _select(lines, WEATHER_EXPR, hour.alias("observation_ts"), _landed_at())


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weather(table(spark, sf_dir, "lineitem"))


# Live events: at minutes of hours that the pulled feeds have, of hours that they lack, and without
# the measures that live sensors do not send. Some name a measure that the pulled feeds have NULL.
LIVE = "l_linenumber <= 2"
LIVE_HOUR = "(l_orderkey + l_linenumber) % 6 * 4 + l_linenumber - 1"
LIVE_MINUTE = "l_partkey % 60"
LIVE_EXPR = {
    "event_id": "concat(l_orderkey, '-', l_linenumber)",
    "city_id": CITY,
    "city_name": CITY_NAME,
    "temperature_c": "case when l_partkey % 13 = 0 then null else l_quantity end",
    "apparent_temperature_c": "l_quantity + 2",
    "relative_humidity_pct": "case when l_partkey % 5 = 0 then null else l_quantity + 10 end",
    "precipitation_mm": "round(l_tax * 50)",
    "wind_speed_kmh": "l_quantity / 2",
    "wind_direction_deg": "cast(l_suppkey % 360 as double)",
    "wind_gusts_kmh": "l_quantity",
    "pressure_hpa": "1000 + l_quantity / 2",
    "cloud_cover_pct": "round(l_discount * 500)",
}


def live_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed stream events, in the sink's layout."""
    lines = table(spark, sf_dir, "lineitem").filter(LIVE)
    at = F.expr(f"l_shipdate + make_dt_interval(0, cast({LIVE_HOUR} as int), cast({LIVE_MINUTE} as int))")
    return _select(
        lines, LIVE_EXPR, F.date_format(at, "yyyy-MM-dd'T'HH:mm").alias("observed_ts"),
        F.expr("l_shipdate + make_dt_interval(cast(l_partkey % 3 as int), 1)").alias("consumed_at"),
    )


def weather_feeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Backfill and daily pull: the two line states."""
    lines = table(spark, sf_dir, "lineitem")
    return (
        _weather(lines.filter("l_linestatus = 'F'")),
        _weather(lines.filter("l_linestatus = 'O'")),
    )


def air(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.trunc("l_shipdate", "week").cast("string")
    return _select(
        table(spark, sf_dir, "lineitem"), AIR_EXPR, day.alias("observation_date"), _landed_at()
    )


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "nation"), NATION_CITY_EXPR)


def supplier_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "supplier"), SUPPLIER_CITY_EXPR)


def event_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw weather with nanosecond time columns, as a writer with that precision leaves it."""
    events = table(spark, sf_dir, "events")
    # A reading lies 123 ns after the microsecond of the event: conversion has to round down.
    nanos = F.unix_micros(F.col("ts").cast("timestamp")) * 1000 + 123
    measures = {name: "cast(event_id % 100 as double)" for name in HOURLY_MEASURES}
    measures["temperature_2m"] = "value"
    return _select(
        events,
        {
            "city_id": EVENT_CITY,
            "city_name": "concat('City ', user_id % 5)",
            "latitude": "cast(user_id % 5 as double)",
            "longitude": "cast(user_id % 5 as double)",
            "elevation_m": "cast(user_id % 5 as bigint)",
            **measures,
        },
        nanos.alias("observation_ts"),
        nanos.alias("ingested_at"),
    )
