"""Landed JSON documents (one response per file or row) to flat raw tables.

The outer generators with a filter behind them are on purpose: for the inner ones Catalyst infers
a filter on the array below, which would parse every document a second time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from aerolith import schemas
from aerolith.fixed import HOURLY_MEASURES, POLLUTANTS
from aerolith.operators.dedupe import dedupe_latest
from aerolith.session import stored
from aerolith.sources.scan import pin_city


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed document in `payload`, with the path's partition columns.

    A document is one API page, so a whole one per row stays small.
    """
    layout = pin_city(spark.read.text(path).schema)
    documents = spark.read.schema(layout).text(path, wholetext=True)
    return documents.withColumnRenamed("value", "payload")


def told_apart(payloads: DataFrame, array: str) -> tuple[DataFrame, DataFrame]:
    """Documents that hold the array they are for (a path such as `hourly.time`), and the others with
    the `reason`. Every document is in one of the two; both keep all columns.

    Documents are parsed as VARIANT, so anything that is JSON can be looked into.
    """
    # Each step its own column, parsed once; stored once, so that the filters on `reason` are not
    # pushed below it with the payload and its parsing repeated in each branch of the reason.
    document, found = F.col("_document"), F.col("_found")
    reason = (
        F.when(F.coalesce(F.trim("payload"), F.lit("")) == "", "empty")
        .when(document.isNull(), "not JSON")
        .when(found.isNull() | F.is_variant_null(found), f"no {array}")
        .when(~F.startswith(F.schema_of_variant(found), F.lit("ARRAY")), f"{array} is no array")
    )
    judged = stored(
        payloads.withColumn("_document", F.try_parse_json("payload"))
        .withColumn("_found", F.try_variant_get(document, f"$.{array}", "variant"))
        .withColumn("reason", reason)
        .drop("_document", "_found"),
        "told-apart",
    )
    return judged.filter("reason IS NULL").drop("reason"), judged.filter("reason IS NOT NULL")


def hourly_rows(payloads: DataFrame, cities: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """(city_id, payload) to one row per hour in the raw weather layout.

    A document without `hourly` or `time` gives no rows; a variable it lacks is NULL. Hours of a
    city that is not listed stay, without its attributes, and a time that cannot be read is NULL, so
    the checks on the raw feed report both instead of losing them.
    """
    parsed = payloads.withColumn("h", F.from_json("payload", schemas.HOURLY_PAYLOAD)["hourly"])
    absent = F.array().cast("array<double>")
    measures = [F.coalesce(F.col("h")[name], absent).alias(name) for name in HOURLY_MEASURES]
    # Zipping gives NULL, hence no hours, if the time array is absent.
    hours = parsed.select(
        "city_id",
        _ingested_at(payloads, ingested_at),
        F.inline_outer(F.arrays_zip(F.col("h.time").alias("time"), *measures)),
    ).filter(F.col("time").isNotNull())
    places = cities.select(
        "city_id", F.col("name").alias("city_name"), "latitude", "longitude", "elevation_m"
    )
    return (
        hours.withColumn("observation_ts", F.try_to_timestamp("time"))
        .join(places, "city_id", "left")
        .select(
            "city_id", "city_name", "latitude", "longitude", "elevation_m",
            *HOURLY_MEASURES, "observation_ts", "ingested_at",
        )
    )


def sensors(payloads: DataFrame) -> DataFrame:
    """(city_id, payload) of station listings to one row per sensor of a kept pollutant."""
    stations = payloads.withColumn(
        "station", F.explode_outer(F.from_json("payload", schemas.STATIONS_PAYLOAD)["results"])
    )
    return (
        stations.withColumn("sensor", F.explode_outer("station.sensors"))
        .filter(F.col("sensor.parameter.name").isin(POLLUTANTS))
        .select(
            "city_id",
            F.col("station.id").alias("location_id"),
            F.col("station.name").alias("location_name"),
            F.col("sensor.id").alias("sensor_id"),
            F.col("sensor.parameter.name").alias("parameter_name"),
            F.col("sensor.parameter.units").alias("parameter_units"),
            *[c for c in ("ingested_at",) if c in payloads.columns],
        )
    )


def measurements(
    payloads: DataFrame, sensors: DataFrame, cities: DataFrame, ingested_at: Column | None = None
) -> DataFrame:
    """(city_id, sensor_id, payload) of daily measurements to the raw air-quality layout.

    A sensor listed several times counts as last listed (by `ingested_at`, where the listing has
    it), so no reading is multiplied. Readings of sensors or cities that are not listed stay, without
    what the listing would add.
    """
    m = F.col("m")
    utc = m["period"]["datetimeFrom"]["utc"]
    results = F.from_json("payload", schemas.MEASUREMENTS_PAYLOAD)["results"]
    flat = payloads.withColumn("m", F.explode_outer(results)).filter(m.isNotNull()).select(
        "city_id",
        "sensor_id",
        F.nullif(F.substring(utc, 1, 10), F.lit("")).alias("observation_date"),
        m["value"].alias("value"),
        m["summary"]["min"].alias("min_value"),
        m["summary"]["max"].alias("max_value"),
        m["summary"]["avg"].alias("avg_value"),
        m["coverage"]["observedCount"].alias("measurement_count"),
        _ingested_at(payloads, ingested_at),
    )
    names = cities.select("city_id", F.col("name").alias("city_name"))
    if "ingested_at" not in sensors.columns:
        sensors = sensors.withColumn("ingested_at", F.lit(None).cast("timestamp"))
    listed = dedupe_latest(sensors, ["city_id", "sensor_id"], "ingested_at").drop("ingested_at")
    return (
        flat.join(listed, ["city_id", "sensor_id"], "left")
        .join(names, "city_id", "left")
        .select(schemas.AIR_RAW.names)
    )


def _ingested_at(payloads: DataFrame, given: Column | None) -> Column:
    if given is None:
        given = F.col("ingested_at") if "ingested_at" in payloads.columns else F.current_timestamp()
    return given.alias("ingested_at")
