"""Registered queries: each operator of the library over the driver's tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from aerolith import fixed, schemas
from aerolith.functions import columns as C
from aerolith.operators import climate, daily as D, merge, percentile, quality
from aerolith.plans import batch, incremental, reports, warehouse as W
from aerolith.plans.checks import Watch
from aerolith.session import scratch_path
from aerolith.sources import payloads, scan, sinks
from aerolith.streaming import sink as stream
from workload import roles

PLACES = 6
TS = "yyyy-MM-dd HH:mm:ss"


def portable(df: DataFrame) -> DataFrame:
    """Doubles to six places, dates and times to text: the same in every engine."""
    shown = []
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind in ("double", "float"):
            column = F.round(column.cast("double"), PLACES)
        elif kind == "date":
            column = column.cast("string")
        elif kind.startswith("timestamp"):
            column = F.date_format(column, TS)
        elif kind in ("int", "smallint", "tinyint"):
            column = column.cast("bigint")
        shown.append(column.alias(name))
    return df.select(*shown)


# --- models -------------------------------------------------------------------------------------


def _staged(spark, d):
    return W.stage_weather(*roles.weather_feeds(spark, d))


def _dim(spark, d):
    return W.dim_cities(roles.cities(spark, d))


def _daily(spark, d):
    return D.batch_daily(roles.weather(spark, d))


def _fct_weather(spark, d):
    return W.weather_mart(*roles.weather_feeds(spark, d), _dim(spark, d))


def _fct_air(spark, d):
    return W.air_mart(roles.air(spark, d), _dim(spark, d))


def _fct_stress(spark, d):
    return W.fct_stress(_fct_weather(spark, d), _fct_air(spark, d))


def corr_rain(spark, d):
    """Only the pollutant's own readings go into the stress mart."""
    readings = roles.air(spark, d).filter(F.col("parameter_name") == "pm25")
    air = W.air_mart(readings, W.dim_cities(roles.cities(spark, d)))
    return reports.rain_correlation(W.fct_stress(_fct_weather(spark, d), air))


def union_stream(spark, d):
    """All three feeds: landed stream events beside the two pulled ones."""
    return W.stage_weather(*roles.weather_feeds(spark, d), roles.live_events(spark, d))


def fct_weather_stream(spark, d):
    """The weather mart with live events, merged by measure."""
    return W.weather_mart(*roles.weather_feeds(spark, d), _dim(spark, d), roles.live_events(spark, d))


def surrogate_key(spark, d):
    lines = roles.table(spark, d, "lineitem")
    flag = F.nullif("l_returnflag", F.lit("R"))
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        C.surrogate_key("l_orderkey", "l_linenumber").alias("two_part_key"),
        C.surrogate_key(flag, F.to_date("l_shipdate"), "l_suppkey").alias("three_part_key"),
    )


def unit_normalise(spark, d):
    return W.stage_air(roles.air(spark, d)).withColumn(
        "normalised_units", C.normalised_units("parameter_name", "parameter_units")
    )


def who_exceedance(spark, d):
    return _fct_air(spark, d).filter("exceeds_who_guideline").select(
        "air_quality_sk", "city_id", "city_name", "observation_date", "parameter_name",
        "normalised_units", "median_value",
    )


def percentile_large_groups(spark, d):
    """Three groups of a third of all rows each: none is ever held by one task."""
    return percentile.rank_percentile(
        roles.table(spark, d, "lineitem"), ["l_returnflag"], "l_extendedprice", 0.95, "price_p95"
    )


def row_count(spark, d):
    return roles.weather(spark, d).agg(F.count(F.lit(1)).alias("raw_rows"))


# --- quality ------------------------------------------------------------------------------------


def quality_report(spark, d):
    """The whole warehouse is built and stored, then every declared check runs on it."""
    feeds, air, cities = roles.weather_feeds(spark, d), roles.air(spark, d), roles.cities(spark, d)
    watch = Watch()
    marts = batch.build_warehouse(spark, *feeds, air, cities, scratch_path(spark, "marts"), watch=watch)
    return batch.check_warehouse(*feeds, air, cities, marts, watch=watch)


def unknown_cities(spark, d):
    """Failing values of the relationship check: cities missing from the dimension."""
    check = quality.relationship("city_id", "cities")
    return quality.failing(roles.weather(spark, d), check, {"cities": roles.cities(spark, d)})


def duplicate_keys(spark, d):
    return quality.failing(_fct_weather(spark, d), quality.unique("weather_sk"))


def missing_measures(spark, d):
    return quality.failing(_staged(spark, d), quality.not_null("temperature_c"))


def unknown_pollutants(spark, d):
    check = quality.accepted_values("parameter_name", fixed.POLLUTANTS)
    return quality.failing(W.stage_air(roles.air(spark, d)), check).drop("ingested_at")


def humidity_out_of_range(spark, d):
    check = quality.accepted_range("relative_humidity_pct", 0, 100, "warn")
    return quality.failing(_staged(spark, d), check)


# --- JSON landing -------------------------------------------------------------------------------


def _hourly_payloads(spark, d, *more):
    """One document per line: three hours, without the variables the line has no data for."""
    hours = [F.date_format("l_shipdate", f"yyyy-MM-dd'T'0{h}:00") for h in range(3)]
    # Some times cannot be read.
    hours[2] = F.when(F.col("l_orderkey") % 11 != 0, hours[2]).otherwise(F.lit("2h later"))
    hours = F.array(*hours)
    three = F.array(F.col("l_quantity"), F.col("l_quantity") + 1, F.lit(None).cast("double"))
    temps = F.array(*[F.col("l_extendedprice") / 2797 + h for h in range(3)])
    hourly = F.struct(
        F.when(F.col("l_orderkey") % 13 != 0, hours).alias("time"),
        temps.alias("temperature_2m"),
        three.alias("wind_speed_10m"),
    )
    return roles.table(spark, d, "lineitem").select(
        *more,
        F.expr(roles.CITY).alias("city_id"),
        F.to_json(F.struct(hourly.alias("hourly"))).alias("payload"),
        F.col("l_shipdate").alias("ingested_at"),
    )


def hourly_payload(spark, d):
    return payloads.hourly_rows(_hourly_payloads(spark, d), roles.cities(spark, d))


def landing_rejects(spark, d):
    """Hourly documents that are damaged in one way or another, told apart; every line is in one part."""
    lines = _hourly_payloads(spark, d, "l_orderkey", "l_linenumber")
    n = F.col("l_orderkey")
    damaged = (
        F.when(n % 17 == 0, F.substring("payload", 1, 20))
        .when(n % 19 == 0, F.lit(" "))
        .when(n % 23 == 0, F.lit('{"hourly": {"time": "2024-03-05T07:00"}}'))
        .when(n % 29 == 0, F.lit("[1, 2]"))
        .when(n % 31 == 0, F.lit(None))
        .otherwise(F.col("payload"))
    )
    good, bad = payloads.told_apart(lines.withColumn("payload", damaged), "hourly.time")
    both = good.withColumn("reason", F.lit(None).cast("string")).unionByName(bad)
    return both.select("l_orderkey", "l_linenumber", "city_id", "reason")


def _station_payloads(spark, d):
    """One document per supplier: a station with a sensor for each of three parameters."""
    s = roles.table(spark, d, "supplier")
    key = F.col("s_suppkey")

    def sensor(i, name, units):
        parameter = F.struct(F.lit(name).alias("name"), F.lit(units).alias("units"))
        return F.struct((key * 10 + i).alias("id"), parameter.alias("parameter"))

    sensors = F.array(sensor(0, "pm25", "µg/m³"), sensor(1, "humidity", "%"), sensor(2, "no2", "ppb"))
    station = F.struct(key.alias("id"), F.col("s_name").alias("name"), sensors.alias("sensors"))
    return s.select(
        F.concat(F.lit("C"), key % 27).alias("city_id"),
        F.to_json(F.struct(F.array(station).alias("results"))).alias("payload"),
    )


def _listed_twice(spark, d):
    """The listing landed twice, under another station name the first time."""
    now = _station_payloads(spark, d).withColumn("ingested_at", F.lit("2024-02-01").cast("timestamp"))
    before = now.withColumns({
        "payload": F.regexp_replace("payload", "Supplier", "Old"),
        "ingested_at": F.lit("2024-01-01").cast("timestamp"),
    })
    return payloads.sensors(before.unionByName(now))


def station_payload(spark, d):
    return payloads.sensors(_station_payloads(spark, d))


def measurement_payload(spark, d):
    """One document per line: one day of the supplier's first sensor, sometimes without a period."""
    utc = F.date_format("l_shipdate", "yyyy-MM-dd'T'00:00:00'Z'")
    period = F.struct(F.struct(utc.alias("utc")).alias("datetimeFrom"))
    summary = F.struct(
        (F.col("l_quantity") - 1).alias("min"),
        (F.col("l_quantity") + 1).alias("max"),
        F.col("l_quantity").alias("avg"),
    )
    result = F.struct(
        F.col("l_quantity").alias("value"),
        F.when(F.col("l_orderkey") % 17 != 0, period).alias("period"),
        F.when(F.col("l_orderkey") % 19 != 0, summary).alias("summary"),
        F.struct(F.col("l_linenumber").alias("observedCount")).alias("coverage"),
    )
    docs = roles.table(spark, d, "lineitem").select(
        F.expr(roles.CITY).alias("city_id"),
        (F.col("l_suppkey") * 10).alias("sensor_id"),
        F.to_json(F.struct(F.array(result).alias("results"))).alias("payload"),
        F.col("l_shipdate").alias("ingested_at"),
    )
    return payloads.measurements(docs, _listed_twice(spark, d), roles.cities(spark, d))


def month_windows(spark, d):
    """Backfill windows of each customer's order history."""
    spans = roles.table(spark, d, "orders").groupBy("o_custkey").agg(
        F.to_date(F.min("o_orderdate")).alias("first_day"),
        F.to_date(F.max("o_orderdate")).alias("last_day"),
    )
    return scan.month_windows(spans, "first_day", "last_day").select(
        "o_custkey", "window_start", "window_end"
    )


def trailing_window(spark, d):
    staged = W.stage_air(roles.air(spark, d))
    return scan.trailing_window(staged, "1998-06-08", 7).drop("ingested_at")


def target_day(spark, d):
    raw = roles.weather(spark, d).withColumn("observation_date", F.to_date("observation_ts"))
    return scan.target_day(raw, "1998-06-08").select(
        "city_id", "observation_ts", "temperature_2m", "precipitation", "observation_date"
    )


# --- storage ------------------------------------------------------------------------------------


def scan_nanos(spark, d):
    """Stored with nanosecond longs below city/year/month, read back as timestamps."""
    path = scratch_path(spark, "weather")
    raw = roles.event_weather(spark, d)
    at = C.nanos_to_timestamp("observation_ts")
    parted = raw.withColumns({"year": F.year(at), "month": F.month(at)})
    sinks.write_parquet(parted, path, schemas.CITY_MONTH_PATH.names, ["observation_ts"])
    return scan.read_weather(spark, path)


def scan_mixed(spark, d):
    """One folder with files of nanoseconds and others of microseconds, read as timestamps."""
    path = scratch_path(spark, "weather-mixed")
    raw = roles.event_weather(spark, d)
    at = C.nanos_to_timestamp("observation_ts")
    parted = raw.withColumns({"year": F.year(at), "month": F.month(at)})
    for rest, write in ((0, lambda df: df), (1, scan.convert_nanos), (2, lambda df: df)):
        part = write(parted.filter(F.pmod("elevation_m", F.lit(3)) == rest))
        part.write.mode("append").partitionBy(*schemas.CITY_MONTH_PATH.names).parquet(path)
    return scan.read_weather(spark, path)


def scan_days(spark, d):
    """The daily layout with an explicit schema."""
    path = scratch_path(spark, "weather-daily")
    raw = scan.convert_nanos(roles.event_weather(spark, d))
    at = F.col("observation_ts")
    parted = raw.withColumns({"year": F.year(at), "month": F.month(at), "day": F.day(at)})
    sinks.write_parquet(parted, path, schemas.DAY_PATH.names, ["city_id"])
    return scan.read_partitioned(spark, path, schemas.weather_raw(), schemas.DAY_PATH)


def scan_external(spark, d):
    """An external table over the stored daily layout."""
    path = scratch_path(spark, "weather-external")
    raw = scan.convert_nanos(roles.event_weather(spark, d))
    at = F.col("observation_ts")
    parted = raw.withColumns({"year": F.year(at), "month": F.month(at), "day": F.day(at)})
    sinks.write_parquet(parted, path, schemas.DAY_PATH.names, ["city_id"])
    name = "aerolith_" + path.rsplit("-", 1)[1]
    return scan.register_external(spark, name, path, schemas.weather_raw(), schemas.DAY_PATH)


def seed_csv(spark, d):
    """The seed through CSV with declared types, then the dimension."""
    path = scratch_path(spark, "cities")
    roles.supplier_cities(spark, d).write.option("header", True).csv(path)
    return W.dim_cities(scan.read_cities(spark, path))


def climate_job(spark, d):
    """The batch job end to end: its three stored results, read back below each other."""
    out = scratch_path(spark, "climate")
    batch.climate_job(spark, roles.weather(spark, d), out)
    results = [
        spark.read.parquet(f"{out}/{name}").withColumn("result", F.lit(name))
        for name in ("monthly_normals", "rolling_30d", "heat_waves")
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), results)


def _event_days(spark, d):
    return roles.table(spark, d, "events").select(
        "event_id", "event_type", "value", F.to_date("ts").alias("day")
    )


def sink_dynamic_overwrite(spark, d):
    """A second write replaces the days it holds and leaves the others."""
    path = scratch_path(spark, "events")
    days = _event_days(spark, d)
    sinks.write_parquet(days, path, ["day"])
    later = days.filter("day >= '2024-01-16'").withColumn("value", F.col("value") + 1)
    sinks.write_parquet(later, path, ["day"])
    return spark.read.schema(days.schema).parquet(path)


def sink_land_rerun(spark, d):
    """Landing the same day twice leaves one copy."""
    path = scratch_path(spark, "landed")
    day = scan.target_day(_event_days(spark, d), "2024-01-10", on="day").drop("day")
    for _ in range(2):
        sinks.land_day(day, path, "2024-01-10")
    return spark.read.parquet(path)


def sink_table_append(spark, d):
    """Overwrite, then append, through the catalog."""
    path = scratch_path(spark, "table")
    name = "aerolith_" + path.rsplit("-", 1)[1]
    days = _event_days(spark, d)
    for mode in ("overwrite", "append"):
        sinks.write_table(
            days, name, partition_by=["day"], cluster_by=["event_type"], mode=mode, path=path
        )
    # Dropping an external table leaves its files.
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(days.schema).parquet(path).groupBy("day", "event_type").agg(
        F.count(F.lit(1)).alias("events"), F.max("value").alias("max_value")
    )


def mart_slice(spark, d):
    """A stored mart, filtered by dates and cities: months outside the range are not read."""
    path = scratch_path(spark, "fct_air")
    sinks.write_mart(_fct_air(spark, d), path, ["city_id", "parameter_name"])
    stored = spark.read.parquet(path)
    return reports.dashboard_slice(stored, "1997-03-10", "1998-02-20", ["C1", "C7", "C26"])


def mart_by_quarter(spark, d):
    """The same mart by an attribute of the month: other months' folders are not read."""
    path = scratch_path(spark, "fct_air")
    sinks.write_mart(_fct_air(spark, d), path, ["city_id", "parameter_name"])
    months = scratch_path(spark, "calendar")
    reports.calendar(spark, "1990-01-01", "2009-12-31").write.parquet(months)
    second = spark.read.parquet(months).filter("quarter = 2")
    return reports.slice_by_months(spark.read.parquet(path), second)


def mart_by_zone(spark, d):
    """The same mart by an attribute of the city."""
    path = scratch_path(spark, "fct_air")
    sinks.write_mart(_fct_air(spark, d), path, ["city_id", "parameter_name"])
    return reports.slice_by_cities(spark.read.parquet(path), _dim(spark, d).filter("climate_zone = 'tierra_fria'"))


def _refreshed(spark, d):
    """The warehouse as built before the last landing, then brought up to date with it."""
    feeds, air, cities = roles.weather_feeds(spark, d), roles.air(spark, d), roles.cities(spark, d)
    late = "observation_ts >= '2001-06-01'"
    late_air = "observation_date >= '2001-06-01'"
    before = [df.filter(f"NOT {late}") for df in feeds]
    out = scratch_path(spark, "warehouse")
    batch.build_warehouse(spark, *before, air.filter(f"NOT {late_air}"), cities, out)
    landed = feeds[0].unionByName(feeds[1]).filter(late)
    incremental.refresh_warehouse(spark, *feeds, air, out, landed, air.filter(late_air))
    return out


def refresh_facts(spark, d):
    """All three facts after an incremental refresh, beside each other."""
    out = _refreshed(spark, d)
    facts = [spark.read.parquet(f"{out}/{name}") for name in ("fct_weather_daily", "fct_air_quality_daily", "fct_environmental_stress")]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), facts)


def stress_bucketed(spark, d):
    """Both facts as tables bucketed by city and day: the stress mart then needs no exchange."""
    path = scratch_path(spark, "bucketed")
    name = "aerolith_" + path.rsplit("-", 1)[1]
    sinks.ensure_namespace(spark, name, path)
    sinks.write_bucketed(_fct_weather(spark, d), f"{name}.fct_weather", D.CITY_DAY, 8)
    sinks.write_bucketed(_fct_air(spark, d), f"{name}.fct_air", D.CITY_DAY, 8)
    return W.fct_stress(spark.table(f"{name}.fct_weather"), spark.table(f"{name}.fct_air"))


# --- streaming ----------------------------------------------------------------------------------


def _event_stream(spark, d):
    """The events as JSON lines in a folder; some lines are broken, some name no city."""
    folder = scratch_path(spark, "stream-in")
    event = F.struct(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(F.col("event_id") % 31 != 0, F.expr(roles.EVENT_CITY)).alias("city_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("observed_ts"),
        F.col("value").alias("temperature_c"),
        F.col("event_type").alias("sensor_kind"),
    )
    # Some values cannot be read.
    warm = F.regexp_replace(F.to_json(event), r'("temperature_c":)[^,]+', '$1"warm"')
    line = F.when(F.col("event_id") % 41 == 0, warm).otherwise(F.to_json(event))
    cut = F.when(F.col("event_id") % 37 == 0, F.substring(line, 1, 20)).otherwise(line)
    roles.table(spark, d, "events").select(cut.alias("value")).write.text(folder)
    return stream.file_source(spark, folder)


def _drain(spark, d, start):
    out, checkpoint = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-progress")
    start(_event_stream(spark, d), out, checkpoint, {"availableNow": True}).awaitTermination()
    return out


def stream_sink(spark, d):
    out = _drain(spark, d, stream.start_sink)
    landed = scan.with_partitions(schemas.STREAM_EVENT, schemas.DAY_PATH)
    return spark.read.schema(landed).parquet(out).select(schemas.STREAM_EVENT.names)


def stream_dead_letters(spark, d):
    out = _drain(spark, d, stream.start_dead_letters)
    return spark.read.schema("key string, value string").parquet(out).select("key", "value")


def _routed(spark, d):
    """Events and dead letters of one query over the source, a file at a time."""
    paths = [scratch_path(spark, name) for name in ("stream-out", "stream-dead", "stream-progress")]
    stream.start_router(_event_stream(spark, d), *paths, {"availableNow": True}).awaitTermination()
    return paths[:2]


def stream_routed(spark, d):
    out, dead = _routed(spark, d)
    landed = scan.with_partitions(schemas.STREAM_EVENT, schemas.DAY_PATH)
    events = spark.read.schema(landed).parquet(out).select(schemas.STREAM_EVENT.names)
    rejected = spark.read.schema("key string, value string").parquet(dead).select("key", "value")
    return events.unionByName(rejected, allowMissingColumns=True)


def stream_order(spark, d):
    """No event stands behind a later one of its city."""
    return stream.order_inversions(spark, _routed(spark, d)[0])


def scan_stream_table(spark, d):
    """The landed stream as a table of the catalog."""
    out = _drain(spark, d, stream.start_sink)
    name = "aerolith_" + out.rsplit("-", 1)[1]
    return scan.register_stream(spark, name, out).select(schemas.STREAM_EVENT.names)


def namespace_tables(spark, d):
    """A namespace of its own, made twice, with the city dimension as a table in it."""
    path = scratch_path(spark, "namespace")
    name = "aerolith_" + path.rsplit("-", 1)[1]
    for _ in range(2):
        sinks.ensure_namespace(spark, name, path)
    sinks.write_table(_dim(spark, d), f"{name}.dim_cities")
    return spark.table(f"{name}.dim_cities")


QUERIES = {
    "dedupe_latest": lambda s, d: D.weather_latest(_staged(s, d)),
    "union_sources": _staged,
    "union_stream": union_stream,
    "merge_hours": lambda s, d: merge.merge_hours(union_stream(s, d)),
    "fct_weather_stream": fct_weather_stream,
    "unit_normalise": unit_normalise,
    "surrogate_key": surrogate_key,
    "daily_rollup": lambda s, d: D.weather_daily_latest(_staged(s, d)),
    "batch_daily": _daily,
    "row_count": row_count,
    "air_daily_median": lambda s, d: D.air_daily(W.stage_air(roles.air(s, d))),
    "air_daily_deduped": lambda s, d: D.air_daily(W.stage_air(roles.air(s, d)), dedupe=True),
    "percentile_large_groups": percentile_large_groups,
    "pivot_pollutants": lambda s, d: D.pollutants_wide(_fct_air(s, d)),
    "dim_zone": lambda s, d: W.dim_cities(roles.supplier_cities(s, d)),
    "fct_weather": _fct_weather,
    "fct_air": _fct_air,
    "who_exceedance": who_exceedance,
    "stress_score": _fct_stress,
    "monthly_normals": lambda s, d: climate.monthly_normals(_daily(s, d)),
    "rolling_30d": lambda s, d: climate.rolling(_daily(s, d)),
    "heat_waves": lambda s, d: climate.heat_waves(_daily(s, d)),
    "heat_waves_calendar": lambda s, d: climate.heat_waves(_daily(s, d), 0.7, 2, calendar=True),
    "heat_episodes": lambda s, d: climate.heat_episodes(_daily(s, d), 0.8, 2),
    "heat_trend": lambda s, d: reports.heat_trend(_daily(s, d), 0.8, 2),
    "rank_exceedance": lambda s, d: reports.rank_exceedance(_fct_air(s, d)),
    "top_stress": lambda s, d: reports.top_stress(_fct_stress(s, d)),
    "corr_rain": corr_rain,
    "outliers_z": lambda s, d: reports.outliers(_fct_weather(s, d), "total_precipitation_mm", 2.0),
    "quality_report": quality_report,
    "unknown_cities": unknown_cities,
    "duplicate_keys": duplicate_keys,
    "missing_measures": missing_measures,
    "unknown_pollutants": unknown_pollutants,
    "humidity_out_of_range": humidity_out_of_range,
    "hourly_payload": hourly_payload,
    "station_payload": station_payload,
    "measurement_payload": measurement_payload,
    "month_windows": month_windows,
    "trailing_window": trailing_window,
    "target_day": target_day,
    "scan_nanos": scan_nanos,
    "scan_days": scan_days,
    "scan_external": scan_external,
    "seed_csv": seed_csv,
    "climate_job": climate_job,
    "sink_dynamic_overwrite": sink_dynamic_overwrite,
    "sink_land_rerun": sink_land_rerun,
    "sink_table_append": sink_table_append,
    "mart_slice": mart_slice,
    "mart_by_quarter": mart_by_quarter,
    "mart_by_zone": mart_by_zone,
    "refresh_facts": refresh_facts,
    "stress_bucketed": stress_bucketed,
    "scan_mixed": scan_mixed,
    "landing_rejects": landing_rejects,
    "stream_sink": stream_sink,
    "stream_dead_letters": stream_dead_letters,
    "stream_routed": stream_routed,
    "stream_order": stream_order,
    "scan_stream_table": scan_stream_table,
    "namespace_tables": namespace_tables,
}


def registered():
    def wrap(run):
        return lambda spark, sf_dir: portable(run(spark, sf_dir))

    return {name: wrap(run) for name, run in QUERIES.items()}


