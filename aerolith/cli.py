"""Command line: python -m aerolith <job> ...; every path is any folder Spark can reach."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from aerolith import schemas
from aerolith.plans import batch, incremental
from aerolith.plans.checks import Watch
from aerolith.session import build_session
from aerolith.sources import payloads, scan, sinks
from aerolith.streaming import sink


def climate(spark: SparkSession, args: argparse.Namespace) -> None:
    raw = scan.read_weather(spark, args.weather)
    print(batch.climate_job(spark, raw, args.out, args.namespace))


def warehouse(spark: SparkSession, args: argparse.Namespace) -> None:
    """Build the marts and check all models; failed checks of severity `error` fail the job."""
    hist, daily = scan.read_weather(spark, args.weather), scan.read_weather(spark, args.weather_daily)
    air = scan.read_partitioned(spark, args.air, schemas.AIR_RAW, schemas.DAY_PATH)
    cities = scan.read_cities(spark, args.cities)
    stream = _landed_stream(spark, args.stream) if args.stream else None
    watch = Watch()
    marts = batch.build_warehouse(
        spark, hist, daily, air, cities, args.out, stream, args.dedupe_air, watch
    )
    report = batch.check_warehouse(hist, daily, air, cities, marts, stream, watch)
    # One line per check, so a few dozen at most.
    failed = report.filter("failures > 0").collect()
    for row in failed:
        print(f"{row.severity}: {row.model}.{row['column']} {row.test}: {row.failures}")
    if any(row.severity == "error" for row in failed):
        raise SystemExit(1)


def refresh(spark: SparkSession, args: argparse.Namespace) -> None:
    """Bring stored marts up to date with one landing: a folder of hours, of readings, or both."""
    air = lambda path: scan.read_partitioned(spark, path, schemas.AIR_RAW, schemas.DAY_PATH)
    print(incremental.refresh_warehouse(
        spark, scan.read_weather(spark, args.weather), scan.read_weather(spark, args.weather_daily),
        air(args.air), args.out,
        scan.read_weather(spark, args.landed_weather) if args.landed_weather else None,
        air(args.landed_air) if args.landed_air else None,
        _landed_stream(spark, args.stream) if args.stream else None, args.dedupe_air,
    ))


def land_weather(spark: SparkSession, args: argparse.Namespace) -> None:
    """Hourly documents below city_id=... to the backfill layout, or one day to the daily layout."""
    cities = scan.read_cities(spark, args.cities)
    rows = payloads.hourly_rows(payloads.read_payloads(spark, args.documents), cities)
    if args.day:
        dated = rows.withColumn("observation_date", F.to_date("observation_ts"))
        day = scan.target_day(dated, args.day).drop("observation_date")
        sinks.land_day(day, args.out, args.day)
    else:
        at = F.col("observation_ts")
        parted = rows.withColumns({"year": F.year(at), "month": F.month(at)})
        sinks.write_parquet(parted, args.out, schemas.CITY_MONTH_PATH.names, ["observation_ts"])


def land_air(spark: SparkSession, args: argparse.Namespace) -> None:
    """Station and measurement documents to one landing that holds the trailing days."""
    cities = scan.read_cities(spark, args.cities)
    sensors = payloads.sensors(payloads.read_payloads(spark, args.stations))
    documents = payloads.read_payloads(spark, args.documents)
    rows = payloads.measurements(documents, sensors, cities)
    dated = rows.withColumn("day_", F.col("observation_date").try_cast("date"))
    window = scan.trailing_window(dated, args.day, args.days, on="day_")
    # Readings without a date land too, for the check that reports them.
    landed = window.unionByName(dated.filter(F.col("day_").isNull())).drop("day_")
    sinks.land_day(landed, args.out, args.day)


def stream(spark: SparkSession, args: argparse.Namespace) -> None:
    """Run the sink, with a folder for dead letters if asked for, until stopped."""
    if args.servers:
        source = sink.kafka_source(
            spark, args.servers, args.topic, args.batch_rows, args.batch_seconds, args.max_rows
        )
        # A source that waits for full batches has its own time limit: ask it every second.
        seconds = 1 if args.batch_rows else args.batch_seconds
        trigger = {"processingTime": f"{seconds} seconds"}
    else:
        source, trigger = sink.file_source(spark, args.folder), None
    if args.once:
        trigger = {"availableNow": True}
    if args.dead_letters:
        query = sink.start_router(source, args.out, args.dead_letters, args.checkpoint, trigger)
    else:
        query = sink.start_sink(source, args.out, f"{args.checkpoint}/events", trigger)
    query.awaitTermination()


def register(spark: SparkSession, args: argparse.Namespace) -> None:
    """Define the four external tables over the landed folders."""
    sinks.ensure_namespace(spark, args.namespace)
    layouts = {
        "ext_weather_hourly": ("raw/weather", schemas.weather_raw(), schemas.CITY_MONTH_PATH),
        "ext_weather_daily": ("raw/weather_daily", schemas.weather_raw(), schemas.DAY_PATH),
        "ext_air_quality": ("raw/air_quality", schemas.AIR_RAW, schemas.DAY_PATH),
        "ext_weather_streaming": ("streaming/weather", schemas.STREAM_LANDED, schemas.DAY_PATH),
    }
    for name, (folder, schema, path_columns) in layouts.items():
        where = f"{args.root.rstrip('/')}/{folder}"
        if scan.is_sink_output(spark, where):
            scan.register_stream(spark, f"{args.namespace}.{name}", where)
        else:
            scan.register_external(spark, f"{args.namespace}.{name}", where, schema, path_columns)


def _landed_stream(spark: SparkSession, path: str) -> DataFrame:
    return scan.read_partitioned(spark, path, schemas.STREAM_LANDED, schemas.DAY_PATH)


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="aerolith", description=__doc__)
    jobs = root.add_subparsers(required=True)

    def job(run, *required: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(run.__name__.replace("_", "-"), help=run.__doc__)
        for name in required:
            sub.add_argument(f"--{name}", required=True)
        sub.add_argument("--scratch", help="shared folder for intermediate tables")
        sub.set_defaults(run=run)
        return sub

    sub = job(climate, "weather", "out")
    sub.add_argument("--namespace", help="also register the results as tables here")

    sub = job(warehouse, "weather", "weather-daily", "air", "out")
    sub.add_argument("--stream", help="landed stream events, a third weather feed")
    sub.add_argument("--cities", help="seed CSV; default: the built-in eight cities")
    sub.add_argument("--dedupe-air", action="store_true")

    sub = job(refresh, "weather", "weather-daily", "air", "out")
    sub.add_argument("--landed-weather", help="the landed hours, also part of the feeds")
    sub.add_argument("--landed-air", help="the landed readings, also part of the feed")
    sub.add_argument("--stream", help="landed stream events, as the marts were built with")
    sub.add_argument("--dedupe-air", action="store_true")

    sub = job(land_weather, "documents", "out")
    sub.add_argument("--day", type=date.fromisoformat)
    sub.add_argument("--cities")

    sub = job(land_air, "stations", "documents", "out")
    sub.add_argument("--day", type=date.fromisoformat, required=True)
    sub.add_argument("--days", type=int, default=7)
    sub.add_argument("--cities")

    sub = job(stream, "out", "checkpoint")
    source = sub.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="Kafka bootstrap servers")
    source.add_argument("--folder", help="folder that JSON lines are dropped into")
    sub.add_argument("--topic", default="weather.sensor.readings")
    sub.add_argument("--batch-rows", type=int, help="wait for so many rows")
    sub.add_argument("--batch-seconds", type=int, default=30)
    sub.add_argument("--max-rows", type=int, help="at most so many rows a batch")
    sub.add_argument("--dead-letters", help="folder for events that cannot be used")
    sub.add_argument("--once", action="store_true", help="drain what is there, then end")

    job(register, "root", "namespace")
    return root


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    conf = {"spark__checkpoint__dir": args.scratch} if args.scratch else {}
    args.run(build_session(**conf), args)


if __name__ == "__main__":
    main()
