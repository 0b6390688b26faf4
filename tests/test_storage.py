"""Scans, landed JSON, sinks and the batch jobs, through real files."""

import glob
import json
import os
from datetime import date, datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from aerolith import cli, fixed, schemas
from aerolith.sources import payloads, scan, sinks
from pyspark.sql import functions as F
from test_models import air, air_row, weather, weather_row


def test_nanosecond_files_with_the_city_in_path_and_file(spark, path):
    folder = path("weather") + "/city_id=007/year=2024/month=03"
    os.makedirs(folder)
    at = pa.array([1_709_622_000_123_456_789], pa.timestamp("ns"))
    pq.write_table(
        pa.table({"city_id": ["other"], "temperature_2m": [1.5], "observation_ts": at, "ingested_at": at}),
        folder + "/data.parquet",
    )
    row = scan.read_weather(spark, path("weather")).first()
    assert (row.city_id, row.year, row.month) == ("007", 2024, 3)
    assert row.observation_ts == row.ingested_at == datetime(2024, 3, 5, 7, 0, 0, 123456)


def write_times(folder, unit, more=()):
    os.makedirs(folder)
    at = pa.array([datetime(2024, 3, 5, 7)], pa.timestamp(unit))
    columns = {"temperature_2m": [1.5], "observation_ts": at, "ingested_at": at, **dict(more)}
    pq.write_table(pa.table(columns), folder + "/data.parquet")


@pytest.mark.parametrize("units", [("ns", "us"), ("us", "ns"), ("us", "ns", "ns", "us", "ns"), ("ms", "us", "ns")])
def test_mixed_precision_in_one_folder_is_read_right(spark, path, units):
    for month, unit in enumerate(units, 1):
        more = [("rain", [2.0])] if month == 1 else []
        write_times(path("mixed") + f"/city_id=007/year=2024/month={month:02}", unit, more)
    rows = scan.read_weather(spark, path("mixed")).collect()
    assert sorted(r.month for r in rows) == list(range(1, len(units) + 1))
    assert {(r.city_id, r.observation_ts, r.ingested_at) for r in rows} == {("007", *[datetime(2024, 3, 5, 7)] * 2)}
    assert [r.rain for r in rows if r.month == 1] == [2.0]


def test_other_conflicts_still_stop_the_read(spark, path):
    write_times(path("odd") + "/city_id=BOG/year=2024/month=01", "us", [("rain", [2.0])])
    write_times(path("odd") + "/city_id=BOG/year=2024/month=02", "us", [("rain", ["wet"])])
    with pytest.raises(Exception):
        scan.read_weather(spark, path("odd")).collect()


@pytest.mark.parametrize("unit", ["ns", "us"])
def test_one_precision_and_columns_of_any_file(spark, path, unit):
    write_times(path("even") + "/city_id=BOG/year=2024/month=01", unit)
    write_times(path("even") + "/city_id=BOG/year=2024/month=02", unit, [("rain", [2.0])])
    rows = scan.read_weather(spark, path("even")).collect()
    assert {(r.observation_ts, r.rain) for r in rows} == {(datetime(2024, 3, 5, 7), x) for x in (None, 2.0)}


def test_external_table_prunes_folders(spark, path):
    rows = [air_row(1.0, day="2024-03-05"), air_row(2.0, day="2024-03-06")]
    for row in rows:
        sinks.land_day(air(spark, row), path("air"), row[7])
    sinks.ensure_namespace(spark, "raw")
    sinks.ensure_namespace(spark, "raw")
    for _ in range(2):
        table = scan.register_external(spark, "raw.air", path("air"), schemas.AIR_RAW, schemas.DAY_PATH)
    assert [(r.value, r.day) for r in table.filter("day = 6").collect()] == [(2.0, 6)]
    plan = table.filter("day = 6")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    spark.sql("DROP DATABASE raw CASCADE")


def test_city_seed_from_csv_or_built_in(spark, path):
    with open(path("cities.csv"), "w") as f:
        f.write("city_id,name,department,latitude,longitude,elevation_m,population,timezone\n")
        f.write("BOG,Bogota,Cundinamarca,4.711,-74.0721,2640,7743955,America/Bogota\n")
    from_csv, built_in = scan.read_cities(spark, path("cities.csv")), scan.read_cities(spark)
    assert from_csv.schema == built_in.schema == schemas.CITIES
    assert from_csv.first() == built_in.filter("city_id = 'BOG'").first()
    assert built_in.count() == len(fixed.CITIES)


def test_hourly_documents(spark):
    documents = [
        {"hourly": {"time": ["2024-03-05T00:00", "2024-03-05T01:00"], "rain": [0.5, None]}},
        {"hourly": {"rain": [1.0]}},
        {"error": True},
        {"hourly": {"time": ["2024-03-05T02:00"], "temperature_2m": [14]}},
    ]
    df = spark.createDataFrame([("BOG", json.dumps(d)) for d in documents], "city_id string, payload string")
    rows = payloads.hourly_rows(df, scan.read_cities(spark))
    assert rows.columns == schemas.weather_raw().names
    got = {r.observation_ts.hour: r for r in rows.collect()}
    assert set(got) == {0, 1, 2}
    assert (got[0].rain, got[1].rain, got[2].temperature_2m, got[2].rain) == (0.5, None, 14.0, None)
    assert got[0].city_name == "Bogota" and got[0].ingested_at is not None


def test_each_document_is_parsed_once(spark):
    df = spark.createDataFrame([("BOG", 1, "{}")], "city_id string, sensor_id bigint, payload string")
    cities = scan.read_cities(spark)
    sensors = spark.createDataFrame([], payloads.sensors(df).schema)
    for frame in (payloads.hourly_rows(df, cities), payloads.measurements(df, sensors, cities)):
        assert frame._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1


def test_documents_told_apart_are_built_and_parsed_once(spark):
    hourly = F.struct(F.when(F.col("id") > 0, F.array(F.lit("2024-03-05T07:00"))).alias("time"))
    built = F.when(F.col("id") == 2, F.lit("{")).otherwise(F.to_json(F.struct(hourly.alias("hourly"))))
    docs = spark.range(3).select(F.lit("BOG").alias("city_id"), built.alias("payload"), "id")
    good, bad = payloads.told_apart(docs, "hourly.time")
    for frame in (good, bad):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "parseJson" not in plan and "StructsToJson" not in plan
    assert [r.id for r in good.collect()] == [1]
    assert sorted((r.id, r.reason) for r in bad.collect()) == [(0, "no hourly.time"), (2, "not JSON")]


def test_station_and_measurement_documents(spark):
    station = {"results": [
        {"id": 1, "name": "Centro", "sensors": [
            {"id": 11, "parameter": {"name": "pm25", "units": "µg/m³"}},
            {"id": 12, "parameter": {"name": "humidity", "units": "%"}},
            {"id": 13},
        ]},
        {"id": 2, "name": "Norte", "sensors": []},
    ]}
    found = payloads.sensors(
        spark.createDataFrame([("BOG", json.dumps(station))], "city_id string, payload string")
    )
    assert [tuple(r) for r in found.collect()] == [("BOG", 1, "Centro", 11, "pm25", "µg/m³")]
    results = {"results": [
        {"value": 7.5, "period": {"datetimeFrom": {"utc": "2024-03-05T05:00:00Z"}},
         "summary": {"min": 1.0, "max": 9.0, "avg": 7.5}, "coverage": {"observedCount": 24}},
        {"value": None, "period": None},
        {"value": 1, "period": {"datetimeFrom": {"utc": ""}}},
    ]}
    rows = payloads.measurements(
        spark.createDataFrame(
            [("BOG", 11, json.dumps(results)), ("BOG", 99, json.dumps(results))],
            "city_id string, sensor_id bigint, payload string",
        ),
        found, scan.read_cities(spark),
    )
    got = rows.drop("ingested_at").collect()
    assert {(r.observation_date, r.value, r.max_value, r.measurement_count) for r in got} == {
        ("2024-03-05", 7.5, 9.0, 24), (None, None, None, None), (None, 1.0, None, None),
    }
    # A sensor that is not listed stays, for the checks to report.
    assert {(r.sensor_id, r.city_name, r.parameter_name) for r in got} == {
        (11, "Bogota", "pm25"), (99, "Bogota", None),
    }
    twice = found.withColumn("ingested_at", F.lit("2024-01-01").cast("timestamp"))
    later = twice.withColumns({"location_name": F.lit("Sur"), "ingested_at": F.lit("2024-02-01").cast("timestamp")})
    readings = spark.createDataFrame(
        [("BOG", 11, json.dumps(results)), ("XXX", 11, json.dumps(results))],
        "city_id string, sensor_id bigint, payload string",
    )
    got = payloads.measurements(readings, twice.unionByName(later), scan.read_cities(spark)).collect()
    assert len(got) == 6 and {(r.city_id, r.location_name) for r in got} == {("BOG", "Sur"), ("XXX", None)}


def test_document_folders_keep_the_city_text(spark, path):
    os.makedirs(path("d") + "/city_id=007/sensor_id=11")
    with open(path("d") + "/city_id=007/sensor_id=11/a.json", "w") as f:
        f.write('{\n"results": []\n}\n')
    rows = payloads.read_payloads(spark, path("d")).collect()
    assert [(r.city_id, r.sensor_id, json.loads(r.payload)) for r in rows] == [("007", 11, {"results": []})]


def test_date_ranges(spark):
    spans = spark.createDataFrame(
        [(date(2023, 11, 20), date(2024, 1, 10)), (date(2024, 2, 2), date(2024, 2, 3)),
         (date(2024, 3, 2), date(2024, 3, 1))], "a date, b date",
    )
    windows = scan.month_windows(spans, "a", "b").select("window_start", "window_end").collect()
    assert [(str(w[0]), str(w[1])) for w in windows] == [
        ("2023-11-20", "2023-11-30"), ("2023-12-01", "2023-12-31"), ("2024-01-01", "2024-01-10"),
        ("2024-02-02", "2024-02-03"),
    ]
    days = spark.range(40).select(F.date_add(F.lit("2024-03-01").cast("date"), F.col("id").cast("int")).alias("observation_date"))
    assert scan.trailing_window(days, "2024-03-15").count() == 8
    assert scan.target_day(days, "2024-03-15").count() == 1
    recent = spark.range(10).select(F.date_sub(F.current_date(), F.col("id").cast("int")).alias("observation_date"))
    assert scan.target_day(recent).count() == 1
    assert scan.trailing_window(recent).count() == 8


def test_landing_again_replaces_and_empty_is_refused(spark, path):
    df = air(spark, air_row(1.0))
    sinks.land_day(df, path("air"), "2024-03-05")
    sinks.land_day(df, path("air"), "2024-03-06")
    sinks.land_day(air(spark, air_row(5.0)), path("air"), "2024-03-06")
    got = {(r.day, r.value) for r in spark.read.parquet(path("air")).collect()}
    assert got == {(5, 1.0), (6, 5.0)}
    with pytest.raises(ValueError):
        sinks.land_day(df.limit(0), path("air"), "2024-03-06")
    assert spark.read.parquet(path("air")).count() == 2


def test_mart_is_split_by_month_and_pruned_by_dates(spark, path):
    days = [date(2023, 12, 30), date(2024, 1, 5), date(2024, 2, 1)]
    df = spark.createDataFrame([("BOG", d) for d in days] * 3, "city_id string, observation_date date")
    sinks.write_mart(df, path("mart"))
    folders = sorted(os.path.relpath(f, path("mart")) for f in glob.glob(path("mart") + "/*/*"))
    assert folders == [
        f"observation_year={d.year}/observation_month={d.month}" for d in days
    ]
    assert all(len(glob.glob(f"{path('mart')}/{f}/*.snappy.parquet")) == 1 for f in folders)
    cut = scan.between_dates(spark.read.parquet(path("mart")), "2024-01-01", "2024-01-31")
    assert [r.observation_date for r in cut.collect()] == [days[1]] * 3
    assert len(cut.inputFiles()) == 3
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(observation_year" in plan and "PushedFilters: [IsNotNull(observation_date)" in plan


def test_table_sink_overwrites_and_appends(spark, path):
    df = spark.createDataFrame([("BOG", date(2024, 3, 5))], "city_id string, observation_date date")
    options = {"partition_by": ["observation_date"], "cluster_by": ["city_id"], "path": path("t")}
    sinks.write_table(df, "sink_table", **options)
    sinks.write_table(df, "sink_table", **options)
    assert spark.table("sink_table").count() == 1
    sinks.write_table(df, "sink_table", mode="append", **options)
    assert spark.table("sink_table").count() == 2
    spark.sql("DROP TABLE sink_table")


def land_inputs(spark, path):
    hours = [
        weather_row(c, datetime(2024, m, d, h), name=c, temperature_2m=10.0 + d, apparent_temperature=30.0)
        for c in ("BOG", "CLO") for m in (1, 2) for d in (1, 2) for h in (0, 12)
    ]
    hist = weather(spark, *hours)
    at = F.col("observation_ts")
    sinks.write_parquet(
        hist.withColumns({"year": F.year(at), "month": F.month(at)}), path("hist"),
        schemas.CITY_MONTH_PATH.names,
    )
    late = weather_row("BOG", datetime(2024, 2, 2), datetime(2024, 4, 1), "BOG", temperature_2m=30.0)
    sinks.land_day(weather(spark, late), path("day"), "2024-02-02")
    sinks.land_day(air(spark, air_row(20.0, day="2024-02-02")), path("air"), "2024-02-03")


def test_warehouse_job(spark, path):
    land_inputs(spark, path)
    job = ["warehouse", "--weather", path("hist"), "--weather-daily", path("day"), "--air", path("air"), "--out", path("dw")]
    args = cli.parser().parse_args(job)
    for _ in range(2):
        args.run(spark, args)
    stress = spark.read.parquet(path("dw") + "/fct_environmental_stress").collect()
    assert len(stress) == 8
    day = next(r for r in stress if r.city_id == "BOG" and str(r.observation_date) == "2024-02-02")
    assert (day.max_temperature_c, day.pm25, day.pollutants_measured) == (30.0, 20.0, 1)
    assert day.environmental_stress_score == pytest.approx(30.0)
    assert spark.read.parquet(path("dw") + "/dim_cities").count() == 8


def test_refresh_job(spark, path):
    land_inputs(spark, path)
    feeds = ["--weather", path("hist"), "--weather-daily", path("day"), "--air", path("air"), "--out", path("dw")]
    args = cli.parser().parse_args(["warehouse", *feeds])
    args.run(spark, args)
    late = weather_row("BOG", datetime(2024, 2, 3, 12), datetime(2024, 4, 2), "BOG", temperature_2m=31.0)
    sinks.land_day(weather(spark, late), path("day"), "2024-02-03")
    args = cli.parser().parse_args(["refresh", *feeds, "--landed-weather", path("day") + "/year=2024/month=2/day=3"])
    args.run(spark, args)
    days = spark.read.parquet(path("dw") + "/fct_weather_daily").filter("city_id = 'BOG' AND observation_month = 2").collect()
    assert {r.observation_date.day: r.max_temperature_c for r in days} == {1: 11.0, 2: 30.0, 3: 31.0}


def test_warehouse_job_with_live_events(spark, path):
    land_inputs(spark, path)
    os.makedirs(path("in"))
    with open(path("in") + "/1.json", "w") as f:
        event = {"event_id": "e", "city_id": "BOG", "city_name": "BOG", "temperature_c": 44.0,
                 "observed_ts": "2024-02-02T12:00"}
        f.write(json.dumps(event) + "\n")
    stream = ["stream", "--folder", path("in"), "--out", path("live"), "--checkpoint", path("p"), "--once"]
    job = ["warehouse", "--weather", path("hist"), "--weather-daily", path("day"), "--air", path("air"),
           "--stream", path("live"), "--out", path("dw")]
    for line in (stream, job):
        args = cli.parser().parse_args(line)
        args.run(spark, args)
    days = spark.read.parquet(path("dw") + "/fct_weather_daily").collect()
    day = next(r for r in days if r.city_id == "BOG" and str(r.observation_date) == "2024-02-02")
    # The pulled noon row has a temperature: the event neither replaces it nor adds an hour.
    assert (day.hour_count, day.max_temperature_c) == (2, 30.0)


def test_warehouse_job_fails_on_an_error_check(spark, path):
    land_inputs(spark, path)
    sinks.land_day(air(spark, air_row(1.0, city="XXX")), path("air"), "2024-02-04")
    args = cli.parser().parse_args(
        ["warehouse", "--weather", path("hist"), "--weather-daily", path("day"), "--air", path("air"), "--out", path("dw")]
    )
    with pytest.raises(SystemExit):
        args.run(spark, args)


def test_climate_job(spark, path):
    land_inputs(spark, path)
    args = cli.parser().parse_args(
        ["climate", "--weather", path("hist"), "--out", path("out"), "--namespace", "reporting"]
    )
    for _ in range(2):
        args.run(spark, args)
    assert spark.table("reporting.weather_monthly_normals").count() == 4
    assert spark.read.parquet(path("out") + "/rolling_30d").count() == 8
    assert sorted(os.listdir(path("out") + "/heat_waves"))[-2:] == ["city_id=BOG", "city_id=CLO"]
    spark.sql("DROP DATABASE reporting CASCADE")


def test_land_jobs(spark, path):
    def write(name, document):
        os.makedirs(os.path.dirname(path(name)), exist_ok=True)
        with open(path(name), "w") as f:
            json.dump(document, f, indent=1)

    write("w/city_id=BOG/a.json", {"hourly": {"time": ["2024-03-05T00:00", "2024-04-01T00:00"], "rain": [1, 2]}})
    write("s/city_id=BOG/a.json", {"results": [{"id": 1, "name": "C", "sensors": [{"id": 11, "parameter": {"name": "co", "units": "ppm"}}]}]})
    write("m/city_id=BOG/sensor_id=11/a.json", {"results": [
        {"value": v, "period": {"datetimeFrom": {"utc": f"2024-03-{d:02d}T05:00:00Z"}}} for v, d in ((1, 1), (2, 5))]})
    for job in (
        ["land-weather", "--documents", path("w"), "--out", path("hist")],
        ["land-weather", "--documents", path("w"), "--out", path("day"), "--day", "2024-03-05"],
        ["land-air", "--stations", path("s"), "--documents", path("m"), "--out", path("air"), "--day", "2024-03-05", "--days", "3"],
    ):
        args = cli.parser().parse_args(job)
        args.run(spark, args)
    hist = scan.read_weather(spark, path("hist"))
    assert {(r.city_id, r.year, r.month, r.rain) for r in hist.collect()} == {("BOG", 2024, 3, 1.0), ("BOG", 2024, 4, 2.0)}
    assert [r.rain for r in scan.read_weather(spark, path("day")).collect()] == [1.0]
    landed = scan.read_partitioned(spark, path("air"), schemas.AIR_RAW, schemas.DAY_PATH).collect()
    assert [(r.sensor_id, r.value, r.observation_date, r.day) for r in landed] == [(11, 2.0, "2024-03-05", 5)]


def test_register_job(spark, path):
    land_inputs(spark, path)
    os.makedirs(path("raw") + "/streaming/weather")
    os.makedirs(path("raw") + "/raw")
    for source, name in (("hist", "weather"), ("day", "weather_daily"), ("air", "air_quality")):
        os.symlink(path(source), f"{path('raw')}/raw/{name}")
    args = cli.parser().parse_args(["register", "--root", path("raw"), "--namespace", "ext"])
    args.run(spark, args)
    counts = [spark.table(f"ext.ext_{n}").count() for n in
              ("weather_hourly", "weather_daily", "air_quality", "weather_streaming")]
    assert counts == [16, 1, 1, 0]
    spark.sql("DROP DATABASE ext CASCADE")


def test_register_job_over_stream_output(spark, path):
    """Committed events are seen, a file that no batch has committed is not."""
    os.makedirs(path("in"))
    for n in (1, 2):
        with open(path("in") + f"/{n}.json", "w") as f:
            f.write(json.dumps({"event_id": f"e{n}", "city_id": "BOG", "temperature_c": 9.5}))
        out = path("root") + "/streaming/weather"
        job = ["stream", "--folder", path("in"), "--out", out, "--checkpoint", path("progress"), "--once"]
        args = cli.parser().parse_args(job)
        args.run(spark, args)
        args = cli.parser().parse_args(["register", "--root", path("root"), "--namespace", "live"])
        for name in ("weather", "weather_daily", "air_quality"):
            os.makedirs(f"{path('root')}/raw/{name}", exist_ok=True)
        args.run(spark, args)
        assert spark.table("live.ext_weather_streaming").count() == n
    stray = glob.glob(out + "/year=*/month=*/day=*/*.parquet")[0]
    with open(stray, "rb") as f, open(stray.replace("part-", "stray-"), "wb") as g:
        g.write(f.read())
    seen = spark.table("live.ext_weather_streaming")
    assert sorted(r.event_id for r in seen.collect()) == ["e1", "e2"]
    assert {"consumed_at", "year", "month", "day"} <= set(seen.columns)
    spark.sql("DROP DATABASE live CASCADE")
