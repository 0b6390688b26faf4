"""Data checks, and the stream sink with restarts."""

import json
import os

from aerolith import cli, schemas
from aerolith.operators import quality as Q
from aerolith.plans import batch
from aerolith.plans.checks import CHECKS, Watch, check_models
from aerolith.sources import scan
from aerolith.streaming import sink
from workload import roles

ONCE = {"availableNow": True}


def test_every_kind_of_check(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 99.0), ("b", None), (None, -1.0), ("z", 2.0), ("z", 2.5)], "k string, v double"
    )
    known = spark.createDataFrame([("a",), ("b",)], "k string")
    checks = [
        Q.not_null("k"), Q.not_null("v", "warn"), Q.unique("k"), Q.relationship("k", "known"),
        Q.accepted_values("k", ["a", "z"]), Q.accepted_range("v", 0, 50, "warn"),
        Q.accepted_range("v", None, 98),
    ]
    report = Q.run_checks("m", df, checks, {"known": known})
    assert report.columns == ["model", "column", "test", "severity", "failures"]
    got = [(r["column"], r.test, r.severity, r.failures) for r in report.collect()]
    assert sorted(got) == sorted([
        ("k", "not_null", "error", 1), ("v", "not_null", "warn", 1), ("k", "unique", "error", 2),
        ("k", "relationships", "error", 2), ("k", "accepted_values", "error", 1),
        ("v", "accepted_range", "warn", 2), ("v", "accepted_range", "error", 1),
    ])
    assert [tuple(r) for r in Q.failing(df, checks[3], {"known": known}).collect()] == [("z", 2)]
    assert Q.failing(df, checks[0]).count() == 1
    assert sorted(r.k for r in Q.failing(df, checks[2]).collect()) == ["a", "z"]


def test_empty_table_passes(spark):
    df = spark.createDataFrame([], "k string, v double")
    checks = [Q.not_null("k"), Q.unique("k"), Q.relationship("k", "known")]
    report = Q.run_checks("m", df, checks, {"known": df})
    assert [r.failures for r in report.collect()] == [0, 0, 0]


def test_row_checks_share_one_pass(spark, path):
    spark.range(5).selectExpr("string(id) city_id", "id observation_ts").write.parquet(path("t"))
    report = Q.run_checks("raw_weather", spark.read.parquet(path("t")), CHECKS["raw_weather"])
    assert report._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def write_events(path, name, *lines):
    with open(path("in") + "/" + name, "w") as f:
        f.writelines(line + "\n" for line in lines)


def event(i, city="BOG"):
    return json.dumps({"event_id": f"e{i}", "city_id": city, "temperature_c": 20 + i, "extra": 1})


def landed(spark, path, name="out"):
    return spark.read.parquet(path(name)).collect()


def test_restart_neither_loses_nor_repeats(spark, path, tmp_path):
    (tmp_path / "in").mkdir()

    def drain():
        source = sink.file_source(spark, path("in"), files_per_batch=1)
        sink.start_sink(source, path("out"), path("progress"), ONCE).awaitTermination()

    write_events(path, "1.json", event(1), event(2))
    write_events(path, "2.json", event(3))
    drain()
    assert sorted(r.event_id for r in landed(spark, path)) == ["e1", "e2", "e3"]
    drain()
    write_events(path, "3.json", event(4), event(4))
    drain()
    rows = landed(spark, path)
    assert sorted(r.event_id for r in rows) == ["e1", "e2", "e3", "e4", "e4"]
    assert set(schemas.STREAM_LANDED.names) | {"year", "month", "day"} == set(rows[0].asDict())
    assert all((r.consumed_at.year, r.consumed_at.month, r.consumed_at.day) == (r.year, r.month, r.day) for r in rows)


def test_unusable_events_are_kept_apart(spark, path, tmp_path):
    (tmp_path / "in").mkdir()
    broken = ["not json", event(1)[:25], event(2, city=None), "[]", '{"city_id": "BOG", "temperature_c": "warm"}']
    write_events(path, "1.json", event(3), *broken)
    job = ["stream", "--folder", path("in"), "--out", path("out"), "--checkpoint", path("progress"),
           "--dead-letters", path("dead"), "--once"]
    args = cli.parser().parse_args(job)
    args.run(spark, args)
    good, dead = landed(spark, path), landed(spark, path, "dead")
    assert {r.event_id for r in good if r.event_id} == {"e3"}
    assert len(good) + len(dead) == 6
    assert {r.value for r in dead} == set(broken)
    assert all(r.rejected_at is not None for r in dead)


def forget(path, folder, batch):
    """As if the query had ended before it noted the batch as done."""
    for name in (f"{batch}", f".{batch}.crc"):
        os.remove(f"{path('progress')}/{folder}/{name}")


def test_a_batch_that_runs_again_replaces_itself(spark, path, tmp_path):
    (tmp_path / "in").mkdir()

    def drain():
        source = sink.file_source(spark, path("in"), files_per_batch=1)
        sink.start_router(source, path("out"), path("dead"), path("progress"), ONCE).awaitTermination()

    write_events(path, "1.json", event(1), event(2), "not json")
    write_events(path, "2.json", event(3), "{")
    drain()
    before = sorted(map(str, landed(spark, path)))
    dead = sorted(map(str, landed(spark, path, "dead")))
    assert len(before) == 3 and len(dead) == 2
    forget(path, "commits", 1)
    drain()
    # The same rows with the same landing times, in the same folders.
    assert sorted(map(str, landed(spark, path))) == before
    assert sorted(map(str, landed(spark, path, "dead"))) == dead
    write_events(path, "3.json", event(4))
    drain()
    assert sorted(r.event_id for r in landed(spark, path)) == ["e1", "e2", "e3", "e4"]


def test_events_of_a_city_stay_in_order(spark, path, tmp_path):
    (tmp_path / "in").mkdir()
    cities = ["BOG", "MDE", "CLO"]
    lines = [
        json.dumps({"event_id": str(i), "city_id": cities[i % 3], "observed_ts": f"2024-03-05T{(i * 7) % 24:02}:{i % 60:02}"})
        for i in range(600)
    ]
    for part in range(6):
        write_events(path, f"{part}.json", *lines[part::6])
    source = sink.file_source(spark, path("in"))
    sink.start_router(source, path("out"), path("dead"), path("progress"), ONCE).awaitTermination()
    found = {r.city_id: (r.events, r.inversions) for r in sink.order_inversions(spark, path("out")).collect()}
    assert found == {city: (200, 0) for city in cities}
    # A folder without that order shows it.
    spark.read.json(path("in")).orderBy("event_id").coalesce(1).write.parquet(path("loose"))
    assert sum(r.inversions for r in sink.order_inversions(spark, path("loose")).collect()) > 0


def test_checks_counted_on_the_way(spark, path):
    sf_dir = "/root/testdata/sf0.001"
    feeds, air = roles.weather_feeds(spark, sf_dir), roles.air(spark, sf_dir)
    cities = roles.cities(spark, sf_dir)
    watch = Watch()
    marts = batch.build_warehouse(spark, *feeds, air, cities, path("a"), watch=watch)
    with_watch = batch.check_warehouse(*feeds, air, cities, marts, watch=watch)
    without = batch.check_warehouse(*feeds, air, cities, marts)
    assert sorted(map(tuple, with_watch.collect())) == sorted(map(tuple, without.collect()))
    # What was counted needs no reading of the models: only keys and cities are looked at again.
    plan = with_watch._jdf.queryExecution().executedPlan().toString()
    assert "l_quantity" not in plan and "avg_temperature_c" not in plan


def test_watch_of_an_empty_frame(spark, path):
    watch, cities = Watch(), scan.read_cities(spark)
    watch.over("raw_weather", spark.createDataFrame([], "city_id string, observation_ts timestamp")).write.parquet(path("none"))
    lines = check_models({}, cities, watch).collect()
    assert [(r["column"], r.failures) for r in lines] == [("city_id", 0), ("observation_ts", 0)]
