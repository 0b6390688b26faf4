"""Hours merged measure by measure, and the mart with live events."""

from datetime import date, datetime

from aerolith import schemas
from aerolith.operators.merge import merge_hours
from aerolith.plans import warehouse as W
from aerolith.sources import scan
from test_models import weather, weather_row

DAY = date(2024, 3, 5)


def events(spark, *rows):
    empty = dict.fromkeys(schemas.STREAM_LANDED.names)
    made = [tuple((empty | {"city_id": "BOG", "city_name": "Bogota"} | row).values()) for row in rows]
    return spark.createDataFrame(made, schemas.STREAM_LANDED)


def full_day(**more):
    return [
        weather_row(ts=datetime(2024, 3, 5, h), temperature_2m=float(h), precipitation=1.0, rain=1.0,
                    ingested=datetime(2024, 3, 6), **more)
        for h in range(24)
    ]


def test_live_events_in_a_full_day_change_nothing_it_has(spark):
    live = events(
        spark,
        {"observed_ts": "2024-03-05T07:15", "temperature_c": 99.0, "precipitation_mm": 50.0, "consumed_at": datetime(2024, 4, 1)},
        {"observed_ts": "2024-03-05T07:40", "temperature_c": -99.0, "wind_gusts_kmh": 44.0, "consumed_at": datetime(2024, 4, 1)},
    )
    dim = W.dim_cities(scan.read_cities(spark))
    mart = W.weather_mart(weather(spark, *full_day()), weather(spark), dim, live).collect()
    assert len(mart) == 1
    day = mart[0]
    assert (day.hour_count, day.is_complete_day, day.total_rain_mm, day.total_precipitation_mm) == (24, True, 24.0, 24.0)
    assert (day.min_temperature_c, day.max_temperature_c) == (0.0, 23.0)
    # The pulled feed has no gusts: the live value fills them.
    assert day.max_wind_gusts_kmh == 44.0 and day.is_windy_day
    assert day.last_ingested_at == datetime(2024, 4, 1)


def test_live_events_fill_missing_hours(spark):
    hours = [r for r in full_day() if r[-2].hour != 12]
    live = events(
        spark,
        {"observed_ts": "2024-03-05T12:05", "temperature_c": 30.0, "consumed_at": datetime(2024, 3, 5, 13)},
        {"observed_ts": "2024-03-05T12:55", "temperature_c": 31.0, "precipitation_mm": 0.5, "consumed_at": datetime(2024, 3, 5, 14)},
        {"observed_ts": "not a time", "temperature_c": 55.0, "consumed_at": datetime(2024, 3, 5, 14)},
    )
    staged = W.stage_weather(weather(spark, *hours), weather(spark), live)
    got = {r.observation_ts: r for r in merge_hours(staged).collect()}
    assert len(got) == 25 and got[None].temperature_c == 55.0
    noon = got[datetime(2024, 3, 5, 12)]
    assert (noon.temperature_c, noon.precipitation_mm, noon.rain_mm, noon.source_kind) == (31.0, 0.5, None, "streaming")
    assert got[datetime(2024, 3, 5, 11)].source_kind == "historical"


def test_latest_value_of_a_feed_and_ties(spark):
    rows = [
        weather_row(temperature_2m=10.0, rain=1.0, ingested=datetime(2024, 3, 6)),
        weather_row(temperature_2m=11.0, ingested=datetime(2024, 3, 8)),
        weather_row("MDE", temperature_2m=5.0), weather_row("MDE", temperature_2m=6.0),
    ]
    staged = W.stage_weather(weather(spark, *rows), weather(spark))
    got = {r.city_id: r for r in merge_hours(staged).collect()}
    # A later version without rain leaves the earlier one's.
    assert (got["BOG"].temperature_c, got["BOG"].rain_mm) == (11.0, 1.0)
    assert got["MDE"].temperature_c == 6.0
    assert merge_hours(staged.limit(0)).collect() == []
    assert merge_hours(staged).columns == staged.columns
