"""Explicit schemas of the raw tables, the landed JSON and the event stream."""

from pyspark.sql import types as T

from aerolith.fixed import HOURLY_MEASURES

STRING, DOUBLE, LONG, INT, TIMESTAMP = (
    T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.TimestampType(),
)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


CITIES = _struct(
    city_id=STRING, name=STRING, department=STRING, latitude=DOUBLE, longitude=DOUBLE,
    elevation_m=LONG, population=LONG, timezone=STRING,
)

_MEASURES = dict.fromkeys(HOURLY_MEASURES, DOUBLE)


def weather_raw(time: T.DataType = TIMESTAMP) -> T.StructType:
    """Raw hourly weather; `time` is the type of both time columns (long for nanoseconds)."""
    return _struct(
        city_id=STRING, city_name=STRING, latitude=DOUBLE, longitude=DOUBLE, elevation_m=LONG,
        **_MEASURES, observation_ts=time, ingested_at=time,
    )


AIR_RAW = _struct(
    city_id=STRING, city_name=STRING, location_id=LONG, location_name=STRING, sensor_id=LONG,
    parameter_name=STRING, parameter_units=STRING, observation_date=STRING, value=DOUBLE,
    min_value=DOUBLE, max_value=DOUBLE, avg_value=DOUBLE, measurement_count=LONG,
    ingested_at=TIMESTAMP,
)

STREAM_EVENT = _struct(
    event_id=STRING, event_ts_utc=STRING, city_id=STRING, city_name=STRING, latitude=DOUBLE,
    longitude=DOUBLE, observed_ts=STRING, temperature_c=DOUBLE, apparent_temperature_c=DOUBLE,
    relative_humidity_pct=DOUBLE, precipitation_mm=DOUBLE, wind_speed_kmh=DOUBLE,
    wind_direction_deg=DOUBLE, wind_gusts_kmh=DOUBLE, pressure_hpa=DOUBLE, cloud_cover_pct=DOUBLE,
    sensor_kind=STRING,
)

STREAM_LANDED = T.StructType(STREAM_EVENT.fields + [T.StructField("consumed_at", TIMESTAMP)])

# Path columns of the layouts.
CITY_MONTH_PATH = _struct(city_id=STRING, year=INT, month=INT)
DAY_PATH = _struct(year=INT, month=INT, day=INT)

# Landed JSON documents.
HOURLY_PAYLOAD = _struct(
    hourly=_struct(
        time=T.ArrayType(STRING), **{name: T.ArrayType(DOUBLE) for name in HOURLY_MEASURES}
    )
)
STATIONS_PAYLOAD = _struct(
    results=T.ArrayType(
        _struct(
            id=LONG,
            name=STRING,
            sensors=T.ArrayType(_struct(id=LONG, parameter=_struct(name=STRING, units=STRING))),
        )
    )
)
MEASUREMENTS_PAYLOAD = _struct(
    results=T.ArrayType(
        _struct(
            value=DOUBLE,
            period=_struct(datetimeFrom=_struct(utc=STRING)),
            summary=_struct(min=DOUBLE, max=DOUBLE, avg=DOUBLE),
            coverage=_struct(observedCount=LONG),
        )
    )
)
