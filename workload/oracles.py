"""The same questions in plain SQL, for the correctness check. Written apart from the library."""

from __future__ import annotations

from workload import roles


def _list(exprs: dict[str, str]) -> str:
    return ",\n".join(f"{text} AS {name}" for name, text in exprs.items()).replace(
        " as string)", " as varchar)"
    )


_LANDED = f"l_shipdate + to_days(cast({roles.LANDED_AFTER_DAYS} as int)) AS ingested_at"
_MEASURES = {
    "temperature_2m": "temperature_c",
    "relative_humidity_2m": "relative_humidity_pct",
    "dew_point_2m": "dew_point_c",
    "apparent_temperature": "apparent_temperature_c",
    "precipitation": "precipitation_mm",
    "rain": "rain_mm",
    "pressure_msl": "pressure_msl_hpa",
    "surface_pressure": "surface_pressure_hpa",
    "cloud_cover": "cloud_cover_pct",
    "wind_speed_10m": "wind_speed_kmh",
    "wind_direction_10m": "wind_direction_deg",
    "wind_gusts_10m": "wind_gusts_kmh",
    "shortwave_radiation": "shortwave_radiation_w_m2",
}

# Common table expressions, each with the ones it reads.
CTES: dict[str, tuple[list[str], str]] = {
    "raw_weather": (
        [],
        f"SELECT {_list(roles.WEATHER_EXPR)}, l_linestatus,"
        f" l_shipdate + to_hours(cast({roles.HOUR} as int)) AS observation_ts, {_LANDED}"
        " FROM lineitem",
    ),
    "staged": (
        ["raw_weather"],
        "SELECT city_id, city_name, latitude, longitude, elevation_m, observation_ts,"
        + ", ".join(f"{r} AS {s}" for r, s in _MEASURES.items())
        + ", CASE WHEN l_linestatus = 'F' THEN 'historical' ELSE 'daily' END AS source_kind,"
        " ingested_at FROM raw_weather",
    ),
    "latest": (
        ["staged"],
        """SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (
          PARTITION BY city_id, observation_ts
          ORDER BY ingested_at DESC, source_kind, temperature_c,
            apparent_temperature_c, relative_humidity_pct, precipitation_mm, rain_mm,
            pressure_msl_hpa, cloud_cover_pct, wind_speed_kmh, wind_gusts_kmh,
            shortwave_radiation_w_m2, city_name, latitude, longitude, elevation_m, dew_point_c,
            surface_pressure_hpa, wind_direction_deg) AS rn
        FROM staged) WHERE rn = 1""",
    ),
    "daily": (
        ["latest"],
        """SELECT city_id, city_name, cast(observation_ts AS date) AS observation_date,
        avg(temperature_c) AS avg_temperature_c, min(temperature_c) AS min_temperature_c,
        max(temperature_c) AS max_temperature_c,
        avg(apparent_temperature_c) AS avg_apparent_temperature_c,
        max(apparent_temperature_c) AS max_apparent_temperature_c,
        avg(relative_humidity_pct) AS avg_humidity_pct,
        sum(precipitation_mm) AS total_precipitation_mm, sum(rain_mm) AS total_rain_mm,
        avg(pressure_msl_hpa) AS avg_pressure_hpa, avg(cloud_cover_pct) AS avg_cloud_cover_pct,
        avg(wind_speed_kmh) AS avg_wind_speed_kmh, max(wind_gusts_kmh) AS max_wind_gusts_kmh,
        sum(shortwave_radiation_w_m2) AS total_shortwave_radiation_w_m2,
        count(*) AS hour_count, max(ingested_at) AS last_ingested_at
        FROM latest GROUP BY ALL""",
    ),
    "batch": (
        ["raw_weather"],
        """SELECT city_id, city_name, cast(observation_ts AS date) AS observation_date,
        avg(temperature_2m) AS avg_temperature_c, min(temperature_2m) AS min_temperature_c,
        max(temperature_2m) AS max_temperature_c, avg(relative_humidity_2m) AS avg_humidity_pct,
        sum(precipitation) AS total_precipitation_mm, avg(pressure_msl) AS avg_pressure_hpa,
        avg(wind_speed_10m) AS avg_wind_speed_kmh, max(wind_gusts_10m) AS max_wind_gusts_kmh,
        count(*) AS hour_count
        FROM raw_weather GROUP BY ALL""",
    ),
    "cities": ([], f"SELECT {_list(roles.NATION_CITY_EXPR)} FROM nation"),
    "supplier_cities": ([], f"SELECT {_list(roles.SUPPLIER_CITY_EXPR)} FROM supplier"),
}


def _dim(source: str) -> str:
    return f"""SELECT city_id, name AS city_name, department, latitude, longitude, elevation_m,
    population, timezone,
    CASE WHEN elevation_m < 500 THEN 'tierra_caliente' WHEN elevation_m < 1000 THEN 'tierra_templada'
      WHEN elevation_m < 2000 THEN 'tierra_fria' WHEN elevation_m < 3000 THEN 'tierra_muy_fria'
      ELSE 'paramo' END AS climate_zone,
    CASE WHEN population < 600000 THEN 'medium' WHEN population < 2000000 THEN 'large'
      ELSE 'metropolitan' END AS population_tier FROM {source}"""


def _key(*texts: str) -> str:
    parts = " || '-' || ".join(
        f"coalesce(cast({t} AS varchar), '_dbt_utils_surrogate_key_null_')" for t in texts
    )
    return f"md5({parts})"


_NORMALISED = """CASE WHEN parameter_name IN ('pm25', 'pm10') AND parameter_units = 'µg/m³' THEN value
  WHEN parameter_name IN ('o3', 'no2', 'so2') AND parameter_units = 'ppb' THEN value
  WHEN parameter_name = 'co' AND parameter_units = 'ppm' THEN value * 1000 END"""
_UNIT = """CASE WHEN parameter_name IN ('pm25', 'pm10') AND parameter_units = 'µg/m³' THEN 'µg/m³'
  WHEN parameter_name IN ('o3', 'no2', 'so2') AND parameter_units = 'ppb' THEN 'ppb'
  WHEN parameter_name = 'co' AND parameter_units = 'ppm' THEN 'ppb' END"""


def _air_daily(source: str) -> str:
    return f"""SELECT DISTINCT r.city_id, r.city_name, r.observation_date, r.parameter_name,
    r.parameter_units, s.median_value, s.mean_value, s.min_value, s.max_value, s.sensor_count,
    s.total_measurements
    FROM (SELECT * FROM {source} WHERE normalised_value IS NOT NULL) r
    JOIN (SELECT city_id, observation_date, parameter_name,
        quantile_cont(normalised_value, 0.5) AS median_value,
        avg(normalised_value) AS mean_value, min(normalised_value) AS min_value,
        max(normalised_value) AS max_value, count(DISTINCT sensor_id) AS sensor_count,
        cast(sum(measurement_count) AS bigint) AS total_measurements
      FROM {source} WHERE normalised_value IS NOT NULL
      GROUP BY city_id, observation_date, parameter_name) s
    USING (city_id, observation_date, parameter_name)"""


_RUN_COLUMNS = "city_tmax_p95, is_heat_day, heat_run_length, is_heat_wave_day"


def _heat(q: float, min_run: int, calendar: bool = False) -> str:
    run = (
        "CASE WHEN hot = 1 THEN date_diff('day', DATE '1970-01-01', observation_date) - hot_so_far END"
        if calendar
        else "rn - hot_so_far"
    )
    return f"""SELECT *, heat_run_length >= {min_run} AS is_heat_wave_day FROM (
      SELECT *, CASE WHEN is_heat_day THEN cast(sum(hot) OVER (PARTITION BY city_id, run) AS bigint)
        ELSE 0 END AS heat_run_length FROM (
      SELECT *, {run} AS run FROM (
      SELECT *, row_number() OVER o AS rn, cast(sum(hot) OVER o AS bigint) AS hot_so_far FROM (
      SELECT *, max_temperature_c > city_tmax_p95 AS is_heat_day,
        CASE WHEN max_temperature_c > city_tmax_p95 THEN 1 ELSE 0 END AS hot
      FROM batch JOIN (SELECT city_id, quantile_cont(max_temperature_c, {q}) AS city_tmax_p95
        FROM batch GROUP BY city_id) USING (city_id))
      WINDOW o AS (PARTITION BY city_id ORDER BY observation_date, city_name
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))))"""


CTES |= {
    "dim": (["cities"], _dim("cities")),
    "raw_air": (
        [],
        f"SELECT {_list(roles.AIR_EXPR)},"
        f" cast(date_trunc('week', l_shipdate) AS date) AS observation_date, {_LANDED} FROM lineitem",
    ),
    "staged_air": (
        ["raw_air"],
        "SELECT city_id, city_name, location_id, location_name, sensor_id, parameter_name,"
        " parameter_units, observation_date, value, min_value, max_value, avg_value,"
        f" measurement_count, ingested_at, {_NORMALISED} AS normalised_value"
        " FROM raw_air WHERE value IS NOT NULL AND value >= 0",
    ),
    "deduped_air": (
        ["staged_air"],
        """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
          PARTITION BY city_id, sensor_id, parameter_name, observation_date
          ORDER BY ingested_at DESC, normalised_value, measurement_count, city_name,
            location_id, location_name, parameter_units, value, min_value, max_value,
            avg_value) AS rn
        FROM staged_air) WHERE rn = 1""",
    ),
    "air_daily": (["staged_air"], _air_daily("staged_air")),
    "air_daily_deduped": (["deduped_air"], _air_daily("deduped_air")),
    "fct_weather": (
        ["daily", "dim"],
        f"""SELECT {_key("d.city_id", "observation_date")} AS weather_sk, d.city_id, d.city_name,
        department, climate_zone, elevation_m, population, observation_date,
        year(observation_date) AS observation_year, month(observation_date) AS observation_month,
        quarter(observation_date) AS observation_quarter,
        dayofweek(observation_date) + 1 AS observation_day_of_week,
        avg_temperature_c, min_temperature_c, max_temperature_c,
        max_temperature_c - min_temperature_c AS temperature_range_c,
        avg_apparent_temperature_c, max_apparent_temperature_c, avg_humidity_pct,
        total_precipitation_mm, total_rain_mm, avg_pressure_hpa, avg_cloud_cover_pct,
        avg_wind_speed_kmh, max_wind_gusts_kmh, total_shortwave_radiation_w_m2,
        total_precipitation_mm > 20 AS is_heavy_rain_day, max_temperature_c >= 32 AS is_hot_day,
        min_temperature_c <= 5 AS is_cold_day, max_wind_gusts_kmh >= 40 AS is_windy_day,
        hour_count, hour_count = 24 AS is_complete_day, last_ingested_at
        FROM daily d LEFT JOIN dim ON d.city_id = dim.city_id""",
    ),
    "fct_air": (
        ["air_daily", "dim"],
        f"""SELECT {_key("d.city_id", "observation_date", "parameter_name")} AS air_quality_sk,
        d.city_id, d.city_name, department, climate_zone, population, observation_date,
        year(observation_date) AS observation_year, month(observation_date) AS observation_month,
        quarter(observation_date) AS observation_quarter, parameter_name, parameter_units,
        {_UNIT} AS normalised_units, median_value, mean_value, min_value, max_value, sensor_count,
        total_measurements,
        CASE WHEN parameter_name = 'pm25' AND median_value > 15 THEN true
          WHEN parameter_name = 'pm10' AND median_value > 45 THEN true
          WHEN parameter_name = 'no2' AND median_value > 25 THEN true
          WHEN parameter_name = 'so2' AND median_value > 40 THEN true
          WHEN parameter_name = 'o3' AND median_value > 100 THEN true
          WHEN parameter_name = 'co' AND median_value > 4000 THEN true
          ELSE false END AS exceeds_who_guideline
        FROM air_daily d LEFT JOIN dim ON d.city_id = dim.city_id""",
    ),
    "wide": (
        ["fct_air"],
        "SELECT city_id, observation_date, "
        + ", ".join(
            f"max(CASE WHEN parameter_name = '{p}' THEN median_value END) AS {p}"
            for p in ("pm25", "pm10", "o3", "no2", "so2", "co")
        )
        + ", count(DISTINCT parameter_name) AS pollutants_measured"
        " FROM fct_air GROUP BY city_id, observation_date",
    ),
    "stress": (
        ["fct_weather", "wide"],
        f"""SELECT {_key("w.city_id", "w.observation_date")} AS stress_sk, w.city_id, city_name,
        department, climate_zone, w.observation_date, observation_year, observation_month,
        avg_temperature_c, max_temperature_c, max_apparent_temperature_c, avg_humidity_pct,
        total_precipitation_mm, pm25, pm10, o3, no2, so2, co, pollutants_measured,
        CASE WHEN points > 100 THEN 100 WHEN points < 0 THEN 0 ELSE points END
          AS environmental_stress_score, last_ingested_at
        FROM (SELECT f.*, pm25, pm10, o3, no2, so2, co, pollutants_measured,
            CASE WHEN max_apparent_temperature_c IS NULL THEN 0
              WHEN max_apparent_temperature_c <= 28 THEN 0
              WHEN (max_apparent_temperature_c - 28) * 3 > 30 THEN 30
              ELSE (max_apparent_temperature_c - 28) * 3 END
            + CASE WHEN pm25 IS NULL THEN 0 WHEN pm25 * 1.2 > 35 THEN 35 ELSE pm25 * 1.2 END
            + CASE WHEN o3 IS NULL THEN 0 WHEN o3 * 0.2 > 20 THEN 20 ELSE o3 * 0.2 END
            + CASE WHEN no2 IS NULL THEN 0 WHEN no2 * 0.5 > 15 THEN 15 ELSE no2 * 0.5 END AS points
          FROM fct_weather f LEFT JOIN wide a
            ON f.city_id = a.city_id AND f.observation_date = a.observation_date) w""",
    ),
    "months": (
        ["batch"],
        """SELECT city_id, city_name, month(observation_date) AS month_of_year,
        year(observation_date) AS year, avg(avg_temperature_c) AS month_avg_temp_c,
        min(min_temperature_c) AS month_min_temp_c, max(max_temperature_c) AS month_max_temp_c,
        sum(total_precipitation_mm) AS month_total_precip_mm,
        avg(avg_humidity_pct) AS month_avg_humidity_pct FROM batch GROUP BY ALL""",
    ),
    "normals": (
        ["months"],
        """SELECT *, avg(month_avg_temp_c) OVER w AS climate_normal_temp_c,
        avg(month_total_precip_mm) OVER w AS climate_normal_precip_mm,
        month_avg_temp_c - avg(month_avg_temp_c) OVER w AS temp_anomaly_c,
        month_total_precip_mm - avg(month_total_precip_mm) OVER w AS precip_anomaly_mm,
        count(year) OVER w AS years_in_sample
        FROM months WINDOW w AS (PARTITION BY city_id, month_of_year)""",
    ),
    "rolled": (
        ["batch"],
        """SELECT *, avg(avg_temperature_c) OVER w AS rolling_30d_avg_temp_c,
        sum(total_precipitation_mm) OVER w AS rolling_30d_total_precip_mm,
        max(max_temperature_c) OVER w AS rolling_30d_max_temp_c
        FROM batch WINDOW w AS (PARTITION BY city_id ORDER BY observation_date
          RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW)""",
    ),
    "heat": (["batch"], _heat(0.95, 3)),
    "heat_calendar": (["batch"], _heat(0.7, 2, calendar=True)),
    "heat_low": (["batch"], _heat(0.8, 2)),
    "episodes": (
        ["heat_low"],
        """SELECT city_id, min(city_name) AS city_name, min(observation_date) AS first_day,
        max(observation_date) AS last_day, count(*) AS heat_days,
        max(max_temperature_c) AS peak_temperature_c
        FROM heat_low WHERE is_heat_wave_day GROUP BY city_id, run""",
    ),
    "event_weather": (
        [],
        "SELECT lpad(cast(user_id % 5 AS varchar), 3, '0') AS city_id,"
        " concat('City ', user_id % 5) AS city_name, cast(user_id % 5 AS double) AS latitude,"
        " cast(user_id % 5 AS double) AS longitude, cast(user_id % 5 AS bigint) AS elevation_m,"
        + ", ".join(
            f"{'value' if m == 'temperature_2m' else 'cast(event_id % 100 AS double)'} AS {m}" for m in _MEASURES
        )
        + ", ts AS observation_ts, ts AS ingested_at, year(ts) AS year, month(ts) AS month,"
        " day(ts) AS day FROM events",
    ),
}

# Live events beside the pulled feeds, and hours merged measure by measure.
_LIVE = {"pressure_msl_hpa": "pressure_hpa"} | {
    m: m for m in _MEASURES.values() if m in roles.LIVE_EXPR
}
_MERGED = [*_MEASURES.values(), "city_name", "latitude", "longitude", "elevation_m", "source_kind"]
CTES |= {
    "live": (
        [],
        f"""SELECT {_list(roles.LIVE_EXPR)},
        l_shipdate + to_hours(cast({roles.LIVE_HOUR} AS int)) + to_minutes(cast({roles.LIVE_MINUTE} AS int)) AS happened_at,
        l_shipdate + to_days(cast(l_partkey % 3 AS int)) + to_hours(1) AS consumed_at
        FROM lineitem WHERE {roles.LIVE}""",
    ),
    "staged_live": (
        ["staged", "live"],
        "SELECT * FROM staged UNION ALL SELECT city_id, city_name, NULL, NULL, NULL, happened_at, "
        + ", ".join(_LIVE.get(m, "NULL") for m in _MEASURES.values())
        + ", 'streaming', consumed_at FROM live",
    ),
    "merged": (
        ["staged_live"],
        "SELECT city_id, date_trunc('hour', observation_ts) AS observation_ts, "
        + ", ".join(f"arg_max({c}, (rank, ingested_at, {c})) FILTER ({c} IS NOT NULL) AS {c}" for c in _MERGED)
        + ", max(ingested_at) AS ingested_at FROM (SELECT *,"
        " CASE source_kind WHEN 'streaming' THEN 0 ELSE 1 END AS rank FROM staged_live) GROUP BY 1, 2",
    ),
    "daily_live": (["merged"], CTES["daily"][1].replace("FROM latest", "FROM merged")),
    "fct_weather_live": (["daily_live", "dim"], CTES["fct_weather"][1].replace("FROM daily d", "FROM daily_live d")),
}

_PLACE = ["city_id", "city_name", "latitude", "longitude", "elevation_m"]
_DOUBLES_WEATHER = [
    "avg_temperature_c", "min_temperature_c", "max_temperature_c", "avg_apparent_temperature_c",
    "max_apparent_temperature_c", "avg_humidity_pct", "total_precipitation_mm", "total_rain_mm",
    "avg_pressure_hpa", "avg_cloud_cover_pct", "avg_wind_speed_kmh", "max_wind_gusts_kmh",
    "total_shortwave_radiation_w_m2",
]
_DOUBLES_BATCH = [
    "avg_temperature_c", "min_temperature_c", "max_temperature_c", "avg_humidity_pct",
    "total_precipitation_mm", "avg_pressure_hpa", "avg_wind_speed_kmh", "max_wind_gusts_kmh",
]
_DAY = "city_id, city_name, observation_date:date"
_AIR_VALUES = (
    "median_value:num, mean_value:num, min_value:num, max_value:num, sensor_count,"
    " total_measurements"
)
_STAGED = (
    "city_id, city_name, latitude:num, longitude:num, elevation_m, observation_ts:ts, "
    + ", ".join(f"{m}:num" for m in _MEASURES.values())
    + ", source_kind, ingested_at:ts"
)
_STAGED_AIR = (
    "city_id, city_name, location_id, location_name, sensor_id, parameter_name, parameter_units,"
    " observation_date:date, value:num, min_value:num, max_value:num, avg_value:num,"
    " measurement_count, normalised_value:num"
)


def _num(names: list[str]) -> str:
    return ", ".join(f"{n}:num" for n in names)


_FCT_WEATHER = (
    "weather_sk, city_id, city_name, department, climate_zone, elevation_m, population,"
    " observation_date:date, observation_year, observation_month, observation_quarter,"
    f" observation_day_of_week, {_num(_DOUBLES_WEATHER)}, temperature_range_c:num,"
    " is_heavy_rain_day, is_hot_day, is_cold_day, is_windy_day, hour_count, is_complete_day,"
    " last_ingested_at:ts"
)
_FCT_AIR = (
    "air_quality_sk, city_id, city_name, department, climate_zone, population,"
    " observation_date:date, observation_year, observation_month, observation_quarter,"
    f" parameter_name, parameter_units, normalised_units, {_AIR_VALUES}, exceeds_who_guideline"
)
_HEAT = f"{_DAY}, {_num(_DOUBLES_BATCH)}, hour_count, city_tmax_p95:num, is_heat_day, heat_run_length, is_heat_wave_day"
_WIDE = "pm25:num, pm10:num, o3:num, no2:num, so2:num, co:num, pollutants_measured"

_FORMS = {
    "num": "round({0}, 6) + 0.0 AS {0}",
    "date": "cast({0} AS varchar) AS {0}",
    "ts": "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}",
}


def _needed(names: list[str]) -> list[str]:
    ordered: list[str] = []
    for name in names:
        for found in [*_needed(CTES[name][0]), name]:
            if found not in ordered:
                ordered.append(found)
    return ordered


def _sql(columns: str, source: str, ctes: list[str], tail: str = "") -> str:
    """SELECT `columns` (name or name:form) FROM `source`, below the CTEs that it needs."""
    shown = []
    for item in columns.split(","):
        name, _, form = item.strip().partition(":")
        shown.append(_FORMS[form].format(name) if form else name)
    body = f"SELECT {', '.join(shown)} FROM {source} {tail}"
    with_ = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in _needed(ctes))
    return f"WITH {with_}\n{body}" if with_ else body


def _check(model: str, column: str, test: str, failures: str, severity: str = "error") -> str:
    return (
        f"SELECT '{model}' AS model, '{column}' AS \"column\", '{test}' AS test,"
        f" '{severity}' AS severity, cast(({failures}) AS bigint) AS failures"
    )


def _quality() -> str:
    lines = []

    def where(model, source, column, test, condition, severity="error"):
        count = f"SELECT count(*) FROM {source} WHERE {condition}"
        lines.append(_check(model, column, test, count, severity))

    def null(model, source, column):
        where(model, source, column, "not_null", f"{column} IS NULL")

    def uniq(model, source, column):
        groups = f"SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1"
        lines.append(_check(model, column, "unique", f"SELECT count(*) FROM ({groups})"))

    def orphan(model, source):
        where(
            model, source, "city_id", "relationships",
            "city_id IS NOT NULL AND city_id NOT IN (SELECT city_id FROM cities)",
        )

    def within(model, source, column, low, high, severity="error"):
        where(model, source, column, "accepted_range", f"{column} < {low} OR {column} > {high}", severity)

    def among(model, source, column, values):
        where(model, source, column, "accepted_values", f"{column} NOT IN ({values})")

    pollutants = "'pm25', 'pm10', 'o3', 'no2', 'so2', 'co'"
    null("raw_weather", "raw_weather", "city_id")
    null("raw_weather", "raw_weather", "observation_ts")
    null("raw_air_quality", "raw_air", "city_id")
    null("raw_air_quality", "raw_air", "parameter_name")
    among("raw_air_quality", "raw_air", "parameter_name", pollutants)
    null("raw_air_quality", "raw_air", "observation_date")
    uniq("cities", "cities", "city_id")
    for column in ("city_id", "name", "latitude", "longitude", "elevation_m", "population", "timezone"):
        null("cities", "cities", column)
    within("cities", "cities", "latitude", -90, 90)
    within("cities", "cities", "longitude", -180, 180)
    null("stg_weather", "staged", "city_id")
    orphan("stg_weather", "staged")
    null("stg_weather", "staged", "observation_ts")
    within("stg_weather", "staged", "temperature_c", -15, 50, "warn")
    within("stg_weather", "staged", "relative_humidity_pct", 0, 100, "warn")
    null("stg_air_quality", "staged_air", "city_id")
    orphan("stg_air_quality", "staged_air")
    null("stg_air_quality", "staged_air", "parameter_name")
    among("stg_air_quality", "staged_air", "parameter_name", pollutants)
    null("stg_air_quality", "staged_air", "value")
    null("stg_air_quality", "staged_air", "observation_date")
    uniq("dim_cities", "dim", "city_id")
    null("dim_cities", "dim", "city_id")
    among(
        "dim_cities", "dim", "climate_zone",
        "'tierra_caliente', 'tierra_templada', 'tierra_fria', 'tierra_muy_fria', 'paramo'",
    )
    among("dim_cities", "dim", "population_tier", "'medium', 'large', 'metropolitan'")
    for model, source, key in (
        ("fct_weather_daily", "fct_weather", "weather_sk"),
        ("fct_air_quality_daily", "fct_air", "air_quality_sk"),
        ("fct_environmental_stress", "stress", "stress_sk"),
    ):
        uniq(model, source, key)
        null(model, source, key)
        null(model, source, "city_id")
        orphan(model, source)
    null("fct_weather_daily", "fct_weather", "observation_date")
    within("fct_weather_daily", "fct_weather", "avg_temperature_c", -15, 45, "warn")
    null("fct_air_quality_daily", "fct_air", "parameter_name")
    among("fct_air_quality_daily", "fct_air", "parameter_name", pollutants)
    within("fct_environmental_stress", "stress", "environmental_stress_score", 0, 100)
    return "(" + "\nUNION ALL ".join(lines) + ")"


def _oracles() -> dict[str, str]:
    air = f"{_DAY}, parameter_name, parameter_units, {_AIR_VALUES}"
    days = f"{_DAY}, {_num(_DOUBLES_WEATHER)}, hour_count, last_ingested_at:ts"
    normals = (
        "city_id, city_name, month_of_year, year, month_avg_temp_c:num, month_min_temp_c:num,"
        " month_max_temp_c:num, month_total_precip_mm:num, month_avg_humidity_pct:num,"
        " climate_normal_temp_c:num, climate_normal_precip_mm:num, temp_anomaly_c:num,"
        " precip_anomaly_mm:num, years_in_sample"
    )
    stress = (
        "stress_sk, city_id, city_name, department, climate_zone, observation_date:date,"
        " observation_year, observation_month, avg_temperature_c:num, max_temperature_c:num,"
        " max_apparent_temperature_c:num, avg_humidity_pct:num, total_precipitation_mm:num,"
        f" {_WIDE}, environmental_stress_score:num, last_ingested_at:ts"
    )
    rolled = (
        f"{_DAY}, {_num(_DOUBLES_BATCH)}, hour_count, rolling_30d_avg_temp_c:num,"
        " rolling_30d_total_precip_mm:num, rolling_30d_max_temp_c:num"
    )
    dim = (
        "city_id, city_name, department, latitude:num, longitude:num, elevation_m, population,"
        " timezone, climate_zone, population_tier"
    )
    raw = (
        "city_id, city_name, latitude:num, longitude:num, elevation_m, "
        + ", ".join(f"{m}:num" for m in _MEASURES)
        + ", observation_ts:ts, ingested_at:ts, year, month"
    )
    absent = ", ".join(
        f"cast(NULL AS double) AS {m}" for m in _MEASURES if m not in ("temperature_2m", "wind_speed_10m")
    )
    city = "concat('C', l_suppkey % 27)"
    event_city = "CASE WHEN event_id % 31 <> 0 THEN lpad(cast(user_id % 5 AS varchar), 3, '0') END"
    silent = (
        "latitude longitude apparent_temperature_c relative_humidity_pct precipitation_mm wind_speed_kmh"
        " wind_direction_deg wind_gusts_kmh pressure_hpa cloud_cover_pct"
    ).split()
    # One line of the stream as the JSON writer leaves it: NULL fields are absent.
    event_line = f"""concat('{{"event_id":"', event_id, '"',
        coalesce(',"city_id":"' || {event_city} || '"', ''),
        ',"observed_ts":"', strftime(ts, '%Y-%m-%dT%H:%M'), '"')"""
    return {
        "dedupe_latest": _sql(_STAGED, "latest", ["latest"]),
        "union_sources": _sql(_STAGED, "staged", ["staged"]),
        "union_stream": _sql(_STAGED, "staged_live", ["staged_live"]),
        "merge_hours": _sql(_STAGED, "merged", ["merged"]),
        "fct_weather_stream": _sql(_FCT_WEATHER, "fct_weather_live", ["fct_weather_live"]),
        "unit_normalise": _sql(
            f"{_STAGED_AIR}, ingested_at:ts, normalised_units",
            f"(SELECT *, {_UNIT} AS normalised_units FROM staged_air)",
            ["staged_air"],
        ),
        "surrogate_key": f"""SELECT l_orderkey, cast(l_linenumber AS bigint) AS l_linenumber,
            l_partkey, l_suppkey,
            {_key("l_orderkey", "l_linenumber")} AS two_part_key,
            {_key("nullif(l_returnflag, 'R')", "cast(l_shipdate AS date)", "l_suppkey")}
              AS three_part_key FROM lineitem""",
        "daily_rollup": _sql(days, "daily", ["daily"]),
        "batch_daily": _sql(f"{_DAY}, {_num(_DOUBLES_BATCH)}, hour_count", "batch", ["batch"]),
        "row_count": "SELECT count(*) AS raw_rows FROM lineitem",
        "air_daily_median": _sql(air, "air_daily", ["air_daily"]),
        "air_daily_deduped": _sql(air, "air_daily_deduped", ["air_daily_deduped"]),
        "percentile_large_groups": """SELECT l_returnflag,
            round(quantile_cont(l_extendedprice, 0.95), 6) AS price_p95
            FROM lineitem GROUP BY l_returnflag""",
        "pivot_pollutants": _sql(f"city_id, observation_date:date, {_WIDE}", "wide", ["wide"]),
        "dim_zone": _sql(dim, f"({_dim('supplier_cities')})", ["supplier_cities"]),
        "fct_weather": _sql(_FCT_WEATHER, "fct_weather", ["fct_weather"]),
        "fct_air": _sql(_FCT_AIR, "fct_air", ["fct_air"]),
        "who_exceedance": _sql(
            "air_quality_sk, city_id, city_name, observation_date:date, parameter_name,"
            " normalised_units, median_value:num",
            "fct_air", ["fct_air"], "WHERE exceeds_who_guideline",
        ),
        "stress_score": _sql(stress, "stress", ["stress"]),
        "monthly_normals": _sql(normals, "normals", ["normals"]),
        "rolling_30d": _sql(rolled, "rolled", ["rolled"]),
        "heat_waves": _sql(_HEAT, "heat", ["heat"]),
        "heat_waves_calendar": _sql(_HEAT, "heat_calendar", ["heat_calendar"]),
        "heat_episodes": _sql(
            "city_id, city_name, first_day:date, last_day:date, heat_days, peak_temperature_c:num",
            "episodes", ["episodes"],
        ),
        "heat_trend": _sql(
            "city_id, year, heat_waves, heat_wave_days, avg_length:num, max_length",
            """(SELECT city_id, year(first_day) AS year, count(*) AS heat_waves,
              cast(sum(heat_days) AS bigint) AS heat_wave_days, avg(heat_days) AS avg_length,
              max(heat_days) AS max_length FROM episodes GROUP BY ALL)""",
            ["episodes"],
        ),
        "rank_exceedance": _sql(
            "parameter_name, city_id, days, days_above, share_above:num, worst_rank",
            """(SELECT *, rank() OVER (PARTITION BY parameter_name ORDER BY share_above DESC)
                AS worst_rank FROM
              (SELECT parameter_name, city_id, count(*) AS days,
                count(*) FILTER (WHERE exceeds_who_guideline) AS days_above,
                avg(CASE WHEN exceeds_who_guideline THEN 1 ELSE 0 END) AS share_above
              FROM fct_air GROUP BY parameter_name, city_id))""",
            ["fct_air"],
        ),
        "top_stress": _sql(
            "city_id, avg_score:num, max_score:num, avg_pollutants_measured:num, days",
            """(SELECT city_id, avg(environmental_stress_score) AS avg_score,
              max(environmental_stress_score) AS max_score,
              avg(coalesce(pollutants_measured, 0)) AS avg_pollutants_measured, count(*) AS days
              FROM stress GROUP BY city_id ORDER BY avg_score DESC, city_id LIMIT 5)""",
            ["stress"],
        ),
        "corr_rain": _sql(
            "climate_zone, rain_correlation:num, days",
            """(SELECT climate_zone, corr(pm25, total_precipitation_mm) AS rain_correlation,
              count(*) AS days FROM stress
              WHERE pm25 IS NOT NULL AND total_precipitation_mm IS NOT NULL GROUP BY climate_zone)""",
            ["stress"],
        ),
        "outliers_z": _sql(
            "city_id, observation_date:date, total_precipitation_mm:num, z_score:num",
            """(SELECT city_id, observation_date, total_precipitation_mm,
              (total_precipitation_mm - avg(total_precipitation_mm) OVER w)
                / nullif(stddev_samp(total_precipitation_mm) OVER w, 0) AS z_score
              FROM fct_weather WINDOW w AS (PARTITION BY city_id, month(observation_date)))""",
            ["fct_weather"], "WHERE abs(z_score) > 2.0",
        ),
        "quality_report": _sql(
            'model, "column", test, severity, failures', _quality(), ["stress"]
        ),
        "unknown_cities": _sql(
            "city_id, rows",
            "(SELECT city_id, count(*) AS rows FROM raw_weather GROUP BY city_id)",
            ["raw_weather", "cities"], "WHERE city_id NOT IN (SELECT city_id FROM cities)",
        ),
        "duplicate_keys": _sql(
            "weather_sk, rows",
            "(SELECT weather_sk, count(*) AS rows FROM fct_weather GROUP BY weather_sk)",
            ["fct_weather"], "WHERE rows > 1",
        ),
        "missing_measures": _sql(_STAGED, "staged", ["staged"], "WHERE temperature_c IS NULL"),
        "unknown_pollutants": _sql(
            _STAGED_AIR, "staged_air", ["staged_air"],
            "WHERE parameter_name NOT IN ('pm25', 'pm10', 'o3', 'no2', 'so2', 'co')",
        ),
        "humidity_out_of_range": _sql(
            _STAGED, "staged", ["staged"],
            "WHERE relative_humidity_pct < 0 OR relative_humidity_pct > 100",
        ),
        "scan_external": _sql(f"{raw}, day", "event_weather", ["event_weather"]),
        "seed_csv": _sql(dim, f"({_dim('supplier_cities')})", ["supplier_cities"]),
        "climate_job": " UNION ALL BY NAME ".join(
            f"SELECT '{name}' AS result, * FROM ({sql})" for name, sql in (
                ("monthly_normals", _sql(normals, "normals", ["normals"])),
                ("rolling_30d", _sql(rolled, "rolled", ["rolled"])),
                ("heat_waves", _sql(_HEAT, "heat", ["heat"])),
            )
        ),
        "hourly_payload": f"""SELECT {city} AS city_id, n_name AS city_name,
            cast(n_nationkey AS double) AS latitude, cast(-60 - n_nationkey AS double) AS longitude,
            cast(n_nationkey * 150 AS bigint) AS elevation_m,
            round(l_extendedprice / 2797 + h, 6) AS temperature_2m, {absent},
            CASE h WHEN 0 THEN l_quantity WHEN 1 THEN l_quantity + 1 END AS wind_speed_10m,
            CASE WHEN h < 2 OR l_orderkey % 11 <> 0
              THEN strftime(l_shipdate + to_hours(cast(h AS int)), '%Y-%m-%d %H:%M:%S') END AS observation_ts,
            strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS ingested_at
            FROM lineitem LEFT JOIN nation ON l_suppkey % 27 = n_nationkey, range(3) hours(h)
            WHERE l_orderkey % 13 <> 0""",
        "station_payload": """SELECT concat('C', s_suppkey % 27) AS city_id,
            s_suppkey AS location_id, s_name AS location_name, s_suppkey * 10 + i AS sensor_id,
            CASE i WHEN 0 THEN 'pm25' ELSE 'no2' END AS parameter_name,
            CASE i WHEN 0 THEN 'µg/m³' ELSE 'ppb' END AS parameter_units
            FROM supplier, (VALUES (0), (2)) sensors(i)""",
        "measurement_payload": f"""SELECT {city} AS city_id, n_name AS city_name,
            s_suppkey AS location_id, s_name AS location_name, s_suppkey * 10 AS sensor_id,
            'pm25' AS parameter_name, 'µg/m³' AS parameter_units,
            CASE WHEN l_orderkey % 17 <> 0 THEN strftime(l_shipdate, '%Y-%m-%d') END
              AS observation_date,
            l_quantity AS value, CASE WHEN l_orderkey % 19 <> 0 THEN l_quantity - 1 END AS min_value,
            CASE WHEN l_orderkey % 19 <> 0 THEN l_quantity + 1 END AS max_value,
            CASE WHEN l_orderkey % 19 <> 0 THEN l_quantity END AS avg_value,
            cast(l_linenumber AS bigint) AS measurement_count,
            strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS ingested_at
            FROM lineitem LEFT JOIN nation ON l_suppkey % 27 = n_nationkey
            JOIN supplier ON l_suppkey = s_suppkey""",
        "month_windows": """SELECT o_custkey,
            cast(greatest(cast(m AS date), first_day) AS varchar) AS window_start,
            cast(least(last_day(cast(m AS date)), last_day_) AS varchar) AS window_end
            FROM (SELECT o_custkey, cast(min(o_orderdate) AS date) AS first_day,
                cast(max(o_orderdate) AS date) AS last_day_ FROM orders GROUP BY o_custkey),
              unnest(generate_series(date_trunc('month', first_day)::timestamp,
                last_day_::timestamp, INTERVAL 1 MONTH)) months(m)""",
        "trailing_window": _sql(
            _STAGED_AIR, "staged_air", ["staged_air"],
            "WHERE observation_date BETWEEN DATE '1998-06-01' AND DATE '1998-06-08'",
        ),
        "target_day": _sql(
            "city_id, observation_ts:ts, temperature_2m:num, precipitation:num,"
            " observation_date:date",
            "(SELECT *, cast(observation_ts AS date) AS observation_date FROM raw_weather)",
            ["raw_weather"], "WHERE observation_date = DATE '1998-06-08'",
        ),
        "scan_nanos": _sql(raw, "event_weather", ["event_weather"]),
        "scan_days": _sql(f"{raw}, day", "event_weather", ["event_weather"]),
        "sink_dynamic_overwrite": """SELECT event_id, event_type,
            round(value + CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN 1 ELSE 0 END, 6) AS value,
            strftime(ts, '%Y-%m-%d') AS day FROM events""",
        "sink_land_rerun": """SELECT event_id, event_type, value,
            year(ts) AS year, month(ts) AS month, day(ts) AS day FROM events WHERE cast(ts AS date) = DATE '2024-01-10'""",
        "sink_table_append": """SELECT strftime(ts, '%Y-%m-%d') AS day, event_type,
            2 * count(*) AS events, max(value) AS max_value FROM events GROUP BY ALL""",
        "mart_slice": _sql(
            _FCT_AIR, "fct_air", ["fct_air"],
            "WHERE observation_date BETWEEN DATE '1997-03-10' AND DATE '1998-02-20'"
            " AND city_id IN ('C1', 'C7', 'C26')",
        ),
        "stream_sink": f"""SELECT cast(event_id AS varchar) AS event_id,
            lpad(cast(user_id % 5 AS varchar), 3, '0') AS city_id,
            strftime(ts, '%Y-%m-%dT%H:%M') AS observed_ts, value AS temperature_c,
            event_type AS sensor_kind, NULL AS event_ts_utc, NULL AS city_name,
            {", ".join(f"cast(NULL AS double) AS {c}" for c in silent)}
            FROM events WHERE event_id % 31 <> 0 AND event_id % 37 <> 0 AND event_id % 41 <> 0""",
        # A cut line is kept in full; a whole line without a city keeps all its fields.
        # A line with a value that cannot be read names its city, which is its key.
        "stream_dead_letters": f"""SELECT
            CASE WHEN event_id % 37 <> 0 AND event_id % 31 <> 0
              THEN lpad(cast(user_id % 5 AS varchar), 3, '0') END AS key,
            CASE WHEN event_id % 37 = 0 THEN substring({event_line}, 1, 20)
              ELSE concat({event_line}, ',"temperature_c":',
                CASE WHEN event_id % 41 = 0 THEN '"warm"' ELSE cast(value AS varchar) END,
                ',"sensor_kind":"', event_type, '"}}') END AS value
            FROM events WHERE event_id % 31 = 0 OR event_id % 37 = 0 OR event_id % 41 = 0""",
    }


ORACLES = _oracles()
ORACLES |= {
    "stream_routed": f"{ORACLES['stream_sink']} UNION ALL BY NAME {ORACLES['stream_dead_letters']}",
    "stream_order": f"SELECT city_id, count(*) AS events, cast(0 AS bigint) AS inversions FROM ({ORACLES['stream_sink']}) GROUP BY 1",
    "scan_stream_table": ORACLES["stream_sink"],
    "scan_mixed": ORACLES["scan_nanos"],
    "stress_bucketed": ORACLES["stress_score"],
    "refresh_facts": " UNION ALL BY NAME ".join(
        f"SELECT * FROM ({ORACLES[name]})" for name in ("fct_weather", "fct_air", "stress_score")
    ),
    "mart_by_quarter": _sql(_FCT_AIR, "fct_air", ["fct_air"], "WHERE observation_quarter = 2"),
    "mart_by_zone": _sql(_FCT_AIR, "fct_air", ["fct_air"], "WHERE climate_zone = 'tierra_fria'"),
    "landing_rejects": """SELECT l_orderkey, cast(l_linenumber AS bigint) AS l_linenumber,
        concat('C', l_suppkey % 27) AS city_id,
        CASE WHEN l_orderkey % 17 = 0 THEN 'not JSON' WHEN l_orderkey % 19 = 0 THEN 'empty'
          WHEN l_orderkey % 23 = 0 THEN 'hourly.time is no array'
          WHEN l_orderkey % 29 = 0 THEN 'no hourly.time' WHEN l_orderkey % 31 = 0 THEN 'empty'
          WHEN l_orderkey % 13 = 0 THEN 'no hourly.time' END AS reason
        FROM lineitem""",
    "namespace_tables": _sql(
        "city_id, city_name, department, latitude:num, longitude:num, elevation_m, population,"
        " timezone, climate_zone, population_tier", "dim", ["dim"],
    ),
}
