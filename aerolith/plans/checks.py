"""The checks declared for each model."""

from __future__ import annotations

from functools import reduce
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from aerolith.fixed import (
    CLIMATE_ZONES, POLLUTANTS, POPULATION_TIERS, SCORE_CAP, TOP_CLIMATE_ZONE, TOP_POPULATION_TIER,
)
from aerolith.operators.quality import (
    Check, accepted_range, accepted_values, not_null, relationship, row_condition, run_checks, unique,
)

_ZONES = [name for _, name in CLIMATE_ZONES] + [TOP_CLIMATE_ZONE]
_TIERS = [name for _, name in POPULATION_TIERS] + [TOP_POPULATION_TIER]
_CITY = [not_null("city_id"), relationship("city_id", "cities")]
_MART_CITY = [not_null("city_id"), relationship("city_id", "dim_cities")]
_POLLUTANT = [not_null("parameter_name"), accepted_values("parameter_name", POLLUTANTS)]

CHECKS = {
    "raw_weather": [not_null("city_id"), not_null("observation_ts")],
    "raw_air_quality": [not_null("city_id"), *_POLLUTANT, not_null("observation_date")],
    "cities": [
        unique("city_id"),
        not_null("city_id"),
        not_null("name"),
        not_null("latitude"),
        accepted_range("latitude", -90, 90),
        not_null("longitude"),
        accepted_range("longitude", -180, 180),
        not_null("elevation_m"),
        not_null("population"),
        not_null("timezone"),
    ],
    "stg_weather": [
        *_CITY,
        not_null("observation_ts"),
        accepted_range("temperature_c", -15, 50, "warn"),
        accepted_range("relative_humidity_pct", 0, 100, "warn"),
    ],
    "stg_air_quality": [
        *_CITY, *_POLLUTANT, not_null("value"), not_null("observation_date"),
    ],
    "dim_cities": [
        unique("city_id"),
        not_null("city_id"),
        accepted_values("climate_zone", _ZONES),
        accepted_values("population_tier", _TIERS),
    ],
    "fct_weather_daily": [
        unique("weather_sk"),
        not_null("weather_sk"),
        *_MART_CITY,
        not_null("observation_date"),
        accepted_range("avg_temperature_c", -15, 45, "warn"),
    ],
    "fct_air_quality_daily": [
        unique("air_quality_sk"), not_null("air_quality_sk"), *_MART_CITY, *_POLLUTANT,
    ],
    "fct_environmental_stress": [
        unique("stress_sk"),
        not_null("stress_sk"),
        *_MART_CITY,
        accepted_range("environmental_stress_score", 0, SCORE_CAP),
    ],
}


class Watch:
    """Checks on single rows, counted while the jobs that read the models run anyway.

    `over` marks a frame; whatever is built from the marked frame counts its failing rows on the way,
    and `report` gives the totals once those jobs are done. Frames marked for one model add up. A
    task that is run again after its executor was lost may count its rows twice: a failed check can
    show more failures than there are, but never turns into a passed one, nor the other way round.
    """

    def __init__(self):
        self._marks: list[tuple[str, list[Check], Observation]] = []

    def over(self, model: str, df: DataFrame) -> DataFrame:
        checks = [c for c in CHECKS[model] if row_condition(c) is not None]
        if not checks:
            return df
        mark = Observation(f"{model}-{uuid4().hex}")
        self._marks.append((model, checks, mark))
        return df.observe(mark, *[F.count_if(row_condition(c)).alias(f"_{i}") for i, c in enumerate(checks)])

    def counted(self, model: str) -> list[Check]:
        return [c for name, checks, _ in self._marks if name == model for c in checks]

    def report(self, spark: SparkSession) -> DataFrame:
        """The lines of all marked models. Only after the jobs: it waits for their counts."""
        failures: dict[tuple[str, Check], int] = {}
        for model, checks, mark in self._marks:
            found = mark.get
            for i, check in enumerate(checks):
                failures[model, check] = failures.get((model, check), 0) + found[f"_{i}"]
        lines = [(model, c.column, c.kind, c.severity, n) for (model, c), n in failures.items()]
        names = ["model", "column", "test", "severity", "failures"]
        kinds = [pa.string()] * 4 + [pa.int64()]
        columns = list(zip(*lines)) or [()] * 5
        return spark.createDataFrame(pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names))


def check_models(
    models: dict[str, DataFrame], cities: DataFrame, watch: Watch | None = None
) -> DataFrame:
    """One report over all the given models that have checks. Marts refer to `dim_cities`, the rest
    to the list of cities; where no `dim_cities` is given, that list stands in. What `watch` has
    counted is reported from there and not looked for again."""
    parents = {"cities": cities, "dim_cities": models.get("dim_cities", cities)}
    reports = [watch.report(cities.sparkSession)] if watch else []
    for name, df in models.items():
        counted = watch.counted(name) if watch else []
        checks = [c for c in CHECKS.get(name, []) if c not in counted]
        if checks:
            reports.append(run_checks(name, df, checks, parents))
    return reduce(DataFrame.unionByName, reports)
