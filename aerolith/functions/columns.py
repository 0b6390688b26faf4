"""Column expressions shared by the models. All stay inside built-in Spark functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from aerolith import fixed


def surrogate_key(*columns: str | Column) -> Column:
    """md5 over the text of the key columns; NULL has its own text, so it differs from ''."""
    parts = [
        F.coalesce(_col(c).cast("string"), F.lit(fixed.KEY_NULL_TEXT)) for c in columns
    ]
    return F.md5(F.concat_ws(fixed.KEY_SEPARATOR, *parts))


def nanos_to_timestamp(nanos: str | Column) -> Column:
    """Nanoseconds since the epoch to a timestamp, rounded down, in whole-number arithmetic."""
    n = _col(nanos)
    return F.timestamp_micros(F.call_function("div", n - F.pmod(n, F.lit(1000)), F.lit(1000)))


def bucket(value: str | Column, bounds: Sequence[tuple[int, str]], top: str) -> Column:
    """Label of the first bound the value lies below; `top` beyond all of them or for NULL."""
    label = F.lit(top)
    for upper, name in reversed(bounds):
        label = F.when(_col(value) < upper, F.lit(name)).otherwise(label)
    return label


def climate_zone(elevation: str | Column) -> Column:
    return bucket(elevation, fixed.CLIMATE_ZONES, fixed.TOP_CLIMATE_ZONE)


def population_tier(population: str | Column) -> Column:
    return bucket(population, fixed.POPULATION_TIERS, fixed.TOP_POPULATION_TIER)


def normalised_value(name: str | Column, units: str | Column, value: str | Column) -> Column:
    """Reading in the normalised unit; NULL for a pollutant in any other unit."""
    return _unit_case(name, units, lambda factor, _: _col(value) * factor)


def normalised_units(name: str | Column, units: str | Column) -> Column:
    return _unit_case(name, units, lambda _, unit: F.lit(unit))


def _unit_case(name, units, result) -> Column:
    case = F
    for pollutants, unit, factor, to_unit in fixed.UNIT_RULES:
        case = case.when(
            _col(name).isin(pollutants) & (_col(units) == unit), result(factor, to_unit)
        )
    return case


def exceeds_guideline(name: str | Column, median: str | Column) -> Column:
    """True where the median lies above the pollutant's guideline; never NULL."""
    above = F.lit(False)
    for pollutant, limit in fixed.GUIDELINES.items():
        above = above | ((_col(name) == pollutant) & (_col(median) > limit))
    return F.coalesce(above, F.lit(False))


def stress_score(apparent: str | Column, pollutants: dict[str, str | Column]) -> Column:
    """0-100 score. A missing input adds 0: Spark's least/greatest skip NULL, so test for it."""
    heat = (_col(apparent) - fixed.HEAT_BASE_C) * fixed.HEAT_POINTS_PER_C
    total = _points(_col(apparent), F.greatest(heat, F.lit(0.0)), fixed.HEAT_CAP)
    for name, per_unit, cap in fixed.POLLUTANT_POINTS:
        level = _col(pollutants[name])
        total = total + _points(level, level * per_unit, cap)
    return F.least(F.greatest(total, F.lit(0.0)), F.lit(float(fixed.SCORE_CAP)))


def _points(source: Column, points: Column, cap: int) -> Column:
    return F.when(source.isNull(), F.lit(0.0)).otherwise(F.least(points, F.lit(float(cap))))


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column
