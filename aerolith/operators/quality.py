"""Declarative data checks, each a query over a table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Check:
    """One rule for one column. NULL passes every kind but not_null."""

    kind: str
    column: str
    severity: str = "error"
    values: tuple = ()
    low: float | None = None
    high: float | None = None
    parent: str | None = None


def not_null(column: str, severity: str = "error") -> Check:
    return Check("not_null", column, severity)


def unique(column: str, severity: str = "error") -> Check:
    return Check("unique", column, severity)


def relationship(column: str, parent: str, severity: str = "error") -> Check:
    """Every value must occur in the column of the same name in table `parent`."""
    return Check("relationships", column, severity, parent=parent)


def accepted_values(column: str, values: Sequence, severity: str = "error") -> Check:
    return Check("accepted_values", column, severity, values=tuple(values))


def accepted_range(
    column: str, low: float | None, high: float | None, severity: str = "error"
) -> Check:
    return Check("accepted_range", column, severity, low=low, high=high)


def row_condition(check: Check) -> Column | None:
    """Condition of a failing row, for the kinds that one row alone can fail."""
    column = F.col(check.column)
    if check.kind == "not_null":
        return column.isNull()
    if check.kind == "accepted_values":
        return ~column.isin(list(check.values))
    if check.kind == "accepted_range":
        bounds = [column < check.low] if check.low is not None else []
        bounds += [column > check.high] if check.high is not None else []
        return reduce(lambda a, b: a | b, bounds)
    return None


def failing(df: DataFrame, check: Check, parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """The rows (for `unique` and `relationships`: the values, with their row count) that fail."""
    condition = row_condition(check)
    if condition is not None:
        return df.filter(condition)
    counts = df.filter(F.col(check.column).isNotNull()).groupBy(check.column).agg(
        F.count(F.lit(1)).alias("rows")
    )
    if check.kind == "unique":
        return counts.filter("rows > 1")
    # Counting before the join leaves one row per value, however often a value occurs.
    known = parents[check.parent].select(check.column)
    return counts.join(known, check.column, "left_anti")


def run_checks(
    model: str, df: DataFrame, checks: Sequence[Check], parents: dict[str, DataFrame] | None = None
) -> DataFrame:
    """One row per check with its number of failures: duplicated values for `unique`, else rows.

    Checks on single rows and the relationships of one column share one pass over the table: rows
    are counted per value of that column, and the counts meet the parents. Each `unique`, and each
    further column with relationships, takes a pass of its own.
    """
    related = [c for c in checks if c.kind == "relationships"]
    shared = [c for c in checks if row_condition(c) is not None]
    column = related[0].column if related else None
    shared += [c for c in related if c.column == column]
    reports = [_in_one_pass(model, df, shared, column, parents or {})] if shared else []
    for check in checks:
        if check not in shared:
            bad = failing(df, check, parents)
            total = F.count(F.lit(1)) if check.kind == "unique" else F.sum("rows")
            failures = bad.agg(F.coalesce(total, F.lit(0)).alias("_n"))
            reports.append(failures.select(F.inline(F.array(_line(model, check, F.col("_n"))))))
    return reduce(DataFrame.unionByName, reports)


def _in_one_pass(
    model: str, df: DataFrame, checks: Sequence[Check], column: str | None,
    parents: dict[str, DataFrame],
) -> DataFrame:
    """Failures of checks on single rows and of relationships of `column`."""
    per_row = [(i, row_condition(c)) for i, c in enumerate(checks) if row_condition(c) is not None]
    counts = [F.count_if(condition).alias(f"_{i}") for i, condition in per_row]
    if column is None:
        counted = df.agg(*counts)
    else:
        by_value = df.groupBy(F.col(column).alias("_value")).agg(F.count(F.lit(1)).alias("_rows"), *counts)
        totals = [F.sum(f"_{i}").alias(f"_{i}") for i, _ in per_row]
        for i, check in enumerate(checks):
            if row_condition(check) is None:
                known = parents[check.parent].select(F.col(column).alias(f"_known_{i}")).distinct()
                by_value = by_value.join(known, F.col("_value") == F.col(f"_known_{i}"), "left")
                lost = F.col("_value").isNotNull() & F.col(f"_known_{i}").isNull()
                totals.append(F.sum(F.when(lost, F.col("_rows"))).alias(f"_{i}"))
        counted = by_value.agg(*totals)
    lines = [_line(model, c, F.coalesce(f"_{i}", F.lit(0).cast("bigint"))) for i, c in enumerate(checks)]
    return counted.select(F.inline(F.array(*lines)))


def _line(model: str, check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(model).alias("model"),
        F.lit(check.column).alias("column"),
        F.lit(check.kind).alias("test"),
        F.lit(check.severity).alias("severity"),
        failures.alias("failures"),
    )
