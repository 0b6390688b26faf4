"""Exact percentiles per group in one lazy plan that stays safe when a group holds much of the data.

Spark's exact percentile keeps a map of all distinct values of a group in one task. Here equal values
are counted first, which the map side begins before any exchange. Counts per fine bucket of values
tell which bucket holds the wanted rank, and only that bucket is looked into. No task brings a whole
group together: one sees its bucket totals, another the distinct values of one bucket.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

# A bucket spans 1/1024 octave, 0.07 % of a value: readings of usual precision have a few distinct
# values in each, and a group spread over ten octaves has about 10,000 bucket totals.
_BUCKETS_PER_OCTAVE = 1024
_UPTO = (Window.unboundedPreceding, Window.currentRow)


def rank_percentile(df: DataFrame, keys: Sequence[str], value: str, q: float, alias: str) -> DataFrame:
    """Exact interpolated percentile `q` of the rows' `value` per group, NULL values left out.

    Groups without a non-NULL value are absent from the result.
    """
    v = F.col(value).cast("double").alias("v")
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, v).agg(F.count(F.lit(1)).alias("w"))
    return weighted_percentile(counted, keys, q, alias)


def weighted_percentile(counted: DataFrame, keys: Sequence[str], q: float, alias: str) -> DataFrame:
    """The same from counted values: rows of the keys, a double `v` and how often it occurs, `w`.

    A value of a group may have several rows.
    """
    keys = list(keys)
    rows = counted.select(*keys, "v", "w", _magnitude(F.col("v")).alias("b"))
    totals = rows.groupBy(*keys, "b").agg(F.sum("w").alias("bw"))
    group = Window.partitionBy(*keys)
    position = (F.sum("bw").over(group) - 1) * F.lit(float(q))
    low, high = F.floor("position"), F.ceil("position")
    exact = low == high
    sides = F.array(
        _side("low", low, F.when(exact, F.lit(1.0)).otherwise(high - F.col("position"))),
        _side("high", high, F.when(exact, F.lit(0.0)).otherwise(F.col("position") - low)),
    )
    before = F.sum("bw").over(group.orderBy("b").rowsBetween(*_UPTO)) - F.col("bw")
    wanted = (
        totals.withColumns({"position": position, "before": before})
        .select(*keys, "b", "bw", "before", F.inline(sides))
        .filter((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("bw")))
    )
    # Null-safe for the buckets too, which are never NULL: a filter inferred from plain equality
    # would make this side's counting differ from that of the totals, and both read one exchange.
    hit = _same_keys([*keys, "b"], "r", "w")
    inside = rows.alias("r").join(wanted.alias("w"), hit).select(
        *[F.col(f"r.{k}").alias(k) for k in keys],
        F.col("r.v").alias("v"), F.col("r.w").alias("w"), F.col("w.side").alias("side"),
        (F.col("w.rank") - F.col("w.before")).alias("rank"), F.col("w.share").alias("share"),
    )
    upto = F.sum("w").over(Window.partitionBy(*keys, "side").orderBy("v").rowsBetween(*_UPTO))
    found = inside.withColumn("upto", upto).filter(
        (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("w"))
    )
    # A side of weight 0 must not turn an infinite value into NaN.
    part = F.when(F.col("share") == 0, F.lit(0.0)).otherwise(F.col("share") * F.col("v"))
    return found.groupBy(*keys).agg(F.sum(part).alias(alias))


def _side(name: str, rank: Column, share: Column) -> Column:
    return F.struct(F.lit(name).alias("side"), rank.alias("rank"), share.alias("share"))


def _magnitude(v: Column) -> Column:
    """A bucket number that never falls as `v` rises, fine near 0 as well as for huge values."""
    size = F.abs(v)
    code = F.floor(F.log2(size) * _BUCKETS_PER_OCTAVE) + 2_000_000
    return (
        F.when(F.isnan(v), F.lit(5_000_000).cast("bigint"))
        .when(v == 0, F.lit(0).cast("bigint"))
        .when(size == float("inf"), F.signum(v).cast("bigint") * 4_000_000)
        .when(v > 0, code)
        .otherwise(-code)
    )


def _same_keys(keys: Sequence[str], left: str, right: str) -> Column:
    """Equality that also matches NULL keys, as grouping does."""
    pairs = [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]
    return reduce(lambda a, b: a & b, pairs)
