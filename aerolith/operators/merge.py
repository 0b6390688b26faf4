"""Bring versions of one hour from several feeds together, measure by measure."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from aerolith import fixed

_HOUR = "observation_ts"


def feed_rank(ranks: Mapping[str, int], kind: str = "source_kind") -> Column:
    """How much a feed counts; one that is not listed counts least."""
    rank = F
    for name, value in ranks.items():
        rank = rank.when(F.col(kind) == name, F.lit(value))
    return rank.otherwise(F.lit(min(ranks.values()) - 1))


def merge_hours(staged: DataFrame, ranks: Mapping[str, int] = fixed.FEED_RANKS) -> DataFrame:
    """One row per city and hour of staged weather, with every value from the best feed that has it.

    Times are brought to the hour they lie in. Each measure is the one of the highest-ranked feed in
    which it is not NULL, there of the latest version; ties go to the greater value, so results do
    not depend on row order. A live sensor thus fills hours and measures that the pulled feeds lack
    and replaces nothing that they have. `source_kind` is the best feed present, `ingested_at` the
    latest of all versions. Rows without a time make an hour of their own, as in grouping.

    One aggregation with partial results before its exchange: an hour with very many events sends one
    row per task.
    """
    version = [feed_rank(ranks).alias("rank"), F.col("ingested_at").alias("at")]

    def best(name: str) -> Column:
        whole = F.struct(*version, F.col(name).alias("value"))
        return F.max(F.when(F.col(name).isNotNull(), whole))["value"].alias(name)

    keys = ("city_id", _HOUR, "source_kind", "ingested_at")
    merged = staged.withColumn(_HOUR, F.date_trunc("hour", _HOUR)).groupBy("city_id", _HOUR).agg(
        *[best(name) for name in staged.columns if name not in keys],
        best("source_kind"),
        F.max("ingested_at").alias("ingested_at"),
    )
    return merged.select(*staged.columns)
