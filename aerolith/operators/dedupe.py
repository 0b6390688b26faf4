"""Keep the latest version of each row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def dedupe_latest(
    df: DataFrame, keys: Sequence[str], latest: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """One row per `keys`: the one with the greatest `latest`.

    Ties go by `tiebreak`, then by all other columns, so the result does not depend on row order.
    `row_number() = 1` lets Spark drop all but the first row of a key on the map side already
    (WindowGroupLimit before the exchange), so a key with very many copies never meets in one task.
    """
    named = [*keys, latest, *tiebreak]
    rest = [c for c in df.columns if c not in named]
    order = [F.desc_nulls_last(latest), *[F.asc_nulls_last(c) for c in [*tiebreak, *rest]]]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
