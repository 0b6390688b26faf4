"""Word rules, column names and running totals that the corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# Words are runs of characters other than ASCII white space.
WHITE = r"\x20\x09-\x0D"
WORD = rf"[^{WHITE}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """`body` of `value`, which is evaluated once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running_total(
    df: DataFrame, group: str, bucket: str, order: Sequence[str], value: Column, alias: str
) -> DataFrame:
    """Add `alias`: the sum of `value` over the rows of the group before this one."""
    return running(df, group, bucket, order, {alias: (F.sum, lambda a, b: a + b, value)})


def running(
    df: DataFrame,
    group: str,
    bucket: str,
    order: Sequence[str],
    columns: dict[str, tuple[Callable, Callable, Column]],
) -> DataFrame:
    """Add columns that gather a value over the rows of the group before this one, 0 if none.

    Each column is (aggregate, how to combine two of its results, value). Rows go by bucket, then by
    `order`. No task sees more of a group than one bucket, whatever its share of the rows: bucket
    totals come first, then each bucket starts at what is before it. The frame is read twice, so it
    should be stored. Rows equal in bucket and order may take each other's places.
    """
    before = (Window.unboundedPreceding, -1)
    along = Window.partitionBy("_g").orderBy("_b").rowsBetween(*before)
    inside = Window.partitionBy(group, bucket).orderBy(*order).rowsBetween(*before)
    zero = F.lit(0).cast("long")
    totals = df.groupBy(F.col(group).alias("_g"), F.col(bucket).alias("_b")).agg(
        *[gather(value).alias(f"_all_{name}") for name, (gather, _, value) in columns.items()]
    )
    starts = totals.select(
        "_g",
        "_b",
        *[
            F.coalesce(gather(f"_all_{name}").over(along), zero).alias(f"_start_{name}")
            for name, (gather, _, _) in columns.items()
        ],
    )
    placed = df.withColumns({
        f"_in_{name}": F.coalesce(gather(value).over(inside), zero)
        for name, (gather, _, value) in columns.items()
    })
    joined = placed.join(starts, F.col(group).eqNullSafe(F.col("_g")) & (F.col(bucket) == F.col("_b")))
    return joined.select(
        *[df[c] for c in df.columns],
        *[
            combine(F.col(f"_start_{name}"), F.col(f"_in_{name}")).alias(name)
            for name, (_, combine, _) in columns.items()
        ],
    )
