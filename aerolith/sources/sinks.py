"""Parquet and table sinks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, functions as F


def arrange(df: DataFrame, partition_by: Sequence[str], cluster_by: Sequence[str]) -> DataFrame:
    """Bring the rows of a partition (else clustering) value together, ordered for clustering.

    The rebalance hint gives few files per partition value, yet lets adaptive execution split a
    value that holds far more rows than the others over several tasks. The order inside each file
    gives row groups narrow min/max ranges, so that scans filtered on those columns skip data.
    """
    if partition_by or cluster_by:
        df = df.hint("rebalance", *(partition_by or cluster_by))
    if cluster_by:
        df = df.sortWithinPartitions(*partition_by, *cluster_by)
    return df


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    *,
    dynamic: bool = True,
) -> None:
    """Overwrite snappy parquet at `path`.

    With partition columns only the partitions present in `df` are replaced; `dynamic=False`
    replaces the whole folder.
    """
    mode = "dynamic" if dynamic and partition_by else "static"
    writer = _writer(df, partition_by, cluster_by, "overwrite")
    writer.option("partitionOverwriteMode", mode).parquet(path)


def write_table(
    df: DataFrame,
    table: str,
    *,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    mode: str = "overwrite",
    path: str | None = None,
) -> None:
    """Replace (`overwrite`) or extend (`append`) a catalog table, stored at `path` if given."""
    writer = _writer(df, partition_by, cluster_by, mode).format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def write_bucketed(
    df: DataFrame, table: str, keys: Sequence[str], buckets: int, *, path: str | None = None
) -> None:
    """Replace a catalog table bucketed and sorted by `keys`, stored at `path` if given.

    Tables with equal keys and numbers of buckets join and aggregate on those keys without an
    exchange. Rows are brought to their bucket before writing, so there is a file for each.
    """
    writer = df.repartition(buckets, *keys).write.mode("overwrite").format("parquet")
    writer = writer.option("compression", "snappy").bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def with_month(df: DataFrame, on: str = "observation_date") -> DataFrame:
    """Add the month partition columns a fact is stored by, where it lacks them."""
    parts = {"observation_year": F.year(on), "observation_month": F.month(on)}
    return df.withColumns({name: part for name, part in parts.items() if name not in df.columns})


def write_mart(
    df: DataFrame, target: str, cluster_by: Sequence[str] = ("city_id",), *, as_table: bool = False
) -> None:
    """Store a mart by month of observation_date (if it has one), clustered within each month."""
    months: Sequence[str] = ()
    if "observation_date" in df.columns:
        df, months = with_month(df), ("observation_year", "observation_month")
    if as_table:
        write_table(df, target, partition_by=months, cluster_by=cluster_by)
    else:
        write_parquet(df, target, months, cluster_by, dynamic=False)


def land_day(df: DataFrame, root: str, day: str | date) -> None:
    """Land one run's rows below year/month/day of `day`; a second run replaces the first.

    An empty frame is refused, so that a failed fetch cannot wipe a good landing.
    """
    if df.isEmpty():
        raise ValueError(f"no rows to land for {day}")
    d = F.to_date(F.lit(str(day)))
    stamped = df.withColumns({"year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d)})
    # All rows go to one folder: no shuffle, one file per task.
    writer = stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("year", "month", "day").option("compression", "snappy").parquet(root)


def ensure_namespace(spark: SparkSession, name: str, path: str | None = None) -> None:
    """Create the namespace unless it is there; its tables are stored below `path` if given."""
    where = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def _writer(df, partition_by, cluster_by, mode) -> DataFrameWriter:
    writer = arrange(df, partition_by, cluster_by).write.mode(mode).option("compression", "snappy")
    return writer.partitionBy(*partition_by) if partition_by else writer
