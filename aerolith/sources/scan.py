"""Scans of the raw layers: hive-partitioned parquet, external tables, the city seed."""

from __future__ import annotations

from datetime import date
from functools import reduce

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from aerolith import fixed, schemas
from aerolith.functions.columns import nanos_to_timestamp

TIME_COLUMNS = ("observation_ts", "ingested_at")


def with_partitions(schema: T.StructType, partitions: T.StructType) -> T.StructType:
    """File columns followed by path columns; a column found in both comes from the path."""
    names = set(partitions.names)
    return T.StructType([f for f in schema if f.name not in names] + list(partitions))


def read_partitioned(
    spark: SparkSession, path: str, schema: T.StructType, partitions: T.StructType
) -> DataFrame:
    """Scan with an explicit schema, so no file is opened to infer one."""
    return spark.read.schema(with_partitions(schema, partitions)).parquet(path)


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """Hourly weather in either layout, with time columns that arrive as nanoseconds converted.

    The schema is that of all footers together, so a column that only some files have is kept. A
    folder may hold files with nanosecond times beside files with microseconds: they are told apart
    by their footers, each group is read with its own schema, and the groups are put together.
    Needs spark.sql.legacy.parquet.nanosAsLong for nanosecond files.
    """
    whole = merged_schema(spark, [path], path)
    if whole is not None:
        return convert_nanos(spark.read.schema(pin_city(whole)).parquet(path))
    groups: dict[tuple, tuple[T.StructType, list[str]]] = {}
    for schema, files in alike(spark, data_files(spark, path), path):
        units = tuple(schema[name].dataType.simpleString() for name in TIME_COLUMNS if name in schema.names)
        known, before = groups.get(units, (schema, []))
        more = [f for f in schema if f.name not in known.names]
        groups[units] = T.StructType([*known, *more]), before + files
    frames = [
        convert_nanos(spark.read.schema(pin_city(schema)).option("basePath", path).parquet(*files))
        for schema, files in groups.values()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def merged_schema(spark: SparkSession, files: list[str], root: str) -> T.StructType | None:
    """The schema of all footers together, which Spark reads in tasks; None if they do not agree."""
    reader = spark.read.option("mergeSchema", "true").option("basePath", root)
    try:
        return reader.parquet(*files).schema
    except (PySparkException, Py4JJavaError) as failed:
        # Raised on the driver or in a task, which wraps it.
        if "CANNOT_MERGE_SCHEMAS" not in str(failed):
            raise
        return None


def data_files(spark: SparkSession, path: str) -> list[str]:
    """All Parquet files, the oldest first: a writer that changes does so at one point in time.

    As many paths as a scan of the folder lists on the driver anyway.
    """
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return [r["path"] for r in found.select("path", "modificationTime").orderBy("modificationTime", "path").collect()]


def alike(spark: SparkSession, files: list[str], root: str) -> list[tuple[T.StructType, list[str]]]:
    """Runs of files whose schemas agree, with their common schema, found by halving.

    A single change costs about as many looks as the number of files has binary digits; each look
    is one job over the footers of half as many files as the one before.
    """
    schema = merged_schema(spark, files, root)
    if schema is not None:
        return [(schema, files)]
    middle = len(files) // 2
    return alike(spark, files[:middle], root) + alike(spark, files[middle:], root)


def pin_city(found: T.StructType) -> T.StructType:
    """The schema with city_id as string: a numeric-looking path value keeps its leading zeros."""
    return T.StructType(
        [T.StructField("city_id", T.StringType()) if f.name == "city_id" else f for f in found]
    )


def convert_nanos(df: DataFrame) -> DataFrame:
    arrived_as_long = [name for name, kind in df.dtypes if name in TIME_COLUMNS and kind == "bigint"]
    return df.withColumns({name: nanos_to_timestamp(name) for name in arrived_as_long})


def is_sink_output(spark: SparkSession, path: str) -> bool:
    """Whether a streaming query has written this folder; its log then says which files count."""
    log = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_spark_metadata")
    return log.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(log)


def register_stream(spark: SparkSession, name: str, path: str) -> DataFrame:
    """(Re)define `name` over a streaming sink's folder, as a view on reading the path: that honours
    the sink's log, so files of batches that were not committed are never seen. A table over the
    files would see them, and Spark finds no partitions to recover below such a folder."""
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{path}`")
    return spark.table(name)


def register_external(
    spark: SparkSession, table: str, path: str, schema: T.StructType, partitions: T.StructType
) -> DataFrame:
    """(Re)define `table` over parquet files that stay where they are."""
    full = with_partitions(schema, partitions)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full)
    by = ", ".join(f"`{name}`" for name in partitions.names)
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType == "VIEW":
        spark.sql(f"DROP VIEW {table}")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({by}) LOCATION '{path}'")
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    return spark.table(table)


def read_cities(spark: SparkSession, path: str | None = None) -> DataFrame:
    """City seed with declared types: a CSV with a header, or the built-in eight cities.

    Both carry a true size estimate, so Spark itself decides whether a join may broadcast it.
    """
    if path:
        return spark.read.schema(schemas.CITIES).option("header", True).csv(path)
    columns = zip(*fixed.CITIES)
    table = pa.table(dict(zip(schemas.CITIES.names, map(list, columns))))
    return spark.createDataFrame(table)


def between_dates(
    df: DataFrame,
    start: str | date,
    end: str | date,
    *,
    on: str = "observation_date",
    year: str = "observation_year",
    month: str = "observation_month",
) -> DataFrame:
    """Rows dated within [start, end]; also bounds the month partitions so that files are pruned."""
    first, last = F.to_date(F.lit(str(start))), F.to_date(F.lit(str(end)))
    df = df.filter(F.col(on).between(first, last))
    if {year, month} <= set(df.columns):
        months = F.col(year) * 12 + F.col(month)
        df = df.filter(months.between(_months(first), _months(last)))
    return df


def for_cities(df: DataFrame, cities: list[str]) -> DataFrame:
    return df.filter(F.col("city_id").isin(cities))


def trailing_window(
    df: DataFrame, end: str | date | Column | None = None, days: int = 7, on: str = "observation_date"
) -> DataFrame:
    """Rows dated within [end - days, end], both ends included; `end` defaults to yesterday."""
    last = _day(end)
    return df.filter(F.col(on).between(F.date_sub(last, days), last))


def target_day(
    df: DataFrame, day: str | date | Column | None = None, on: str = "observation_date"
) -> DataFrame:
    """Rows of one day; yesterday unless overridden."""
    return df.filter(F.col(on) == _day(day))


def month_windows(df: DataFrame, start: str, end: str) -> DataFrame:
    """One row per calendar month that [start, end] touches, clipped to the range."""
    first, last = F.to_date(start), F.to_date(end)
    months = F.sequence(F.trunc(first, "MM"), last, F.expr("interval 1 month"))
    windows = df.filter(first <= last).withColumn("month_start", F.explode(months))
    return windows.withColumns(
        {
            "window_start": F.greatest(F.col("month_start"), first),
            "window_end": F.least(F.last_day("month_start"), last),
        }
    ).drop("month_start")


def _months(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def _day(day: str | date | Column | None) -> Column:
    if day is None:
        return F.date_sub(F.current_date(), 1)
    return day if isinstance(day, Column) else F.to_date(F.lit(str(day)))
