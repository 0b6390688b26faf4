"""Bring stored marts up to date with one landing, without building them anew.

A landing touches some days of some cities. Those days are worked out again from the raw feeds, where
a semi-join keeps only their rows; of the stored mart only the months that hold such a day are read
and replaced. All other files stay as they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from aerolith.operators.daily import CITY_DAY, air_daily
from aerolith.plans import warehouse as W
from aerolith.session import stored
from aerolith.sources.sinks import with_month, write_parquet

MONTH = ["observation_year", "observation_month"]
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder name for NULL
WEATHER, AIR, STRESS = "fct_weather_daily", "fct_air_quality_daily", "fct_environmental_stress"


def touched_days(spark: SparkSession, *landed: DataFrame) -> DataFrame:
    """City and day of all landed rows, each once, with the month the marts keep it in; stored.

    Frames have city_id and either observation_date or observation_ts. Rows without a day touch the
    mart's rows without one.
    """
    day = lambda df: (
        F.col("observation_date").try_cast("date") if "observation_date" in df.columns else F.to_date("observation_ts")
    )
    days = [df.select("city_id", day(df).alias("observation_date")) for df in landed]
    every = reduce(DataFrame.unionByName, days).distinct()
    return stored(
        every.withColumns({MONTH[0]: F.year("observation_date"), MONTH[1]: F.month("observation_date")}), "touched"
    )


def only_days(df: DataFrame, touched: DataFrame, day: Column) -> DataFrame:
    """The rows of `df` that lie on a touched day of their city. The list carries its true size, so
    Spark broadcasts it while it is small; a city or day that is NULL matches itself."""
    keys = touched.select(F.col("city_id").alias("_city"), F.col("observation_date").alias("_day"))
    return df.join(keys, df["city_id"].eqNullSafe(keys["_city"]) & day.eqNullSafe(keys["_day"]), "left_semi")


def replace_days(
    spark: SparkSession, path: str, fresh: DataFrame, touched: DataFrame, cluster_by: Sequence[str]
) -> int:
    """Put `fresh`, the mart's rows of the touched days, in the place of those that are stored.

    Touched months are put together in the shared folder first and then written over the stored
    ones, so the mart is never read while it is written, and a job that failed can be run again.
    Months that keep no row are removed. Returns the number of months written or removed.
    """
    months = [(r[0], r[1]) for r in touched.select(*MONTH).distinct().collect()]  # a line per month
    if not months:
        return 0
    mart = read_mart(spark, path, fresh)
    here = reduce(lambda a, b: a | b, [F.col(MONTH[0]).eqNullSafe(F.lit(y)) & F.col(MONTH[1]).eqNullSafe(F.lit(m)) for y, m in months])
    same = [F.col(f"o.{c}").eqNullSafe(F.col(f"t.{c}")) for c in CITY_DAY]
    kept = mart.filter(here).alias("o").join(touched.alias("t"), same[0] & same[1], "left_anti")
    together = stored(kept.unionByName(fresh.select(mart.columns)), "touched-months")
    write_parquet(together, path, MONTH, cluster_by)
    left = {(r[0], r[1]) for r in together.select(*MONTH).distinct().collect()}
    for month in set(months) - left:
        parts = [f"{name}={_NO_VALUE if value is None else value}" for name, value in zip(MONTH, month)]
        _remove(spark, "/".join([path.rstrip("/"), *parts]))
    return len(months)


def read_mart(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """A stored mart with the columns of `like`: no file is opened for its schema, and there may be none."""
    return spark.read.schema(with_month(like).schema).parquet(path)


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def refresh_warehouse(
    spark: SparkSession,
    hist: DataFrame,
    daily: DataFrame,
    air: DataFrame,
    out: str,
    landed_weather: DataFrame | None = None,
    landed_air: DataFrame | None = None,
    stream: DataFrame | None = None,
    dedupe_air: bool = False,
) -> dict[str, int]:
    """Update the facts below `out` (see build_warehouse) after a landing; the months written of each.

    The feeds are the whole raw ones with the landing in them. The result equals a full rebuild as
    long as the dimension is unchanged. The stress mart follows both landings.
    """
    root = out.rstrip("/")
    dim = spark.read.parquet(f"{root}/dim_cities")
    hours, readings = W.stage_weather(hist, daily, stream), W.stage_air(air)

    def weather(hours: DataFrame) -> DataFrame:
        return W.fct_weather(W.weather_days(hours, stream is not None), dim)

    def pollution(readings: DataFrame) -> DataFrame:
        return W.fct_air(air_daily(readings, dedupe_air), dim)

    paths = {name: f"{root}/{name}" for name in (WEATHER, AIR, STRESS)}
    written = {}
    if landed_weather is not None:
        touched = touched_days(spark, landed_weather)
        fresh = weather(only_days(hours, touched, F.to_date("observation_ts")))
        written[WEATHER] = replace_days(spark, paths[WEATHER], fresh, touched, ["city_id"])
    if landed_air is not None:
        touched = touched_days(spark, landed_air)
        fresh = pollution(only_days(readings, touched, F.col("observation_date")))
        written[AIR] = replace_days(spark, paths[AIR], fresh, touched, ["city_id", "parameter_name"])
    landed = [df for df in (landed_weather, landed_air) if df is not None]
    if landed:
        touched = touched_days(spark, *landed)
        facts = [
            only_days(read_mart(spark, paths[name], like), touched, F.col("observation_date"))
            for name, like in ((WEATHER, weather(hours)), (AIR, pollution(readings)))
        ]
        written[STRESS] = replace_days(spark, paths[STRESS], W.fct_stress(*facts), touched, ["city_id"])
    return written
