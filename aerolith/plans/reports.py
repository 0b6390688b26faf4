"""Dashboard questions as queries over the marts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from aerolith.operators.climate import heat_episodes
from aerolith.sources.scan import between_dates, for_cities


def rank_exceedance(air: DataFrame) -> DataFrame:
    """Cities ranked, per pollutant, by the share of days above the guideline.

    The ranking window holds one row per city, after the days were aggregated.
    """
    rates = air.groupBy("parameter_name", "city_id").agg(
        F.count(F.lit(1)).alias("days"),
        F.count_if("exceeds_who_guideline").alias("days_above"),
        F.avg(F.col("exceeds_who_guideline").cast("int")).alias("share_above"),
    )
    worst_first = Window.partitionBy("parameter_name").orderBy(F.desc("share_above"))
    return rates.withColumn("worst_rank", F.rank().over(worst_first))


def heat_trend(daily: DataFrame, q: float = 0.95, min_run: int = 3) -> DataFrame:
    """Heat waves per city and year: how many, how long."""
    return (
        heat_episodes(daily, q, min_run)
        .groupBy("city_id", F.year("first_day").alias("year"))
        .agg(
            F.count(F.lit(1)).alias("heat_waves"),
            F.sum("heat_days").alias("heat_wave_days"),
            F.avg("heat_days").alias("avg_length"),
            F.max("heat_days").alias("max_length"),
        )
    )


def top_stress(stress: DataFrame, k: int = 5) -> DataFrame:
    """The k cities with the highest mean score, with the mean number of pollutants measured."""
    return (
        stress.groupBy("city_id")
        .agg(
            F.avg("environmental_stress_score").alias("avg_score"),
            F.max("environmental_stress_score").alias("max_score"),
            F.avg(F.coalesce("pollutants_measured", F.lit(0))).alias("avg_pollutants_measured"),
            F.count(F.lit(1)).alias("days"),
        )
        .orderBy(F.desc("avg_score"), "city_id")
        .limit(k)
    )


def rain_correlation(stress: DataFrame, pollutant: str = "pm25") -> DataFrame:
    """Correlation of a pollutant with rainfall over the days of each climate zone.

    A stress mart that is not stored works out all pollutants first, as a filter cannot pass the
    pivot: build it from the readings of this pollutant alone.
    """
    both = F.col(pollutant).isNotNull() & F.col("total_precipitation_mm").isNotNull()
    return (
        stress.filter(both)
        .groupBy("climate_zone")
        .agg(
            F.corr(pollutant, "total_precipitation_mm").alias("rain_correlation"),
            F.count(F.lit(1)).alias("days"),
        )
    )


def outliers(weather: DataFrame, measure: str, z: float = 3.0) -> DataFrame:
    """Days further than z standard deviations from the city's mean for the calendar month."""
    peers = Window.partitionBy("city_id", F.month("observation_date"))
    mean, spread = F.avg(measure).over(peers), F.stddev(measure).over(peers)
    score = F.when(spread > 0, (F.col(measure) - mean) / spread)
    return (
        weather.select("city_id", "observation_date", measure, score.alias("z_score"))
        .filter(F.abs("z_score") > z)
    )


def dashboard_slice(
    mart: DataFrame, start: str | date, end: str | date, cities: list[str] | None = None
) -> DataFrame:
    """The date-range and city filters; both reach the scan of a stored mart."""
    mart = between_dates(mart, start, end)
    return for_cities(mart, cities) if cities else mart


def calendar(spark: SparkSession, first: str | date, last: str | date) -> DataFrame:
    """A row per month from `first` to `last`, with what months are chosen by."""
    months = F.explode(F.sequence(F.trunc(F.to_date(F.lit(str(first))), "MM"), F.to_date(F.lit(str(last))), F.expr("interval 1 month")))
    return spark.range(1).select(months.alias("first_day")).select(
        F.year("first_day").alias("observation_year"),
        F.month("first_day").alias("observation_month"),
        F.quarter("first_day").alias("quarter"),
        F.dayofmonth(F.last_day("first_day")).alias("days"),
    )


def slice_by_months(mart: DataFrame, months: DataFrame) -> DataFrame:
    """The mart's rows of the given months. Of a stored mart, only their folders are read: the
    filter on the months reaches the scan while the query runs."""
    return mart.join(months.select("observation_year", "observation_month"), ["observation_year", "observation_month"], "left_semi")


def slice_by_cities(mart: DataFrame, cities: DataFrame) -> DataFrame:
    """The mart's rows of the given cities of the dimension, such as those of a climate zone."""
    return mart.join(cities.select("city_id"), "city_id", "left_semi")
