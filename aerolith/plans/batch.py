"""The two batch jobs: climate aggregations over the raw history, and the warehouse build."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from aerolith.operators.climate import heat_waves, monthly_normals, rolling
from aerolith.operators.daily import air_daily, batch_daily
from aerolith.plans import warehouse as W
from aerolith.plans.checks import Watch, check_models
from aerolith.session import stored
from aerolith.sources.sinks import ensure_namespace, with_month, write_mart, write_parquet, write_table


def climate_job(
    spark: SparkSession, raw: DataFrame, out: str, namespace: str | None = None
) -> dict[str, int]:
    """Raw hours to monthly normals, rolling figures and heat waves below `out`, by city.

    The daily grain is written to the shared folder once and read back by all three, so losing
    executors never repeats the scan of the raw history. Rows are counted on the way. With
    `namespace` each result is also loaded into a table there, from the files just written: the two
    daily ones by day, clustered by city, the normals clustered by city and month.
    """
    read, kept = Observation(), Observation()
    n = F.count(F.lit(1)).alias("n")
    daily = stored(batch_daily(raw.observe(read, n)).observe(kept, n), "daily")
    results = {
        "monthly_normals": (monthly_normals(daily), ["month_of_year", "year"], [], ["city_id", "month_of_year"]),
        "rolling_30d": (rolling(daily), ["observation_date"], ["observation_date"], ["city_id"]),
        "heat_waves": (heat_waves(daily), ["observation_date"], ["observation_date"], ["city_id"]),
    }
    if namespace:
        ensure_namespace(spark, namespace)
    for name, (df, inside, days, cluster) in results.items():
        path = f"{out.rstrip('/')}/{name}"
        write_parquet(df, path, ["city_id"], inside, dynamic=False)
        if namespace:
            written = spark.read.schema(df.schema).parquet(path).select(df.columns)
            write_table(written, f"{namespace}.weather_{name}", partition_by=days, cluster_by=cluster)
    return {"raw_rows": read.get["n"], "days": kept.get["n"]}


def build_warehouse(
    spark: SparkSession,
    hist: DataFrame,
    daily: DataFrame,
    air: DataFrame,
    cities: DataFrame,
    out: str,
    stream: DataFrame | None = None,
    dedupe_air: bool = False,
    watch: Watch | None = None,
) -> dict[str, DataFrame]:
    """Build and store the marts below `out`, each from the stored ones before it.

    `watch` counts the failing rows of the raw, staged and mart models on the way.
    """
    over = watch.over if watch else lambda _, df: df

    def store(name: str, df: DataFrame, cluster: list[str]) -> DataFrame:
        path = f"{out.rstrip('/')}/{name}"
        write_mart(over(name, df), path, cluster)
        return spark.read.schema(with_month(df).schema if "observation_date" in df.columns else df.schema).parquet(path)

    marts = {"dim_cities": store("dim_cities", W.dim_cities(over("cities", cities)), ["city_id"])}
    dim = marts["dim_cities"]
    hours = W.stage_weather(over("raw_weather", hist), over("raw_weather", daily), stream)
    days = W.weather_days(over("stg_weather", hours), stream is not None)
    marts["fct_weather_daily"] = store("fct_weather_daily", W.fct_weather(days, dim), ["city_id"])
    readings = over("stg_air_quality", W.stage_air(over("raw_air_quality", air)))
    marts["fct_air_quality_daily"] = store(
        "fct_air_quality_daily", W.fct_air(air_daily(readings, dedupe_air), dim), ["city_id", "parameter_name"]
    )
    marts["fct_environmental_stress"] = store(
        "fct_environmental_stress",
        W.fct_stress(marts["fct_weather_daily"], marts["fct_air_quality_daily"]),
        ["city_id"],
    )
    return marts


def check_warehouse(
    hist: DataFrame,
    daily: DataFrame,
    air: DataFrame,
    cities: DataFrame,
    marts: dict[str, DataFrame],
    stream: DataFrame | None = None,
    watch: Watch | None = None,
) -> DataFrame:
    """The report over raw, staged and stored models; with the `watch` of their build only what it
    could not count takes jobs of its own."""
    models = {
        "raw_weather": hist.select("city_id", "observation_ts").unionByName(
            daily.select("city_id", "observation_ts")
        ),
        "raw_air_quality": air,
        "cities": cities,
        "stg_weather": W.stage_weather(hist, daily, stream),
        "stg_air_quality": W.stage_air(air),
        **marts,
    }
    return check_models(models, cities, watch)
