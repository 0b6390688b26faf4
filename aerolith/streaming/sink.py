"""Live events: read, parse, land as parquet by landing day, keep what cannot be parsed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from aerolith import schemas

_UNREAD = "_unread"
BATCH = "batch"
_FOLDERS = ["year", "month", "day", BATCH]


def kafka_source(
    spark: SparkSession,
    servers: str,
    topic: str = "weather.sensor.readings",
    batch_rows: int | None = None,
    batch_seconds: int = 30,
    max_rows: int | None = None,
) -> DataFrame:
    """Topic from its start. By default a batch takes whatever is there when the trigger fires.

    `batch_rows` makes a batch wait for so many new rows, `batch_seconds` at most; `max_rows` limits
    a batch's rows, and with the trigger's interval the rate.

    Events are keyed by city, so Kafka keeps a city's order within its partition. Needs the
    spark-sql-kafka package on the classpath.
    """
    limits = {}
    if batch_rows:
        limits = {"minOffsetsPerTrigger": batch_rows, "maxTriggerDelay": f"{batch_seconds}s"}
    if max_rows:
        limits["maxOffsetsPerTrigger"] = max_rows
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**limits)
        .load()
        .select(F.col("key").cast("string"), F.col("value").cast("string"))
    )


def file_source(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """JSON lines dropped into a folder, as rows of `key` and `value`; all new files make a batch,
    unless there is a limit."""
    limits = {"maxFilesPerTrigger": files_per_batch} if files_per_batch else {}
    return (
        spark.readStream.schema("value string")
        .options(**limits)
        .text(path)
        .select(F.get_json_object("value", "$.city_id").alias("key"), "value")
    )


def parse_events(source: DataFrame) -> DataFrame:
    """Event fields beside the original text, and whether all of it could be read: malformed text
    and values of another type give NULL fields, never a failure."""
    schema = T.StructType([*schemas.STREAM_EVENT, T.StructField(_UNREAD, T.StringType())])
    event = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _UNREAD})
    fields = F.struct(*[event[name].alias(name) for name in schemas.STREAM_EVENT.names])
    usable = event["city_id"].isNotNull() & event[_UNREAD].isNull()
    return source.select(
        "key", "value", fields.alias("event"), F.coalesce(usable, F.lit(False)).alias("usable")
    )


def valid_events(parsed: DataFrame) -> DataFrame:
    """Events that can be read and name a city, stamped with the landing time and its UTC day.

    In a stream the current time is that of the micro-batch and is kept in the checkpoint, so a
    batch that is run again after a failure lands in the same folder.
    """
    return _stamp(parsed.filter("usable").select("event.*"), "consumed_at")


def dead_letters(parsed: DataFrame) -> DataFrame:
    """Everything else, as it arrived."""
    unusable = parsed.filter("NOT usable").select("key", "value")
    return _stamp(unusable, "rejected_at")


def start_sink(
    source: DataFrame, out: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Land valid events below `out` by year/month/day.

    Offsets and written files are both logged, and a batch counts only once its files are
    complete: a restart neither loses nor repeats events.
    """
    return _start(valid_events(parse_events(source)), out, checkpoint, trigger)


def start_dead_letters(
    source: DataFrame, out: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Land unusable events below `out`, as a query of its own with its own progress."""
    return _start(dead_letters(parse_events(source)), out, checkpoint, trigger)


def start_router(
    source: DataFrame, out: str, dead: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Land valid events below `out` and unusable ones below `dead`, reading the source once.

    A micro-batch is read and parsed once, into a folder beside the checkpoint; both kinds are then
    written from there, by year/month/day and the batch's number. The landing time is that of the
    batch and is kept in the checkpoint. So a batch that is run again after a failure, before or
    after one of its writes, replaces exactly the folders that it wrote before.

    Within a batch a city's events lie together in order of their time, unless one city holds so much
    of it that adaptive execution splits it over several files, each of them in order.
    """
    stamped = _stamp(parse_events(source), "landed_at")
    staging = f"{checkpoint.rstrip('/')}/routed"

    def route(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(staging)
        rows = batch.sparkSession.read.schema(batch.schema).parquet(staging)
        rows = rows.withColumn(BATCH, F.lit(number).cast("bigint"))
        events = rows.filter("usable").select("event.*", F.col("landed_at").alias("consumed_at"), *_FOLDERS)
        unusable = rows.filter("NOT usable").select("key", "value", F.col("landed_at").alias("rejected_at"), *_FOLDERS)
        _replace(events.hint("rebalance", "city_id"), out, ["city_id", "observed_ts"])
        _replace(unusable, dead, [])

    return (
        stamped.writeStream.foreachBatch(route)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
        .start()
    )


def _replace(df: DataFrame, path: str, order: list[str]) -> None:
    """Write the batch's folders anew, rows in `order` inside each file."""
    arranged = df.sortWithinPartitions(*_FOLDERS, *order)
    writer = arranged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("compression", "snappy").partitionBy(*_FOLDERS).parquet(path)


def order_inversions(spark: SparkSession, path: str) -> DataFrame:
    """city_id, events and how many of them stand behind a later one of their city in a file."""
    rows = spark.read.parquet(path).select(
        "city_id", "observed_ts", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")
    )
    before = F.lag("observed_ts").over(Window.partitionBy("file", "city_id").orderBy("at"))
    return rows.withColumn("before", before).groupBy("city_id").agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("before") > F.col("observed_ts")).alias("inversions")
    )


def _stamp(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.current_timestamp()).withColumns(
        {"year": F.year(name), "month": F.month(name), "day": F.dayofmonth(name)}
    )


def _start(df: DataFrame, out: str, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("compression", "snappy")
        .option("checkpointLocation", checkpoint)
        .partitionBy("year", "month", "day")
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
        .start(out)
    )
