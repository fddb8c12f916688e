"""The periodic refresh as streams: ingest of new rows and weekly trends.

Both run with ``availableNow``: they take what has arrived since the last run,
keep their progress in the checkpoint folder and stop. Keep the folders to go on
from the last run; without them a run starts afresh in the shared folder.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from adlode.session import scratch_path
from adlode.sources.sinks import append_new


def read_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Files of a parquet table as they arrive."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def event_time(column: str):
    """Zone-less timestamps read as UTC whatever the session's zone, since watermarks need an instant."""
    return F.from_utc_timestamp(F.col(column).cast("timestamp"), F.current_timezone())


def _run(writer, checkpoint: str) -> None:
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def stream_dedup(stream: DataFrame, keys: Sequence[str], time: str, out: str | None = None,
                 checkpoint: str | None = None, lateness: str = "1 hour") -> DataFrame:
    """First row per key among rows at most ``lateness`` behind; returns the written table.

    State is kept by key and dropped as the watermark passes.
    """
    spark = stream.sparkSession
    out, checkpoint = out or scratch_path(spark, "dedup"), checkpoint or scratch_path(spark, "progress")
    unique = stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark(list(keys))
    _run(unique.writeStream.format("parquet").option("path", out).outputMode("append"), checkpoint)
    return spark.read.schema(unique.schema).parquet(out)


def stream_ingest(stream: DataFrame, table: str, checkpoint: str) -> None:
    """Append every listing the table does not have, however old the stored one is.

    A batch that is repeated after a failure finds its rows stored and adds none.
    """
    _run(stream.writeStream.foreachBatch(lambda batch, _: append_new(batch, table) and None), checkpoint)


def weekly_trend(rows: DataFrame, time: str, category: str, period: str = "7 days") -> DataFrame:
    """(week, category, count): rows per category and period; batch or stream."""
    week = F.window(F.col(time), period)
    start = F.to_utc_timestamp("week.start", F.current_timezone())
    return (
        rows.groupBy(week.alias("week"), category).agg(F.count(F.lit(1)).alias("count"))
        .select(F.date_format(start, "yyyy-MM-dd").alias("week"), category, "count")
    )


def stream_weekly_trend(stream: DataFrame, time: str, category: str, out: str | None = None,
                        checkpoint: str | None = None) -> DataFrame:
    """The same counts kept up to date by a stream, the running week included; returns the written table.

    Only weeks with new rows are written, as one more version of their counts; readers
    take the latest version.
    """
    spark = stream.sparkSession
    out, checkpoint = out or scratch_path(spark, "trend"), checkpoint or scratch_path(spark, "progress")
    counts = weekly_trend(stream, time, category)

    def write(batch: DataFrame, version: int) -> None:
        batch.withColumn("version", F.lit(version)).write.mode("overwrite").parquet(f"{out}/batch={version}")

    _run(counts.writeStream.outputMode("update").foreachBatch(write), checkpoint)
    layout = T.StructType([*counts.schema.fields, T.StructField("version", T.LongType())])
    versions = spark.read.schema(layout).parquet(out)
    return versions.groupBy("week", category).agg(F.max_by("count", "version").alias("count"))
