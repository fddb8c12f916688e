from pyspark.sql import functions as F

from adlode.operators import ingest
from adlode.schema import LISTING_FIELDS
from adlode.streaming import refresh

EVENTS = "/root/testdata/sf0.001/events.parquet"


def arriving(spark, tmp_path):
    """The events as several files, so that the streams run over several batches."""
    folder = str(tmp_path / "in")
    events = spark.read.parquet(EVENTS).withColumn("ts", refresh.event_time("ts"))
    events.repartitionByRange(5, "ts").write.parquet(folder)
    return events, refresh.read_stream(spark, folder, events.schema, files_per_batch=1)


def test_weekly_trend_stream_equals_batch(spark, tmp_path):
    events, stream = arriving(spark, tmp_path)
    streamed = refresh.stream_weekly_trend(stream, "ts", "event_type", str(tmp_path / "out"), str(tmp_path / "ck"))
    batch = refresh.weekly_trend(events, "ts", "event_type")
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def test_dedup_stream_equals_batch(spark, tmp_path):
    events, stream = arriving(spark, tmp_path)
    keys = ["user_id", "event_type"]
    found = refresh.stream_dedup(stream.select("ts", *keys), keys, "ts", lateness="400 days").select(keys)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, events.select(keys).distinct().collect()))


def test_ingest_stream_goes_on_where_it_stopped(spark, tmp_path):
    folder, table, progress = (str(tmp_path / n) for n in ("in", "jobs", "ck"))
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = ingest.normalise_record(documents.select(F.substring("text", 1, 20).alias("title"), F.lit("c").alias("company")), "p")
    rows.repartition(3).write.parquet(folder)
    stream = refresh.read_stream(spark, folder, rows.schema, files_per_batch=1)
    refresh.stream_ingest(stream, table, progress)
    expected = ingest.with_hash(rows).select("hash").distinct().count()
    stored = spark.read.parquet(table)
    assert stored.count() == expected == stored.select("hash").distinct().count()
    assert stored.agg(F.max("id")).first()[0] == expected
    rows.withColumn("title", F.concat(F.lit("again "), "title")).write.mode("append").parquet(folder)
    refresh.stream_ingest(stream, table, progress)
    assert spark.read.parquet(table).count() == 2 * expected
    assert list(rows.columns) == list(LISTING_FIELDS)


def test_weeks_do_not_depend_on_the_session_zone(spark):
    def weeks():
        events = spark.read.parquet(EVENTS).withColumn("ts", refresh.event_time("ts"))
        return sorted(map(tuple, refresh.weekly_trend(events, "ts", "event_type").collect()))

    expected = weeks()
    try:
        for zone in ("America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert weeks() == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
