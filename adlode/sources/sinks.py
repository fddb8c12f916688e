"""Writing tables: append what is new, replace results by versions, export."""

import uuid
from collections.abc import Callable, Mapping
from datetime import datetime, timezone
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from adlode.operators.ingest import keep_first, new_rows, normalise_record, number_rows, with_hash
from adlode.schema import LISTING_FIELDS, RAW, VERSIONS
from adlode.session import settle
from adlode.sources.tables import read_or_empty, read_table


def append_new(batch: DataFrame, path: str) -> int:
    """Append the listings the table does not have yet, numbered in their order; returns how many.

    Safe to repeat: rows stored by an earlier, interrupted attempt are recognised
    by their hash. Of equal listings the one with the least ``arrival`` is kept, and ids follow it;
    without such a column, the listing's fields give the order.
    """
    spark = batch.sparkSession
    stored = read_or_empty(spark, path, RAW)
    order = ["arrival"] if "arrival" in batch.columns else list(LISTING_FIELDS)
    # the comparison reads its rows twice, so they are settled; the numbering settles its own
    kept = ["hash", *LISTING_FIELDS, *(c for c in order if c not in LISTING_FIELDS)]
    unique = settle(keep_first(with_hash(batch), "hash", order).select(kept))
    last = stored.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    rows = settle(number_rows(new_rows(unique, stored), last, order=order))
    rows.withColumn("scraped_at", F.current_timestamp()).select(RAW.fieldNames()).write.mode("append").parquet(path)
    return rows.count()


def ingest_portals(spark: SparkSession, portals: Mapping[str, Callable[[], DataFrame]], path: str,
                   parallelism: int = 4) -> DataFrame:
    """Read every portal, append what is new and return (source, scraped, new, failed), portals and a TOTAL.

    A portal is a function that gives its listings. Portals are read as jobs of their own, some at a time; one
    that fails counts 0 rows and does not stop the others. What was read is stored in one append, with ids
    in the order of portals and of their ``arrival``.
    """
    def read(place: tuple[int, str]) -> tuple[str, DataFrame | None, str]:
        number, portal = place
        try:
            rows = normalise_record(portals[portal](), portal)
            own = F.col("arrival").cast("long") if "arrival" in rows.columns else F.lit(0).cast("long")
            return portal, settle(rows.withColumn("_arrival", F.struct(F.lit(number).alias("portal"), own.alias("own"))).drop(
                "arrival").withColumnRenamed("_arrival", "arrival")), ""
        except Exception as error:  # whatever goes wrong in a portal stays with that portal
            return portal, None, f"{type(error).__name__}: {error}"[:500]

    # the threads submit jobs only; executors do the work
    with ThreadPool(max(1, min(parallelism, len(portals)))) as pool:
        results = pool.map(inheritable_thread_target(spark)(read), list(enumerate(portals)), chunksize=1)
    batches = [batch for _, batch, _ in results if batch is not None]
    after = read_or_empty(spark, path, RAW).agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    status = spark.createDataFrame([(p, why) for p, _, why in results], "source string, failed string")
    counts = spark.createDataFrame([], "source string, scraped long, new long")
    if batches:
        together = reduce(DataFrame.unionByName, batches)
        append_new(together, path)
        one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
        added = read_table(spark, path, RAW).filter(F.col("id") > after)
        counts = together.select("source", one.alias("scraped"), zero.alias("new")).unionByName(
            added.select("source", zero.alias("scraped"), one.alias("new")))
    named = status.join(counts.groupBy("source").agg(F.sum("scraped").alias("scraped"), F.sum("new").alias("new")), "source", "left").select(
        "source", F.coalesce("scraped", F.lit(0)).alias("scraped"), F.coalesce("new", F.lit(0)).alias("new"), "failed")
    total = named.agg(F.lit("TOTAL").alias("source"), F.sum("scraped").alias("scraped"), F.sum("new").alias("new"), F.lit("").alias("failed"))
    return named.unionByName(total)


def write_version(df: DataFrame, folder: str) -> str:
    """Write ``df`` as a new version of the table in ``folder`` and make it the current one; returns its path.

    Readers see the version before until the new one is whole: the last act appends one row to the list of
    versions. A job that is lost leaves files that no list names. ``df`` may read the table that it replaces.
    """
    spark, folder = df.sparkSession, folder.rstrip("/")
    name = f"version-{uuid.uuid4().hex[:12]}"
    df.write.parquet(f"{folder}/{name}")
    last = read_or_empty(spark, f"{folder}/versions", VERSIONS).agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
    spark.createDataFrame([(last + 1, name)], VERSIONS).coalesce(1).write.mode("append").parquet(f"{folder}/versions")
    return f"{folder}/{name}"


def export_csv(df: DataFrame, folder: str, name: str, stamped: bool = False) -> str:
    """Write any table or view as CSV with a header, in parts; returns the path."""
    if stamped:
        name = f"{name}_{datetime.now(timezone.utc):%Y%m%d_%H%M%S}"
    path = f"{folder.rstrip('/')}/{name}.csv"
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path
