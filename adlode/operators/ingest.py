"""Ingest: normalise, unite, deduplicate and append only what is new."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from adlode.functions.text import listing_hash, text
from adlode.schema import LISTING_FIELDS
from adlode.session import settle


def normalise_record(rows: DataFrame, portal: str) -> DataFrame:
    """The nine listing fields, '' where a field is missing, ``source`` set to the portal.

    A column ``arrival`` that orders the listings is kept beside them.
    """
    present = set(rows.columns)
    fields = [text(F.col(f)) if f in present else F.lit("") for f in LISTING_FIELDS if f != "source"]
    return rows.select(
        *[c.alias(f) for c, f in zip(fields, LISTING_FIELDS)], F.lit(portal).alias("source"),
        *[F.col(c) for c in rows.columns if c == "arrival"])


def drop_untitled(rows: DataFrame, title: str = "title") -> DataFrame:
    return rows.filter(text(F.col(title)) != "")


def union_sources(portals: Mapping[str, DataFrame], enabled: Sequence[str] | None = None,
                  only: str | None = None) -> DataFrame:
    """All enabled portals' listings together, or those of one portal."""
    chosen = [p for p in portals if (enabled is None or p in enabled) and (only is None or p == only)]
    if not chosen:
        raise ValueError("no portal chosen")
    return reduce(DataFrame.unionByName, [normalise_record(portals[p], p) for p in chosen])


def with_hash(rows: DataFrame) -> DataFrame:
    return rows.withColumn("hash", listing_hash(F.col("title"), F.col("company"), F.col("source")))


def keep_first(rows: DataFrame, key: str | list[str] = "hash", order: Sequence[str | Column] = ("id",)) -> DataFrame:
    """The earliest row per key.

    Spark applies the rank limit on the map side first, so a key that holds much
    of the data sends one row per task into the shuffle.
    """
    keys = [key] if isinstance(key, str) else key
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def new_rows(batch: DataFrame, stored: DataFrame, key: str = "hash") -> DataFrame:
    """Rows of ``batch`` (one per key) whose key ``stored`` does not have.

    The stored keys are first cut down to those of the batch, which Spark can do
    without shuffling the stored table where the batch is small.
    """
    known = stored.select(key).join(batch.select(key), key, "left_semi")
    return batch.join(known, key, "left_anti")


def number_rows(rows: DataFrame, after: int = 0, key: str = "hash", order: Sequence[str] = ()) -> DataFrame:
    """Add a dense ``id`` from ``after + 1``, by ``order`` and then ``key``, which has to be unique.

    The rows are split into ranges of that order and written; a row's id is the number of rows in the ranges
    before its own (one broadcast row per range) plus its place within the range. So no task holds more than
    a range, and as the key ends the order, equal values of ``order`` can be split too.
    """
    placed = [*order, key]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = settle(rows.repartitionByRange(parts, *placed).withColumn("_range", F.spark_partition_id()))
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(
        F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("_range", before.alias("_before"))
    position = F.row_number().over(Window.partitionBy("_range").orderBy(*placed))
    return (
        ranged.withColumn("_position", position)
        .join(F.broadcast(offsets), "_range")
        .withColumn("id", (F.lit(after) + F.col("_before") + F.col("_position")).cast("long"))
        .drop("_range", "_position", "_before")
    )


def ingest_summary(batch: DataFrame, key: str = "hash", stored: DataFrame | None = None,
                   order: Sequence[str | Column] = ("id",), source: str = "source") -> DataFrame:
    """(source, scraped, new) per portal and in total.

    Counts of scraped and of new rows are added up after each is aggregated, so
    the wide rows are not ranked for the scraped count.
    """
    narrow = batch.select(key, source, *order)
    fresh = keep_first(narrow, key, order)
    if stored is not None:
        fresh = new_rows(fresh, stored, key)
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    marks = narrow.select(source, one.alias("scraped"), zero.alias("new")).unionByName(
        fresh.select(source, zero.alias("scraped"), one.alias("new")))
    return (
        marks.rollup(source).agg(F.sum("scraped").alias("scraped"), F.sum("new").alias("new"),
                                 F.grouping(source).alias("_total"))
        .withColumn(source, F.when(F.col("_total") == 1, F.lit("TOTAL")).otherwise(F.col(source)))
        .drop("_total")
    )
