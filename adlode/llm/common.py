"""Small helpers of the operators in this package."""

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlode.session import settle

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names starting with ``names`` that ``df`` does not have."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def slices(batches, rows: int = 1024):
    """Arrow batches cut into pieces of at most ``rows`` rows, so that working memory does not follow the batch size."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def record_batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def uniform(seed: str, key):
    """A number in [0, 1) from ``key`` (a column; NULL counts as an empty string): the same in every run and every engine."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def fold(key, folds: int):
    """crc32 of the id as text, modulo ``folds``; rows without an id belong to fold 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds, F.lit(0))


def balanced_sample(rows: DataFrame, group: str, key: str, size: int, seed: str) -> DataFrame:
    """About equally many rows of every ``group``, at most ``size`` in all, chosen by a hash of ``key``.

    A row's place within its group is estimated as hash * group size, so one bounded top-k over
    narrow rows replaces a window over a group that may hold most of the table.
    """
    counts = settle(rows.groupBy(group).agg(F.count("*").alias("sample_n")))
    place = uniform(seed, F.col(key)) * F.col("sample_n")
    joined = rows.join(counts, group)
    return joined.withColumn("sample_place", place).orderBy("sample_place", key).limit(size).drop("sample_n", "sample_place")
