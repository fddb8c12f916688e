"""Importance resampling towards a target distribution of hashed n-grams.

A batch of texts is joined into one string with a separator between them that no word can hold.
One pass of a pattern finds all words of the batch; runs of n consecutive words are hashed to
buckets, those that would reach into the next text are masked by comparing the document numbers
that searchsorted gives for their first and last word, and a bincount adds up the rest. The
counts of all batches give every bucket's log ratio between target and corpus; a document's
weight is the sum over its features. The sample is the top of weight plus Gumbel noise, which
draws without replacement in proportion to the exponent of the weight.

The features of a document are written once, as bucket numbers, and read again for the weights,
so texts are scanned once. What the driver holds are one count and one gain per bucket. Ranks come
from a sort by ranges with the ranges' sizes as offsets: no task sees all rows.

Defined results: a NULL or empty text has no features and weight 0; a NULL id counts as an empty
string in the noise; ties go to the smaller id, NULL first, and rows of equal id are ranked one by
one; an empty table gives no rows, an empty target leaves a gain to every bucket by smoothing.
Further columns of the input, whatever their names, are left out by ``resample``.
"""

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlode.llm.common import fresh, record_batch, slices, table
from adlode.session import settle

MAX_RUN, BUCKETS, SHARE_PERCENT, MIN_WORDS, SEED = 1, 10_000, 10, 20, "2024"
#: Lower-case ASCII letters, digits and all bytes of characters beyond ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xFF]+")
IN_WORD = np.array([WORD.fullmatch(bytes([n])) is not None for n in range(256)])
#: Stands between the texts of a batch; it is no part of a word.
SENTINEL = b"\n"
#: Texts of a batch, and features whose hashes one worker remembers before it starts anew.
BATCH, CACHE_FEATURES = 256, 300_000


class BatchFeatures:
    """Buckets of all features of a batch of UTF-8 texts."""

    def __init__(self, max_run: int = MAX_RUN, buckets: int = BUCKETS):
        self.max_run, self.buckets = max_run, buckets
        self.known: dict[bytes, int] = {}

    def numbers(self, features: list[bytes]) -> np.ndarray:
        if len(self.known) > CACHE_FEATURES:
            self.known = {}
        for feature in set(features).difference(self.known):
            self.known[feature] = zlib.crc32(feature) % self.buckets
        return np.fromiter(map(self.known.__getitem__, features), np.int64, len(features))

    def __call__(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Buckets, document by document; how many each document has; the words of each document."""
        texts = [text or b"" for text in texts]
        joined = SENTINEL.join(texts).lower()  # of bytes: A to Z alone
        words = WORD.findall(joined)
        inside = IN_WORD[np.frombuffer(joined, np.uint8)]
        starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]])) if len(inside) else np.zeros(0, np.int64)
        ends = np.cumsum([len(text) + len(SENTINEL) for text in texts])
        owner = np.searchsorted(ends, starts, "right")
        parts, owners = [], []
        for n in range(1, min(self.max_run, len(words)) + 1):
            runs = words if n == 1 else [b" ".join(words[i: i + n]) for i in range(len(words) - n + 1)]
            whole = owner[: len(runs)] == owner[n - 1:]
            parts.append(self.numbers(runs)[whole])
            owners.append(owner[: len(runs)][whole])
        n_words = np.bincount(owner, minlength=len(texts))
        if len(parts) <= 1:
            return (parts[0] if parts else np.zeros(0, np.int64)), n_words, n_words
        owners = np.concatenate(owners)
        order = np.argsort(owners, kind="stable")
        return np.concatenate(parts)[order], np.bincount(owners, minlength=len(texts)), n_words


def _kind(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def with_features(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_run: int = MAX_RUN, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_words, buckets (their numbers, little-endian, 2 bytes each, or 4 beyond 65,536) of every text."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("text"))

    def run(batches):
        features = BatchFeatures(max_run, buckets)
        for batch in slices(batches, BATCH):
            found, sizes, n_words = features(batch.column(1).to_pylist())
            raw, width = found.astype(_kind(buckets)).tobytes(), int(_kind(buckets)[-1])
            edges = [0, *(np.cumsum(sizes) * width).tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()),
                 pa.array([raw[a:b] for a, b in zip(edges, edges[1:])], pa.binary())], names=["doc_id", "n_words", "buckets"])

    return rows.mapInArrow(run, rows.select("doc_id").schema.add("n_words", "long").add("buckets", "binary"))


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: how often each bucket occurs. A task adds up its own rows first."""
    schema = pa.schema([("bucket", pa.int64()), ("n", pa.int64())])

    def run(batches):
        counts = np.zeros(buckets, np.int64)
        for batch in slices(batches, BATCH):
            raw = b"".join([x or b"" for x in batch.column(0).to_pylist()])
            counts += np.bincount(np.frombuffer(raw, _kind(buckets)), minlength=buckets)
        used = np.flatnonzero(counts)
        yield record_batch(schema, [pa.array(used, pa.int64()), pa.array(counts[used])])

    return features.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 * ln(smoothed target share / smoothed corpus share)) of every bucket, from (bucket, n) tables."""
    counts = np.zeros((2, buckets), np.int64)
    for side, table_ in enumerate((corpus, target)):
        for bucket, n in table_.collect():  # one row per bucket, however large the corpus
            counts[side, bucket] = n
    s, t = counts.tolist()
    total_s, total_t = sum(s), sum(t)
    return np.array([math.floor(1000 * math.log(((t[b] + 1) * (total_s + buckets)) / ((s[b] + 1) * (total_t + buckets))))
                     for b in range(buckets)], np.int64)


def weighted(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight: the sum of gains over each document's features."""
    kind = _kind(len(gain))

    def run(batches):
        for batch in slices(batches, BATCH):
            raw = [x or b"" for x in batch.column(2).to_pylist()]
            sizes = np.array([len(x) // int(kind[-1]) for x in raw], np.int64)
            sums = np.concatenate([[0], np.cumsum(gain[np.frombuffer(b"".join(raw), kind)])])
            ends = np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(sums[ends] - sums[ends - sizes], pa.int64())],
                names=["doc_id", "n_words", "n_features", "weight"])

    return features.select("doc_id", "n_words", "buckets").mapInArrow(
        run, features.select("doc_id", "n_words").schema.add("n_features", "long").add("weight", "long"))


def noise(doc_id, seed: str = SEED):
    """floor of 1000 times a Gumbel number from the id: the same in every run."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def ranked(rows: DataFrame, order: list, rank: str = "rank") -> DataFrame:
    """``rows`` with their places 1, 2, 3... in ``order``.

    Rows are sorted by ranges; a row's place is its position in its range plus the sizes of the
    ranges before. Rows that ``order`` does not tell apart may lie in several ranges.
    """
    part, place, before = fresh(rows, "range_part", "range_place", "range_before")
    tie, = fresh(rows, "range_tie")
    keys = [*order, F.col(tie)]
    columns = rows.columns

    def number(batches):
        at = 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(columns)], pa.array(np.full(n, TaskContext.get().partitionId()), pa.int32()),
                 pa.array(np.arange(at + 1, at + n + 1), pa.int64())], names=[*columns, part, place])
            at += n

    # The tie-breaker is written first, as a number given while a shuffle is planned may change with it.
    fixed = settle(rows.withColumn(tie, F.monotonically_increasing_id()))
    placed = settle(fixed.repartitionByRange(*keys).sortWithinPartitions(*keys)
                    .mapInArrow(number, rows.schema.add(part, "integer").add(place, "long")))
    sizes = placed.groupBy(part).agg(F.count("*").alias("n"))
    offsets = sizes.select(F.col(part), F.coalesce(F.sum("n").over(  # one row per range
        Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(before))
    return placed.join(settle(offsets), part).withColumn(rank, F.col(place) + F.col(before)).select(*[F.col(f"`{c}`") for c in columns], rank)


def scored(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
           max_run: int = MAX_RUN, buckets: int = BUCKETS, seed: str = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every row of ``docs``."""
    features = settle(with_features(docs, doc_id, text, max_run, buckets))
    wanted = with_features(target.select(F.lit(0).alias("doc_id"), F.col(f"`{target_text}`").alias("text")), max_run=max_run, buckets=buckets)
    gain = gains(bucket_counts(features, buckets), bucket_counts(wanted, buckets), buckets)
    return weighted(features, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def resample(docs: DataFrame, target: DataFrame, share_percent: int = SHARE_PERCENT, min_words: int = MIN_WORDS, **options) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank: the drawn documents have a rank, the others none.

    ``share_percent`` of the documents with ``min_words`` words are drawn.
    """
    rows = settle(scored(docs, target, **options))
    eligible = F.col("n_words") >= min_words
    drawn = rows.agg(F.count_if(eligible)).first()[0] * share_percent // 100
    places = ranked(rows.filter(eligible), [F.col("score").desc(), F.col("doc_id").asc_nulls_first()])
    places = places.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return places.unionByName(rows.filter(~eligible).withColumn("rank", F.lit(None).cast("long")))


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resample(docs, table(spark, sf_dir, "benchmark").select("text")).select("doc_id", "n_features", "weight", "score", "rank")


SQL = r"""
WITH RECURSIVE spoken AS (
  SELECT 0 AS side, doc_id, text FROM documents UNION ALL SELECT 1, NULL, text FROM benchmark),
numbered AS (SELECT row_number() OVER () AS row_no, * FROM spoken),
found AS MATERIALIZED (
  SELECT row_no, side, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words
  FROM numbered),
said AS (SELECT row_no, side, unnest(words) AS word FROM found),
step AS (SELECT n, list_reduce(list_concat([n], range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM (SELECT unnest(range(256)) AS n)),
crc_table AS (SELECT list(v ORDER BY n) AS v FROM step),
hashed AS MATERIALIZED (
  SELECT word, xor(list_reduce(list_concat([4294967295], list_transform(range(length(hex(encode(word))) // 2),
      lambda i: ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, v[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT word FROM said), crc_table),
placed AS MATERIALIZED (SELECT row_no, side, bucket, count(*) AS n FROM said JOIN hashed USING (word) GROUP BY ALL),
counts AS (SELECT bucket, sum(n) FILTER (side = 0) AS s, sum(n) FILTER (side = 1) AS t FROM placed GROUP BY bucket),
totals AS (SELECT coalesce(sum(s), 0) AS all_s, coalesce(sum(t), 0) AS all_t FROM counts),
gains AS (SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * (all_s + 10000)) / ((coalesce(s, 0) + 1)::DOUBLE * (all_t + 10000))))::BIGINT AS gain
  FROM counts, totals),
weights AS (SELECT row_no, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM placed JOIN gains USING (bucket) GROUP BY row_no),
scores AS (
  SELECT row_no, doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM found LEFT JOIN weights USING (row_no) WHERE side = 0),
eligible AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST) AS place, count(*) OVER () AS n FROM scores WHERE n_features >= 20)
SELECT scores.doc_id, scores.n_features, scores.weight, scores.score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scores LEFT JOIN eligible USING (row_no)
"""
