"""Exact top-k search by MaxScore over integer vectors.

Every dimension is a query term whose posting list holds all vectors. Inside a block of
candidates a term adds ``q * c`` to a score; how far that can rise above the block's least
value for the term is the term's bound. Per query the terms are ordered by bound. Those whose
bounds add up to less than the gap between the best floor and the current k-th score are
non-essential: they alone cannot lift a candidate into the result. The essential postings are
traversed, and the non-essential ones are probed only for candidates that still can compete.
Candidates and queries meet in cells of bounded size, and the cells' lists are merged.

Defined results: vectors that are NULL or hold a NULL or non-finite component take no part; a
missing trailing component counts as 0; ties go to the smaller id; rows without an id take no
part, and rows of equal id are one vector (the least); a query with fewer candidates than k
gets them all; no candidates, no rows. Scores are exact while a vector's components stay
below 2**24 after scaling; larger ones are computed with Python's integers.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlode.llm.common import record_batch, table
from adlode.session import settle

SCALE, K, EVERY = 256.0, 5, 50
#: Rows of a cell: at most about so many queries meet about so many candidates in one task.
QUERY_ROWS, CANDIDATE_ROWS = 2048, 8192
#: Components up to here are multiplied as 64-bit integers without overflow.
SAFE = 1 << 24
RESULT = "query_id long, vec_id long, score long"


def integer_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: float = SCALE) -> DataFrame:
    """vec_id, v (array of long): floor(scale * x) of every usable vector, one row per id."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    usable = (vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
              .filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", finite)))
    return (usable.select("vec_id", F.transform("v", lambda x: F.floor(x * F.lit(scale)).cast("long")).alias("v"))
            .groupBy("vec_id").agg(F.min("v").alias("v")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of an array column as one matrix, short rows filled with 0."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = flat
    return out


def _exact(ids, c, query, own, k):
    """All scores by Python's integers, for components beyond SAFE."""
    scores = [(-sum(int(a) * int(b) for a, b in zip(query, row)), int(i)) for i, row in zip(ids, c) if i != own]
    return [(i, -s) for s, i in sorted(scores)[:k] if -(1 << 63) <= -s < 1 << 63]


def max_score(ids: np.ndarray, c: np.ndarray, columns: np.ndarray, query: np.ndarray, own: int, k: int, floor: int | None = None):
    """The k best (id, score) of one block for one query; ``columns`` is ``c`` by dimension."""
    n = len(ids)
    low, high = query * columns.min(axis=1), query * columns.max(axis=1)
    least, span = np.minimum(low, high), np.abs(high - low)
    order = np.argsort(-span, kind="stable")
    # Seeds: full scores of the candidates that do best on the heaviest terms give the first threshold.
    head = order[:4]
    lead = query[head] @ columns[head]
    seeds = np.argpartition(-lead, min(4 * k, n - 1))[: 4 * k + 1]
    seeds = seeds[ids[seeds] != own]
    known = np.sort(c[seeds] @ query)[::-1]
    threshold = known[k - 1] if len(known) >= k else None
    if floor is not None:
        threshold = floor if threshold is None else max(threshold, floor)
    if threshold is None:
        alive, score = np.arange(n), c @ query
    else:
        rest = np.cumsum(span[order][::-1])[::-1]  # what the terms from here on can add above their least
        base = int(least.sum())
        essential = max(1, int(np.searchsorted(-rest, -(threshold - base), side="right")))
        at, alive = essential, np.arange(n)
        score = query[order[:at]] @ columns[order[:at]] + least[order[at:]].sum()
        while at < len(order):
            keep = score + rest[at] >= threshold
            alive, score = alive[keep], score[keep]
            if len(alive) <= 64 or at + 8 >= len(order):
                score = c[alive] @ query
                break
            terms = order[at: at + 8]
            score = score + query[terms] @ columns[np.ix_(terms, alive)] - least[terms].sum()
            at += 8
    mine = ids[alive] != own
    found, score = ids[alive][mine], score[mine]
    best = np.lexsort((found, -score))[:k]
    return [(int(found[i]), int(score[i])) for i in best]


def _cell(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(key, queries: pa.Table, candidates: pa.Table) -> pa.Table:
        rows = []
        if queries.num_rows and candidates.num_rows:
            sides = [t.sort_by("vec_id") for t in (queries, candidates)]
            width = max(1, *[int(np.diff(t["v"].combine_chunks().offsets.to_numpy()).max()) for t in sides])
            (q_ids, q), (ids, c) = [(t["vec_id"].to_numpy(), _matrix(t["v"], width)) for t in sides]
            columns = np.ascontiguousarray(c.T)
            small = max(np.abs(q).max(), np.abs(c).max()) < SAFE
            for own, query in zip(q_ids, q):
                best = max_score(ids, c, columns, query, own, k) if small else _exact(ids, c, query, own, k)
                rows += [(own, i, s) for i, s in best]
        columns = list(zip(*rows)) if rows else [[], [], []]
        return pa.Table.from_batches([record_batch(schema, [list(x) for x in columns])])

    return run


def search(vectors: DataFrame, k: int = K, every: int = EVERY, query_rows: int = QUERY_ROWS,
           candidate_rows: int = CANDIDATE_ROWS, **names) -> DataFrame:
    """query_id, rank, vec_id, score of the queries (ids divisible by ``every``) against all other vectors.

    The numbers of query blocks and candidate shards follow from a count, so cells keep their
    size at any scale; a cell's rows are dealt by a hash of the id.
    """
    numbers = settle(integer_vectors(vectors, **names))
    is_query = F.col("vec_id") % every == 0
    n, n_queries = numbers.agg(F.count("*"), F.count_if(is_query)).first()
    blocks, shards = max(1, -(-n_queries // query_rows)), max(1, -(-n // candidate_rows))
    block, shard = (F.pmod(F.xxhash64("vec_id", F.lit(s)), F.lit(m)) for s, m in (("block", blocks), ("shard", shards)))
    queries = (numbers.filter(is_query).withColumn("block", block)
               .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("shard", F.col("shard").cast("long")))
    candidates = (numbers.withColumn("shard", shard)
                  .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("block", F.col("block").cast("long")))
    found = queries.groupBy("block", "shard").cogroup(candidates.groupBy("block", "shard")).applyInArrow(_cell(k), RESULT)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


SQL = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256.0)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM usable q JOIN usable c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
