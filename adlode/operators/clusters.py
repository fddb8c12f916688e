"""K-Means role clusters over yes/no skill vectors.

Listings with the same skills are one point with a weight, so every step runs over the
distinct skill sets instead of all listings. All fits of a search (numbers of clusters and
restarts) advance together: a step is one pass over the points, in which Arrow tasks find
each point's nearest centre of every fit and add up weights; Spark adds the tasks' sums.
The driver holds the centres only.

Weights are whole numbers and a centre is a quotient of two sums of them, so results do not
depend on partitioning.
"""

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from adlode import constants as C
from adlode.operators.archetypes import cluster_archetypes, group_profiles
from adlode.operators.rules import distinct_baskets
from adlode.operators.taxonomy import skilled_only

# Features are skills; a vocabulary beyond this is not a skill taxonomy.
MAX_FEATURES = 100_000
# Numbers that a task holds for one slice of points.
SLICE_CELLS = 1 << 21


@dataclass(frozen=True)
class Clusters:
    """A fit: centres (one row per cluster) over ``vocabulary``, and the cost, the weighted sum of squared distances."""

    centres: np.ndarray
    cost: float
    vocabulary: tuple[str, ...]

    def transform(self, rows: DataFrame, column: str = "skills") -> DataFrame:
        """``rows`` with the ``cluster_id`` of the nearest centre, the first on ties."""
        lookup = {word: i for i, word in enumerate(self.vocabulary)}
        centres = self.centres
        schema = rows.withColumn("cluster_id", F.lit(0)).schema

        def assign(batches):
            for batch in batches:
                found = np.zeros(batch.num_rows, np.int32)
                for at, present in _slices(batch.column(batch.schema.get_field_index(column)), lookup):
                    found[at: at + len(present)] = _distances(present, centres).argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=[*batch.schema.names, "cluster_id"])

        return rows.mapInArrow(assign, schema)


def _slices(sets: pa.Array, lookup: dict[str, int]):
    """(first row, yes/no matrix) of pieces of a column of skill sets."""
    step = max(1, SLICE_CELLS // max(1, len(lookup)))
    for at in range(0, len(sets), step):
        piece = sets[at: at + step].to_pylist()
        present = np.zeros((len(piece), len(lookup)))
        for i, words in enumerate(piece):
            present[i, [lookup[w] for w in words or () if w in lookup]] = 1
        yield at, present


def _distances(present: np.ndarray, centres: np.ndarray) -> np.ndarray:
    squares = present.sum(axis=1)[:, None] - 2 * present @ centres.T + (centres * centres).sum(axis=1)[None, :]
    return np.maximum(squares, 0)


def weighted_points(tagged: DataFrame, column: str = "skills") -> tuple[DataFrame, tuple[str, ...]]:
    """((skills, weight) per distinct skill set, stored for the iterations; the vocabulary in order)."""
    sets = distinct_baskets(tagged, column)
    words = sets.select(F.explode(column).alias("w")).distinct().limit(MAX_FEATURES + 1).collect()
    if len(words) > MAX_FEATURES:
        raise ValueError(f"more than {MAX_FEATURES} distinct skills")
    return sets, tuple(sorted(r["w"] for r in words))


def _starts(points: DataFrame, lookup: dict[str, int], seeds: Sequence[int | None], k: int, column: str) -> list[np.ndarray]:
    """Up to ``k`` first centres for every seed, chosen one after the other in one pass each.

    Without a seed the next centre is the point with the greatest weight times squared distance to the
    centres so far; with one it is drawn with that probability, by the least of exponential clocks that a
    hash of seed and point sets. Ties go to the set that sorts last. A search ends when no point is away from
    its centres.
    """
    chosen: list[list[np.ndarray]] = [[] for _ in seeds]
    # Numbers in (0, 1), the same wherever the point is read.
    clocks = [F.lit(0.5) if s is None else (F.pmod(F.xxhash64(F.lit(s), column), F.lit(1 << 40)) + 0.5) / float(1 << 40) for s in seeds]
    timed = points.select(column, "weight", F.array(*clocks).alias("clock"))
    for _ in range(k):
        fixed = [np.array(c) for c in chosen]

        def best(batches):
            for batch in batches:
                weight = np.asarray(batch.column(1).to_pylist(), float)
                clock = np.array(batch.column(2).to_pylist())
                rows = []
                for at, present in _slices(batch.column(0), lookup):
                    heavy = weight[at: at + len(present)]
                    for s, centres in enumerate(fixed):
                        pull = heavy * (_distances(present, centres).min(axis=1) if len(centres) else 1.0)
                        near = pull > 1e-9
                        if near.any():
                            drawn = pull if seeds[s] is None else np.log(clock[at: at + len(present), s]) / np.where(near, pull, 1.0)
                            drawn = np.where(near, drawn, -np.inf)
                            for i in np.flatnonzero(drawn == drawn.max()):
                                rows.append((s, float(drawn[i]), batch.column(0)[at + int(i)].as_py()))
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(("fit", "score", "point"), r)) for r in rows])

        found = timed.mapInArrow(best, "fit long, score double, point array<string>").groupBy("fit").agg(
            F.max(F.struct("score", "point")).alias("top")).collect()
        if not found:
            break
        for row in found:
            centre = np.zeros(len(lookup))
            centre[[lookup[w] for w in row["top"]["point"]]] = 1
            chosen[row["fit"]].append(centre)
    return [np.array(c).reshape(-1, len(lookup)) for c in chosen]


def _refine(points: DataFrame, vocabulary: tuple[str, ...], starts: Sequence[np.ndarray], max_iter: int, column: str) -> list[Clusters]:
    """Lloyd's steps from all ``starts`` together until no centre moves."""
    lookup = {word: i for i, word in enumerate(vocabulary)}
    centres, costs, moving = [s.copy() for s in starts], [0.0] * len(starts), set(range(len(starts)))
    for step in range(max_iter + 1):
        now = {f: centres[f] for f in moving}

        def sums(batches):
            total = {f: np.zeros((len(c), len(lookup) + 2)) for f, c in now.items()}
            for batch in batches:
                weight = np.asarray(batch.column(1).to_pylist(), float)
                for at, present in _slices(batch.column(0), lookup):
                    heavy = weight[at: at + len(present)]
                    for f, c in now.items():
                        away = _distances(present, c)
                        nearest = away.argmin(axis=1)
                        member = (nearest[:, None] == np.arange(len(c))[None, :]) * heavy[:, None]
                        total[f][:, :-2] += member.T @ present
                        total[f][:, -2] += member.sum(axis=0)
                        total[f][:, -1] += member.T @ away[np.arange(len(away)), nearest]
            for f, table in total.items():
                cluster, place = np.nonzero(table)
                if len(cluster):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(cluster), f)), pa.array(cluster), pa.array(place), pa.array(table[cluster, place])],
                        names=["fit", "cluster", "place", "total"])

        added = points.select(column, "weight").mapInArrow(sums, "fit long, cluster long, place long, total double").groupBy(
            "fit", "cluster", "place").agg(F.sum("total").alias("total")).toArrow()
        tables = {f: np.zeros((len(c), len(lookup) + 2)) for f, c in now.items()}
        for f, cluster, place, total in zip(*(added[c].to_numpy() for c in ("fit", "cluster", "place", "total"))):
            tables[f][cluster, place] = total
        for f, table in tables.items():
            costs[f] = float(table[:, -1].sum())
            size = table[:, -2]
            # a cluster that lost all its points keeps its centre
            moved = np.where(size[:, None] > 0, table[:, :-2] / np.maximum(size, 1)[:, None], centres[f])
            if step == max_iter or np.array_equal(moved, centres[f]):
                moving.discard(f)
            else:
                centres[f] = moved
        if not moving:
            break
    return [Clusters(c, cost, vocabulary) for c, cost in zip(centres, costs)]


def fit_by_k(points: DataFrame, vocabulary: tuple[str, ...], ks: Sequence[int], restarts: int, seed: int = C.KMEANS_SEED,
             max_iter: int = C.KMEANS_MAX_ITER, column: str = "skills") -> dict[int, Clusters]:
    """The fit with the least cost for every number of clusters in ``ks``, the first on ties.

    The first start is farthest-first, so the starts of growing k are nested; the other ``restarts`` - 1 are
    drawn. Where a fit still costs more than one with fewer clusters, it starts again from that one's
    centres and the point farthest from them, so costs never rise with k. With fewer different points than
    k, every point is a cluster.
    """
    if not ks:
        return {}
    # every step reads the points again
    points = points.select(column, "weight").persist()
    try:
        return _search(points, vocabulary, ks, [None, *(seed + i for i in range(1, max(1, restarts)))], max_iter, column)
    finally:
        points.unpersist()


def _search(points: DataFrame, vocabulary: tuple[str, ...], ks: Sequence[int], seeds: Sequence[int | None], max_iter: int,
            column: str) -> dict[int, Clusters]:
    lookup = {word: i for i, word in enumerate(vocabulary)}
    starts = _starts(points, lookup, seeds, max(ks), column)
    jobs = [(k, s[:k]) for k in ks for s in starts]
    fits = _refine(points, vocabulary, [s for _, s in jobs], max_iter, column)
    best = {k: min((f for (j, _), f in zip(jobs, fits) if j == k), key=lambda f: f.cost) for k in ks}
    ordered = sorted(ks)
    for fewer, k in zip(ordered, ordered[1:]):
        if best[k].cost > best[fewer].cost:
            centres = best[fewer].centres
            while len(centres) < k:
                centres = np.vstack([centres, _farthest(points, lookup, centres)])
            best[k] = _refine(points, vocabulary, [centres], max_iter, column)[0]
    return best


def _farthest(points: DataFrame, lookup: dict[str, int], centres: np.ndarray) -> np.ndarray:
    """The point with the greatest weight times squared distance to ``centres``."""
    def best(batches):
        for batch in batches:
            weight = np.asarray(batch.column(1).to_pylist(), float)
            for at, present in _slices(batch.column(0), lookup):
                pull = weight[at: at + len(present)] * _distances(present, centres).min(axis=1)
                yield pa.RecordBatch.from_pylist([
                    {"score": float(pull[i]), "point": batch.column(0)[at + int(i)].as_py()} for i in np.flatnonzero(pull == pull.max())])

    top = points.mapInArrow(best, "score double, point array<string>").agg(F.max(F.struct("score", "point")).alias("top")).first()["top"]
    centre = np.zeros(len(lookup))
    centre[[lookup[w] for w in top["point"]]] = 1
    return centre


def fit_best(points: DataFrame, vocabulary: tuple[str, ...], k: int, restarts: int, seed: int = C.KMEANS_SEED) -> Clusters:
    return fit_by_k(points, vocabulary, [k], restarts, seed)[k]


def costs_by_k(points: DataFrame, vocabulary: tuple[str, ...], n: int, k_min: int = C.K_MIN, k_max: int = C.K_MAX,
               restarts: int = C.ELBOW_RESTARTS, seed: int = C.KMEANS_SEED) -> list[tuple[int, float]]:
    """(k, least cost) for k from ``k_min`` to ``k_max``, staying below the number of listings ``n``."""
    fits = fit_by_k(points, vocabulary, range(k_min, min(k_max + 1, n)), restarts, seed)
    return [(k, fit.cost) for k, fit in fits.items()]


def misplaced(assigned: DataFrame, column: str = "skills", tolerance: float = 1e-9) -> DataFrame:
    """(listings, clusters, misplaced) of ``column, cluster_id, weight``: points that another cluster's mean is nearer to.

    Plain joins over clusters and skills, independent of how the clusters were found. A squared distance to a
    mean is the set's size less twice the sum of its skills' shares plus the mean's own square.
    """
    sizes = assigned.groupBy("cluster_id").agg(F.sum("weight").alias("size"))
    shares = assigned.select("cluster_id", "weight", F.explode(column).alias("skill")).groupBy("cluster_id", "skill").agg(
        F.sum("weight").alias("held")).join(sizes, "cluster_id").select(
        F.col("cluster_id").alias("other"), "skill", (F.col("held") / F.col("size")).alias("share"))
    # one row: the clusters with the squares of their means
    squares = shares.groupBy("other").agg(F.sum(F.col("share") * F.col("share")).alias("square"))
    others = squares.agg(F.collect_list(F.struct("other", "square")).alias("others")).scalar()
    sets = assigned.withColumn("point", F.array_join(column, "\n"))
    pairs = sets.select("point", "cluster_id", "weight", F.size(column).alias("n"), F.explode(others).alias("o")).select(
        "point", "cluster_id", "weight", "n", "o.other", "o.square")
    dots = sets.select("point", F.explode(column).alias("skill")).join(shares, "skill").groupBy("point", "other").agg(
        F.sum("share").alias("dot"))
    away = pairs.join(dots, ["point", "other"], "left").withColumn(
        "away", F.col("n") - 2 * F.coalesce("dot", F.lit(0.0)) + F.col("square"))
    points = away.groupBy("point").agg(
        F.first("weight").alias("weight"), F.min("away").alias("least"),
        F.min(F.when(F.col("other") == F.col("cluster_id"), F.col("away"))).alias("own"),
        F.first("cluster_id").alias("cluster_id"))
    return points.agg(F.coalesce(F.sum("weight"), F.lit(0)).alias("listings"), F.countDistinct("cluster_id").alias("clusters"),
                      F.count_if(F.col("own") > F.col("least") + tolerance).alias("misplaced"))


def elbow(costs: DataFrame, default: int = C.K_MIN) -> DataFrame:
    """(k): the k after which the drop in ``cost`` shrinks most, the first on ties.

    ``costs`` has one row per k, so ordering all of them in one task is cheap.
    Fewer than three costs give ``default``.
    """
    by_k = Window.orderBy("k")
    drop = F.col("cost") - F.lead("cost").over(by_k)
    bends = costs.select("k", drop.alias("drop")).select(
        F.lead("k").over(by_k).alias("k"), (F.col("drop") - F.lead("drop").over(by_k)).alias("bend"))
    best = bends.filter("bend is not null").agg(F.max_by("k", F.struct("bend", -F.col("k"))).alias("k"))
    return best.select(F.coalesce("k", F.lit(default)).cast("int").alias("k"))


def choose_k(points: DataFrame, vocabulary: tuple[str, ...], n: int, **options) -> int:
    costs = costs_by_k(points, vocabulary, n, **options)
    if not costs:
        return C.K_MIN
    return elbow(points.sparkSession.createDataFrame(costs, "k int, cost double")).first()["k"]


def cluster_roles(tagged: DataFrame, k: int | None = None, restarts: int = C.FINAL_RESTARTS,
                  keep: Sequence[str] = ("raw_id", "title"), **options) -> tuple[DataFrame, DataFrame]:
    """(listing clusters, cluster profiles) of the listings that have skills.

    Listings get their cluster row by row from the fitted centres; profiles come
    from the distinct skill sets and their weights.
    """
    points, vocabulary = weighted_points(tagged)
    n = points.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    if n < C.K_MIN:
        raise ValueError(f"{n} listings with skills, need at least {C.K_MIN}")
    model = fit_best(points, vocabulary, k or choose_k(points, vocabulary, n), restarts)
    profiles = group_profiles(model.transform(points), "cluster_id", weight="weight", **options)
    assigned = model.transform(skilled_only(tagged).select(*keep, "skills")).select(*keep, "cluster_id")
    return cluster_archetypes(assigned, profiles), profiles
