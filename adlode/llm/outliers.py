"""Quality rules by robust multivariate outliers.

Per language and source a minimum-covariance-determinant estimate gives the centre and shape of
the transformed statistics of ordinary documents; a document far from it by Mahalanobis
distance is rejected. Base rules (too few words, too much repetition) go first and take no part
in the estimates.

The estimate follows the concentration steps of FAST-MCD from one robust start (median and
median deviation), over all documents: a step computes every document's distance, keeps the
nearer half of its group, and takes their mean and covariance. The half is found from counts and
moments summed per fine bin of the distance, so a step is one aggregation with partial sums on
the map side, and no group's documents ever meet in one task. Groups with fewer than MIN_GROUP
documents use the estimate of their language over all sources, or, failing that, of all
documents. Scales have a floor, because most ordinary documents share a statistic exactly
(no symbols at all, say), and such a group would reject whatever deviates a little.

Defined results: a NULL text has no words; NULL languages and sources are groups of their own;
repeated rows count each; texts without words fail the base rules; an empty table gives no rows.
"""

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlode.llm.common import fresh, slices, table
from adlode.session import settle

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Documents a group needs for an estimate of its own.
MIN_GROUP = 40
#: Least standard deviations of the transformed statistics, in the order of FEATURES: what the shortest document that
#: passes the base rules can tell apart. Word length: its sampling error, words' lengths varying by about a half of their
#: mean. The others: one symbol, one repeated line, the least repetition (four equal words).
FEATURES = ("word_length", "symbols", "dup_lines", "repeats")
FLOORS = (0.5 / math.sqrt(MIN_WORDS), math.log1p(1 / MIN_WORDS), 1 / 21, 4 / MIN_WORDS)
#: Rejected beyond this squared distance: the chi-square quantile of 4 degrees at 0.999.
LIMIT = 18.467
STEPS = 4
#: Share of a group that an estimate keeps, and median of chi-square with 4 degrees (a fixed value).
HALF, CHI_MEDIAN = 0.5, 3.357
#: Bins per doubling of the squared distance; distances under 2**LOW fall into the first.
PER_OCTAVE, LOW = 32, -20
SYMBOLS = "#*$%&|<>"


def statistics(text: str | None) -> tuple[int, int, int, int, int]:
    """Words, characters in words, symbols, repeated lines, words in repeated 3-word windows of one text."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    chars = len(text) - sum(map(text.count, " \t\n\v\f\r"))
    symbols = sum(map(text.count, SYMBOLS))
    repeated_lines = 0
    if "\n" in text:
        seen = set()
        for line in text.split("\n"):
            if line in seen:
                repeated_lines += bool(line.strip(" \t\v\f\r"))
            seen.add(line)
    if n < 3:
        return n, chars, symbols, repeated_lines, 0
    number = {}
    ids = np.fromiter([number.setdefault(w, len(number)) for w in words], np.int64, n)
    # Pairs are numbered anew before the third word joins, so that the keys stay below 2**63 for any text.
    _, pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)
    _, place, count = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    twice = count[place] > 1
    marked = np.zeros(n, bool)
    for shift in range(3):
        marked[shift: n - 2 + shift] |= twice
    return n, chars, symbols, repeated_lines, int(marked.sum())


def with_statistics(docs: DataFrame, text: str, names: list[str], keep_text: bool = False) -> DataFrame:
    """``docs`` with the five statistics under ``names``, without its text unless that is asked for."""
    kept = [c for c in docs.columns if keep_text or c != text]
    schema = docs.select(*[F.col(f"`{c}`") for c in kept])
    for name in names:
        schema = schema.withColumn(name, F.lit(0).cast("long"))

    def run(batches):
        for batch in slices(batches):
            place = batch.schema.get_field_index
            found = [statistics(t) for t in batch.column(place(text)).to_pylist()]
            new = [pa.array(list(c), pa.int64()) for c in zip(*found)] if found else [pa.array([], pa.int64())] * 5
            yield pa.RecordBatch.from_arrays([*(batch.column(place(c)) for c in kept), *new], names=[*kept, *names])

    return docs.mapInArrow(run, schema.schema)


def features(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) -> list:
    """The transformed statistics as columns: logarithms and square roots bring them near a normal shape."""
    n = F.greatest(n_words, F.lit(1)).cast("double")
    return [F.log(F.greatest(word_chars, F.lit(1)) / n), F.log1p(n_symbols / n),
            n_dup_lines / (n_dup_lines + F.lit(20.0)), n_repeat_words / n]


def _moments(x: list) -> list:
    """Sums from which mean and covariance follow."""
    p = len(x)
    return ([F.count("*").alias("n")] + [F.sum(x[i]).alias(f"s{i}") for i in range(p)]
            + [F.sum(x[i] * x[j]).alias(f"s{i}_{j}") for i in range(p) for j in range(i, p)])


def _fit(n: float, first: np.ndarray, second: np.ndarray, floors) -> tuple[np.ndarray, np.ndarray]:
    centre = first / n
    cov = second / n - np.outer(centre, centre)
    values, vectors = np.linalg.eigh((cov + cov.T) / 2)
    cov = (vectors * np.clip(values, 0, None)) @ vectors.T
    return centre, cov + np.diag(np.square(floors))


def _estimate(floors, factor: float):
    """From a group's bins (nearest first) the centre and inverse shape of its nearer half."""
    p = len(floors)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("bin")
        half = math.ceil(group["n"].sum() * HALF)
        near = group[group["n"].cumsum().shift(fill_value=0) < half]
        first = near[[f"s{i}" for i in range(p)]].to_numpy(float).sum(axis=0)
        second = np.zeros((p, p))
        for i in range(p):
            for j in range(i, p):
                second[i, j] = second[j, i] = near[f"s{i}_{j}"].sum()
        centre, cov = _fit(near["n"].sum(), first, second, floors)
        inverse = np.linalg.inv(cov * factor)
        out = group[["level", "lang", "source"]].head(1).copy()
        out["centre"], out["shape"] = [centre.tolist()], [inverse.ravel().tolist()]
        return out

    return run


def _distance(x: list, estimate):
    p, (centre, shape) = len(x), estimate
    d = [x[i] - centre[i] for i in range(p)]
    return sum((d[i] * d[j] * shape[i * p + j] for i in range(p) for j in range(p)), F.lit(0.0))


def _bin(squared):
    return F.greatest(F.lit(0), F.floor(F.log2(F.greatest(squared, F.lit(2.0 ** LOW))) * PER_OCTAVE) - LOW * PER_OCTAVE).cast("int")


def estimates(stats: DataFrame, x: list[str], floors=FLOORS, steps: int = STEPS) -> DataFrame:
    """level, lang, source, n, centre, shape: the estimates of all groups of ``stats`` (lang, source, features).

    Level 0 is a language and source, 1 a language, 2 everything; every row belongs to three
    groups. The start takes each feature's median and median deviation from approximate
    percentiles; the factor corrects the half's shape to the whole's, by the median distance.
    """
    p, keys = len(x), ["level", "lang", "source"]
    grouped = stats.select(
        F.explode(F.array(*[F.struct(F.lit(level).alias("level"),
                                     (F.col("lang") if level < 2 else F.lit(None).cast("string")).alias("lang"),
                                     (F.col("source") if level < 1 else F.lit(None).cast("string")).alias("source"))
                            for level in range(3)])).alias("g"), *x).select("g.*", *x)
    middle = grouped.groupBy(*keys).agg(*[F.percentile_approx(c, 0.5, 10000).alias(f"m_{c}") for c in x])

    def joined(groups):
        right = groups.toDF(*[f"g_{c}" if c in keys else c for c in groups.columns])
        on = [F.col(c).eqNullSafe(F.col(f"g_{c}")) for c in keys]
        return grouped.join(right, on, "inner").drop(*[f"g_{c}" for c in keys])

    spread = (joined(settle(middle)).groupBy(*keys)
              .agg(*[F.percentile_approx(F.abs(F.col(c) - F.col(f"m_{c}")), 0.5, 10000).alias(f"d_{c}") for c in x],
                   *[F.first(f"m_{c}").alias(f"m_{c}") for c in x]))
    scale = [F.greatest(F.col(f"d_{c}") * 1.4826, F.lit(f)) for c, f in zip(x, floors)]
    current = settle(spread.select(
        *keys, F.array(*[F.col(f"m_{c}") for c in x]).alias("centre"),
        F.array(*[1 / (scale[i] * scale[i]) if i == j else F.lit(0.0) for i in range(p) for j in range(p)]).alias("shape")))
    kinds = "level int, lang string, source string, centre array<double>, shape array<double>"
    for _ in range(steps):
        bins = (joined(current).withColumn("bin", _bin(_distance([F.col(c) for c in x], (F.col("centre"), F.col("shape")))))
                .groupBy(*keys, "bin").agg(*_moments([F.col(c) for c in x])))
        current = settle(bins.groupBy(*keys).applyInPandas(_estimate(floors, 1.0), kinds))
    squared = _distance([F.col(c) for c in x], (F.col("centre"), F.col("shape")))
    factor = (joined(current).groupBy(*keys, "centre", "shape")
              .agg(F.count("*").alias("n"), F.percentile_approx(squared, 0.5, 10000).alias("median")))
    correction = F.greatest(F.lit(1.0), F.col("median") / CHI_MEDIAN)
    return settle(factor.select(*keys, "n", "centre", F.transform("shape", lambda v: v / correction).alias("shape")))


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _ruled(docs: DataFrame, text: str, names, x: list[str], keep_text: bool = False) -> DataFrame:
    """Statistics, the base rules' verdict and the features ``x``."""
    *stat_names, failed, _ = names
    n, repeat = F.col(stat_names[0]), F.col(stat_names[4])
    return (with_statistics(docs, text, stat_names, keep_text)
            .withColumn(failed, (n < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n))
            .withColumns(dict(zip(x, features(*[F.col(c) for c in stat_names])))))


def _groups(ruled: DataFrame, x: list[str], lang: str, source: str, failed: str) -> DataFrame:
    return estimates(ruled.filter(~F.col(failed)).select(
        F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{source}`").cast("string").alias("source"), *x), x)


def _verdicts(ruled: DataFrame, groups: DataFrame, x: list[str], lang: str, source: str, names, limit: float) -> DataFrame:
    """``ruled`` with the last of ``names``. The estimates, one row per group, were written and read
    back, so Spark broadcasts them only below its threshold; the one for everything is a literal."""
    marks, out = fresh(ruled, "mcd_own", "mcd_lang", "mcd_all"), ruled
    for level, mark in enumerate(marks[:2]):
        one = (groups.filter((F.col("level") == level) & (F.col("n") >= MIN_GROUP))
               .select(F.col("lang").alias("mcd_l"), F.col("source").alias("mcd_s"), F.struct("centre", "shape").alias(mark)))
        on = [F.col(f"`{lang}`").eqNullSafe(F.col("mcd_l"))]
        if level == 0:
            on.append(F.col(f"`{source}`").eqNullSafe(F.col("mcd_s")))
        out = out.join(one, on, "left").drop("mcd_l", "mcd_s")
    row = groups.filter(F.col("level") == 2).select("centre", "shape").first()
    whole = [F.lit(list(v) if row else None).cast("array<double>") for v in row or (None, None)]
    out = out.withColumn(marks[2], F.struct(whole[0].alias("centre"), whole[1].alias("shape")))
    near = _distance([F.col(c) for c in x], [F.coalesce(*[F.col(m)[part] for m in marks]) for part in ("centre", "shape")])
    *_, failed, kept = names
    return out.withColumn(kept, ~F.col(failed) & F.coalesce(near <= limit, F.lit(False))).drop(*marks)


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", limit: float = LIMIT,
          names=NAMES) -> DataFrame:
    """``docs`` without its text, with the statistics, ``base_failed`` and ``kept`` under ``names``."""
    x = fresh(docs, *[f"mcd_{f}" for f in FEATURES])
    ruled = settle(_ruled(docs, text, names, x))
    return _verdicts(ruled, _groups(ruled, x, lang, source, names[5]), x, lang, source, names, limit).drop(*x)


def keep(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", limit: float = LIMIT) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns. Texts are read twice and never shuffled."""
    names, x = fresh(docs, *[f"mcd_{n}" for n in NAMES]), fresh(docs, *[f"mcd_{f}" for f in FEATURES])
    groups = _groups(settle(_ruled(docs.select(text, lang, source), text, names, x).select(lang, source, names[5], *x)),
                     x, lang, source, names[5])
    ruled = _ruled(docs, text, names, x, keep_text=True)
    return (_verdicts(ruled, groups, x, lang, source, names, limit).filter(F.col(names[6]))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return judge(docs).drop("lang", "source")
