"""Mixing sources to target weights.

Words are summed per source, targets follow from the weights under a ceiling, and every
document is emitted floor(rate) times plus once more with the probability of the fraction,
decided by a hash of its id. Nothing depends on partitioning, so reruns agree.

Defined results: a NULL or empty text has size 0 and is emitted like any other row; the NULL
source is a source of its own, sorted last; repeated rows and equal ids share their decision;
a source without words has target 0; an empty table gives an empty result. Further columns of
the input are kept, whatever their names.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlode.llm.common import WORD, fresh, uniform
from adlode.session import settle

WEIGHTS, SHARE, CEILING = (3, 1, 2), 1.5, 2.0


def words(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(docs: DataFrame, weights=WEIGHTS, share=SHARE, ceiling=CEILING,
                   text: str = "text", source: str = "source") -> DataFrame:
    """source, source_size, target: one row per source.

    Weights repeat over the sources in code-point order. All targets together are ``share``
    times all words; a target stops at ``ceiling`` times its source, and what exceeds that is
    shared again by weight. The final state of this sharing is the level at which
    sum(min(cap, level * weight)) meets the total; it is found by one pass over the sources in
    the order in which they reach their caps. The windows run over the table of sources, which
    has one aggregated row per source.
    """
    sizes = docs.groupBy(F.col(source).alias("source")).agg(F.sum(words(F.col(text))).alias("source_size"))
    in_order, by_cap = Window.orderBy(F.col("source").asc_nulls_last()), Window.orderBy("ratio", "place")
    everything = Window.partitionBy()
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.withColumn("place", F.row_number().over(in_order))
    weighted = (placed.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                         (F.col("place") - 1) % len(weights) + 1))
                .withColumn("cap", F.col("source_size") * F.lit(float(ceiling)))
                .withColumn("ratio", F.col("cap") / F.col("weight")))
    levels = (weighted
              .withColumn("open", F.sum("source_size").over(everything) * F.lit(float(share))
                          - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
              .withColumn("open_weight", F.sum("weight").over(everything)
                          - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
              .withColumn("at", F.col("open") / F.col("open_weight")))
    met = F.when(F.col("at") <= F.col("ratio"), F.struct("ratio", "place", "at"))
    return (levels.withColumn("level", F.min(met).over(everything).getField("at"))
            .select("source", "source_size",
                    F.coalesce(F.least("cap", F.col("level") * F.col("weight")), F.col("cap")).alias("target")))


def with_copies(docs: DataFrame, seed: str = "mix", doc_id: str = "doc_id", text: str = "text", source: str = "source",
                names=("size", "source_size", "target", "copies"), **rules) -> DataFrame:
    """``docs`` with four more columns: its words, its source's words and target, and how often it is emitted.

    The targets are written and read back, so that their size is known: Spark broadcasts them
    while they are below its threshold and splits hot sources of a sorted join beyond it.
    """
    size, total, target, copies = names
    key, = fresh(docs, "mix_source")
    targets = settle(source_targets(docs, text=text, source=source, **rules)).toDF(key, total, target)
    joined = docs.join(targets, F.col(source).eqNullSafe(F.col(key)), "left").drop(key)
    rate = F.when(F.col(total) > 0, F.col(target) / F.col(total)).otherwise(0.0)
    extra = uniform(seed, F.col(doc_id)) < rate - F.floor(rate)
    return (joined.withColumn(size, words(F.col(text)))
            .withColumn(copies, F.floor(rate) + extra.cast("long")))


def mix(docs: DataFrame, seed: str = "mix", **options) -> DataFrame:
    """The mixed corpus: the columns of ``docs``, each row as often as its source's rate asks for."""
    names = fresh(docs, "mix_size", "mix_source_size", "mix_target", "mix_copies")
    copy, = fresh(docs, "mix_copy")
    planned = with_copies(docs, seed, names=names, **options)
    return (planned.filter(F.col(names[3]) > 0)
            .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(names[3]).cast("int"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def query(spark, sf_dir: str) -> DataFrame:
    from adlode.llm.common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return with_copies(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM totals),
capped AS (
  SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(place - 1) % 3 + 1] AS weight, source_size * 2.0::DOUBLE AS cap FROM weighted),
levels AS (
  SELECT *, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
      - coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE) AS open,
    sum(weight) OVER ()
      - coalesce(sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE) AS open_weight
  FROM capped),
level AS (SELECT min_by(open / open_weight, place_in_line) AS lvl FROM (
  SELECT *, row_number() OVER (ORDER BY cap / weight, place) AS place_in_line FROM levels) WHERE open / open_weight <= cap / weight),
targets AS (SELECT source, source_size, coalesce(least(cap, lvl * weight), cap) AS target FROM levels, level),
rates AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate FROM targets)
SELECT doc_id, size, source_size, target,
  size * (floor(rate)::BIGINT
    + (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE < rate - floor(rate))::BIGINT) AS taken
FROM sized JOIN rates ON sized.source IS NOT DISTINCT FROM rates.source
"""
