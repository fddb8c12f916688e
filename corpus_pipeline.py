"""The corpus pipeline: from raw documents to token ids of a clean, mixed corpus."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlode.llm import bpe, jaccard, mixing, outliers, toxicity
from adlode.llm.common import fresh, table
from adlode.llm.records import vocabulary
from adlode.session import settle


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the robust outlier test reject go."""
    return outliers.keep(docs)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier marks as toxic go; it learns from the labelled folds of the raw tables."""
    score, = fresh(docs, "toxicity_score")
    scored = toxicity.with_scores(docs, toxicity.model_for(spark, sf_dir), score=score, keep_text=True)
    return scored.filter(F.col(score) < toxicity.THRESHOLD).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingles stays."""
    return jaccard.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that each source's words meet its target."""
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids and whether decoding the ids gives the text back."""
    ids, decoded = fresh(docs, "bpe_ids", "bpe_decoded")
    coded = bpe.encode_decode(docs, vocabulary("byte_bpe_50k.json"), ids=ids, decoded=decoded)
    return coded.select("doc_id", "lang", "source", F.size(ids).cast("long").alias("n_tokens"), F.col(ids).alias("ids"),
                        (F.col(decoded) == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("ngram_jaccard", near_duplicates),
    ("source_mix", source_mix),
    ("bpe", token_ids),
]

#: The learnt and estimated stages have no equivalent in SQL; tests/llm/test_pipeline.py holds every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written and read back."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs
