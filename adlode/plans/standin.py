"""The given tables in the role of listings, taxonomy, pages and baskets.

``documents`` stand for listings, ``pages`` for captured pages, ``lineitem`` and
``part`` for baskets, ``events`` for arriving rows. The word lists below are
parameters of the registered queries, chosen so that every rule has something to do.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from adlode.operators.ingest import with_hash
from adlode.operators.taxonomy import taxonomy_aliases, tag_skills
from adlode.sources.tables import spread

# (canonical, aliases, category): whole words that occur in the texts, one alias claimed twice.
TAXONOMY = (
    ("That", "that;thatth", "English"),
    ("With", "with", "English"),
    ("From", "this;from", "English"),
    ("This", "this", "English"),
    ("Of", "of", "English"),
    ("Pour", "pour;avec", "French"),
    ("La", "la", "French"),
    ("Le", "le", "French"),
    ("Un", "un", "French"),
    ("Sich", "sich;nicht", "German"),
    ("Der", "der", "German"),
    ("Los", "los;del", "Spanish"),
)

# The alias "un" counts only where one of these phrases occurs.
GUARDS = {"un": r"(pour\s+un|dans\s+un|un\s+est)"}

# Keywords of the stand-in archetypes, with two single words that are specific on their own.
RULES = (
    ("Anglo", ("That", "With", "This", "Of")),
    ("Gallic", ("Pour", "La", "Le", "Un")),
    ("Mixed", ("La", "Los", "Of")),
    ("Teutonic", ("Sich", "Der")),
)
SINGLES = {"Los": "Iberian", "Der": "Teutonic"}

# Groups of skills for the report.
GROUPS = {"Articles": ("La", "Le", "Der", "Un", "Los"), "Particles": ("That", "With", "Of", "Sich")}

# City spellings; the first key that occurs wins, so the longer ones below are never reached.
CITIES = {"nation_1": "Primary", "nation_10": "Tenth", "nation_2": "Secondary", "building": "Builder"}

# Display names of some sources.
LABELS = {"src0": "Source Zero", "src1": "Source One", "src10": "Source Ten"}

# Words that start the part to cut off.
CUT_WORDS = ("the", "le", "der", "los")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def listings(spark: SparkSession, folder: str, spread_out: bool = False) -> DataFrame:
    """Documents in the layout of raw listings, title being the first line; language is kept beside it."""
    d = table(spark, folder, "documents")
    if spread_out:
        d = spread(d, "doc_id")
    blank = F.lit("")
    return with_hash(d.select(
        F.col("doc_id").alias("id"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("lang").alias("company"),
        blank.alias("city"),
        blank.alias("experience"),
        blank.alias("skills_raw"),
        F.col("text").alias("description"),
        blank.alias("url"),
        blank.alias("date_posted"),
        "source",
        "lang",
    ))


def aliases() -> dict[str, str]:
    """The stand-in alias table; a later line wins."""
    found = {}
    for canonical, names, _ in TAXONOMY:
        for name in [canonical, *names.split(";")]:
            found[name.lower()] = canonical
    return found


def taxonomy(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(line, *row) for line, row in enumerate(TAXONOMY)],
        "line bigint, canonical string, aliases string, category string")


def tagged(spark: SparkSession, folder: str, engine: str = "direct") -> DataFrame:
    """Listings with ``skills`` and ``skill_count``, and ``raw_id`` as after cleaning."""
    return tag_skills(_to_tag(spark, folder), aliases(), guards=GUARDS, engine=engine)


def _to_tag(spark: SparkSession, folder: str) -> DataFrame:
    return listings(spark, folder, spread_out=True).withColumn("raw_id", F.col("id"))


def tagged_by_join(spark: SparkSession, folder: str) -> DataFrame:
    return tag_skills(_to_tag(spark, folder), taxonomy_aliases(taxonomy(spark)), guards=GUARDS, limit=0)


def large_taxonomy(spark: SparkSession, folder: str, words: int = 12) -> DataFrame:
    """Benchmark items as a taxonomy of full size: the first words of each text are its aliases."""
    spoken = F.filter(F.split(F.lower("text"), r"\P{L}+"), lambda word: word != "")
    return table(spark, folder, "benchmark").select(
        F.col("item_id").alias("line"), F.concat(F.lit("Item "), F.col("item_id")).alias("canonical"),
        F.array_join(F.slice(spoken, 1, words), ";").alias("aliases"))


def tagged_large(spark: SparkSession, folder: str) -> DataFrame:
    return tag_skills(_to_tag(spark, folder), taxonomy_aliases(large_taxonomy(spark, folder)), guards={})


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    """(order, item): the second word of each ordered part's name."""
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.element_at(F.split("p_name", " "), 2).alias("item"))
    return table(spark, folder, "lineitem").select("l_orderkey", "l_partkey").join(parts, "l_partkey")
