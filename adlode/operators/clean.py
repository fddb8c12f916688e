"""Cleaning: raw listings to clean, tagged listings."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from adlode import constants as C
from adlode.functions import text as X
from adlode.operators.taxonomy import tag_skills


def exclude_demo(rows: DataFrame, url: str = "url", fragment: str = C.DEMO_URL) -> DataFrame:
    """Rows whose url does not contain ``fragment`` in any letter case; NULL urls drop out."""
    return rows.filter(~F.contains(F.lower(F.col(url)), F.lit(fragment.lower())))


def excluded_count(rows: DataFrame, url: str = "url", fragment: str = C.DEMO_URL) -> DataFrame:
    """(total, kept, excluded) of :func:`exclude_demo` in one pass."""
    kept = ~F.contains(F.lower(F.col(url)), F.lit(fragment.lower()))
    return rows.agg(F.count(F.lit(1)).alias("total"), F.count_if(kept).alias("kept")).withColumn(
        "excluded", F.col("total") - F.col("kept"))


def clean_listings(raw: DataFrame, aliases: DataFrame | Mapping[str, str], demo_url: str | None = C.DEMO_URL,
                   cities: Mapping[str, str] = C.CITY_MAP, guards: Mapping[str, str] = C.CONTEXT_GUARDS,
                   engine: str = "auto", scan_chars: int | None = C.LANGUAGE_SCAN_CHARS) -> DataFrame:
    """Raw listings to the clean layout; ``skills`` holds the array behind ``skills_extracted``.

    The language is told from the first ``scan_chars`` characters, from the whole text with None.

    Every step stays within the row: one scan, no shuffle.
    """
    rows = exclude_demo(raw, fragment=demo_url) if demo_url else raw
    tagged = tag_skills(rows, aliases, "id", guards, engine=engine)
    whole = X.combined_text(F.col("skills_raw"), F.col("description"))
    return tagged.select(
        F.col("id").alias("raw_id"),
        "hash",
        X.strip(F.col("title")).alias("title"),
        X.strip(F.col("company")).alias("company"),
        X.normalise_city(F.col("city"), F.col("description"), cities).alias("city"),
        X.bucket_experience(F.col("experience")).alias("experience"),
        X.detect_language(whole, scan_chars=scan_chars).alias("language"),
        X.text(F.col("skills_raw")).alias("skills_raw"),
        X.join_list(F.col("skills")).alias("skills_extracted"),
        "skill_count",
        X.truncate(F.col("description"), 1000).alias("description"),
        *[X.text(F.col(c)).alias(c) for c in ("url", "date_posted", "source")],
        "scraped_at",
        "skills",
    )
