"""Filtered views of clean listings and of rules."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from adlode import constants as C
from adlode.functions.text import display_list, truncate
from adlode.operators.stats import skill_frequency

# Columns of the listing view and their headings.
VIEW_COLUMNS = {
    "title": "Job Title",
    "company": "Company",
    "city": "City",
    "experience": "Experience",
    "skills_extracted": "Skills",
    "source": "Portal",
    "date_posted": "Posted",
    "url": "Link",
}


def filter_multi(rows: DataFrame, **chosen: Sequence[str] | None) -> DataFrame:
    """Keep rows whose columns have one of the chosen values; nothing chosen means no filter."""
    for column, values in chosen.items():
        if values:
            rows = rows.filter(F.col(column).isin(*values))
    return rows


def search(rows: DataFrame, pattern: str, columns: Sequence[str] = ("title", "company")) -> DataFrame:
    """Rows where the pattern (a regular expression, any letter case) occurs in one of the columns."""
    if not pattern:
        return rows
    hit = F.lit(False)
    for column in columns:
        hit = hit | F.coalesce(F.rlike(F.col(column), F.lit("(?iu)" + pattern)), F.lit(False))
    return rows.filter(hit)


def listing_view(rows: DataFrame, columns: Mapping[str, str] = VIEW_COLUMNS,
                 labels: Mapping[str, str] = C.PORTAL_LABELS) -> DataFrame:
    """The available columns under their headings, portals by display name, skills with commas."""
    shown = {c: F.col(c) for c in columns if c in rows.columns}
    if "source" in shown and labels:
        table = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
        shown["source"] = F.coalesce(F.try_element_at(table, F.col("source")), F.col("source"))
    if "skills_extracted" in shown:
        shown["skills_extracted"] = display_list(F.col("skills_extracted"))
    return rows.select(*[c.alias(columns[name]) for name, c in shown.items()])


def filter_options(rows: DataFrame, column: str) -> DataFrame:
    return rows.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def skill_frequency_filtered(tagged: DataFrame, top: int = 30, digits: int | None = 1,
                             **chosen: Sequence[str] | None) -> DataFrame:
    """Top skills of the chosen listings, shares of the chosen listings."""
    return skill_frequency(filter_multi(tagged, **chosen), top, digits)


def rules_filtered(rules: DataFrame, min_confidence: float = C.MIN_CONFIDENCE, min_lift: float = C.MIN_LIFT,
                   top: int = 15) -> DataFrame:
    return (
        rules.filter((F.col("confidence") >= min_confidence) & (F.col("lift") >= min_lift))
        .orderBy(F.desc("lift"), F.desc("confidence"), "if_skills", "then_skills")
        .limit(top)
    )


def chart_order(top_rows: DataFrame, *columns: str) -> DataFrame:
    """A top-N table turned round for a horizontal bar chart."""
    return top_rows.orderBy(*[F.asc(c) for c in columns])


def listings_with_skill(clean: DataFrame, raw: DataFrame, skill: str, n: int | None = 3, exact: bool = False,
                        chars: int = 400) -> DataFrame:
    """(raw_id, title, description start) of listings tagged with a skill, lowest ids first.

    By default the skill is searched in the joined list in any letter case, as a
    LIKE does; ``exact`` compares whole entries.
    """
    hit = (F.array_contains("skills", skill) if exact
           else F.contains(F.lower("skills_extracted"), F.lit(skill.lower())))
    found = clean.filter(hit).select("raw_id")
    if n is not None:
        found = found.orderBy("raw_id").limit(n)
    joined = raw.join(found, raw["id"] == found["raw_id"])
    return joined.select("raw_id", raw["title"], truncate(raw["description"], chars).alias("description"))


def zero_skill_sample(clean: DataFrame, raw: DataFrame, n: int = 5, chars: int = 300) -> DataFrame:
    """The first listings without any skill."""
    picked = clean.filter("skill_count = 0").orderBy("raw_id").limit(n).select(F.col("raw_id").alias("id"))
    return raw.join(picked, "id", "left_semi").select(
        "id", "title", "skills_raw", truncate(F.col("description"), chars).alias("description"))


def with_archetypes(clean: DataFrame, clusters: DataFrame) -> DataFrame:
    """Clean listings with their archetype; unclustered ones keep NULL."""
    if "archetype" in clean.columns:
        return clean
    return clean.join(clusters.select("raw_id", "archetype"), "raw_id", "left")
