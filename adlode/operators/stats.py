"""Counts, shares, averages and rankings over clean listings."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from adlode import constants as C
from adlode.functions.rounding import with_percent
from adlode.functions.text import list_length


def rows_by(rows: DataFrame, column: str) -> DataFrame:
    """(column, count), largest first, ties by value."""
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), F.asc(column))


def share_of_total(rows: DataFrame, column: str, top: int | None = None, digits: int | None = None) -> DataFrame:
    """(column, count, pct of all rows); ``top`` keeps the largest but not the denominator."""
    counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    # the total is added up from the same counts, whose shuffle Spark runs once
    total = counts.agg(F.sum("count")).scalar()
    shares = with_percent(counts, "count", total, digits).orderBy(F.desc("count"), F.asc(column))
    return shares.limit(top) if top else shares


def explode_skills(tagged: DataFrame, *keep: str) -> DataFrame:
    """One row per listing and skill."""
    return tagged.select(*keep, F.explode("skills").alias("skill"))


def counts_and_total(rows: DataFrame, items: str, name: str) -> tuple[DataFrame, Column]:
    """((name, count) per array entry, number of rows), both from one aggregation.

    Every row adds one NULL entry. The two readers must not test the entry alone:
    Spark would move such a test below the aggregation, whose two variants would
    then be computed separately.
    """
    marks = rows.select(F.explode(F.concat(F.array(F.lit(None).cast("string")), items)).alias(name))
    counts = marks.groupBy(name).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.max(F.when(F.col(name).isNull(), F.col("count")))).scalar()
    return counts.filter(F.when(F.col("count") > 0, F.col(name)).isNotNull()), total


def skill_frequency(tagged: DataFrame, top: int | None = None, digits: int | None = 1) -> DataFrame:
    """(skill, count, pct of all listings, those without skills included).

    Each listing adds one row without a skill; that group's count is the
    denominator, so the tagged listings are read once.
    """
    counts, total = counts_and_total(tagged, "skills", "skill")
    table = with_percent(counts, "count", total, digits).orderBy(F.desc("count"), F.asc("skill"))
    return table.limit(top) if top else table


def ranked(rows: DataFrame, *order: str | Column, top: int = 30) -> DataFrame:
    """The first ``top`` rows with their rank. Only those rows are ranked, never the whole table."""
    first = rows.orderBy(*order).limit(top)
    return first.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def category_breakdown(frequency: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Mentions per taxonomy category; skills without one count as Other.

    ``frequency`` is already a top-N table, so the sum is that of the top N.
    """
    categories = taxonomy.select(F.col("canonical").alias("skill"), "category")
    return (
        frequency.join(categories, "skill", "left")
        .withColumn("category", F.coalesce("category", F.lit(C.OTHER)))
        .groupBy("category").agg(F.sum("count").alias("count"))
        .orderBy(F.desc("count"), F.asc("category"))
    )


def average_skills(tagged: DataFrame) -> DataFrame:
    """Average number of skills over all listings and over those that have any."""
    n = F.size("skills").cast("long")
    return tagged.agg(
        F.avg(n).alias("avg_all"),
        F.avg(F.when(n > 0, n)).alias("avg_skilled"),
    )


def kpis(tagged: DataFrame) -> DataFrame:
    return tagged.agg(F.count(F.lit(1)).alias("listings"), F.avg(F.col("skill_count").cast("long")).alias("avg_skills"))


def source_comparison(clean: DataFrame, raw: DataFrame, city: str = "city") -> DataFrame:
    """Per source: listings with skills, their average number of skills, distinct cities."""
    skilled = clean.filter(F.col("skills_extracted") != "").select("raw_id", "skills_extracted", city)
    return (
        skilled.join(raw.select(F.col("id").alias("raw_id"), "source"), "raw_id")
        .groupBy("source")
        .agg(
            F.count(F.lit(1)).alias("total_jobs"),
            F.avg(list_length(F.col("skills_extracted"))).alias("avg_skills"),
            F.countDistinct(city).alias("unique_cities"),
        )
        .orderBy(F.desc("total_jobs"), F.asc("source"))
    )


def group_literals(frequency: DataFrame, groups: Mapping[str, Sequence[str]], key: str, name: str) -> DataFrame:
    """(name, key) rows of a small fixed mapping."""
    rows = [(group, member) for group, members in groups.items() for member in members]
    return frequency.sparkSession.createDataFrame(rows, f"{name} string, {key} string")


def skill_groups(frequency: DataFrame, groups: Mapping[str, Sequence[str]] = C.SKILL_GROUPS) -> DataFrame:
    """Mentions per skill of every group, and a row with skill NULL for the group's total."""
    table = group_literals(frequency, groups, "skill", "skill_group")
    return (
        frequency.join(F.broadcast(table), "skill")
        .rollup("skill_group", "skill").agg(F.sum("count").alias("count"))
        .filter("skill_group is not null")
        .orderBy("skill_group", F.desc("count"), F.asc_nulls_first("skill"))
    )


def rule_stats(rules: DataFrame) -> DataFrame:
    return rules.agg(
        F.count(F.lit(1)).alias("rules"),
        F.avg("support").alias("avg_support"),
        F.avg("confidence").alias("avg_confidence"),
        F.avg("lift").alias("avg_lift"),
        F.max("lift").alias("max_lift"),
    )


def archetype_counts(labelled: DataFrame, column: str = "archetype") -> DataFrame:
    """Listings per archetype; unlabelled ones are left out."""
    return rows_by(labelled.filter(F.col(column).isNotNull()), column)


def top_per_group(counts: DataFrame, group: str, order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of every group, with their rank."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return counts.withColumn("rank", rank).filter(F.col("rank") <= k)


def top_skills_per_group(tagged: DataFrame, group: str, k: int = 15) -> DataFrame:
    """(group, skill, count, rank): the k most frequent skills of every group.

    Counts come first, so a group's size does not matter for the ranking.
    """
    counts = (
        explode_skills(tagged.filter(F.col(group).isNotNull()), group)
        .groupBy(group, "skill").agg(F.count(F.lit(1)).alias("count"))
    )
    return top_per_group(counts, group, [F.desc("count"), F.asc("skill")], k)
