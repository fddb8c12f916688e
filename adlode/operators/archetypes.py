"""Naming groups of listings after their top skills."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from adlode import constants as C
from adlode.functions.rounding import round_scaled
from adlode.functions.text import once
from adlode.operators.stats import top_per_group


def archetype(top_skills: Column, rules=C.ARCHETYPE_RULES, singles: Mapping[str, str] = C.SPECIFIC_SINGLES,
              default: str = C.DEFAULT_ARCHETYPE) -> Column:
    """Label of an ordered array of skills.

    The rule with the most keywords among the skills wins if it has at least two,
    the earlier rule on equal scores; else the first skill that is specific on its
    own names the group, provided some rule scored at all.
    """
    scores = [F.size(F.array_intersect(top_skills, F.array(*map(F.lit, words)))) for _, words in rules]
    ranked = F.array(*[
        F.struct(score.alias("score"), F.lit(-i).alias("order"), F.lit(name).alias("name"))
        for i, (score, (name, _)) in enumerate(zip(scores, rules))
    ])
    names = F.create_map(*[F.lit(x) for pair in singles.items() for x in pair])
    single = F.get(F.array_compact(F.transform(top_skills, lambda s: F.try_element_at(names, s))), 0)
    return once(F.array_max(ranked), lambda best: (
        F.when(best["score"] >= 2, best["name"])
        .when(best["score"] == 1, F.coalesce(single, F.lit(default)))
        .otherwise(F.lit(default))))


def archetype_scores(profiles: DataFrame, skills: str = "skills", **options) -> DataFrame:
    return profiles.withColumn("archetype", archetype(F.col(skills), **options))


def group_profiles(tagged: DataFrame, group: str, k: int = C.PROFILE_SKILLS, min_weight: float = C.PROFILE_WEIGHT,
                   weight: str | None = None, digits: int | None = 1, **options) -> DataFrame:
    """(group, archetype, size, top_skills, pct_of_total) per group of listings.

    A skill's weight is the share of the group's listings that have it, which is
    what a cluster centre holds for yes/no features. ``weight`` names a column with
    the number of listings a row stands for.
    """
    one = F.col(weight) if weight else F.lit(1)
    # A NULL skill per listing counts the group itself in the same aggregation. The tests
    # below involve the count, so that Spark does not move them before the aggregation.
    marks = tagged.select(
        group, one.cast("long").alias("_w"),
        F.explode(F.concat(F.array(F.lit(None).cast("string")), "skills")).alias("skill"))
    counts = marks.groupBy(group, "skill").agg(F.sum("_w").alias("count"))
    is_skill = F.when(F.col("count") > 0, F.col("skill")).isNotNull()
    sizes = counts.filter(~is_skill).select(group, F.col("count").alias("size"))
    total = sizes.agg(F.sum("size")).scalar()
    weights = (
        counts.filter(is_skill).join(sizes, group)
        .withColumn("weight", F.col("count").cast("double") / F.col("size").cast("double"))
    )
    top = top_per_group(weights, group, [F.desc("weight"), F.asc("skill")], k).filter(F.col("weight") > min_weight)
    listed = top.groupBy(group).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "skill"))), lambda e: e["skill"]).alias("skills"))
    named = sizes.join(listed, group, "left").withColumn(
        "skills", F.coalesce("skills", F.array().cast("array<string>")))
    pct = F.lit(100.0) * F.col("size").cast("double") / total.cast("double")
    return named.select(
        group,
        archetype(F.col("skills"), **options).alias("archetype"),
        "size",
        F.array_join("skills", ", ").alias("top_skills"),
        (pct if digits is None else round_scaled(pct, digits)).alias("pct_of_total"),
    ).orderBy(F.desc("size"), F.asc(group))


def cluster_archetypes(assigned: DataFrame, profiles: DataFrame) -> DataFrame:
    """(raw_id, title, cluster_id, archetype) of every clustered listing."""
    # one row per cluster, so the look-up side has at most K_MAX rows
    names = profiles.select("cluster_id", "archetype")
    return assigned.join(names, "cluster_id", "left").select("raw_id", "title", "cluster_id", "archetype")
