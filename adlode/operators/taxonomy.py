"""Taxonomy of skills: alias table, tagging of texts, distinct counts."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from adlode import constants as C
from adlode.functions import skills as S
from adlode.functions.text import combined_text, once, split_list, strip, text
from adlode.session import settle

# Alias tables up to this size are held by every task; larger ones are joined.
MAX_HELD_ALIASES = 200_000
# Tasks a frequent run is spread over in that join, and the length from which a run is cut.
SPREAD, LONG_RUN = 16, 32


def taxonomy_aliases(taxonomy: DataFrame, line: str = "line") -> DataFrame:
    """(alias, canonical): every skill under its own name and its aliases; the last line wins."""
    canonical = strip(F.col("canonical"))
    names = F.concat(F.array(F.lower(canonical)), split_list(F.lower(F.col("aliases")), ";"))
    return (
        taxonomy.select(canonical.alias("canonical"), F.col(line).alias("line"), F.explode(names).alias("alias"))
        .filter("alias <> '' and canonical <> ''")
        .groupBy("alias")
        .agg(F.max_by("canonical", "line").alias("canonical"))
    )


def held_aliases(aliases: DataFrame, limit: int = MAX_HELD_ALIASES) -> dict[str, str] | None:
    """The alias table as a mapping, or None where it is larger than ``limit``."""
    rows = aliases.select("alias", "canonical").limit(limit + 1).collect()
    return None if len(rows) > limit else {r["alias"]: r["canonical"] for r in sorted(rows)}


def tag_skills(listings: DataFrame, aliases: DataFrame | Mapping[str, str], id_col: str = "id",
               guards: Mapping[str, str] = C.CONTEXT_GUARDS, match: str = S.ANYWHERE, engine: str = "auto",
               limit: int = MAX_HELD_ALIASES) -> DataFrame:
    """Add ``skills`` and ``skill_count`` from ``skills_raw`` and ``description``.

    Tagging stays within the row. Only an alias table beyond ``limit`` is joined by
    :func:`tag_by_join` instead.
    """
    held = held_aliases(aliases, limit) if isinstance(aliases, DataFrame) else aliases
    whole = combined_text(F.col("skills_raw"), F.col("description"))
    if held is None:
        tagged = tag_by_join(listings.withColumn("_text", whole), aliases, id_col, "_text", guards, match)
        tagged = tagged.drop("_text")
    else:
        # generated, not projected: a later filter on the skills then reads them instead of matching again
        found = S.match_skills(whole, held, guards, match, engine)
        tagged = listings.select("*", F.explode(F.array(found)).alias("skills"))
    return tagged.withColumn("skill_count", F.size("skills"))


def tag_by_join(rows: DataFrame, aliases: DataFrame, id_col: str, text_col: str,
                guards: Mapping[str, str] = C.CONTEXT_GUARDS, match: str = S.ANYWHERE) -> DataFrame:
    """The same tags for alias tables of any size, by joining texts and aliases on the runs of a text.

    A text falls into runs of word characters and of others, and an alias is filed under its longest
    run of word characters. Which aliases a run may belong to is found once for every distinct run of
    the table, on short grams; the texts then meet the runs that lead to any. Only run and id travel,
    and every candidate is tested against the whole text before it counts.
    """
    lowered = F.lower(text(F.col(text_col)))
    word, size = f"[{C.WORD_CHARS}]", C.SHORT_ALIAS + 1

    def runs(c):
        return F.regexp_extract_all(c, F.lit(f"{word}+|[^{C.WORD_CHARS}]+"), F.lit(0))

    def windows(run):
        # a long run is cut so that every gram lies in a window
        starts = F.sequence(F.lit(1), F.length(run), F.lit(LONG_RUN - size))
        return F.when(F.length(run) <= LONG_RUN, F.array(run)).otherwise(
            F.transform(starts, lambda at: F.substring(run, at, LONG_RUN)))

    own = F.filter(runs(F.col("alias")), lambda run: F.rlike(run, F.lit(word)))
    longest = F.array_max(F.transform(own, lambda run: F.struct(F.length(run).alias("n"), run.alias("run"))))["run"]
    bounded = F.lit(match == S.AS_WORD) | (F.length("alias") <= C.SHORT_ALIAS)
    keyed = (
        aliases.filter(~F.col("alias").isin(*guards)).select("alias", "canonical", F.coalesce(longest, "alias").alias("part"),
                                                             (bounded & longest.isNotNull()).alias("alone"))
        .withColumn("gram", F.substring("part", 1, size))
    )
    present = rows.select(id_col, F.explode(F.array_distinct(F.flatten(F.transform(runs(lowered), windows)))).alias("run"))
    # every start position gives one gram of each size, in one pass per size
    grams = F.array_distinct(F.flatten(F.array(*[
        F.regexp_extract_all(F.col("run"), F.lit(rf"(?s)(?=(.{{{n}}}))"), F.lit(1)) for n in range(1, size + 1)])))
    fits = F.when(F.length("run") >= LONG_RUN, F.lit(True)).when(F.col("alone"), F.col("run") == F.col("part")).otherwise(
        F.contains("run", "part"))
    # written, so that Spark knows how few runs lead to an alias and need not shuffle the texts' runs
    filed = settle(present.select("run").distinct().withColumn("gram", F.explode(grams)).join(keyed, "gram").filter(fits)
                   .groupBy("run").agg(F.collect_set(F.struct("alias", "canonical")).alias("entries")))
    # a run may occur in most texts, so its rows are spread over several tasks
    present = present.withColumn("spread", F.pmod(F.xxhash64(id_col), F.lit(SPREAD)))
    filed = filed.withColumn("spread", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)).cast("array<bigint>")))
    candidates = present.join(filed, ["run", "spread"]).groupBy(id_col).agg(
        F.array_distinct(F.flatten(F.collect_list("entries"))).alias("_candidates"))

    def occurs(whole, entry):
        quoted = F.replace(entry["alias"], F.lit(r"\E"), F.lit(r"\E\\E\Q"))
        bounded = F.concat(F.lit(f"(?<![{C.WORD_CHARS}])\\Q"), quoted, F.lit(f"\\E(?![{C.WORD_CHARS}])"))
        short = F.lit(match == S.AS_WORD) | (F.length(entry["alias"]) <= C.SHORT_ALIAS)
        return F.contains(whole, entry["alias"]) & (~short | F.rlike(whole, bounded))

    tested = once(lowered, lambda whole: F.filter(
        F.coalesce("_candidates", F.array()), lambda entry: occurs(whole, entry)))
    candidates = candidates.withColumnRenamed(id_col, "_candidates_id")
    tagged = rows.join(candidates, F.col(id_col).eqNullSafe(F.col("_candidates_id")), "left").drop("_candidates_id").withColumn("skills", F.transform(tested, lambda e: e["canonical"]))
    tagged = tagged.drop("_candidates")
    for alias, pattern in guards.items():
        skill = aliases.filter(F.col("alias") == alias).agg(F.max("canonical")).scalar()
        tagged = tagged.withColumn(
            "skills", F.concat("skills", F.array(F.when(S.context_hit(F.col(text_col), pattern), skill))))
    return tagged.withColumn("skills", F.array_sort(F.array_distinct(F.array_compact("skills"))))


def distinct_skills(rows: DataFrame, column: str) -> DataFrame:
    return rows.agg(F.countDistinct(column).alias("n"))


def baskets(tagged: DataFrame, id_col: str = "raw_id") -> DataFrame:
    """(id, items): the skills of every listing that has any."""
    return skilled_only(tagged).select(id_col, F.col("skills").alias("items"))


def skilled_only(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.size("skills") > 0)
