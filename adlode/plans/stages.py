"""The stages end to end: ingest, clean and tag, mine. Each reads and writes tables under one folder."""

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from adlode import constants as C, schema
from adlode.operators.clean import clean_listings
from adlode.operators.clusters import cluster_roles
from adlode.operators.pages import BASE_URLS, portal_listings
from adlode.operators.rules import association_rules, itemsets, rule_table
from adlode.operators.stats import skill_frequency
from adlode.operators.taxonomy import baskets, taxonomy_aliases
from adlode.functions.text import split_list
from adlode.sources.sinks import export_csv, ingest_portals, write_version
from adlode.sources.tables import read_or_empty, read_taxonomy, read_version, seed_if_empty
from pyspark.sql import functions as F


def ingest_report(spark: SparkSession, pages: DataFrame, store: str, only: str | None = None, cap: int | None = None) -> DataFrame:
    """Listings of captured pages, all of them unless ``cap`` limits a portal's pages, into the ``jobs``
    table; returns (source, scraped, new, failed) per portal and in total."""
    portals = {p: partial(portal_listings, p, pages, cap) for p in BASE_URLS if only is None or p == only}
    if not portals:
        raise ValueError("no portal chosen")
    return ingest_portals(spark, portals, f"{store}/jobs")


def run_ingest(spark: SparkSession, pages: DataFrame, store: str, only: str | None = None, cap: int | None = None) -> int:
    """The same; returns the number of new listings."""
    return ingest_report(spark, pages, store, only, cap).filter("source = 'TOTAL'").first()["new"]


def run_cleaning(spark: SparkSession, store: str, taxonomy_path: str, exports: str | None = None) -> DataFrame:
    """``jobs`` to ``jobs_clean`` and the skill frequencies, which are returned."""
    raw = seed_if_empty(read_or_empty(spark, f"{store}/jobs", schema.RAW))
    aliases = taxonomy_aliases(read_taxonomy(spark, taxonomy_path))
    write_version(clean_listings(raw, aliases).drop("skills"), f"{store}/jobs_clean")
    write_version(skill_frequency(load_clean(spark, store)), f"{store}/skill_frequency")
    frequency = read_version(spark, f"{store}/skill_frequency", schema.FREQUENCY)
    if exports:
        export_csv(frequency, exports, "skill_frequency")
    return frequency


def load_clean(spark: SparkSession, store: str) -> DataFrame:
    """``jobs_clean`` with the skills as an array again; empty if not written yet."""
    clean = read_version(spark, f"{store}/jobs_clean", schema.CLEAN)
    return clean.withColumn("skills", split_list(F.col("skills_extracted")))


def run_mining(spark: SparkSession, store: str, exports: str | None = None) -> dict[str, DataFrame]:
    """Rules, clusters and cluster profiles; nothing where too few listings have skills."""
    clean = load_clean(spark, store)
    skilled = clean.filter(F.size("skills") > 0)
    if skilled.limit(C.K_MIN).count() < C.K_MIN:
        return {}
    rules = rule_table(association_rules(itemsets(baskets(skilled))))
    clusters, profiles = cluster_roles(skilled)
    layouts = {"association_rules": schema.RULES, "job_clusters": schema.CLUSTERS, "cluster_profiles": schema.PROFILES}
    written = {}
    for (name, layout), table in zip(layouts.items(), (rules, clusters, profiles)):
        write_version(table, f"{store}/{name}")
        written[name] = read_version(spark, f"{store}/{name}", layout)
        if exports:
            export_csv(written[name], exports, name)
    return written


def run_all(spark: SparkSession, pages: DataFrame, store: str, taxonomy_path: str,
            exports: str | None = None) -> dict[str, DataFrame]:
    run_ingest(spark, pages, store)
    frequency = run_cleaning(spark, store, taxonomy_path, exports)
    return {"skill_frequency": frequency, **run_mining(spark, store, exports)}
