import pytest
from pyspark.sql import functions as F

from adlode import schema
from adlode.operators import stats, views
from adlode.plans import stages
from adlode.sources.sinks import write_version
from tests.test_pages import PAGES

TAXONOMY = """canonical,aliases,category
Java,java,Languages
SQL,sql,Databases
Python,python;py,Languages
Linux,linux,Systems
"""


@pytest.fixture
def taxonomy_file(tmp_path):
    path = tmp_path / "taxonomy.csv"
    path.write_text(TAXONOMY, encoding="utf-8")
    return str(path)


def test_run_all(spark, tmp_path, taxonomy_file):
    store, exports = str(tmp_path / "store"), str(tmp_path / "exports")
    pages = spark.createDataFrame(PAGES, "portal string, page_no int, url string, html string")
    results = stages.run_all(spark, pages, store, taxonomy_file, exports)
    assert list(results) == ["skill_frequency"]  # two listings with skills are too few to mine
    assert [tuple(r) for r in results["skill_frequency"].collect()][0] == ("SQL", 2, 28.6)
    assert stages.load_clean(spark, store).count() == 7
    assert stages.run_ingest(spark, pages, store) == 0


def test_cleaning_without_listings_seeds_and_drops_the_seed(spark, tmp_path, taxonomy_file):
    frequency = stages.run_cleaning(spark, str(tmp_path), taxonomy_file)
    assert frequency.count() == 0 and frequency.schema == schema.FREQUENCY
    assert stages.run_mining(spark, str(tmp_path)) == {}


def test_mining_writes_every_table(spark, tmp_path):
    kinds = [["Docker", "AWS"], ["React", "CSS", "HTML"], ["Oracle", "COBOL"], []]
    rows = [(i, f"t{i}", "|".join(kinds[i % 4])) for i in range(80)]
    clean = spark.createDataFrame(rows, "raw_id long, title string, skills_extracted string")
    for field in schema.CLEAN.fields:
        if field.name not in clean.columns:
            clean = clean.withColumn(field.name, F.lit(None).cast(field.dataType))
    write_version(clean.select(schema.CLEAN.fieldNames()), f"{tmp_path}/jobs_clean")
    results = stages.run_mining(spark, str(tmp_path), str(tmp_path / "exports"))
    assert results["association_rules"].count() > 0 and results["job_clusters"].count() == 60
    assert sum(r["size"] for r in results["cluster_profiles"].collect()) == 60
    shown = views.with_archetypes(stages.load_clean(spark, str(tmp_path)), results["job_clusters"])
    assert shown.count() == 80 and stats.archetype_counts(shown).agg(F.sum("count")).first()[0] == 60


def test_views(spark):
    rows = spark.createDataFrame(
        [("Dev (senior)", "Acme", "emploi_cm", "Java|SQL"), ("Ops", None, "other", "")],
        "title string, company string, source string, skills_extracted string")
    shown = views.listing_view(rows).collect()
    assert shown[0].asDict() == {"Job Title": "Dev (senior)", "Company": "Acme", "Skills": "Java, SQL", "Portal": "Emploi.cm"}
    assert shown[1]["Portal"] == "other"
    assert views.search(rows, "ACME|zzz").count() == 1 and views.search(rows, "").count() == 2
    assert views.search(rows, "^ops$").count() == 1
    assert views.filter_multi(rows, source=[], title=None).count() == 2
    assert views.filter_multi(rows, source=["other"]).count() == 1


def test_small_statistics(spark):
    tagged = spark.createDataFrame([(1, ["A", "B"]), (2, ["A"]), (3, [])], "raw_id long, skills array<string>")
    frequency = stats.skill_frequency(tagged)
    assert [tuple(r) for r in frequency.collect()] == [("A", 2, 66.7), ("B", 1, 33.3)]
    assert stats.average_skills(tagged).first().asDict() == {"avg_all": 1.0, "avg_skilled": 1.5}
    assert [r["rank"] for r in stats.ranked(frequency, F.desc("count"), top=2).collect()] == [1, 2]
    nothing = tagged.filter("raw_id > 5")
    assert stats.skill_frequency(nothing).count() == 0
    groups = stats.skill_groups(frequency, {"g": ["A", "B", "C"], "empty": ["D"]})
    assert [tuple(r) for r in groups.collect()] == [("g", None, 3), ("g", "A", 2), ("g", "B", 1)] or \
        sorted(map(str, groups.collect())) == sorted(map(str, [("g", "A", 2), ("g", "B", 1), ("g", None, 3)]))
