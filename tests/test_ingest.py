import pytest
from pyspark.sql import functions as F

from adlode import schema
from adlode.operators import clean, ingest
from adlode.sources import sinks, tables


@pytest.fixture
def batch(spark):
    return spark.createDataFrame(
        [(1, "Dev", "Acme", "p"), (2, "dev", "ACME", "p"), (3, "Dev", "Acme", "q"), (4, "Ops", "", "p")],
        "id long, title string, company string, source string")


def test_keep_first(batch):
    kept = ingest.keep_first(ingest.with_hash(batch))
    assert sorted(r["id"] for r in kept.collect()) == [1, 3, 4]


def test_keep_first_limits_before_the_shuffle(batch):
    plan = ingest.keep_first(batch, "title")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert plan.rindex("Partial") > plan.index("Exchange hashpartitioning")


def test_hot_key(spark):
    rows = spark.range(20000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("hash"))
    kept = ingest.keep_first(rows)
    assert kept.count() == rows.select("hash").distinct().count()
    assert kept.filter("hash = 'hot'").first()["id"] == 0


@pytest.mark.parametrize("partitions", ["1", "4", "16"])
def test_number_rows_is_dense(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = ingest.number_rows(spark.range(5000).select(F.hex("id").alias("hash")), after=10)
        numbered = {r["hash"]: r["id"] for r in rows.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(numbered.values()) == list(range(11, 5011))
    assert sorted(numbered, key=numbered.get) == sorted(numbered)
    assert numbered == getattr(test_number_rows_is_dense, "seen", numbered)
    test_number_rows_is_dense.seen = numbered


def test_append_new(spark, batch, tmp_path):
    path = str(tmp_path / "jobs")
    rows = ingest.normalise_record(batch.filter("source = 'p'"), "p")
    assert sinks.append_new(rows, path) == 2
    assert sinks.append_new(rows, path) == 0
    more = rows.unionByName(rows.withColumn("title", F.lit("New")))
    assert sinks.append_new(more, path) == 2  # the two new titles differ by company
    stored = spark.read.parquet(path)
    assert sorted(r["id"] for r in stored.collect()) == [1, 2, 3, 4]
    assert stored.select("hash").distinct().count() == 4
    assert set(stored.columns) == set(schema.RAW.fieldNames())


def test_union_and_summary(spark, batch):
    a, b = batch.filter("source = 'p'"), batch.filter("source = 'q'")
    united = ingest.union_sources({"p": a, "q": b})
    assert united.columns == list(schema.LISTING_FIELDS) and united.count() == 4
    assert ingest.union_sources({"p": a, "q": b}, only="q").count() == 1
    assert ingest.union_sources({"p": a, "q": b}, enabled=["p"]).count() == 3
    summary = ingest.ingest_summary(ingest.with_hash(batch))
    assert {r["source"]: (r["scraped"], r["new"]) for r in summary.collect()} == {"p": (3, 2), "q": (1, 1), "TOTAL": (4, 3)}


def test_untitled_rows_and_missing_fields(spark):
    rows = spark.createDataFrame([("", "x"), (None, "y"), ("t", None)], "title string, city string")
    assert [r["title"] for r in ingest.drop_untitled(rows).collect()] == ["t"]
    record = ingest.normalise_record(rows, "portal").collect()[-1]
    assert record.asDict() == {**dict.fromkeys(schema.LISTING_FIELDS, ""), "title": "t", "source": "portal"}


def test_demo_rows(spark):
    rows = spark.createDataFrame([("http://Demo.Example.com/1",), ("http://x",), (None,)], "url string")
    assert [r["url"] for r in clean.exclude_demo(rows).collect()] == ["http://x"]
    assert clean.excluded_count(rows).first().asDict() == {"total": 3, "kept": 1, "excluded": 2}


def test_missing_table_and_seed(spark, tmp_path):
    missing = tables.read_or_empty(spark, str(tmp_path / "none"), schema.RAW)
    assert missing.count() == 0 and missing.schema == schema.RAW
    seed = tables.seed_if_empty(missing)
    assert seed.count() == tables.SEED_ROWS and clean.exclude_demo(seed).count() == 0
    assert tables.seed_if_empty(seed) is seed


def test_export_and_read_back(spark, tmp_path):
    rows = spark.createDataFrame([("a, \"b\"\nc", 3, 1.5), ("é", 1, 0.1)], schema.FREQUENCY)
    path = sinks.export_csv(rows, str(tmp_path), "freq", stamped=True)
    back = tables.read_csv(spark, path, schema.FREQUENCY)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def test_ids_follow_the_order_and_ties_are_split(spark):
    rows = spark.range(3000).select(F.hex("id").alias("hash"), F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("arrival"))
    numbered = ingest.number_rows(rows, order=["arrival"]).collect()
    want = sorted(rows.collect(), key=lambda r: (r["arrival"], r["hash"]))
    assert [r["hash"] for r in sorted(numbered, key=lambda r: r["id"])] == [r["hash"] for r in want]


def test_a_failing_portal_does_not_stop_the_others(spark, batch, tmp_path):
    def broken():
        raise RuntimeError("no answer")

    late = batch.filter("source = 'p'").withColumn("arrival", -F.col("id"))
    hurt = batch.withColumn("title", F.raise_error(F.lit("bad page")).cast("string"))  # fails in the tasks
    portals = {"p": lambda: late, "x": broken, "y": lambda: hurt, "q": lambda: batch.filter("source = 'q'")}
    for new in (2, 0):
        report = {r["source"]: r for r in sinks.ingest_portals(spark, portals, str(tmp_path / "jobs")).collect()}
        assert {s: (r["scraped"], r["new"]) for s, r in report.items()} == {
            "p": (3, new), "q": (1, new // 2), "x": (0, 0), "y": (0, 0), "TOTAL": (4, new + new // 2)}
        assert "no answer" in report["x"]["failed"] and report["y"]["failed"] and not report["p"]["failed"]
    stored = spark.read.parquet(str(tmp_path / "jobs")).orderBy("id").collect()
    assert [(r["id"], r["title"], r["source"]) for r in stored] == [(1, "Ops", "p"), (2, "dev", "p"), (3, "Dev", "q")]
    nothing = sinks.ingest_portals(spark, {"x": broken}, str(tmp_path / "none"))
    assert [tuple(r)[:3] for r in nothing.collect()] == [("x", 0, 0), ("TOTAL", 0, 0)]


def test_versions(spark, tmp_path):
    folder, layout = str(tmp_path / "t"), spark.range(1).schema
    assert tables.read_version(spark, folder, layout).count() == 0
    sinks.write_version(spark.range(10), folder)
    before = tables.read_version(spark, folder, layout)
    sinks.write_version(before.filter("id < 4"), folder)  # reads what it replaces
    assert tables.read_version(spark, folder, layout).count() == 4 and before.count() == 10
    spark.range(3).write.parquet(f"{folder}/version-lost")  # an attempt that never was listed
    assert tables.read_version(spark, folder, layout).count() == 4
