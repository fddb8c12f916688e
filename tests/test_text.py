import hashlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from adlode.functions import rounding, text as X


@pytest.mark.parametrize("raw, bucket", [
    ("", "Non précisé"), (None, "Non précisé"), ("Junior", "Junior (0–1 an)"), ("1 an", "1–2 ans"),
    ("Expérience entre 2 ans et 5 ans", "2–5 ans"), ("12 ans", "2–5 ans"), ("Senior", "5+ ans"),
    ("15 ans", "5+ ans"), ("10 ans", "10+ ans"), ("entre 10 ans", "1–2 ans"), ("10-15 ans", "Junior (0–1 an)"),
    ("< 10 ans", "Junior (0–1 an)"), ("3 ans", "Non précisé"), ("CONFIRMÉ", "5+ ans"),
])
def test_experience(column, raw, bucket):
    assert column([(raw,)], "v string", X.bucket_experience(F.col("v"))) == [bucket]


def test_city(column):
    rows = [("Douala & Yaoundé", ""), ("yaounde cameroun", ""), ("Cameroun", "poste à Douala"), ("", "poste à Kribi"),
            ("saint-louis d'or", ""), ("", ""), (None, None), ("LIMBÉ", "Douala"), ("  ", "")]
    assert column(rows, "c string, d string", X.normalise_city(F.col("c"), F.col("d"))) == [
        "Douala", "Yaoundé", "Cameroun", "Kribi", "Saint-Louis D'Or", "Non précisé", "Non précisé", "Limbé", "  "]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet=" -'.1éÉßabYZ\n", max_size=12), min_size=1, max_size=40))
def test_title_case_is_that_of_python(spark, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    found = dict(rows.select("i", X.title_case(F.col("v"))).collect())
    # one letter becomes two in upper case; Python then writes only the first large
    assert found == {i: v.title() for i, v in enumerate(values) if "ß" not in v} | {
        i: f for i, f in found.items() if "ß" in values[i]}


def test_hash(column):
    rows = [("a", "b", "c"), ("A", "B", "c"), (None, "é", "S")]
    expected = [hashlib.sha256(k.encode()).hexdigest()[:16] for k in ("a|b|c", "a|b|c", "|é|S")]
    assert expected[0] == "a52dd81bfd5e4e66"
    assert column(rows, "t string, c string, s string", X.listing_hash(F.col("t"), F.col("c"), F.col("s"))) == expected


def test_clean_text(column):
    values = [" a \n\t b  c ", "", None, "\x1cx"]
    assert column([(v,) for v in values], "v string", X.clean_text(F.col("v"))) == [
        " ".join((v or "").split()) for v in values]


def test_pairs_and_places(column):
    left, right = X.split_pair(F.col("v"))
    rows = [("Acme • Douala",), ("Acme",), ("a•b•c",), ("",)]
    assert column(rows, "v string", left) == ["Acme", "Acme", "a", ""]
    assert column(rows, "v string", right) == ["Douala", "", "b", ""]
    places = [("Douala, Cameroon, Full-time",), ("Full-time Douala",), ("Yaoundé,",), ("Fulltime X Part-time",),
              ("Buea Contractor",), ("Buea, Contract Temporary",)]
    assert column(places, "v string", X.before_word(F.col("v"))) == [
        "Douala, Cameroon", "", "Yaoundé", "Fulltime X", "Buea Contractor", "Buea"]


def test_lists(column):
    rows = [("a| b ||c ",), ("",), (None,)]
    assert column(rows, "v string", X.split_list(F.col("v"))) == [["a", "b", "c"], [], []]
    assert column([("a|b|c",), ("a",)], "v string", X.list_length(F.col("v"))) == [3, 1]
    assert column([("a, b, c, d, e",), ("a",)], "v string", X.first_entries(F.col("v"), 4)) == ["a, b, c, d", "a"]
    assert column([("a|b",)], "v string", X.display_list(F.col("v"))) == ["a, b"]


def test_urls(column):
    assert column([("/x",), ("http://y/x",), (None,)], "v string", X.absolute_url(F.col("v"), "https://h")) == [
        "https://h/x", "http://y/x", "https://h"]


def test_language(column):
    rows = [("le poste est dans la ville avec une équipe",), ("the job is in the city with a team",), ("der die das",),
            ("xyz " * 10,), (None,), ("x " * 300 + "the and of " * 20,)]
    assert column(rows, "v string", X.detect_language(F.col("v"))) == ["fr", "en", "unknown", "unknown", "unknown", "unknown"]


def test_language_against_labels(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = documents.select("lang", X.detect_language(F.col("text")).alias("found")).filter("found <> 'unknown'")
    assert found.filter("lang = found").count() / found.count() > 0.95


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4000), st.integers(1, 4000)), min_size=1, max_size=200))
def test_percent_rounds_like_python(spark, pairs):
    pairs = [(min(a, b), max(a, b)) for a, b in pairs] + [(1, 2000), (3, 2000), (9, 400), (27, 400)]
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, count long, n long")
    found = {r["i"]: r["pct"] for r in rounding.with_percent(rows, "count", F.col("n")).collect()}
    assert found == {i: round(100 * a / b, 1) for i, (a, b) in enumerate(pairs)}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(0, 50), min_size=1, max_size=200))
def test_scaled_rounding_is_that_of_numpy(spark, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    found = dict(rows.select("i", rounding.round_scaled(F.col("v"), 3)).collect())
    assert [found[i] for i in range(len(values))] == list(np.round(np.array(values), 3))


def test_frequency_golden(spark):
    rows = spark.createDataFrame([(38, 290), (3, 290)], "count long, n long")
    assert sorted(r["pct"] for r in rounding.with_percent(rows, "count", F.col("n")).collect()) == [1.0, 13.1]
