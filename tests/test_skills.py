import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from adlode import constants as C
from adlode.functions.skills import match_skills
from adlode.operators import taxonomy

# The rows of a taxonomy that the golden cases need.
ROWS = [
    ("JavaScript", "javascript;js"), ("Java", "java;Java EE"), ("C++", "c++;cpp"), ("C#", "c#;csharp;.NET"),
    ("Ruby", "ruby;ruby on rails"), ("Go", "golang"), ("Scala", "scala"), ("R", "R language;langage R"),
    ("SQL", "sql;SQL Server"), ("Vue.js", "vue;vuejs"), ("Ruby on Rails", "rails;ror;ruby on rails"),
    ("Apache", "apache;apache2"), ("Git", "git;github"), ("Big Data", "big data;Apache Spark"),
    ("Networking", "networking;TCP/IP"), ("TCP/IP", "tcp/ip;TCP-IP"), ("SAP/ERP", "sap;sage"), ("", "ghost"),
]


@pytest.fixture(scope="module")
def alias_table(spark):
    rows = [(i, c, a, "x") for i, (c, a) in enumerate(ROWS)]
    return taxonomy.taxonomy_aliases(spark.createDataFrame(rows, "line long, canonical string, aliases string, category string"))


@pytest.fixture(scope="module")
def held(alias_table):
    return taxonomy.held_aliases(alias_table)


def test_alias_table(held):
    assert held["ruby on rails"] == "Ruby on Rails" and held["tcp/ip"] == "TCP/IP" and held[".net"] == "C#"
    assert held["go"] == "Go" and "ghost" not in held and "" not in held


def test_large_alias_tables_are_not_held(alias_table):
    assert taxonomy.held_aliases(alias_table, limit=5) is None


GOLDEN = [
    ("JavaScript", ["Java", "JavaScript"]), ("développeur", []), ("langage R", ["R"]), ("your language", ["R"]),
    ("constatation", ["R"]), ("fiscale", []), ("apache spark", ["Apache", "Big Data", "Scala"]),
    ("message", ["SAP/ERP"]), ("en vue de", ["Vue.js"]), ("github", ["Git"]), ("digital", []),
    ("C++ / C#", ["C#", "C++"]), ("ruby on rails", ["Ruby", "Ruby on Rails"]), ("TCP/IP", ["TCP/IP"]),
    ("", []), (None, []), ("git", ["Git"]), ("(git)", ["Git"]), ("git2", []), ("égit", []), ("SCALA!", ["Scala"]),
]


@pytest.mark.parametrize("engine", ["direct", "dictionary"])
def test_golden(spark, held, engine):
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(GOLDEN)], "i int, t string")
    found = dict(rows.select("i", match_skills(F.col("t"), held, engine=engine)).collect())
    assert found == {i: s for i, (_, s) in enumerate(GOLDEN)}


def test_golden_by_join(spark, alias_table):
    rows = spark.createDataFrame([(i, t, "") for i, (t, _) in enumerate(GOLDEN)], "id int, skills_raw string, description string")
    found = taxonomy.tag_skills(rows, alias_table, limit=0)
    assert {r["id"]: r["skills"] for r in found.collect()} == {i: s for i, (_, s) in enumerate(GOLDEN)}


def by_hand(text, aliases):
    """The rules one alias at a time."""
    found = set()
    for alias, skill in aliases.items():
        if alias in C.CONTEXT_GUARDS:
            hit = re.search(C.CONTEXT_GUARDS[alias], text, re.I)
        elif len(alias) <= 3:
            hit = re.search(f"(?<![{C.WORD_CHARS}]){re.escape(alias)}(?![{C.WORD_CHARS}])", text.lower())
        else:
            hit = alias in text.lower()
        if hit:
            found.add(skill)
    return sorted(found)


pieces = st.sampled_from(["java", "script", "c", "++", "#", "git", "hub", "r", " ", ",", "/", "scala", "ble", "sas",
                          "python", "vue", "é", "1", "sql", "SQL", "ruby on rails", "tcp/ip", "big data", "\n", "go"])


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(pieces, max_size=8).map("".join), min_size=1, max_size=40))
def test_engines_agree(spark, held, alias_table, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    expected = {i: by_hand(t, held) for i, t in enumerate(texts)}
    for engine in ("direct", "dictionary"):
        assert dict(rows.select("id", match_skills(F.col("t"), held, engine=engine)).collect()) == expected
    joined = taxonomy.tag_by_join(rows, alias_table, "id", "t").select("id", "skills")
    assert dict(joined.collect()) == expected


def test_word_match_is_optional(spark, held):
    rows = spark.createDataFrame([("javascript message",)], "t string")
    for engine in ("direct", "dictionary"):
        assert rows.select(match_skills(F.col("t"), held, match="word", engine=engine)).first()[0] == ["JavaScript"]
    with pytest.raises(ValueError):
        match_skills(F.col("t"), held, match="fuzzy")


def test_skills_are_matched_once_per_listing(spark, held):
    rows = spark.createDataFrame([(1, "", "java")], "id int, skills_raw string, description string")
    tagged = taxonomy.skilled_only(taxonomy.tag_skills(rows, held, engine="direct"))
    plan = tagged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("javascript") == plan.count("[javascript,JavaScript]") == 1


def test_aliases_with_pattern_signs(spark):
    """Signs that mean something in a pattern, words of several runs and letters outside the word class."""
    aliases = {r"\e": "Escape", r"a\eb": "Quoted", "(x)": "Paren", "c++": "C++", "big data": "Big Data", "ñao": "Ñao", "tcp/ip": "TCP/IP", "état": "État"}
    texts = [r"a \e b", r"xa\eby", r"a\eb", "f(x)", "f (x) y", "c++11", "a c++ b", "bigger data", "my big data!", "ñao", "xñao", "tcp/ip4", "l'état", "détats", ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    table = spark.createDataFrame(list(aliases.items()), "alias string, canonical string")
    for match, limit in (("reference", 3), ("word", 99)):
        def hit(alias, t):
            bounded = re.search(f"(?<![{C.WORD_CHARS}]){re.escape(alias)}(?![{C.WORD_CHARS}])", t)
            return bounded is not None if len(alias) <= limit else alias in t
        expected = {i: sorted(s for a, s in aliases.items() if hit(a, t)) for i, t in enumerate(texts)}
        for engine in ("direct", "dictionary"):
            assert dict(rows.select("id", match_skills(F.col("t"), aliases, {}, match, engine)).collect()) == expected
        assert dict(taxonomy.tag_by_join(rows, table, "id", "t", {}, match).select("id", "skills").collect()) == expected


def test_hundreds_of_aliases_are_looked_up_in_the_jvm(spark, held):
    many = {**held, **{f"alias number {n}": f"N{n}" for n in range(300)}, **{f"word{n}": f"W{n}" for n in range(300)}}
    rows = spark.createDataFrame([(1, "xword17 Alias Number 23, java"), (2, None)], "id int, t string")
    tagged = rows.select("id", match_skills(F.col("t"), many).alias("skills"))
    assert "Python" not in tagged._jdf.queryExecution().executedPlan().toString()
    assert dict(tagged.collect()) == {1: ["Java", "N2", "N23", "W1", "W17"], 2: []}


def test_a_run_met_by_parts_is_no_word(spark):
    """A long alias of several words leads to its parts in other words; those are no words of their own."""
    rows = spark.createDataFrame([("javascript",), ("java",), ("x java ee y",)], "t string")
    aliases = {"java": "Java", "java ee": "EE"}
    for engine in ("direct", "dictionary"):
        got = rows.select(match_skills(F.col("t"), aliases, {}, "word", engine)).collect()
        assert [r[0] for r in got] == [[], ["Java"], ["EE", "Java"]]


def test_join_meets_runs_not_grams(spark):
    """Every distinct run of a text goes into the join once, long ones in windows; its grams do not."""
    long = "я" * 50 + "данные" + "я" * 50
    aliases = {"данные": "Data", "ab": "Ab", "c-d-e": "Cde", "longest": "Long", "++": "Plus"}
    table = spark.createDataFrame(list(aliases.items()), "alias string, canonical string")
    rows = spark.createDataFrame([(1, long), (1, "ab"), (None, "xab c-d-efg"), (2, "thelongestword a++b"), (3, "++ab ab"), (4, None)], "id int, t string")
    got = taxonomy.tag_by_join(rows, table, "id", "t", {})
    assert sorted((r.t or "", r.skills) for r in got.collect()) == sorted([
        (long, ["Data"]), ("ab", ["Ab"]), ("xab c-d-efg", ["Cde"]), ("thelongestword a++b", ["Long"]), ("++ab ab", ["Ab"]), ("", [])])
    assert "{1})" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_dictionary_is_one_pattern(spark, held):
    """No part of a text is looked up that is no alias."""
    many = {**held, **{f"alias number {n}": f"N{n}" for n in range(300)}}
    plan = spark.createDataFrame([("x",)], "t string").repartition(1).select(match_skills(F.col("t"), many))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "array_intersect" not in text and "sequence(" not in text
