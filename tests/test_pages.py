import pytest
from pyspark.sql import functions as F

from adlode.functions import html as H
from adlode.functions.html import Pick
from adlode.operators import pages as P

LABELLED = """<html><!-- <div class="card-job-detail">x</div> --><body>
<div class="card card-job" data-href="/offre/1"><div class="card-job-detail"><h3><a href="/offre/1">Dev  Java</a></h3>
<a class="card-job-company">ACME</a><div class="card-job-description"><p>Un <b>poste</b></p></div>
<ul><li>Niveau d'études : <strong></strong></li><li>Compétences clés : <strong>Java - SQL</strong></li>
<li>Région de : <strong>Douala &amp; Yaoundé</strong></li><li>Niveau d'expérience : <strong>2 ans</strong></li>
<li>Niveau d'étude : <strong>Master</strong></li></ul><time datetime="2026-04-01">1 avril</time></div></div>
<div class="card card-job" data-href="https://x.y/2"><div><div class="card-job-detail"><h2><a>Admin</a></h2>
<time>02.04.2026</time></div></div></div>
<div class="card-job-detail"><h3><a>No link</a></h3></div>
<div class="card" data-href="/3"><div class="card-job-detail"><h3>No title</h3></div></div></body></html>"""
CARDS = """<div class="job-card"><h2>Title <em>A</em></h2><a href="/j/1">go</a><span class="company-name">C1</span>
<div class="job-location"><div>Douala</div> Bonanjo</div><p>Desc<p>other<span class="date">today</span></div>
<article class="job"><h3>not reached</h3></article><div class="big job-card x"><h3>T2</h3></div>
<div class="job-card"><p>no heading</p></div>"""
ROWS = """<table><tbody class="wpjb-job-list"><tr><td><div><img src="x"></div> logo</td><td><a href="/job/1">Dev</a><small class="wpjb-sub">Corp</small></td>
<td>Douala, Cameroon, Full-time</td><td>Apr 1<br/>2026</td></tr><tr><td>too few</td></tr>
<tr><td></td><td><a href="http://z/2"> </a></td><td></td><td></td></tr></tbody></table>"""
VIEWS = '<h2><a href="/view?id=1">x</a><a href="/view?id=7">second</a></h2><h2><a href="/other">y</a></h2><h2><a href="/view?id=1">x</a></h2>'
VIEW = """<h1>Data Eng</h1><div class="job-company">Acme • Douala</div>
<div class="description"><div>Python</div> and SQL</div><p>Il y a 3 jours</p>"""
JOBS = '<article><a href="/job/9">z</a></article><h2><a href="/h2">n</a></h2>'
JOB = """<div class="title">Dev</div><span class="employer">E</span><span class="city">Kribi</span>
<div class="x-content"><div>aa</div>bb</div><span class="date">D</span><i class="experience">3 ans</i>"""
PAGES = [
    ("emploi_cm", 0, "u", LABELLED), ("emploi_cm", 1, "u", "<div></div>"), ("emploi_cm", 2, "u", LABELLED),
    ("workconnect", 1, "u", CARDS), ("workconnect", 3, "u", CARDS), ("newjobscm", 1, "u", ROWS),
    ("talent_cm", 1, "u", VIEWS), ("talent_cm", None, "https://cm.talent.com/view?id=1", VIEW),
    ("expertini_cm", 1, "u", JOBS), ("expertini_cm", None, "https://cm.expertini.com/job/9", JOB),
]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(PAGES, "portal string, page_no int, url string, html string")


def test_all_portals(pages):
    found = {(r["source"], r["title"]): r.asDict() for r in P.all_listings(pages).collect()}
    assert set(found) == {
        ("emploi_cm", "Dev Java"), ("emploi_cm", "Admin"), ("workconnect", "Title A"), ("workconnect", "T2"),
        ("newjobscm", "Dev"), ("talent_cm", "Data Eng"), ("expertini_cm", "Dev")}
    labelled = found["emploi_cm", "Dev Java"]
    assert labelled["skills_raw"] == "Java - SQL" and labelled["city"] == "Douala & Yaoundé"
    assert labelled["experience"] == "2 ans" and labelled["company"] == "ACME" and labelled["description"] == "Un poste"
    assert labelled["url"] == "https://www.emploi.cm/offre/1" and labelled["date_posted"] == "2026-04-01"
    other = found["emploi_cm", "Admin"]
    assert other["url"] == "https://x.y/2" and other["date_posted"] == "02.04.2026" and other["skills_raw"] == ""
    card = found["workconnect", "Title A"]
    assert card["city"] == "Douala Bonanjo" and card["company"] == "C1" and card["description"] == "Desc"
    assert card["date_posted"] == "today" and card["url"] == "https://www.workconnectjob.com/j/1"
    row = found["newjobscm", "Dev"]
    assert row["city"] == "Douala, Cameroon" and row["company"] == "Corp" and row["url"] == "https://newjobscameroon.com/job/1"
    view = found["talent_cm", "Data Eng"]
    assert (view["company"], view["city"], view["date_posted"]) == ("Acme", "Douala", "Il y a 3 jours")
    assert view["description"] == "Python and SQL"
    job = found["expertini_cm", "Dev"]
    assert (job["company"], job["city"], job["experience"], job["description"]) == ("E", "Kribi", "3 ans", "aabb")


def test_only_one_portal_and_no_cap(pages):
    assert P.all_listings(pages, only="newjobscm").count() == 1
    assert P.all_listings(pages, only="workconnect", cap=None).count() == 4


def test_stop_at_empty_or_missing_page(spark):
    rows = [("a", 1, 3), ("a", 2, 0), ("a", 3, 5), ("b", 1, 1), ("b", 3, 1), ("c", 1, 1), ("c", 2, 1), ("c", 3, 1), ("d", 1, 0)]
    pages = spark.createDataFrame(rows, "portal string, page_no int, n_cards int")
    kept = sorted((r["portal"], r["page_no"]) for r in P.pages_until_empty(pages, cap=2).collect())
    assert kept == [("a", 1), ("b", 1), ("c", 1), ("c", 2)]
    kept = sorted((r["portal"], r["page_no"]) for r in P.pages_until_empty(pages, cap=None).collect())
    assert kept == [("a", 1), ("b", 1), ("b", 3), ("c", 1), ("c", 2), ("c", 3)]


def test_nested_and_unclosed_elements(column):
    page = '<div class="a"><div class="b">1</div>2</div><div class="a">3<div>4'
    found = column([(page,)], "v string", H.elements(F.col("v"), [Pick("div", "class", "none"), Pick("div", "class", "a")]))[0]
    assert [e["element"] for e in found] == ['<div class="a"><div class="b">1</div>2</div>', '<div class="a">3<div>4']
    assert column([(None,), ("",)], "v string", H.elements(F.col("v"), [Pick("div")])) == [[], []]


def test_first_existing_element_wins_even_if_blank(column):
    page = '<h2> </h2><h3>x</h3>'
    assert column([(page,)], "v string", P.shown(H.first(F.col("v"), Pick("h2"), Pick("h3")))) == [""]
    assert column([(page,)], "v string", H.first(F.col("v"), Pick("h1"))) == [None]


def test_many_tags_do_not_exhaust_the_stack(column):
    page = "<div class='job-card'>" + "<div><p>x</p></div>" * 20000 + "</div>"
    assert column([(page,)], "v string", F.size(H.leaves(H.visible(F.col("v")), Pick("p")))) == [20000]
    assert column([(page,)], "v string", F.size(H.elements(F.col("v"), [Pick("div", "class", "job-card")]))) == [1]


def test_links(column):
    page = '<h2><a href="/a">1</a></h2><a href="/b">2</a><a href="http://c/a">3</a><a href="/a">4</a>'
    everything = H.leaves(F.col("v"), Pick("a", "href"))
    headed = H.all_within(F.col("v"), Pick("h2"), Pick("a", "href"))
    assert column([(page,)], "v string", P.page_links([headed, everything], "https://s")) == [["https://s/a"]]
    assert column([(page,)], "v string", P.page_links([everything], "https://s", "a")) == [
        ["https://s/a", "http://c/a"]]
    assert column([("",)], "v string", P.page_links([headed, everything], "https://s")) == [[]]


def test_attributes(column):
    rows = [("""<a title="l'offre" href="/d'été/job">x</a>""",), ("<a href='/y?a=1&amp;b=2'>x</a>",), ("<a href=/z class=k>x</a>",),
            ("<a>x</a>",)]
    assert column(rows, "v string", H.attribute(F.col("v"), "href")) == ["/d'été/job", "/y?a=1&b=2", "/z", ""]
    assert column(rows, "v string", F.size(H.leaves(F.col("v"), Pick("a", "href", "/")))) == [1, 1, 1, 0]
    assert column(rows, "v string", F.size(H.leaves(F.col("v"), Pick("a", "class", "k", whole=True)))) == [0, 0, 1, 0]


def test_first_shown_listing_is_kept(spark, tmp_path):
    card = '<div class="job-card"><h2>Same</h2><p>{}</p></div>'
    pages = spark.createDataFrame(
        [("workconnect", 2, "u", card.format("late")), ("workconnect", 1, "u", card.format("b") + card.format("a"))],
        "portal string, page_no int, url string, html string")
    from adlode.sources.sinks import append_new
    path = str(tmp_path / "jobs")
    assert append_new(P.all_listings(pages, only="workconnect"), path) == 1
    assert spark.read.parquet(path).first()["description"] == "b"


def test_references_and_void_elements(spark):
    from pyspark.sql import functions as F

    from adlode.functions import html as H

    text = "C&ocirc;te d&#8217;Ivoire &#233;&#xE9; &amp;lt; &#0; &#99999999; &unknown; a&b &alpha;&Scaron;&NotEqualTilde; &&lt &;"
    got = spark.createDataFrame([(text,), ("",), (None,)], "t string").select(H.decode(F.col("t"))).collect()
    assert [r[0] for r in got] == ["Côte d’Ivoire éé &lt; &#0; &#99999999; &unknown; a&b αŠ≂̸ &&lt &;", "", None]
    page = '<div><img class="company-logo" src="x">ACME<p>long description</p></div>'
    found = spark.createDataFrame([(page,)], "t string").select(H.elements(F.col("t"), [H.Pick("", "class", "company")])).first()[0]
    assert [r["element"] for r in found] == ['<img class="company-logo" src="x">']


def test_more_pages_than_any_cap(spark):
    pages = spark.createDataFrame([(n, "p", n + 1, 1) for n in range(14)], "page_id long, portal string, page_no int, n_cards int")
    assert P.pages_until_empty(pages).count() == 14 and P.pages_until_empty(pages, cap=10).count() == 10


def test_stop_rule_does_not_depend_on_the_cap(spark):
    """Page 2 is empty and page 4 was not captured: with any cap the portal ends at page 1; a detail page that lacks ends nothing."""
    card = '<div class="job-card"><h2>T{0}</h2></div>'
    link = '<h2><a href="/view?id={0}">x</a></h2>'
    schema = "portal string, page_no int, url string, html string"
    for portal, shown, detail in (("workconnect", card, None), ("talent_cm", link, "<h1>T{0}</h1>")):
        rows = [(portal, n, f"list{n}", "" if n == 2 else shown.format(n)) for n in (1, 2, 3, 5)]
        if detail:
            rows += [(portal, None, f"https://cm.talent.com/view?id={n}", detail.format(n)) for n in (1, 3, 5)]
        pages = spark.createDataFrame(rows, schema)
        for cap in (None, 9):
            assert [r.title for r in P.all_listings(pages, only=portal, cap=cap).collect()] == ["T1"]
        whole = spark.createDataFrame([r for r in rows if r[1] != 2] + [(portal, 2, "list2", shown.format(2))], schema)
        titles = {"T1", "T3"} if detail else {"T1", "T2", "T3"}
        assert {r.title for r in P.all_listings(whole, only=portal).collect()} == titles | {"T5"}
        assert {r.title for r in P.all_listings(whole, only=portal, cap=9, missing_stops=True).collect()} == titles


def test_elements_are_found_row_by_row(spark):
    """No Arrow batch, which holds thousands of pages with all their elements, stands in a Python worker."""
    pages = spark.createDataFrame([(1, "<section><section>a</section></section>"), (2, None)], "page_id long, html string")
    cards = P.page_cards(pages, [Pick("section")])
    plan = cards._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan
    assert [(r.page_id, r.card_no, r.card) for r in cards.collect()] == [
        (1, 0, "<section><section>a</section></section>"), (1, 1, "<section>a</section>")]
