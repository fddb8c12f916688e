"""The registered queries, each with the SQL that gives the same rows where there is one."""

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from adlode import constants as C
from adlode.functions import html as H, text as X
from adlode.functions.html import Pick
from adlode.functions.skills import context_hit
from adlode.operators import archetypes, clean, clusters, ingest, pages as P, rules as R, stats, taxonomy, views
from adlode.plans import standin as S
from adlode.plans.standin import table
from adlode.schema import RAW
from adlode.session import scratch_path
from adlode.sources import sinks
from adlode.sources.tables import read_csv, read_table, read_taxonomy, read_version, spread
from adlode.streaming import refresh

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn
    return register


# ---- SQL shared by the oracles ----------------------------------------------------------------

def _values(rows) -> str:
    return ", ".join("(" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in row) + ")" for row in rows)


_BOUNDARY = "[^a-zàâäéèêëïîôöùûüç\\x{0300}-\\x{036f}0-9]"

LISTINGS_SQL = """
listings AS (
  SELECT doc_id AS id, split_part(text, chr(10), 1) AS title, lang AS company, text AS description, source, lang,
         substr(sha256(lower(split_part(text, chr(10), 1)) || '|' || lower(lang) || '|' || source), 1, 16) AS hash
  FROM documents)"""

TAGS_SQL = LISTINGS_SQL + f""",
alias_table(alias, skill) AS (VALUES {_values(S.aliases().items())}),
hits AS (
  SELECT DISTINCT l.id, a.skill FROM listings l JOIN alias_table a ON
    CASE WHEN a.alias = 'un' THEN regexp_matches(l.description, '(?i){S.GUARDS["un"]}')
         WHEN length(a.alias) > 3 THEN contains(lower(' ' || l.description), a.alias)
         ELSE regexp_matches(lower(' ' || l.description), '(^|{_BOUNDARY})' || a.alias || '({_BOUNDARY}|$)') END),
per_listing AS (
  SELECT id, string_agg(skill, '|' ORDER BY skill) AS skills, count(*) AS n FROM hits GROUP BY id),
tags AS (
  SELECT l.*, coalesce(p.skills, '') AS skills, coalesce(p.n, 0) AS skill_count
  FROM listings l LEFT JOIN per_listing p USING (id))"""

FREQUENCY_SQL = TAGS_SQL + """,
frequency AS (SELECT skill, count(*) AS count FROM hits GROUP BY skill)"""

# printf rounds the exact binary value, ties to even
_PCT1 = "CAST(printf('%.1f', CAST(100 * {part} AS DOUBLE) / CAST({whole} AS DOUBLE)) AS DOUBLE)"


def _share_sql(source: str, column: str, name: str, tail: str = "") -> str:
    return f"""
SELECT {column} AS {name}, count(*) AS count,
       CAST(100 * count(*) AS DOUBLE) / CAST((SELECT count(*) FROM {source}) AS DOUBLE) AS pct
FROM {source} GROUP BY 1 {tail}"""


# ---- scans, sources, ingest -------------------------------------------------------------------

@query("SELECT doc_id, lang, source FROM documents WHERE n_chars >= 500")
def scan_listings(spark, d):
    return table(spark, d, "documents").filter("n_chars >= 500").select("doc_id", "lang", "source")


@query("SELECT page_id, url FROM pages WHERE url NOT ILIKE '%example.net%'")
def exclude_demo(spark, d):
    return clean.exclude_demo(table(spark, d, "pages").select("page_id", "url"), fragment="Example.NET")


@query("""SELECT count(*) AS total, count(*) FILTER (WHERE url NOT ILIKE '%example.net%') AS kept,
                 count(*) FILTER (WHERE url ILIKE '%example.net%') AS excluded FROM pages""")
def excluded_count(spark, d):
    return clean.excluded_count(table(spark, d, "pages"), fragment="example.net")


@query("WITH " + LISTINGS_SQL + " SELECT id, hash FROM listings")
def listing_hash(spark, d):
    return S.listings(spark, d).select("id", "hash")


@query("""SELECT min(doc_id) AS id, lower(text) AS text, lang FROM documents GROUP BY lower(text), lang""")
def dedup_listings(spark, d):
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.lower("text").alias("text"), "lang")
    return ingest.keep_first(rows, ["text", "lang"])


@query("WITH " + LISTINGS_SQL + """
SELECT hash, min(id) AS id FROM listings WHERE company = 'en'
  AND hash NOT IN (SELECT substr(sha256(lower(split_part(text, chr(10), 1)) || '|en|' || source), 1, 16)
                   FROM documents WHERE lang <> 'en') GROUP BY hash""")
def ingest_new_rows(spark, d):
    """English listings against all others as if those were stored under the same company."""
    rows = S.listings(spark, d)
    stored = ingest.with_hash(rows.filter("lang <> 'en'").withColumn("company", F.lit("en")))
    return ingest.new_rows(ingest.keep_first(rows.filter("lang = 'en'").select("hash", "id")), stored)


@query("WITH " + LISTINGS_SQL + """
SELECT hash, 10 + row_number() OVER (ORDER BY min(id), hash) AS id FROM listings GROUP BY hash""")
def number_rows(spark, d):
    """Ids after 10 for every distinct listing, in the order of arrival."""
    unique = S.listings(spark, d).groupBy("hash").agg(F.min("id").alias("arrival"))
    return ingest.number_rows(unique, after=10, order=["arrival"]).select("hash", "id")


@query("WITH " + LISTINGS_SQL + """
SELECT hash, row_number() OVER (ORDER BY min(CASE WHEN lang = 'en' THEN 0 ELSE 1 END), min(id), hash) AS id
FROM listings GROUP BY hash""")
def append_twice(spark, d):
    """English listings stored first, then all: the stored ones stay, the others follow by arrival."""
    rows, path = S.listings(spark, d).withColumn("arrival", F.col("id")), scratch_path(spark, "store")
    sinks.append_new(rows.filter("lang = 'en'"), path)
    sinks.append_new(rows, path)
    return read_table(spark, path, RAW).select("hash", "id")


@query("""
WITH firsts AS (SELECT lang AS source, count(*) AS scraped, count(DISTINCT lower(split_part(text, chr(10), 1))) AS new
                FROM documents WHERE lang IN ('de', 'en', 'es', 'fr') GROUP BY lang)
SELECT source, scraped, new, false AS failed FROM firsts UNION ALL SELECT 'xx', 0, 0, true
UNION ALL SELECT 'TOTAL', CAST(sum(scraped) AS BIGINT), CAST(sum(new) AS BIGINT), false FROM firsts""")
def ingest_run_summary(spark, d):
    """Languages as portals, one of which cannot be read."""
    rows = S.listings(spark, d).withColumn("arrival", F.col("id"))
    portals = {lang: partial(rows.filter, F.col("lang") == lang) for lang in ("de", "en", "es", "fr")}
    portals["xx"] = lambda: rows.select("missing")
    report = sinks.ingest_portals(spark, portals, scratch_path(spark, "store"))
    return report.withColumn("failed", F.col("failed") != "")


@query("SELECT doc_id, text, lang FROM documents")
def csv_read_back(spark, d):
    """Whole texts, with their quotes, commas, accents and line ends, as CSV and back."""
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    return read_csv(spark, sinks.export_csv(docs, scratch_path(spark, "exports"), "documents", stamped=True), docs.schema)


@query("SELECT p_brand || ' ' || p_type AS canonical, replace(p_name, ' ', ';') AS aliases, p_brand AS category FROM part")
def taxonomy_read_back(spark, d):
    rows = table(spark, d, "part").select(
        F.concat_ws(" ", "p_brand", "p_type").alias("canonical"),
        F.replace("p_name", F.lit(" "), F.lit(";")).alias("aliases"), F.col("p_brand").alias("category"))
    return read_taxonomy(spark, sinks.export_csv(rows, scratch_path(spark, "exports"), "taxonomy")).drop("line")


@query("SELECT doc_id, lang, n_chars FROM documents WHERE n_chars >= 500")
def replaced_table(spark, d):
    """A table written, then replaced by a part of itself."""
    docs, folder = table(spark, d, "documents").select("doc_id", "lang", "n_chars"), scratch_path(spark, "versions")
    sinks.write_version(docs, folder)
    sinks.write_version(read_version(spark, folder, docs.schema).filter("n_chars >= 500"), folder)
    return read_version(spark, folder, docs.schema)


@query("SELECT doc_id AS url, lang AS source, text AS description FROM documents WHERE lang IN ('de', 'fr', 'es')")
def union_sources(spark, d):
    """Portals are languages; English is switched off."""
    docs = table(spark, d, "documents")
    portals = {lang: docs.filter(F.col("lang") == lang).select(F.col("doc_id").alias("url"), F.col("text").alias("description"))
               for lang in ("de", "en", "es", "fr")}
    united = ingest.union_sources(portals, enabled=("de", "es", "fr"))
    return united.select(F.col("url").cast("long").alias("url"), "source", "description")


@query("WITH " + LISTINGS_SQL + """,
firsts AS (SELECT hash, min(id) AS id FROM listings GROUP BY hash)
SELECT coalesce(source, 'TOTAL') AS source, count(*) AS scraped, CAST(count(f.id) AS BIGINT) AS new
FROM listings l LEFT JOIN firsts f ON l.id = f.id GROUP BY ROLLUP (source)""")
def ingest_summary(spark, d):
    return ingest.ingest_summary(S.listings(spark, d))


# ---- pages ------------------------------------------------------------------------------------

def _captured(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "pages").select("page_id", "html"), "page_id")


_ARTICLE = "regexp_extract(html, '(?s)<article>(.*?)</article>', 1)"
_TITLE = "regexp_extract(html, '(?s)<title>(.*?)</title>', 1)"
_H1 = "regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)"


# Named references that occur in the pages; the ampersand comes last, so that nothing is decoded twice.
_NAMES = [name for name, char in H.ENTITIES.items() if len(char) == 1 and 160 <= ord(char) <= 255] + [
    "nbsp", "lt", "gt", "quot", "apos", "bull", "rsquo", "lsquo", "ldquo", "rdquo", "ndash", "mdash", "hellip", "euro", "amp"]


def _sql_text(x: str) -> str:
    x = f"regexp_replace({x}, '<[^>]*>', '', 'g')"
    for name in _NAMES:
        x = f"replace({x}, '&{name};', '{H.ENTITIES[name].replace(chr(39), chr(39) * 2)}')"
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


@query(f"""
WITH cards AS (
  SELECT page_id, unnest(string_split_regex({_ARTICLE}, '<p>')[2:]) AS card,
         generate_subscripts(string_split_regex({_ARTICLE}, '<p>')[2:], 1) - 1 AS card_no FROM pages)
SELECT page_id, CAST(card_no AS INTEGER) AS card_no, {_sql_text("regexp_replace(card, '(?s)</p>.*', '')")} AS text FROM cards""")
def page_cards(spark, d):
    """Paragraphs of the article as cards; a paragraph ends where the next one starts."""
    pages = _captured(spark, d)
    articles = P.page_cards(pages, [Pick("section"), Pick("article")]).select("page_id", "card")
    return articles.select("page_id", F.posexplode(H.leaves(F.col("card"), Pick("p"))).alias("card_no", "p")).select(
        "page_id", "card_no", H.inner_text(F.col("p")).alias("text"))


@query(f"""
SELECT page_id, {_sql_text(f"CASE WHEN {_H1} <> '' THEN {_H1} ELSE {_TITLE} END")} AS title,
       {_sql_text("regexp_extract(html, '(?s)<div class=.ad.>(.*?)</div>', 1)")} AS advert,
       {_sql_text("regexp_extract(html, '(?s)<footer>(.*?)</footer>', 1)")} AS footer
FROM pages""")
def page_fields(spark, d):
    """The first selector that occurs wins for every field."""
    page = H.visible(F.col("html"))
    return _captured(spark, d).select(
        "page_id",
        P.shown(H.first(page, Pick("h1"), Pick("title"))).alias("title"),
        P.shown(H.first(page, Pick(attr="class", has="banner"), Pick(attr="class", has="ad"))).alias("advert"),
        P.shown(H.first(page, Pick("footer"), Pick("main"))).alias("footer"),
    )


@query(f"""
SELECT page_id, {_sql_text("regexp_extract(html, '(?s)<div class=.ad.>(.*?)</div>', 1)")} AS title FROM pages
WHERE {_sql_text("regexp_extract(html, '(?s)<div class=.ad.>(.*?)</div>', 1)")} <> ''""")
def page_untitled(spark, d):
    """Pages without an advert have no title here and drop out."""
    advert = P.shown(H.first(H.visible(F.col("html")), Pick(attr="class", has="banner"), Pick(attr="class", has="ad")))
    return ingest.drop_untitled(_captured(spark, d).select("page_id", advert.alias("title")))


_PHRASE = "regexp_extract(html, '>([^<]*?{}[^<]*)(<|$)', 1)"


@query(f"""
SELECT page_id, {_sql_text(f"CASE WHEN {_PHRASE.format('nicht')} <> '' THEN {_PHRASE.format('nicht')} ELSE {_PHRASE.format('that')} END")} AS phrase
FROM pages""")
def page_dates(spark, d):
    """The first piece of text with the first phrase that occurs, as dates are found."""
    return _captured(spark, d).select("page_id", P.first_phrase(F.col("html"), ("nicht", "that")).alias("phrase"))


@query("""
WITH items AS (
  SELECT page_id, unnest(regexp_extract_all(html, '<li>.*?</li>')) AS item,
         generate_subscripts(regexp_extract_all(html, '<li>.*?</li>'), 1) AS pos FROM pages),
pairs AS (
  SELECT page_id, pos, regexp_extract(item, '>([^<>]*)</a>', 1) AS value FROM items),
keyed AS (
  SELECT page_id, pos, value,
         CASE WHEN contains(value, 'th') THEN 'city' WHEN contains(value, 'e') THEN 'skills'
              WHEN contains(value, 'a') THEN 'city' END AS field FROM pairs WHERE trim(value) <> '')
SELECT p.page_id, coalesce((SELECT arg_min(value, pos) FROM keyed k WHERE k.page_id = p.page_id AND field = 'city'), '') AS city,
       coalesce((SELECT arg_min(value, pos) FROM keyed k WHERE k.page_id = p.page_id AND field = 'skills'), '') AS skills
FROM pages p""")
def page_label_map(spark, d):
    """Navigation items as label/value pairs; per field the first value counts."""
    items = H.leaves(H.visible(F.col("html")), Pick("li"))
    fields = H.labelled_values(items, {"th": "city", "e": "skills", "a": "city"}, Pick("a"))
    return _captured(spark, d).select("page_id", fields["city"].alias("city"), fields["skills"].alias("skills"))


@query("""
WITH hrefs AS (
  SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href,
         generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)"', 1), 1) AS pos FROM pages),
firsts AS (
  SELECT page_id, CASE WHEN starts_with(href, 'http') THEN href ELSE 'https://site.example' || href END AS link, min(pos) AS pos
  FROM hrefs WHERE href <> '' AND contains(href, 'th') GROUP BY 1, 2)
SELECT p.page_id, coalesce(string_agg(f.link, ' ' ORDER BY f.pos), '') AS links, count(f.link) AS n
FROM pages p LEFT JOIN firsts f USING (page_id) GROUP BY p.page_id""")
def page_links(spark, d):
    """Links below headings, else all; only those with the fragment."""
    page = F.col("html")
    links = P.page_links([H.all_within(page, Pick("h2"), Pick("a", "href")), H.leaves(page, Pick("a", "href"))],
                         "https://site.example", "th")
    return _captured(spark, d).select("page_id", links.alias("l")).select(
        "page_id", F.array_join("l", " ").alias("links"), F.size("l").cast("long").alias("n"))


_FOOT = _sql_text("regexp_extract(html, '(?s)<footer>(.*?)</footer>', 1)")


@query(f"""
SELECT page_id, trim(split_part({_FOOT}, '·', 1)) AS left_side, trim(split_part({_FOOT}, '·', 2)) AS right_side FROM pages""")
def split_company_city(spark, d):
    left, right = X.split_pair(H.inner_text(F.get(H.leaves(F.col("html"), Pick("footer")), 0)), "·")
    return _captured(spark, d).select("page_id", left.alias("left_side"), right.alias("right_side"))


@query(f"""
WITH words AS (
  SELECT doc_id, string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ') AS w FROM documents),
cut AS (
  SELECT doc_id, w, (SELECT min(list_position(w, c)) FROM (VALUES {_values((w,) for w in S.CUT_WORDS)}) v(c)
                     WHERE list_contains(w, c)) AS p FROM words)
SELECT doc_id, trim(rtrim(array_to_string(CASE WHEN p IS NULL THEN w ELSE w[1:p - 1] END, ' '), ',')) AS place FROM cut""")
def trim_location(spark, d):
    return table(spark, d, "documents").select("doc_id", X.before_word(F.col("text"), S.CUT_WORDS).alias("place"))


@query("SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text FROM documents")
def clean_text(spark, d):
    return table(spark, d, "documents").select("doc_id", X.clean_text(F.col("text")).alias("text"))


@query("""
WITH numbered AS (
  SELECT page_id, regexp_extract(url, '//([^/]+)', 1) AS portal, CAST(regexp_extract(url, '/([0-9]+)', 1) AS BIGINT) AS page_no,
         CASE WHEN len(regexp_extract_all(html, '<li>')) >= 5 THEN 1 ELSE 0 END AS n_cards FROM pages)
SELECT page_id, portal, page_no FROM numbered n
WHERE page_no < coalesce((SELECT min(page_no) FROM numbered m WHERE m.portal = n.portal AND m.n_cards = 0), 9223372036854775807)""")
def pages_until_empty(spark, d):
    """Hosts as portals, the number in the path as page number; a page with fewer than five links is empty."""
    pages = table(spark, d, "pages").select(
        "page_id",
        F.regexp_extract("url", "//([^/]+)", 1).alias("portal"),
        F.regexp_extract("url", "/([0-9]+)", 1).cast("long").alias("page_no"),
        F.when(F.regexp_count("html", F.lit("<li>")) >= 5, 1).otherwise(0).alias("n_cards"))
    return P.pages_until_empty(pages, first=0).select("page_id", "portal", "page_no")


@query("""
WITH numbered AS (
  SELECT page_id, regexp_extract(url, '//([^/]+)', 1) AS portal, page_id // 3 % 40 AS page_no,
         CASE WHEN len(regexp_extract_all(html, '<li>')) >= 5 THEN 1 ELSE 0 END AS n_cards FROM pages),
per_page AS (SELECT portal, page_no, max(n_cards) AS n_cards FROM numbered WHERE page_no >= 2 GROUP BY ALL),
runs AS (SELECT *, page_no - row_number() OVER (PARTITION BY portal ORDER BY page_no) AS run,
                sum(CASE WHEN n_cards = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY portal ORDER BY page_no) AS empty_before FROM per_page)
SELECT page_id, portal, page_no FROM numbered JOIN runs USING (portal, page_no)
WHERE run = 1 AND empty_before = 0 AND page_no < 2 + 5""")
def pages_until_empty_capped(spark, d):
    """The same with a cap of five pages from the third on, where a page that was not captured stops too."""
    pages = table(spark, d, "pages").select(
        "page_id",
        F.regexp_extract("url", "//([^/]+)", 1).alias("portal"),
        F.pmod(F.floor(F.col("page_id") / 3), F.lit(40)).alias("page_no"),
        F.when(F.regexp_count("html", F.lit("<li>")) >= 5, 1).otherwise(0).alias("n_cards"))
    return P.pages_until_empty(pages, first=2, cap=5, missing_stops=True).select("page_id", "portal", "page_no")


# ---- filters, projections, views --------------------------------------------------------------

@query("SELECT doc_id, lang, source FROM documents WHERE lang IN ('fr', 'de') AND source IN ('src1', 'src2', 'src3')")
def filter_multi(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source")
    return views.filter_multi(docs, lang=["fr", "de"], source=["src1", "src2", "src3"])


@query("SELECT doc_id, lang, source FROM documents")
def filter_multi_nothing_chosen(spark, d):
    return views.filter_multi(table(spark, d, "documents").select("doc_id", "lang", "source"), lang=[], source=None)


@query("WITH " + LISTINGS_SQL + """
SELECT id, title, source FROM listings WHERE regexp_matches(title, '(?i)th(e|at)\\b') OR regexp_matches(source, '(?i)th(e|at)\\b')""")
def search_listings(spark, d):
    return views.search(S.listings(spark, d).select("id", "title", "source"), r"TH(e|at)\b", ("title", "source"))


@query("WITH " + TAGS_SQL + " SELECT id, skills FROM tags WHERE skill_count > 0")
def skilled_only(spark, d):
    return taxonomy.skilled_only(S.tagged(spark, d)).select("id", X.join_list(F.col("skills")).alias("skills"))


@query("WITH " + TAGS_SQL + """, found AS (SELECT id FROM tags WHERE skills ILIKE '%le%' )
SELECT l.id AS raw_id, l.title, substr(l.description, 1, 400) AS description FROM listings l JOIN found USING (id)""")
def skill_like_join(spark, d):
    clean_rows = S.tagged(spark, d).withColumn("skills_extracted", X.join_list(F.col("skills")))
    return views.listings_with_skill(clean_rows, S.listings(spark, d), "LE", n=None)


@query("WITH " + TAGS_SQL + """, found AS (SELECT id FROM tags WHERE list_contains(string_split(skills, '|'), 'Sich') ORDER BY id LIMIT 3)
SELECT l.id AS raw_id, l.title, substr(l.description, 1, 400) AS description FROM listings l JOIN found USING (id)""")
def skill_exact_sample(spark, d):
    """The first three listings with a skill, as the report shows them."""
    clean_rows = S.tagged(spark, d).withColumn("skills_extracted", X.join_list(F.col("skills")))
    return views.listings_with_skill(clean_rows, S.listings(spark, d), "Sich", n=3, exact=True)


@query("WITH " + TAGS_SQL + """, zero AS (SELECT id FROM tags WHERE skill_count = 0 ORDER BY id LIMIT 5)
SELECT l.id, l.title, '' AS skills_raw, substr(l.description, 1, 300) AS description FROM listings l JOIN zero USING (id)""")
def zero_skill_sample(spark, d):
    return views.zero_skill_sample(S.tagged(spark, d), S.listings(spark, d))


@query("WITH " + TAGS_SQL + """
SELECT title AS "Job Title", company AS "Company", replace(skills, '|', ', ') AS "Skills",
       CASE source WHEN 'src0' THEN 'Source Zero' WHEN 'src1' THEN 'Source One' WHEN 'src10' THEN 'Source Ten' ELSE source END AS "Portal"
FROM tags""")
def listing_view(spark, d):
    rows = S.tagged(spark, d).select("title", "company", X.join_list(F.col("skills")).alias("skills_extracted"), "source")
    return views.listing_view(rows, labels=S.LABELS)


@query("SELECT doc_id, substr(text, 1, 1000) AS t1000, substr(text, 1, 300) AS t300 FROM documents")
def truncate_text(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", X.truncate(t, 1000).alias("t1000"), X.truncate(t, 300).alias("t300"))


@query("WITH " + TAGS_SQL + " SELECT id, skill FROM hits")
def explode_skills(spark, d):
    listed = S.tagged(spark, d).select("id", X.join_list(F.col("skills"), " | ").alias("skills_extracted"))
    return stats.explode_skills(listed.withColumn("skills", X.split_list(F.col("skills_extracted"))), "id")


@query("SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL")
def filter_options(spark, d):
    return views.filter_options(table(spark, d, "documents"), "lang")


# ---- scalar text functions --------------------------------------------------------------------

@query("""
SELECT c_custkey, n_name, c_mktsegment,
       CASE WHEN contains(lower(n_name), 'nation_1') THEN 'Primary' WHEN contains(lower(n_name), 'nation_2') THEN 'Secondary'
            WHEN contains(lower(n_name), 'building') THEN 'Builder'
            WHEN contains(lower(c_mktsegment), 'nation_1') THEN 'Primary' WHEN contains(lower(c_mktsegment), 'nation_2') THEN 'Secondary'
            WHEN contains(lower(c_mktsegment), 'building') THEN 'Builder'
            ELSE upper(n_name[1]) || lower(n_name[2:]) END AS city
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def normalise_city(spark, d):
    nations = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    city = X.normalise_city(F.col("n_name"), F.col("c_mktsegment"), S.CITIES)
    return table(spark, d, "customer").join(nations, "c_nationkey").select(
        "c_custkey", "n_name", "c_mktsegment", city.alias("city"))


_MONTHS = "CAST(month(o_orderdate) AS VARCHAR) || ' ans ' || o_orderpriority"


@query(f"""
SELECT raw, CASE
    WHEN contains(raw, 'junior') OR contains(raw, 'débutant') OR contains(raw, '0-1') OR contains(raw, 'moins d''1')
      OR contains(raw, '< 1') OR contains(raw, 'entry') THEN 'Junior (0–1 an)'
    WHEN contains(raw, '1 an') OR contains(raw, '1-2') OR contains(raw, '1 à 2') OR contains(raw, 'entre 1') THEN '1–2 ans'
    WHEN contains(raw, '2 ans') OR contains(raw, '2-5') OR contains(raw, '2 à 5') OR contains(raw, 'entre 2') THEN '2–5 ans'
    WHEN contains(raw, '5 ans') OR contains(raw, '5-10') OR contains(raw, '5 à 10') OR contains(raw, 'entre 5')
      OR contains(raw, 'senior') OR contains(raw, 'confirmé') THEN '5+ ans'
    WHEN contains(raw, '10 ans') OR contains(raw, '> 10') OR contains(raw, '10+') THEN '10+ ans'
    ELSE 'Non précisé' END AS bucket, count(*) AS n
FROM (SELECT lower({_MONTHS}) AS raw FROM orders) GROUP BY 1, 2""")
def bucket_experience(spark, d):
    raw = F.concat(F.month("o_orderdate").cast("string"), F.lit(" ans "), F.col("o_orderpriority"))
    return table(spark, d, "orders").select(F.lower(raw).alias("raw"), X.bucket_experience(raw).alias("bucket")).groupBy(
        "raw", "bucket").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
WITH profile(lang, word) AS (VALUES {_values((k, w) for k, ws in C.LANGUAGE_WORDS.items() for w in ws)}),
words AS (
  SELECT doc_id, unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) AS word FROM documents
  WHERE length(text) >= 20),
scores AS (SELECT doc_id, lang, count(*) AS hits FROM words JOIN profile USING (word) GROUP BY 1, 2),
best AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY doc_id ORDER BY hits DESC, lang) AS r FROM scores)
SELECT d.doc_id, coalesce(b.lang, 'unknown') AS language FROM documents d LEFT JOIN best b ON b.doc_id = d.doc_id AND r = 1""")
def detect_language(spark, d):
    return spread(table(spark, d, "documents"), "doc_id").select("doc_id", X.detect_language(F.col("text"), scan_chars=None).alias("language"))


_ALIAS_ROWS = """
SELECT p_partkey AS line, p_brand || ' ' || p_type AS canonical, replace(p_name, ' ', ';') AS aliases FROM part"""


@query(f"""
WITH taxonomy AS ({_ALIAS_ROWS}),
entries AS (
  SELECT line, canonical, lower(canonical) AS alias FROM taxonomy
  UNION ALL SELECT line, canonical, lower(trim(unnest(string_split(aliases, ';')))) FROM taxonomy)
SELECT alias, arg_max(canonical, line) AS canonical FROM entries WHERE alias <> '' GROUP BY alias""")
def taxonomy_aliases(spark, d):
    """Parts as a taxonomy: the words of the name are aliases of brand and type."""
    rows = table(spark, d, "part").select(
        F.col("p_partkey").alias("line"), F.concat_ws(" ", "p_brand", "p_type").alias("canonical"),
        F.replace("p_name", F.lit(" "), F.lit(";")).alias("aliases"))
    return taxonomy.taxonomy_aliases(rows)


_SKILLS_SQL = "WITH " + TAGS_SQL + " SELECT id, skills, skill_count FROM tags"


def _skills(tagged: DataFrame) -> DataFrame:
    return tagged.select("id", X.join_list(F.col("skills")).alias("skills"), F.col("skill_count").cast("long").alias("skill_count"))


@query(_SKILLS_SQL)
def extract_skills(spark, d):
    return _skills(S.tagged(spark, d))


@query(_SKILLS_SQL)
def extract_skills_one_pass(spark, d):
    return _skills(S.tagged(spark, d, "dictionary"))


@query(_SKILLS_SQL)
def extract_skills_joined(spark, d):
    return _skills(S.tagged_by_join(spark, d))


LARGE_SQL = LISTINGS_SQL + f""",
entries AS (
  SELECT item_id AS line, 'Item ' || item_id AS skill, 'item ' || item_id AS alias FROM benchmark
  UNION ALL
  SELECT item_id, 'Item ' || item_id, unnest(list_filter(string_split_regex(lower(text), '[^\\p{{L}}]+'), lambda w: w <> '')[1:12]) FROM benchmark),
alias_table AS MATERIALIZED (SELECT alias, arg_max(skill, line) AS skill FROM entries GROUP BY alias),
lowered AS MATERIALIZED (SELECT id, lower(' ' || description) AS body FROM listings),
hits AS (
  SELECT DISTINCT l.id, a.skill FROM lowered l JOIN alias_table a ON contains(l.body, a.alias)
    AND (length(a.alias) > 3 OR regexp_matches(l.body, '(^|{_BOUNDARY})' || a.alias || '({_BOUNDARY}|$)')))"""


@query("WITH " + LARGE_SQL + """
SELECT l.id, coalesce(string_agg(skill, '|' ORDER BY skill), '') AS skills, count(skill) AS skill_count
FROM listings l LEFT JOIN hits h ON h.id = l.id GROUP BY l.id""")
def extract_skills_large(spark, d):
    """A taxonomy of several hundred aliases, taken from a table."""
    return _skills(S.tagged_large(spark, d))


@query(f"""WITH {LARGE_SQL}
SELECT skill, count(*) AS count, {_PCT1.format(part='count(*)', whole='(SELECT count(*) FROM documents)')} AS pct FROM hits GROUP BY skill""")
def skill_frequency_large(spark, d):
    return stats.skill_frequency(S.tagged_large(spark, d))


@query("WITH " + TAGS_SQL + """
SELECT id, string_agg(skill, '|' ORDER BY skill) AS skills FROM hits WHERE skill IN ('Of', 'La', 'Le', 'Der') GROUP BY id""")
def extract_skills_short(spark, d):
    """Only the aliases that need word boundaries."""
    short = {a: s for a, s in S.aliases().items() if s in ("Of", "La", "Le", "Der")}
    rows = taxonomy.tag_skills(S.listings(spark, d), short, guards={})
    return taxonomy.skilled_only(rows).select("id", X.join_list(F.col("skills")).alias("skills"))


@query(f"""SELECT doc_id, regexp_matches(text, '(?i){S.GUARDS["un"]}') AS hit,
       regexp_matches(text, '(?i)(sas|spss|stata|jvm|sbt)') AS other FROM documents""")
def context_guard(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", context_hit(F.col("text"), S.GUARDS["un"]).alias("hit"),
        context_hit(F.col("text"), "(sas|spss|stata|jvm|sbt)").alias("other"))


@query("WITH " + TAGS_SQL + """
SELECT skills, count(*) AS n, min(skill_count) AS skill_count FROM tags GROUP BY skills""")
def skill_arrays(spark, d):
    """Sorted distinct skills, their joined form and number."""
    return S.tagged(spark, d).groupBy("skills").agg(F.count(F.lit(1)).alias("n")).select(
        X.join_list(F.col("skills")).alias("skills"), "n", F.size("skills").cast("long").alias("skill_count"))


@query("WITH " + TAGS_SQL + """
SELECT id, array_to_string(string_split(replace(skills, '|', ', '), ', ')[1:4], ', ') AS first_four FROM tags""")
def top_skill_prefix(spark, d):
    shown = X.display_list(X.join_list(F.col("skills")))
    return S.tagged(spark, d).select("id", X.first_entries(shown, 4).alias("first_four"))


@query("""
WITH letters AS (
  SELECT page_id, url, unnest(string_split(lower(url), '')) AS ch, generate_subscripts(string_split(lower(url), ''), 1) AS pos FROM pages),
marked AS (
  SELECT page_id, pos, ch, lag(ch) OVER (PARTITION BY page_id ORDER BY pos) AS before FROM letters)
SELECT page_id, string_agg(CASE WHEN before IS NULL OR NOT regexp_matches(before, '\\p{L}') THEN upper(ch) ELSE ch END, '' ORDER BY pos) AS titled
FROM marked GROUP BY page_id""")
def title_case(spark, d):
    return table(spark, d, "pages").select("page_id", X.title_case(F.col("url")).alias("titled"))


_CLEAN_SQL = f"""
WITH profile(lang, word) AS (VALUES {_values((k, w) for k, ws in C.LANGUAGE_WORDS.items() for w in ws)}),
words AS (
  SELECT doc_id, unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) AS word FROM documents
  WHERE length(text) >= 19),
scores AS (SELECT doc_id, lang, count(*) AS hits FROM words JOIN profile USING (word) GROUP BY 1, 2),
best AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY doc_id ORDER BY hits DESC, lang) AS r FROM scores),
{TAGS_SQL}
SELECT t.id AS raw_id, t.hash, trim(t.title) AS title, t.company, 'Non précisé' AS city, 'Non précisé' AS experience,
       coalesce(b.lang, 'unknown') AS language, t.skills AS skills_extracted, CAST(t.skill_count AS BIGINT) AS skill_count,
       substr(t.description, 1, 1000) AS description, t.source
FROM tags t LEFT JOIN best b ON b.doc_id = t.id AND b.r = 1"""


@query(_CLEAN_SQL)
def clean_listings(spark, d):
    """The whole cleaning stage in one pass over the listings."""
    raw = S.listings(spark, d, spread_out=True).withColumn("scraped_at", F.lit(None).cast("timestamp"))
    rows = clean.clean_listings(raw, S.aliases(), demo_url=None, cities=S.CITIES, guards=S.GUARDS, scan_chars=None)
    return rows.select("raw_id", "hash", "title", "company", "city", "experience", "language", "skills_extracted",
                       F.col("skill_count").cast("long").alias("skill_count"), "description", "source")


# ---- statistics -------------------------------------------------------------------------------

@query("SELECT source, count(*) AS count FROM documents GROUP BY source")
def rows_by_source(spark, d):
    return stats.rows_by(table(spark, d, "documents"), "source")


@query(_share_sql("documents", "lang", "lang"))
def language_share(spark, d):
    return stats.share_of_total(table(spark, d, "documents"), "lang")


@query("""
WITH c AS (SELECT n_name AS city FROM customer JOIN nation ON c_nationkey = n_nationkey)
""" + _share_sql("c", "city", "city", "ORDER BY count DESC, city LIMIT 10"))
def top_cities(spark, d):
    """Ten largest, shares of all rows."""
    nations = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("city"))
    return stats.share_of_total(table(spark, d, "customer").join(nations, "c_nationkey"), "city", top=10)


@query(_share_sql("orders", "o_orderpriority", "o_orderpriority"))
def experience_share(spark, d):
    return stats.share_of_total(table(spark, d, "orders"), "o_orderpriority")


@query(f"WITH {FREQUENCY_SQL} SELECT skill, count, {_PCT1.format(part='count', whole='(SELECT count(*) FROM documents)')} AS pct FROM frequency")
def skill_frequency(spark, d):
    return stats.skill_frequency(S.tagged(spark, d))


@query(f"""WITH {TAGS_SQL}, chosen AS (SELECT id FROM tags WHERE lang IN ('fr', 'es'))
SELECT skill, count(*) AS count, {_PCT1.format(part='count(*)', whole='(SELECT count(*) FROM chosen)')} AS pct
FROM hits JOIN chosen USING (id) GROUP BY skill ORDER BY count DESC, skill LIMIT 5""")
def skill_frequency_filtered(spark, d):
    return views.skill_frequency_filtered(S.tagged(spark, d), top=5, lang=["fr", "es"], source=[])


@query(f"WITH {FREQUENCY_SQL} SELECT skill, count, row_number() OVER (ORDER BY count DESC, skill) AS rank FROM frequency QUALIFY rank <= 8")
def skill_rank(spark, d):
    top = stats.ranked(stats.skill_frequency(S.tagged(spark, d)), F.desc("count"), F.asc("skill"), top=8)
    return top.select("skill", "count", F.col("rank").cast("long").alias("rank"))


@query(f"WITH {FREQUENCY_SQL}, top AS (SELECT * FROM frequency ORDER BY count DESC, skill LIMIT 6) SELECT skill, count FROM top ORDER BY count")
def chart_order(spark, d):
    return views.chart_order(stats.skill_frequency(S.tagged(spark, d), top=6).select("skill", "count"), "count", "skill")


@query(f"""WITH {FREQUENCY_SQL}, categories(skill, category) AS (VALUES {_values((c, k) for c, _, k in S.TAXONOMY if c != "Los")}),
top AS (SELECT * FROM frequency ORDER BY count DESC, skill LIMIT 10)
SELECT coalesce(category, 'Other') AS category, CAST(sum(count) AS BIGINT) AS count FROM top LEFT JOIN categories USING (skill) GROUP BY 1""")
def category_breakdown(spark, d):
    known = S.taxonomy(spark).filter("canonical <> 'Los'")
    return stats.category_breakdown(stats.skill_frequency(S.tagged(spark, d), top=10), known)


@query("WITH " + TAGS_SQL + """
SELECT CAST(sum(skill_count) AS DOUBLE) / count(*) AS avg_all,
       CAST(sum(skill_count) AS DOUBLE) / count(*) FILTER (WHERE skill_count > 0) AS avg_skilled FROM tags""")
def avg_skills(spark, d):
    return stats.average_skills(S.tagged(spark, d))


@query("WITH " + TAGS_SQL + " SELECT count(*) AS listings, CAST(sum(skill_count) AS DOUBLE) / count(*) AS avg_skills FROM tags")
def kpis(spark, d):
    return stats.kpis(S.tagged(spark, d))


@query("WITH " + TAGS_SQL + """
SELECT source, count(*) AS total_jobs, CAST(sum(skill_count) AS DOUBLE) / count(*) AS avg_skills, count(DISTINCT lang) AS unique_cities
FROM tags WHERE skills <> '' GROUP BY source""")
def source_comparison(spark, d):
    clean_rows = S.tagged(spark, d).select("raw_id", X.join_list(F.col("skills")).alias("skills_extracted"), "lang")
    return stats.source_comparison(clean_rows, S.listings(spark, d), city="lang")


@query(f"""WITH {FREQUENCY_SQL}, g(skill_group, skill) AS (VALUES {_values((k, s) for k, ss in S.GROUPS.items() for s in ss)})
SELECT skill_group, skill, CAST(sum(count) AS BIGINT) AS count FROM g JOIN frequency USING (skill)
GROUP BY GROUPING SETS ((skill_group, skill), (skill_group))""")
def skill_groups(spark, d):
    return stats.skill_groups(stats.skill_frequency(S.tagged(spark, d)), S.GROUPS)


@query("WITH " + TAGS_SQL + " SELECT count(DISTINCT skill) AS n FROM hits")
def distinct_skills(spark, d):
    return taxonomy.distinct_skills(stats.explode_skills(S.tagged(spark, d)), "skill")


@query("WITH " + TAGS_SQL + """, counts AS (SELECT t.lang, h.skill, count(*) AS count FROM hits h JOIN tags t USING (id) GROUP BY 1, 2)
SELECT lang, skill, count, row_number() OVER (PARTITION BY lang ORDER BY count DESC, skill) AS rank FROM counts QUALIFY rank <= 4""")
def top_skills_per_group(spark, d):
    top = stats.top_skills_per_group(S.tagged(spark, d), "lang", k=4)
    return top.select("lang", "skill", "count", F.col("rank").cast("long").alias("rank"))


@query("""
SELECT d.doc_id AS raw_id, d.lang, CASE WHEN l.doc_id IS NULL THEN NULL ELSE 'quality ' || l.quality END AS archetype
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def listing_clusters(spark, d):
    """Labels in the role of clusters; unlabelled documents keep NULL."""
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("raw_id"), "lang")
    labels = table(spark, d, "labels").select(
        F.col("doc_id").alias("raw_id"), F.concat(F.lit("quality "), F.col("quality")).alias("archetype"))
    return views.with_archetypes(rows, labels)


@query("SELECT 'quality ' || quality AS archetype, count(*) AS count FROM labels JOIN documents USING (doc_id) GROUP BY 1")
def archetype_counts(spark, d):
    return stats.archetype_counts(listing_clusters(spark, d))


# ---- mining -----------------------------------------------------------------------------------

@query("WITH " + TAGS_SQL + " SELECT id AS raw_id, skills AS items FROM tags WHERE skill_count > 0")
def baskets(spark, d):
    return taxonomy.baskets(S.tagged(spark, d)).select("raw_id", F.array_join("items", "|").alias("items"))


def _itemsets_sql(items: str) -> str:
    """Itemsets of the relation ``items(id, skill)`` of distinct rows, at the default support."""
    return f"""
n AS (SELECT count(DISTINCT id) AS n FROM {items}),
sets AS (
  SELECT [a.skill] AS items, 1 AS size, count(*) AS count FROM {items} a GROUP BY 1
  UNION ALL
  SELECT [a.skill, b.skill], 2, count(*) FROM {items} a JOIN {items} b ON a.id = b.id AND a.skill < b.skill GROUP BY 1
  UNION ALL
  SELECT [a.skill, b.skill, c.skill], 3, count(*) FROM {items} a JOIN {items} b ON a.id = b.id AND a.skill < b.skill
  JOIN {items} c ON a.id = c.id AND b.skill < c.skill GROUP BY 1),
itemsets AS MATERIALIZED (
  SELECT items, size, count, CAST(count AS DOUBLE) / CAST(n AS DOUBLE) AS support FROM sets, n
  WHERE CAST(count AS DOUBLE) / CAST(n AS DOUBLE) >= CAST({C.MIN_SUPPORT} AS DOUBLE))"""


def _rules_sql(lift: float) -> str:
    """Every set with every proper part of it: the parts of a set of up to three items are listed, then looked up."""
    return f"""
keyed AS MATERIALIZED (SELECT *, array_to_string(items, ' + ') AS name FROM itemsets),
parts AS (
  SELECT name, support, items, unnest(list_filter([[items[1]], [items[2]], [items[3]], [items[1], items[2]], [items[1], items[3]], [items[2], items[3]]],
    lambda p: len(list_filter(p, lambda x: x IS NOT NULL)) = len(p) AND len(p) < size)) AS ante FROM keyed),
splits AS MATERIALIZED (
  SELECT support, array_to_string(ante, ' + ') AS if_skills,
         array_to_string(list_filter(items, lambda x: NOT list_contains(ante, x)), ' + ') AS then_skills FROM parts),
rules AS (
  SELECT if_skills, then_skills, s.support, s.support / a.support AS confidence, s.support / a.support / c.support AS lift
  FROM splits s JOIN keyed a ON a.name = if_skills JOIN keyed c ON c.name = then_skills
  WHERE s.support / a.support >= CAST({C.MIN_CONFIDENCE} AS DOUBLE) AND s.support / a.support / c.support >= CAST({lift} AS DOUBLE))"""


_ITEMS_SQL = """
order_items AS MATERIALIZED (
  SELECT DISTINCT l_orderkey AS id, string_split(p_name, ' ')[2] AS skill FROM lineitem JOIN part ON l_partkey = p_partkey)"""
_ITEMSET_OUT = " SELECT array_to_string(items, '|') AS items, size, count, support FROM itemsets"
_ROUND3 = "round_even({x} * CAST(1000 AS DOUBLE), 0) / CAST(1000 AS DOUBLE)"
_RULES_OUT = f""" SELECT if_skills, then_skills, {_ROUND3.format(x='support')} AS support,
       {_ROUND3.format(x='confidence')} AS confidence, {_ROUND3.format(x='lift')} AS lift FROM rules"""


def _flat(itemsets: DataFrame) -> DataFrame:
    return itemsets.select(F.array_join("items", "|").alias("items"), "size", "count", "support")


@query(f"WITH {TAGS_SQL}, {_itemsets_sql('hits')}" + _ITEMSET_OUT)
def itemsets(spark, d):
    return _flat(R.itemsets(taxonomy.baskets(S.tagged(spark, d))))


@query(f"WITH {_ITEMS_SQL}, {_itemsets_sql('order_items')}" + _ITEMSET_OUT)
def itemsets_orders(spark, d):
    return _flat(R.itemsets(R.basket_items(S.order_items(spark, d), "l_orderkey", "item")))


@query(f"WITH {_ITEMS_SQL}, {_itemsets_sql('order_items')}" + _ITEMSET_OUT)
def itemsets_fpgrowth(spark, d):
    return _flat(R.itemsets_fpgrowth(R.basket_items(S.order_items(spark, d), "l_orderkey", "item")))


def _rules(spark, d) -> DataFrame:
    return R.association_rules(R.itemsets(taxonomy.baskets(S.tagged(spark, d))))


@query(f"WITH {TAGS_SQL}, {_itemsets_sql('hits')}, {_rules_sql(C.MIN_LIFT)}" + _RULES_OUT)
def association_rules(spark, d):
    return R.rule_table(_rules(spark, d))


@query(f"WITH {_ITEMS_SQL}, {_itemsets_sql('order_items')}, {_rules_sql(0.0)}" + _RULES_OUT)
def association_rules_orders(spark, d):
    """Independent items, so the lift threshold is off."""
    found = R.itemsets(R.basket_items(S.order_items(spark, d), "l_orderkey", "item"))
    return R.rule_table(R.association_rules(found, min_lift=0.0))


@query(f"""WITH {TAGS_SQL}, {_itemsets_sql('hits')}, {_rules_sql(C.MIN_LIFT)},
shown AS ({_RULES_OUT})
SELECT * FROM shown WHERE confidence >= CAST(0.7 AS DOUBLE) AND lift >= 2 ORDER BY lift DESC, confidence DESC, if_skills, then_skills LIMIT 15""")
def rules_filtered(spark, d):
    return views.rules_filtered(R.rule_table(_rules(spark, d)), 0.7, 2.0, 15)


@query(f"""WITH {TAGS_SQL}, {_itemsets_sql('hits')}, {_rules_sql(C.MIN_LIFT)}
SELECT count(*) AS rules, round(avg(support), 6) AS avg_support, round(avg(confidence), 6) AS avg_confidence,
       round(avg(lift), 6) AS avg_lift, round(max(lift), 6) AS max_lift FROM rules""")
def rule_stats(spark, d):
    shown = stats.rule_stats(R.rule_table(_rules(spark, d), digits=None))
    return shown.select("rules", *[F.round(c, 6).alias(c) for c in shown.columns[1:]])


@query("""
WITH costs AS (SELECT l_linenumber AS k, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cost FROM lineitem GROUP BY 1),
bends AS (SELECT lead(k) OVER w AS k, cost - lead(cost) OVER w - (lead(cost) OVER w - lead(cost, 2) OVER w) AS bend FROM costs WINDOW w AS (ORDER BY k))
SELECT CAST(coalesce((SELECT k FROM bends WHERE bend IS NOT NULL ORDER BY bend DESC, k LIMIT 1), 3) AS INTEGER) AS k""")
def elbow_from_costs(spark, d):
    """Revenue per line number as a falling curve."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    costs = table(spark, d, "lineitem").groupBy(F.col("l_linenumber").alias("k")).agg(F.sum(cents).alias("cost"))
    return clusters.elbow(costs)


def _score(words) -> str:
    return "len(list_intersect(s, [" + ", ".join(f"'{w}'" for w in words) + "]))"


_LABEL_SQL = f"""
CASE WHEN greatest({", ".join(_score(ws) for _, ws in S.RULES)}) >= 2 THEN CASE greatest({", ".join(_score(ws) for _, ws in S.RULES)})
       {" ".join(f"WHEN {_score(ws)} THEN '{name}'" for name, ws in S.RULES)} END
     WHEN greatest({", ".join(_score(ws) for _, ws in S.RULES)}) = 1 THEN coalesce(
       list_filter(list_transform(s, lambda x: CASE x WHEN 'Los' THEN 'Iberian' WHEN 'Der' THEN 'Teutonic' END), lambda x: x IS NOT NULL)[1], 'General IT')
     ELSE 'General IT' END"""


@query(f"WITH {TAGS_SQL}, arrays AS (SELECT id, string_split(skills, '|') AS s FROM tags) SELECT id, {_LABEL_SQL} AS archetype FROM arrays")
def archetype_scores(spark, d):
    rows = S.tagged(spark, d).select("id", "skills")
    return archetypes.archetype_scores(rows, rules=S.RULES, singles=S.SINGLES).select("id", "archetype")


_PROFILES_SQL = f"""
sizes AS (SELECT lang, count(*) AS size FROM tags GROUP BY lang),
weights AS (
  SELECT t.lang, h.skill, CAST(count(*) AS DOUBLE) / CAST(any_value(s.size) AS DOUBLE) AS weight
  FROM hits h JOIN tags t USING (id) JOIN sizes s USING (lang) GROUP BY 1, 2),
top AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY weight DESC, skill) AS r FROM weights QUALIFY r <= 10),
listed AS (SELECT lang, list(skill ORDER BY r) AS s FROM top WHERE weight > CAST(0.05 AS DOUBLE) GROUP BY lang),
named AS (SELECT lang, size, coalesce(s, []) AS s FROM sizes LEFT JOIN listed USING (lang)),
profiles AS (
  SELECT lang, {_LABEL_SQL} AS archetype, size, array_to_string(s, ', ') AS top_skills,
         round_even(CAST(100 AS DOUBLE) * size / (SELECT count(*) FROM tags) * CAST(10 AS DOUBLE), 0) / CAST(10 AS DOUBLE) AS pct_of_total
  FROM named)"""


@query(f"WITH {TAGS_SQL}, {_PROFILES_SQL} SELECT * FROM profiles")
def group_profiles(spark, d):
    """Profiles of the languages as if they were clusters."""
    return archetypes.group_profiles(S.tagged(spark, d), "lang", rules=S.RULES, singles=S.SINGLES)


@query(f"WITH {TAGS_SQL}, {_PROFILES_SQL} SELECT id AS raw_id, title, lang AS cluster_id, archetype FROM tags JOIN profiles USING (lang)")
def cluster_archetypes(spark, d):
    rows = S.tagged(spark, d)
    profiles = archetypes.group_profiles(rows, "lang", rules=S.RULES, singles=S.SINGLES)
    return archetypes.cluster_archetypes(
        rows.select("raw_id", "title", F.col("lang").alias("cluster_id")), profiles.withColumnRenamed("lang", "cluster_id"))


@query()
def kmeans_clusters(spark, d):
    listed, _ = clusters.cluster_roles(S.tagged(spark, d), k=4, rules=S.RULES, singles=S.SINGLES)
    return listed


@query()
def cluster_profiles(spark, d):
    """Order baskets clustered at the K that the elbow gives."""
    items = R.basket_items(S.order_items(spark, d), "l_orderkey", "item").select(
        F.col("l_orderkey").alias("raw_id"), F.lit("").alias("title"), F.col("items").alias("skills"))
    _, profiles = clusters.cluster_roles(items, restarts=C.FINAL_RESTARTS)
    return profiles


@query()
def elbow_k(spark, d):
    points, words = clusters.weighted_points(S.tagged(spark, d))
    k = clusters.choose_k(points, words, points.agg(F.sum("weight")).first()[0])
    return points.select(F.lit(k).alias("k")).limit(1)


@query("WITH " + TAGS_SQL + " SELECT skills, count(*) AS weight FROM tags WHERE skill_count > 0 GROUP BY skills")
def skill_points(spark, d):
    """The points of the clustering: distinct skill sets and how many listings have them."""
    points, _ = clusters.weighted_points(S.tagged(spark, d))
    return points.select(X.join_list(F.col("skills")).alias("skills"), "weight")


@query("WITH " + TAGS_SQL + """, skilled AS (SELECT * FROM tags WHERE skill_count > 0)
SELECT count(*) AS listings, least(4, count(DISTINCT skills)) AS clusters, 0 AS misplaced FROM skilled""")
def kmeans_check(spark, d):
    """All listings with skills are in four clusters, and none is nearer to another cluster's mean."""
    points, words = clusters.weighted_points(S.tagged(spark, d))
    found = clusters.misplaced(clusters.fit_best(points, words, 4, C.FINAL_RESTARTS).transform(points))
    return found.select("listings", "clusters", F.col("misplaced").cast("int").alias("misplaced"))


@query(f"SELECT CAST(unnest(generate_series({C.K_MIN}, {C.K_MAX})) AS INTEGER) AS k, true AS falls")
def elbow_costs(spark, d):
    """The cost of the best fit for every number of clusters never rises with it."""
    points, words = clusters.weighted_points(S.tagged(spark, d))
    costs = clusters.costs_by_k(points, words, points.agg(F.sum("weight")).first()[0])
    rows = spark.createDataFrame(costs, "k int, cost double")
    before = F.lag("cost").over(Window.orderBy("k"))
    return rows.select("k", F.coalesce(F.col("cost") <= before, F.lit(True)).alias("falls"))


# ---- streams ----------------------------------------------------------------------------------

def _event_stream(spark, d) -> DataFrame:
    # as a pattern the path may be a single file, which a stream does not take by name
    events = refresh.read_stream(spark, f"{d}/events.parquet*", table(spark, d, "events").schema)
    return events.withColumn("ts", refresh.event_time("ts"))


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark, d):
    stream = _event_stream(spark, d).select("ts", "user_id", "event_type")
    return refresh.stream_dedup(stream, ["user_id", "event_type"], "ts", lateness="3650 days").select("user_id", "event_type")


_TREND_SQL = """
SELECT strftime(time_bucket(INTERVAL 7 DAYS, ts, TIMESTAMP '1970-01-01'), '%Y-%m-%d') AS week, event_type, count(*) AS count
FROM events GROUP BY 1, 2"""


@query(_TREND_SQL)
def weekly_trend(spark, d):
    events = table(spark, d, "events").withColumn("ts", refresh.event_time("ts"))
    return refresh.weekly_trend(events, "ts", "event_type")


@query(_TREND_SQL)
def stream_weekly_trend(spark, d):
    return refresh.stream_weekly_trend(_event_stream(spark, d), "ts", "event_type")
