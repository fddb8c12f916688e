"""Captured pages to listings.

A page table has ``portal, page_no, url, html``. Portals differ only by where
their fields are; each reader maps pages to listing rows without a shuffle, and
pages are the unit of scale-out.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from adlode import constants as C
from adlode.functions import html as H
from adlode.functions.html import Pick
from adlode.functions.text import absolute_url, before_word, clean_text, split_pair
from adlode.operators.ingest import drop_untitled, normalise_record, union_sources
from adlode.session import settle

COMPANY = (Pick(attr="class", has="company"), Pick(attr="class", has="employer"))
PLACE = (Pick(attr="class", has="location"), Pick(attr="class", has="city"))


def shown(element: Column) -> Column:
    """Text of an element, '' where there is none."""
    return F.coalesce(H.inner_text(element), F.lit(""))


def date_of(element: Column) -> Column:
    """The datetime attribute if it has one, else the text."""
    stamp = H.attribute(element, "datetime")
    return F.coalesce(F.when(stamp != "", stamp), shown(element))


def first_phrase(html: Column, phrases: Sequence[str] = C.DATE_PHRASES) -> Column:
    """First piece of text with the first of ``phrases`` that occurs, else ''."""
    hits = [F.regexp_extract(html, rf">([^<]*?{phrase}[^<]*)(?:<|$)", 1) for phrase in phrases]
    return F.coalesce(*[F.when(h != "", clean_text(H.decode(h))) for h in hits], F.lit(""))


def page_cards(pages: DataFrame, picks: Sequence[Pick], up: str = "") -> DataFrame:
    """One row per card: ``page_id, card_no, card, outer``, of the first kind of card that a page has."""
    found = H.elements(H.visible(F.col("html")), picks, up)
    cards = pages.select(*[c for c in pages.columns if c != "html"], F.posexplode(found).alias("card_no", "_card"))
    return cards.select("*", "_card.element", "_card.outer").drop("_card").withColumnRenamed("element", "card")


def page_links(sources: Sequence[Column], base: str, fragment: str = "") -> Column:
    """Ordered distinct absolute hrefs of the first of ``sources`` (arrays of links) that has any link."""
    chosen = F.coalesce(*[F.when(F.size(s) > 0, s) for s in sources], F.array().cast("array<string>"))
    found = F.filter(F.transform(chosen, lambda a: H.attribute(a, "href")),
                     lambda h: (h != "") & F.contains(h, F.lit(fragment)))
    return F.array_distinct(F.transform(found, lambda h: absolute_url(h, base)))


def arrival(position: Column) -> Column:
    """Order in which a portal shows its listings: by page, then by place on the page."""
    return (F.col("page_no").cast("long") * 2 ** 32 + position).alias("arrival")


# ---- portals that show whole listings as cards ------------------------------------------------

def read_job_cards(pages: DataFrame, base: str) -> DataFrame:
    """Cards with a heading; everything else by class names."""
    picks = [Pick("div", "class", "job-card"), Pick("div", "class", "JobCard"),
             Pick("article", "class", "job"), Pick("div", "class", "listing")]
    card = F.col("card")
    rows = page_cards(pages, picks).select(
        "page_no",
        arrival(F.col("card_no")),
        H.first(card, Pick("h2"), Pick("h3"), Pick(attr="class", has="title")).alias("heading"),
        absolute_url(H.attribute(H.first(card, Pick("a", "href")), "href"), base).alias("url"),
        shown(H.first(card, *COMPANY)).alias("company"),
        shown(H.first(card, *PLACE)).alias("city"),
        shown(H.first(card, Pick("p"), Pick(attr="class", has="description"))).alias("description"),
        shown(H.first(card, Pick("time"), Pick(attr="class", has="date"))).alias("date_posted"),
    )
    return rows.filter("heading is not null").withColumn("title", shown(F.col("heading"))).drop("heading")


def read_labelled_cards(pages: DataFrame, base: str) -> DataFrame:
    """Cards whose fields are label/value items; the link is on an enclosing element."""
    card = F.col("card")
    cards = page_cards(pages, [Pick("div", "class", "card-job-detail", whole=True)], up="data-href")
    items = H.leaves(card, Pick("li"))
    rows = cards.filter("outer <> ''").select(
        "page_no",
        arrival(F.col("card_no")),
        shown(F.coalesce(H.within(card, Pick("h3"), Pick("a")), H.within(card, Pick("h2"), Pick("a")))).alias("title"),
        absolute_url(H.attribute(F.col("outer"), "data-href"), base).alias("url"),
        shown(H.first(card, Pick("a", "class", "card-job-company", whole=True))).alias("company"),
        shown(H.within(card, Pick("div", "class", "card-job-description", whole=True), Pick("p"))).alias("description"),
        date_of(H.first(card, Pick("time"))).alias("date_posted"),
        *[c.alias(name) for name, c in H.labelled_values(items, C.LABEL_FIELDS).items()],
    )
    return drop_untitled(rows)


def read_table_rows(pages: DataFrame, base: str, min_cells: int = 4) -> DataFrame:
    """Rows of a listing table: logo, title and company, place and job type, date."""
    body = H.first(H.visible(F.col("html")), Pick("tbody", "class", "wpjb-job-list", whole=True))
    rows = pages.withColumn("_body", body).select(
        "page_no", F.posexplode(H.leaves(F.col("_body"), Pick("tr"))).alias("row_no", "row"))
    cells = rows.withColumn("cells", H.leaves(F.col("row"), Pick("td"))).filter(F.size("cells") >= min_cells)
    cell = [F.get("cells", F.lit(i)) for i in range(min_cells)]
    link = H.first(cell[1], Pick("a"))
    href = H.attribute(link, "href")
    return drop_untitled(cells.select(
        "page_no",
        arrival(F.col("row_no")),
        shown(link).alias("title"),
        shown(H.first(cell[1], Pick("small", "class", "wpjb-sub", whole=True))).alias("company"),
        before_word(shown(cell[2])).alias("city"),
        shown(cell[3]).alias("date_posted"),
        F.when(href != "", absolute_url(href, base)).otherwise(F.lit("")).alias("url"),
    ))


# ---- portals that link to a page per listing --------------------------------------------------

def harvest_view_links(pages: DataFrame, base: str) -> DataFrame:
    """The first link of every heading that leads to a listing; without any, all such links."""
    page = F.col("html")
    headings = F.transform(H.leaves(page, Pick("h2")), lambda h: F.get(H.leaves(h, Pick("a", "href")), 0))
    headed = page_links([F.array_compact(headings)], base, "/view")
    direct = page_links([H.leaves(page, Pick("a", "href", "/view?id="))], base)
    return pages.withColumn("html", H.visible(page)).withColumn("links", F.when(F.size(headed) > 0, headed).otherwise(direct))


def harvest_job_links(pages: DataFrame, base: str) -> DataFrame:
    page = F.col("html")
    sources = [
        H.all_within(page, Pick("article"), Pick("a", "href", "/job")),
        H.all_within(page, Pick("div", "class", "job"), Pick("a", "href")),
        H.all_within(page, Pick("h2"), Pick("a", "href")),
        H.all_within(page, Pick("h3"), Pick("a", "href")),
        H.leaves(page, Pick("a", "href", "/jobs/")),
    ]
    links = F.array_remove(page_links(sources, base), base)
    return pages.withColumn("html", H.visible(page)).withColumn("links", links)


def read_split_details(details: DataFrame) -> DataFrame:
    """Detail pages with company and place in one line, separated by a bullet."""
    page = F.col("html")
    lines = [shown(H.first(page, p)) for p in (
        Pick(attr="class", has="company"), Pick(attr="class", has="employer"), Pick(attr="class", has="subtitle"))]
    lines.append(shown(H.within(page, Pick(attr="class", has="header"), Pick("p"))))
    header = shown(H.first(page, Pick("header"), Pick(attr="class", has="job-header")))
    line = F.coalesce(*[F.when(x != "", x) for x in lines], F.when(F.contains(header, F.lit("•")), header), F.lit(""))
    stamp = H.first(page, Pick("time"), Pick(attr="class", has="date"), Pick(attr="datetime", has=""))
    described = H.first(page, Pick("div", "class", "description", whole=True), Pick(attr="class", has="description"),
                        Pick("div", "class", "content"), Pick("main"))
    rows = details.withColumn("html", H.visible(page)).select(
        "url",
        shown(H.first(page, Pick("h1"))).alias("title"),
        line.alias("_line"),
        shown(described).alias("description"),
        F.when(stamp.isNotNull(), date_of(stamp)).otherwise(first_phrase(page)).alias("date_posted"),
    )
    company, city = split_pair(F.col("_line"))
    return drop_untitled(rows.withColumn("company", company).withColumn("city", city).drop("_line"))


def read_details(details: DataFrame) -> DataFrame:
    """Detail pages with every field under its own class name; untitled ones stay."""
    page = F.col("html")
    return details.withColumn("html", H.visible(page)).select(
        "url",
        shown(H.first(page, Pick("h1"), Pick(attr="class", has="title"))).alias("title"),
        shown(H.first(page, *COMPANY)).alias("company"),
        shown(H.first(page, *PLACE)).alias("city"),
        shown(H.first(page, Pick("div", "class", "description"), Pick("div", "class", "content"),
                      Pick("section", "class", "job"))).alias("description"),
        shown(H.first(page, Pick("time"), Pick(attr="class", has="date"))).alias("date_posted"),
        shown(H.first(page, Pick(attr="class", has="experience"))).alias("experience"),
    )


def harvested(pages: DataFrame, harvest: Callable, base: str) -> DataFrame:
    """page_no, arrival, url: one row per link of the listing pages."""
    links = harvest(pages, base).select("page_no", F.posexplode("links").alias("place", "url"))
    return links.select("page_no", arrival(F.col("place")), "url")


# ---- which pages count ------------------------------------------------------------------------

def pages_until_empty(pages: DataFrame, n_cards: str = "n_cards", first: int = 1, cap: int | None = None,
                      missing_stops: bool = False) -> DataFrame:
    """Pages from ``first`` on, before a portal's first page without cards, and at most ``cap`` of them.

    With ``missing_stops`` the first number that was not captured stops a portal as an empty page does.
    What stops a portal does not depend on the cap. A page captured several times is empty if all its
    captures are. Pages and their successors meet by portal and number, and the stop is one aggregated
    row per portal, so a portal's size does not matter.
    """
    number = F.col("page_no").cast("long")
    per_page = (pages.filter(number >= first).groupBy("portal", number.alias("page_no"))
                .agg(F.max(F.coalesce(F.col(n_cards), F.lit(0))).alias("_cards")))
    stops = per_page.filter("_cards <= 0").select("portal", "page_no")
    if missing_stops:
        known = per_page.select("portal", "page_no")
        wanted = known.select("portal", F.col("page_no") + 1).toDF("portal", "page_no").unionByName(
            known.select("portal").distinct().withColumn("page_no", F.lit(first).cast("long")))
        stops = stops.unionByName(wanted.join(known, ["portal", "page_no"], "left_anti"))
    stops = stops.groupBy("portal").agg(F.min("page_no").alias("_stop"))
    inside = number.between(first, first + cap - 1) if cap is not None else number >= first
    return (pages.filter(inside).join(stops, "portal", "left")
            .filter(F.col("_stop").isNull() | (number < F.col("_stop"))).drop("_stop").select(*pages.columns))


# ---- all portals ------------------------------------------------------------------------------

# Site roots that relative links are resolved against.
BASE_URLS = {
    "emploi_cm": "https://www.emploi.cm",
    "talent_cm": "https://cm.talent.com",
    "expertini_cm": "https://cm.expertini.com",
    "workconnect": "https://www.workconnectjob.com",
    "newjobscm": "https://newjobscameroon.com",
}
FIRST_PAGE = {"emploi_cm": 0}


def portal_listings(portal: str, pages: DataFrame, cap: int | None = None, missing_stops: bool = False) -> DataFrame:
    """Listings of one portal from its captured pages.

    Pages of links and of single listings share the table; the latter have no ``page_no``. Cards, or
    the links of a page whether or not what they lead to was captured, decide where the portal ends.
    """
    base, first = BASE_URLS[portal], FIRST_PAGE.get(portal, 1)
    own = pages.filter(F.col("portal") == portal)
    lists, details = own.filter("page_no is not null"), own.filter("page_no is null")
    shown_on = {
        "workconnect": lambda: read_job_cards(lists, base),
        "emploi_cm": lambda: read_labelled_cards(lists, base),
        "newjobscm": lambda: read_table_rows(lists, base),
        "talent_cm": lambda: harvested(lists, harvest_view_links, base),
        "expertini_cm": lambda: harvested(lists, harvest_job_links, base),
    }
    # read once for the stop rule and for the listings
    found = settle(shown_on[portal]())
    counts = found.groupBy("page_no").agg(F.count("*").alias("n_cards"))
    filled = lists.select("page_no").distinct().join(counts, "page_no", "left").withColumn("portal", F.lit(portal))
    rows = found.join(pages_until_empty(filled, first=first, cap=cap, missing_stops=missing_stops), "page_no", "left_semi")
    read = {"talent_cm": read_split_details, "expertini_cm": read_details}.get(portal)
    if read:
        rows = rows.join(read(details.select("url", "html")), "url")
    return normalise_record(rows, portal)


def all_listings(pages: DataFrame, enabled: Sequence[str] = tuple(BASE_URLS), only: str | None = None,
                 cap: int | None = None, missing_stops: bool = False) -> DataFrame:
    """Listings of all enabled portals, or of one."""
    chosen = [p for p in enabled if only is None or p == only]
    return union_sources({p: portal_listings(p, pages, cap, missing_stops) for p in chosen})
