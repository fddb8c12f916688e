"""Fields from captured HTML.

Most fields are leaf elements and come from Spark's own pattern functions. Only an
element that can contain others of its own kind (a card, a description block) needs
its matching end tag; :func:`elements` finds those in one linear pass per page.
"""

import re
from collections.abc import Sequence
from dataclasses import dataclass
from html.entities import html5

from pyspark.sql import Column, functions as F

from adlode.functions.text import clean_text, lookup, once

# Named references, by Python's own table of those that HTML defines; a hard space is shown as a space.
ENTITIES = {name[:-1]: char for name, char in html5.items() if name.endswith(";")} | {"nbsp": " "}

# Elements without content: they end with their own tag.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())

# Elements whose end tag may be left out, with the tags that end them.
_OPEN_ENDED = {
    "p": r"<(?i:p|div|ul|ol|dl|table|form|pre|blockquote|h[1-6])[\s>]"
         r"|</(?i:p|div|article|section|main|header|footer|nav|ul|ol|li|td|tr|table|tbody|body|html)\s*>",
    "li": r"<(?i:li)[\s>]|</(?i:li|ul|ol)\s*>",
    "td": r"<(?i:td|th|tr)[\s>]|</(?i:td|tr|tbody|table)\s*>",
    "tr": r"<(?i:tr)[\s>]|</(?i:tr|tbody|table)\s*>",
}
# Elements read with Spark's pattern functions.
_LEAVES = (*_OPEN_ENDED, "a", "b", "h1", "h2", "h3", "small", "strong", "time", "title")


@dataclass(frozen=True)
class Pick:
    """Which element to take: a tag name or any, and optionally an attribute with a fragment of its value.

    ``whole`` asks for the fragment as a whole word of the value, as for a class name.
    """

    tag: str = ""
    attr: str = ""
    has: str = ""
    whole: bool = False

    def opening(self) -> str:
        """Pattern of the opening tag."""
        name = self.tag or r"[a-zA-Z][a-zA-Z0-9]*"
        if not self.attr:
            return rf"<(?i:{name})(?=[\s/>])[^>]*>"
        def value(inside: str) -> str:
            part = re.escape(self.has)
            return rf"(?:{inside}*\s)?{part}(?:\s{inside}*)?" if self.whole else rf"{inside}*{part}{inside}*"

        values = "|".join((f'"{value("[^\"]")}"', f"'{value("[^']")}'", value(r"[^\s\"'>]")))
        return rf"<(?i:{name})(?=\s)[^>]*?\s(?i:{self.attr})\s*=\s*(?:{values})[^>]*>"


def visible(html: Column) -> Column:
    """The page without comments, scripts and styles."""
    return F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", "")


def decode(c: Column) -> Column:
    """Character references, numeric and named, as characters, in one pass: nothing is decoded twice.

    Unknown names and numbers beyond Unicode stay as they are.
    """
    named = lookup(ENTITIES)

    def numbered(number: Column) -> Column:
        hexadecimal = F.lower(F.substring(number, 1, 1)) == "x"
        code = F.when(hexadecimal, F.conv(F.substr(number, F.lit(2)), 16, 10)).otherwise(number).cast("long")
        known = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        return F.when(known, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))

    def behind_sign(piece: Column) -> Column:
        name = F.regexp_extract(piece, "^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);", 1)
        char = F.when(F.startswith(name, F.lit("#")), numbered(F.substr(name, F.lit(2)))).otherwise(named(name))
        return F.when(char.isNotNull(), F.concat(char, F.substr(piece, F.length(name) + 2))).otherwise(F.concat(F.lit("&"), piece))

    def pieces(parts: Column) -> Column:
        rest = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
        return F.concat(F.get(parts, F.lit(0)), F.array_join(F.transform(rest, behind_sign), ""))

    return once(c, lambda value: F.when(F.contains(value, F.lit("&")), once(F.split(value, "&"), pieces)).otherwise(value))


def inner_text(element: Column) -> Column:
    """Text of an element: tags out, entities decoded, white space collapsed. NULL stays NULL."""
    return once(element, lambda e: F.when(e.isNotNull(), clean_text(decode(F.regexp_replace(e, r"(?s)<[^>]*>", "")))))


def attribute(element: Column, name: str) -> Column:
    """Value of an attribute of the element's own opening tag, '' without it."""
    opening = F.regexp_extract(element, r"^\s*(<[^>]*>)", 1)
    quoted = F.regexp_extract(opening, rf"""(?is)\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
    return decode(F.regexp_replace(quoted, """^["']|["']$""", ""))


def leaves(html: Column, pick: Pick) -> Column:
    """Array of the elements ``pick`` names that do not contain others of their kind."""
    if pick.tag in _OPEN_ENDED:
        end = f"(?={_OPEN_ENDED[pick.tag]}|$)"
    else:
        end = rf"</(?i:{pick.tag})\s*>"
    return F.regexp_extract_all(html, F.lit(rf"(?s)({pick.opening()}.*?){end}"), F.lit(1))


def elements(html: Column, picks: Sequence[Pick], up: str = "") -> Column:
    """Array of (element, outer) for the first of ``picks`` that occurs in the page, else an empty array.

    ``element`` runs to its matching end tag. ``outer`` is the opening tag of the
    nearest enclosing element, or of the element itself, that has the attribute ``up``.
    """
    wanted = [(re.compile(p.opening()), p.tag.lower()) for p in picks]
    has_up = re.compile(rf"\s{re.escape(up)}\s*=", re.I) if up else None

    def spans(page: str, opening: re.Pattern, tag: str):
        names = {tag} if tag else {re.match(r"<([a-zA-Z0-9]+)", m.group()).group(1).lower()
                                   for m in opening.finditer(page)}
        for name in names:
            if name in VOID:
                for m in re.finditer(rf"<{name}(?=[\s/>])[^>]*>", page, re.I):
                    yield from matching(page, opening, [(m.start(), m.group())], m.end())
                continue
            open_tags = []
            for m in re.finditer(rf"<(/?){name}(?=[\s/>])[^>]*>", page, re.I):
                if not m.group(1):
                    open_tags.append((m.start(), m.group()))
                elif open_tags:
                    yield from matching(page, opening, open_tags, m.end())
                    open_tags.pop()
            while open_tags:  # never closed: to the end of the page
                yield from matching(page, opening, open_tags, len(page))
                open_tags.pop()

    def matching(page: str, opening: re.Pattern, open_tags: list, end: int):
        start, own = open_tags[-1]
        if opening.fullmatch(own):
            around = [t for _, t in reversed(open_tags[:-1])] + [own]
            yield start, page[start:end], next((t for t in around if has_up and has_up.search(t)), "")

    def first_kind(page: str | None) -> list[tuple[str, str]]:
        for opening, tag in wanted:
            found = sorted(spans(page or "", opening, tag))
            if found:
                return [(element, outer) for _, element, outer in found]
        return []

    # Row by row, in Spark's small pickled batches: an Arrow batch would hold thousands of pages and their elements at once.
    return F.udf(first_kind, "array<struct<element:string,outer:string>>", useArrow=False)(html)


def first(html: Column, *picks: Pick) -> Column:
    """First element of the first of ``picks`` that occurs, else NULL."""
    found, containers = [], []
    for pick in picks:
        if pick.tag in _LEAVES:
            if containers:
                found.append(F.get(elements(html, containers), 0)["element"])
                containers = []
            found.append(F.get(leaves(html, pick), 0))
        else:
            containers.append(pick)
    if containers:
        found.append(F.get(elements(html, containers), 0)["element"])
    return F.coalesce(*found)


def all_within(html: Column, outer: Pick, inner: Pick) -> Column:
    """Array of every ``inner`` inside any ``outer``."""
    parts = leaves(html, outer) if outer.tag in _LEAVES else F.transform(
        elements(html, [outer]), lambda e: e["element"])
    return F.flatten(F.transform(parts, lambda p: leaves(p, inner)))


def within(html: Column, outer: Pick, inner: Pick) -> Column:
    """First ``inner`` inside any ``outer``, else NULL."""
    return F.get(all_within(html, outer, inner), 0)


def labelled_values(items: Column, labels: dict[str, str], value: Pick = Pick("strong")) -> dict[str, Column]:
    """Field -> value from label/value items such as ``<li>Label: <strong>value</strong></li>``.

    An item belongs to the first fragment of ``labels`` its text contains; per field
    the first item with a value counts.
    """
    pairs = F.filter(
        F.transform(items, lambda i: F.struct(
            inner_text(i).alias("label"), F.coalesce(inner_text(F.get(leaves(i, value), 0)), F.lit("")).alias("value"))),
        lambda p: p["value"] != "")

    def key(label):
        chain = None
        for fragment, field in labels.items():
            hit = F.contains(label, F.lit(fragment))
            chain = F.when(hit, F.lit(field)) if chain is None else chain.when(hit, F.lit(field))
        return chain

    keyed = F.transform(pairs, lambda p: F.struct(key(p["label"]).alias("field"), p["value"].alias("value")))

    def first_value(field: str) -> Column:
        return F.coalesce(F.get(F.filter(keyed, lambda p: p["field"] == field), 0)["value"], F.lit(""))

    return {field: first_value(field) for field in dict.fromkeys(labels.values())}
