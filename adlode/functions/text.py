"""Text functions on columns. All are plain Spark expressions and treat NULL as ''."""

import json
import re
import zlib
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, functions as F

from adlode import constants as C

# White space as in the result files: Unicode white space and the four separator controls.
_SPACES = r"(?U)[\s\x1c-\x1f]+"


def text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), 0)


def lookup(names: Mapping[str, object], kind: str = "string") -> Callable[[Column], Column]:
    """A function from a name to its value of type ``kind``, NULL for others: a literal table, however many names it has.

    Spark searches a map from its start, so the names are dealt to many small ones by their checksum.
    """
    buckets: list[dict] = [{} for _ in range(max(1, len(names) // 2))]
    for name, value in names.items():
        buckets[zlib.crc32(name.encode("utf-8")) % len(buckets)][name] = value
    dealt = F.from_json(F.lit(json.dumps(buckets)), f"array<map<string,{kind}>>")
    return lambda name: F.try_element_at(
        F.get(dealt, F.pmod(F.crc32(name.cast("binary")), F.lit(len(buckets))).cast("int")), name)


def strip(c: Column) -> Column:
    return F.regexp_replace(text(c), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def clean_text(c: Column) -> Column:
    """Collapse runs of white space to one blank and trim."""
    return F.trim(F.regexp_replace(text(c), _SPACES, " "))


def title_case(c: Column) -> Column:
    """Upper-case every letter that does not follow a letter, lower-case the rest."""
    pieces = F.split(F.lower(text(c)), r"(?<=\P{L})")
    return F.array_join(
        F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 2**31 - 1))), "")


def truncate(c: Column, length: int) -> Column:
    return F.substring(text(c), 1, length)


def combined_text(skills_raw: Column, description: Column) -> Column:
    return F.concat(text(skills_raw), F.lit(" "), text(description))


def split_list(c: Column, sep: str = "|") -> Column:
    """Delimited text to an array; entries trimmed, blanks dropped."""
    return F.filter(F.transform(F.split(text(c), re.escape(sep)), strip), lambda x: x != "")


def join_list(c: Column, sep: str = "|") -> Column:
    return F.array_join(c, sep)


def display_list(c: Column, sep: str = "|", shown: str = ", ") -> Column:
    return F.replace(c, F.lit(sep), F.lit(shown))


def list_length(c: Column, sep: str = "|") -> Column:
    """Number of entries, counted by separators."""
    return (F.length(c) - F.length(F.replace(c, F.lit(sep), F.lit(""))) + F.lit(1)).cast("long")


def first_entries(c: Column, k: int, sep: str = ", ") -> Column:
    return F.array_join(F.slice(F.split(c, re.escape(sep)), 1, k), sep)


def listing_hash(title: Column, company: Column, source: Column) -> Column:
    """Identity of a listing: 16 hex digits over title, company and source."""
    key = F.concat_ws("|", F.lower(text(title)), F.lower(text(company)), text(source))
    return F.substring(F.sha2(key, 256), 1, 16)


def absolute_url(href: Column, base: str) -> Column:
    href = text(href)
    return F.when(href.startswith("http"), href).otherwise(F.concat(F.lit(base), href))


def split_pair(c: Column, sep: str = "•") -> tuple[Column, Column]:
    """``left sep right`` to its two cleaned sides; without a separator all is left."""
    parts = F.split(clean_text(c), re.escape(sep))
    return clean_text(F.get(parts, 0)), clean_text(F.get(parts, 1))


def before_word(c: Column, words: Sequence[str] = C.JOB_TYPES) -> Column:
    """The words before the first of ``words``, without trailing commas."""
    any_word = "|".join(re.escape(w) for w in words)
    head = F.regexp_replace(clean_text(c), rf"(^| )({any_word})( .*)?$", "")
    return F.trim(F.regexp_replace(head, ",+$", ""))


def _first_contained(c: Column, mapping: Mapping[str, str]) -> Column:
    """Value of the first key of ``mapping`` that ``c`` contains, else NULL."""
    chain = None
    for key, value in mapping.items():
        hit = F.contains(c, F.lit(key))
        chain = F.when(hit, F.lit(value)) if chain is None else chain.when(hit, F.lit(value))
    return F.lit(None).cast("string") if chain is None else chain


def normalise_city(city: Column, description: Column, mapping: Mapping[str, str] = C.CITY_MAP,
                   missing: str = C.UNSPECIFIED) -> Column:
    """Known city in the field, else in the description, else the field itself in title case."""
    city = text(city)
    return F.coalesce(
        once(F.lower(city), lambda field: _first_contained(field, mapping)),
        once(F.lower(text(description)), lambda body: _first_contained(body, mapping)),
        F.when(city != "", title_case(city)),
        F.lit(missing),
    )


def bucket_experience(raw: Column, buckets=C.EXPERIENCE_BUCKETS, missing: str = C.UNSPECIFIED) -> Column:
    fragments = {f: bucket for bucket, found in buckets for f in found}
    return F.coalesce(once(F.lower(text(raw)), lambda field: _first_contained(field, fragments)), F.lit(missing))


def detect_language(c: Column, profiles: Mapping[str, Sequence[str]] = C.LANGUAGE_WORDS,
                    min_chars: int = C.LANGUAGE_MIN_CHARS, scan_chars: int | None = C.LANGUAGE_SCAN_CHARS) -> Column:
    """Language with the most function words in the first ``scan_chars`` characters, in all of them
    with None; ties by language code.

    One row at a time and without a join, so nothing is shuffled.
    """
    scanned = text(c) if scan_chars is None else truncate(c, scan_chars)
    words = F.split(F.lower(scanned), r"\P{L}+")

    def winner(found: Column) -> Column:
        # a score carries its language behind it, so that the greatest score names the winner
        return F.array_max(F.array(*[
            F.struct(F.size(F.filter(found, lambda w: w.isin(*profile))).alias("hits"),
                     F.lit(-position).alias("order"), F.lit(language).alias("language"))
            for position, (language, profile) in enumerate(sorted(profiles.items()))
        ]))

    best = once(once(words, winner), lambda top: F.when(top["hits"] > 0, top["language"]))
    return F.coalesce(F.when(F.length(text(c)) >= min_chars, best), F.lit(C.UNKNOWN))
