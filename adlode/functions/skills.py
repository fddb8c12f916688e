"""Finding taxonomy aliases in text.

Aliases longer than ``SHORT_ALIAS`` characters match anywhere; shorter ones only
where neither neighbour belongs to a word; guarded ones count when their context
pattern occurs. Everything is a Spark expression. Two ways give the same result:

* ``direct``     - one substring test per alias;
* ``dictionary`` - one pattern, a tree of the aliases' letters, takes the longest alias at every place of
  a text; the others that start there are its beginnings and looked up. The cost follows the text and
  not the taxonomy.
"""

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F

from adlode import constants as C
from adlode.functions.text import lookup, once, text

# Up to so many aliases, testing each of them costs less than the words of a text (measured).
DIRECT_UP_TO = 24

ANYWHERE, AS_WORD = "reference", "word"


def _quote(alias: str) -> str:
    return r"\Q" + alias.replace(r"\E", r"\E\\E\Q") + r"\E"


def _bounded(pattern: str) -> str:
    return f"(?<![{C.WORD_CHARS}]){pattern}(?![{C.WORD_CHARS}])"


def _direct(lowered: Column, anywhere: Mapping[str, str], as_word: Mapping[str, str]) -> Column:
    parts = []
    if anywhere:
        table = F.array(*[F.struct(F.lit(a).alias("alias"), F.lit(c).alias("skill")) for a, c in anywhere.items()])
        hits = F.filter(table, lambda entry: F.contains(lowered, entry["alias"]))
        parts.append(F.transform(hits, lambda entry: entry["skill"]))
    # between word boundaries such aliases cannot overlap, so one pattern finds them all
    plain = {a: c for a, c in as_word.items() if re.fullmatch(f"[{C.WORD_CHARS}]+", a)}
    if plain:
        names = F.create_map(*[F.lit(x) for pair in plain.items() for x in pair])
        # most positions are ruled out by their character alone
        firsts = "".join(sorted({a[0] for a in plain}))
        pattern = f"(?=[{firsts}]){_bounded(f'(?:{'|'.join(plain)})')}"
        hits = F.regexp_extract_all(lowered, F.lit(pattern), F.lit(0))
        parts.append(F.transform(F.array_distinct(hits), lambda alias: F.try_element_at(names, alias)))
    others = {a: c for a, c in as_word.items() if a not in plain}
    if others:
        # the substring test spares most texts the pattern
        parts.append(F.array(*[
            F.when(F.contains(lowered, F.lit(a)) & F.rlike(lowered, F.lit(_bounded(_quote(a)))), F.lit(c))
            for a, c in others.items()
        ]))
    return F.concat(*parts) if parts else F.array().cast("array<string>")


def _sign(c: str) -> str:
    return c if c.isascii() and c.isalnum() else f"\\x{{{ord(c):x}}}"


def _longest(aliases: Iterable[str]) -> str:
    """A pattern that takes the longest alias at a place; aliases share the beginnings they have in common."""
    tree: dict[str, dict] = {}
    for alias in aliases:
        node = tree
        for c in alias:
            node = node.setdefault(c, {})
        node[""] = {}

    def pattern(node: dict) -> str:
        line = ""
        while len(node) == 1 and "" not in node:
            (c, node), = node.items()
            line += _sign(c)
        ways = [_sign(c) + pattern(node[c]) for c in sorted(node) if c]
        return f"{line}(?:{'|'.join(ways)}){'?' * ('' in node)}" if ways else line

    return pattern(tree)


def _dictionary(lowered: Column, anywhere: Mapping[str, str], as_word: Mapping[str, str]) -> Column:
    word = f"[{C.WORD_CHARS}]"

    def found(aliases: Mapping[str, str], bounded: bool) -> Column:
        # other aliases that start at the same place are beginnings of the longest one
        reached = {alias: [aliases[alias[:n]] for n in range(1, len(alias) + 1) if alias[:n] in aliases
                           and not (bounded and re.match(word, alias[n:]))] for alias in aliases}
        before, behind = (f"(?<!{word})", f"(?!{word})") if bounded else ("", "")
        # most positions are ruled out by their character alone
        firsts = "".join(_sign(c) for c in sorted({a[0] for a in aliases}))
        pattern = f"(?=[{firsts}]){before}(?=({_longest(aliases)}){behind})"
        hits = F.array_distinct(F.regexp_extract_all(lowered, F.lit(pattern), F.lit(1)))
        return F.flatten(F.transform(hits, lookup(reached, "array<string>")))

    parts = [found(aliases, bounded) for aliases, bounded in ((anywhere, False), (as_word, True)) if aliases]
    return F.concat(*parts) if parts else F.array().cast("array<string>")


def match_skills(c: Column, aliases: Mapping[str, str], guards: Mapping[str, str] = C.CONTEXT_GUARDS,
                 match: str = ANYWHERE, engine: str = "auto") -> Column:
    """Sorted distinct skills whose aliases occur in ``c``.

    ``aliases`` maps lower-case alias to skill. ``match='word'`` asks long aliases
    for word boundaries too.
    """
    if match not in (ANYWHERE, AS_WORD):
        raise ValueError(f"match must be {ANYWHERE!r} or {AS_WORD!r}")
    guarded = {a: s for a, s in aliases.items() if a in guards}
    open_aliases = {a: s for a, s in aliases.items() if a and a not in guards}
    as_word = {a: s for a, s in open_aliases.items() if len(a) <= C.SHORT_ALIAS or match == AS_WORD}
    anywhere = {a: s for a, s in open_aliases.items() if a not in as_word}
    if engine not in ("auto", "direct", "dictionary"):
        raise ValueError("engine must be 'auto', 'direct' or 'dictionary'")
    find = _direct if engine == "direct" or engine == "auto" and len(open_aliases) <= DIRECT_UP_TO else _dictionary
    # as a lambda's variable the lowered text is made once, not once per alias
    found = once(F.lower(text(c)), lambda t: find(t, anywhere, as_word))
    if guarded:
        contexts = [F.when(context_hit(c, guards[a]), F.lit(s)) for a, s in guarded.items()]
        found = F.concat(found, F.array(*contexts))
    return F.array_sort(F.array_distinct(F.array_compact(found)))


def context_hit(c: Column, pattern: str) -> Column:
    """Whether a context pattern occurs, in any letter case."""
    return F.rlike(text(c), F.lit("(?iU)" + pattern))
