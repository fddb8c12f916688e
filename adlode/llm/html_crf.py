"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is cut into leaf blocks: runs of text without a block element's border inside. Each has
features of its ancestors (tags, words of their classes and ids, the role such words usually
name) and of its text (length, links, punctuation, place). A chain over the blocks decides
article or not for all of them together, by Viterbi.

The field is trained on labelled pages. They are made from a bounded sample of SAMPLE pages of
the table itself: their paragraphs and menu words are laid out anew in LAYOUTS random layouts
each, with the containers pages are built from, so the label of every block is known.

Defined results: a NULL or empty page, or one without article blocks, has an empty text; markup
that never closes, closes twice or is cut off is read as far as it goes; repeated pages give
repeated rows. Character references are decoded, white space in a block becomes one space,
blocks are joined by a line end; scripts, styles, comments and form controls are no text.
"""

import html as entities
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlode.llm.common import slices, table, uniform

SAMPLE, LAYOUTS, EPOCHS = 150, 3, 6

OPENING = re.compile(r"<(?:(!--)|([!?])|(/?)([A-Za-z][^\s/>]*))")
#: What decides where a tag ends: its bracket, or a value in quotes. A quote elsewhere than behind ``=`` is a sign like others.
DECISIVE = re.compile(r">|=\s*([\"'])")
NAMES = re.compile(r"(?:\s|^)(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose inside is no text of the page, read up to their own end tag.
RAW = frozenset("script style textarea title noscript template iframe xmp".split())
#: Elements that hold controls or drawings; text inside them is left out.
SILENT = frozenset("select button svg math canvas object audio video datalist head".split())
#: Elements that leave an open head open; any other one ends it, as text does, for its end tag may be left out.
IN_HEAD = frozenset("base head link meta noframes".split())
BLOCK = frozenset(("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
                   "form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td "
                   "tfoot th thead tr ul").split())
#: Words of classes and ids by the role they usually name.
ROLES = {
    "menu": "menu nav navbar navigation breadcrumb breadcrumbs crumbs topbar toc tabs pager pagination skip links sitemap dropdown",
    "head": "header masthead banner logo branding top tagline hero",
    "foot": "footer foot bottom copyright legal colophon imprint disclaimer",
    "side": "sidebar side aside widget widgets rail right left related recommended popular trending recent tags tagcloud more archive",
    "note": "notice notices cookie cookies consent alert alerts gdpr popup modal overlay newsletter subscribe subscription paywall promo "
            "announcement warning message toast privacy signup",
    "advert": "ad ads adv advert advertisement advertising sponsor sponsored sponsors promotion promoted banner adsense dfp teaser affiliate",
    "form": "form login search searchbox contact register input field",
    "talk": "comment comments commentlist commentary reply replies respond response responses discussion disqus thread feedback review reviews "
            "reader readers guestbook forum",
    "share": "share sharing social facebook twitter follow like likes print email meta byline author date tools toolbar actions",
    "body": "article content post entry story main body text page maincontent articlebody blog news hentry prose copy paragraph",
}
ROLE_OF = {}
for _role, _words in ROLES.items():
    for _word in _words.split():
        ROLE_OF.setdefault(_word, []).append(_role)


def tokens(attributes: str) -> list[str]:
    """Words of an element's class, id, role and itemprop."""
    return [w.lower() for found in NAMES.findall(attributes) for w in PIECE.findall(" ".join(found))]


class Tags:
    """The tags of a page one after the other, in time linear in its length however broken it is.

    A quoted value that never closes is no quoted value. Where quotes that close run on to the end of the page, this and
    all later tags end at the next bracket.
    """

    def __init__(self, page: str):
        self.page, self.quoted = page, True
        self.last = {quote: page.rfind(quote) for quote in "\"'"}

    def end(self, at: int) -> int:
        """Where the tag that is open at ``at`` has its bracket, -1 if it has none."""
        here = at
        while self.quoted:
            found = DECISIVE.search(self.page, here)
            if found is None:
                self.quoted = False
            elif found[1] is None:
                return found.start()
            elif self.last[found[1]] < found.end():
                here = found.end()
            else:
                here = self.page.index(found[1], found.end()) + 1
        return self.page.find(">", at)

    def next(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """(start, end, whether it is an end tag, name, attributes) of the next tag; comments and the like have no name."""
        page = self.page
        found = OPENING.search(page, at)
        if found is None:
            return None
        if found[1]:
            end = page.find("-->", found.end())
            return found.start(), end + 3 if end >= 0 else len(page), False, "", ""
        end = page.find(">", found.end()) if found[2] else self.end(found.end())
        if end < 0:
            return None
        return found.start(), end + 1, bool(found[3]), (found[4] or "").lower(), page[found.end():end] if found[4] else ""


def blocks(page: str | None) -> list[tuple[str, float, tuple]]:
    """(text, share of it inside links, ancestors) of the leaf blocks with text, in page order.

    Ancestors are (tag, words) pairs from the outside in.
    """
    page = page or ""
    stack, out, parts, linked = [], [], [], 0
    links = silent = at = 0

    def flush():
        nonlocal linked
        text = " ".join(entities.unescape("".join(parts)).split()) if parts else ""
        if text:
            out.append((text, min(1.0, linked / len(text)), tuple(x for x in stack if x[0] in BLOCK)))
        parts.clear()
        linked = 0

    def close(n: int):
        nonlocal links, silent
        for tag, _ in stack[n:]:
            links -= tag == "a"
            silent -= tag in SILENT
        del stack[n:]

    def end_head():
        if silent:
            close(next((n for n, (tag, _) in enumerate(stack) if tag == "head"), len(stack)))

    def add(text: str):
        nonlocal linked
        if silent and stack[-1][0] == "head" and text.strip():
            end_head()
        if text and not silent:
            parts.append(text)
            if links:
                linked += len(text.strip())

    tags = Tags(page)
    while (found := tags.next(at)) is not None:
        start, end, closing, tag, attributes = found
        add(page[at:start])
        at = end
        if not tag:
            continue
        if closing:
            if tag in BLOCK:
                flush()
            for n in range(len(stack) - 1, -1, -1):
                if stack[n][0] == tag:
                    close(n)
                    break
                if stack[n][0] in BLOCK and tag not in BLOCK:
                    break  # an inline end tag closes nothing beyond its block
            continue
        if tag in RAW:
            ending = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = ending.end() if ending else len(page)
            continue
        if tag not in IN_HEAD:
            end_head()
        if tag == "br":
            add(" ")
        if tag in BLOCK:
            flush()
            # A paragraph, list item or cell ends where the next one or a larger block begins.
            own = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)),
                   "td": ("td th", ("table", "tr")), "th": ("td th", ("table", "tr"))}.get(tag, ("", ()))
            for n in range(len(stack) - 1, -1, -1):
                name = stack[n][0]
                if name == "p" or name in own[0].split():
                    close(n)
                elif name in own[1] or name in BLOCK and not own[0]:
                    break
        if tag not in VOID and not attributes.rstrip().endswith("/"):
            stack.append((tag, tuple(tokens(attributes)) if attributes else ()))
            links += tag == "a"
            silent += tag in SILENT
    # A tag that is cut off at the end of the page is no text.
    tail = page[at:]
    cut = re.search(r"<[A-Za-z/!][^<]*\Z", tail)
    add(tail[: cut.start()] if cut else tail)
    flush()
    return out


def block_features(text: str, share: float, ancestors: tuple, place: int, total: int, has_article: bool) -> list[str]:
    found, words = {"bias"}, text.count(" ") + 1
    roles = ({r for n in (tag, *names) for r in ROLE_OF.get(n, ())} for tag, names in reversed(ancestors))
    found.update(f"nearest {r}" for r in next((r for r in roles if r), {"none"}))
    for depth, (tag, names) in enumerate(reversed(ancestors)):
        found.add(f"in {tag}")
        if depth == 0:
            found.add(f"own {tag}")
        if depth == 1:
            found.add(f"parent {tag}")
        for name in names:
            found.add(f"named {name}")
            found.update(f"role {r}" for r in ROLE_OF.get(name, ()))
    found.add(f"words {min(words.bit_length(), 8)}")
    found.add(f"links {int(share * 4)}")
    if share > 0.5 and words < 6:
        found.add("short link")
    found.add("ends" if text[-1] in ".!?:;…\"»”" else "open")
    found.add(f"marks {min(sum(map(text.count, ',.')), 4)}")
    if "©" in text or "(c)" in text.lower():
        found.add("copyright")
    if any(tag == "article" or tag == "main" for tag, _ in ancestors):
        found.add("in text container")
    elif has_article:
        found.add("outside of the page's text container")
    found.add(f"place {min(3, 4 * place // max(1, total))}")
    return sorted(found)


def page_features(found: list) -> list[list[str]]:
    has = any(tag in ("article", "main") for _, _, ancestors in found for tag, _ in ancestors)
    return [block_features(*block, i, len(found), has) for i, block in enumerate(found)]


class Field:
    """A chain with two labels: 1 for the article. ``weights`` are those of label 1 against 0."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.weights = np.zeros(0)
        self.transition = np.zeros((2, 2))

    def energies(self, page: list[list[int]]) -> np.ndarray:
        return np.array([self.weights[f].sum() for f in page])

    def train(self, pages: list[list[list[str]]], labels: list[np.ndarray], epochs: int = EPOCHS, rate: float = 0.1, ridge: float = 1e-4,
              seed: int = 3) -> None:
        """Stochastic gradients of the log-likelihood (forward-backward), steps scaled by AdaGrad."""
        for page in pages:
            for block in page:
                for name in block:
                    self.number.setdefault(name, len(self.number))
        coded = [[np.array([self.number[n] for n in block]) for block in page] for page in pages]
        self.weights = np.zeros(len(self.number))
        square, square_t = np.full(len(self.weights), 1e-2), np.full((2, 2), 1e-2)
        rng = np.random.default_rng(seed)
        for _ in range(epochs):
            for k in rng.permutation(len(coded)):
                page, truth = coded[k], labels[k]
                if not page:
                    continue
                marginal, pairs = self.marginals(self.energies(page))
                gradient, gradient_t = {}, pairs.copy()
                for block, error in zip(page, marginal - truth):
                    for f in block:
                        gradient[f] = gradient.get(f, 0.0) + error
                np.subtract.at(gradient_t, (truth[:-1].astype(int), truth[1:].astype(int)), 1)
                at = np.fromiter(gradient, np.int64, len(gradient))
                g = np.fromiter(gradient.values(), float, len(gradient)) + ridge * self.weights[at]
                square[at] += g * g
                self.weights[at] -= rate * g / np.sqrt(square[at])
                square_t += gradient_t ** 2
                self.transition -= rate * gradient_t / np.sqrt(square_t)

    def marginals(self, energy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(label 1) of every block, and expected transitions."""
        n, t = len(energy), np.exp(self.transition - self.transition.max())
        local = np.ones((n, 2))
        high = np.clip(energy, -30, 30)
        local[:, 1] = np.exp(high)
        local /= local.sum(axis=1, keepdims=True)
        forward, backward = np.zeros((n, 2)), np.ones((n, 2))
        forward[0] = local[0]
        for i in range(1, n):
            row = (forward[i - 1] @ t) * local[i]
            forward[i] = row / row.sum()
        for i in range(n - 2, -1, -1):
            row = t @ (local[i + 1] * backward[i + 1])
            backward[i] = row / row.sum()
        both = forward * backward
        pairs = np.zeros((2, 2))
        for i in range(n - 1):
            joint = forward[i][:, None] * t * (local[i + 1] * backward[i + 1])[None, :]
            pairs += joint / joint.sum()
        return both[:, 1] / both.sum(axis=1), pairs

    def decode(self, page: list[list[str]]) -> list[int]:
        """The most likely labels (Viterbi); features never seen in training count nothing."""
        get, weights = self.number.get, self.weights
        (s00, s01), (s10, s11) = self.transition.tolist()
        zero = one = 0.0
        back = []
        for i, block in enumerate(page):
            energy = float(sum(weights[j] for j in map(get, block) if j is not None))
            if i == 0:
                zero, one = 0.0, energy
                continue
            from0, from1 = (zero + s00 < one + s10), (zero + s01 < one + s11)
            back.append((from0, from1))
            zero, one = max(zero + s00, one + s10), max(zero + s01, one + s11) + energy
        if not page:
            return []
        labels = [int(one > zero)]
        for choice in reversed(back):
            labels.append(int(choice[labels[-1]]))
        return labels[::-1]

    def text(self, page: str | None) -> str:
        found = blocks(page)
        return "\n".join(text for (text, _, _), label in zip(found, self.decode(page_features(found))) if label)


#: How labelled pages are laid out: opening tags of article containers and of other parts, by kind.
TEXT_CONTAINERS = ("<article>", "<main>", '<div class="content">', '<div id="main-content">', '<div class="post-body">',
                   '<section class="article-text">', '<div class="entry-content"><div>', '<main><article class="post">',
                   '<div itemprop="articleBody">', '<div class="story">', "<div>")
OTHERS = {
    "menu": ("<nav><ul>", '<div class="menu"><ul>', '<ul class="navbar">', '<div id="navigation">', '<ol class="breadcrumb">', '<header><nav>'),
    "head": ("<header>", '<div class="header">', '<div id="masthead">', '<div class="topbar">', '<div role="banner">'),
    "foot": ("<footer>", '<div id="footer">', '<div class="copyright">', '<footer><div class="legal">'),
    "side": ("<aside>", '<div class="sidebar">', '<div id="side-widget"><ul>', '<section class="related">', '<aside class="recommended"><ul>'),
    "note": ('<div class="cookie-notice">', '<div class="alert">', '<section id="newsletter">', '<div class="notice">', '<div class="consent-banner">',
             '<aside class="notice">', '<div role="alert">', '<p class="notice">'),
    "advert": ('<div class="ad">', '<div class="ads">', '<aside class="sponsored">', '<div id="advert-top">', '<div class="advertisement">',
               '<div class="promo">', '<p class="ad">'),
    "form": ("<form>", '<form class="search"><label>', '<div class="login-form">', "<form><fieldset>", '<form id="contact"><p>'),
    "talk": ('<div class="comments"><p>', '<section id="comments"><div class="comment"><p>', '<ol class="commentlist"><li>',
             '<div id="disqus_thread">', '<section class="responses"><article class="comment"><p>', '<div class="reader-comments">',
             '<ul class="replies"><li><p>', '<div class="comment">', '<div id="comments"><ul><li>'),
    "share": ('<div class="share">', '<ul class="social"><li>', '<div class="post-meta">', '<div class="author-date">'),
}
INSIDE = ("advert", "note", "share", "side", "talk", "form")


def _closing(opened: str) -> str:
    return "".join(f"</{t}>" for t in reversed(re.findall(r"<(\w+)", opened)))


def labelled_page(sentences: list[str], words: list[str], rng: random.Random) -> list[tuple[str, int]]:
    """(markup, label) pieces of a page: label 1 for article blocks; other pieces hold blocks of label 0 only."""
    pieces = []

    def other(kind: str):
        opened = rng.choice(OTHERS[kind])
        if kind in ("menu", "share") or kind == "side" and rng.random() < 0.5:
            inner = "".join(f'<li><a href="/x">{rng.choice(words)}</a></li>' if rng.random() < 0.7 else f'<a href="/y">{rng.choice(words)}</a> '
                            for _ in range(rng.randint(1, 7)))
        elif kind == "talk":
            inner = "".join(f"<p>{rng.choice(sentences)}</p>" if rng.random() < 0.7 else rng.choice(sentences) + "<br>"
                            for _ in range(rng.randint(1, 4)))
        elif kind == "form":
            inner = f"{rng.choice(words)} <input name='q'><button>{rng.choice(words)}</button> {rng.choice(sentences)[:60]}"
        elif kind == "foot":
            inner = f"&copy; {rng.choice(words)} &middot; {rng.choice(sentences)[:rng.randint(20, 120)]}"
        else:
            inner = rng.choice(sentences)[: rng.choice([30, 80, 200, 4000])]
            if rng.random() < 0.3:
                inner = f"<p>{inner}</p><p>{rng.choice(sentences)[:100]}</p>"
            if rng.random() < 0.3:
                inner += f' <a href="/z">{rng.choice(words)}</a>'
        pieces.append((f"{opened}{inner}{_closing(opened)}", 0))

    for kind in ("menu", "head", "note", "advert", "side", "share", "form"):
        if rng.random() < (0.8 if kind == "menu" else 0.35):
            other(kind)
    rng.shuffle(pieces)
    container = rng.choice(TEXT_CONTAINERS)
    pieces.append((container, -1))
    if rng.random() < 0.8:
        pieces.append((f"<h1>{rng.choice(sentences)[:rng.randint(15, 90)]}</h1>", 1))
    for _ in range(rng.randint(1, 14)):
        text, kind = rng.choice(sentences), rng.random()
        if kind < 0.06:
            pieces.append((f"<h2>{' '.join(rng.choices(words, k=rng.randint(1, 5)))}</h2>", 1))
        elif kind < 0.12:
            pieces.append((f"<ul><li>{text[:80]}</li><li>{' '.join(rng.choices(words, k=3))}</li></ul>", 1))
        elif kind < 0.15:
            pieces.append((f"<blockquote>{text}</blockquote>", 1))
        elif kind < 0.18:
            pieces.append((f"<table><tr><td>{rng.choice(words)}</td><td>{text[:40]}</td></tr></table>", 1))
        elif kind < 0.30:
            pieces.append((f"<p>{' '.join(rng.choices(words, k=rng.randint(1, 4)))}.</p>", 1))
        elif kind < 0.36:
            pieces.append((f'<p><b>{text}</b> <a href="/w">{rng.choice(words)}</a></p>', 1))
        else:
            pieces.append((f"<p>{text}</p>", 1))
        if rng.random() < 0.06:
            other(rng.choice(INSIDE))
    if rng.random() < 0.3:
        other("talk")
    pieces.append((_closing(container), -1))
    for kind in ("share", "side", "talk", "note", "form", "advert", "foot"):
        if rng.random() < (0.8 if kind == "foot" else 0.35):
            other(kind)
    return pieces


#: Private characters that carry a piece's label through the block reader.
MARKS = ("\ue000", "\ue001")


def labelled_blocks(pieces: list[tuple[str, int]]) -> tuple[list, np.ndarray]:
    """Blocks of the page, with their labels: pieces with a label carry it in a mark before their text."""
    page = "<html><body>" + "".join(
        re.sub(r">(?=[^<\s])", ">" + MARKS[label], markup) if label >= 0 else markup for markup, label in pieces) + "</body></html>"
    found = blocks(page)
    labels = np.array([float(MARKS[1] in text) for text, _, _ in found])
    clean = [("".join(c for c in text if c not in MARKS), share, ancestors) for text, share, ancestors in found]
    kept = [i for i, (text, _, _) in enumerate(clean) if text]
    return [clean[i] for i in kept], labels[kept]


def learn(pages: DataFrame, page_id: str = "page_id", html: str = "html", sample: int = SAMPLE) -> Field:
    """A field trained on pages laid out anew from the texts of at most ``sample`` pages."""
    key = uniform("html", F.col(page_id))
    chosen = [r[0] for r in pages.select(F.col(page_id).alias("sample_id"), key.alias("place"))
              .orderBy("place", "sample_id").limit(sample).select("sample_id").collect()]
    rows = pages.filter(F.col(page_id).isin([i for i in chosen if i is not None])).select(F.col(html).alias("sample_html")).limit(sample).collect()
    outside = {"nav", "footer", "header", "aside", "form"}
    texts = sorted({text for row in rows for text, share, ancestors in blocks(row["sample_html"])
                    if share < 0.5 and "\u00a9" not in text and not outside & {tag for tag, _ in ancestors}})
    sentences = [entities.escape(t[:4000]) for t in texts if t.count(" ") >= 4] or ["The text of a page without any other text."]
    words = sorted({w for s in sentences for w in s.split()[:40] if "&" not in w}) or ["word"]
    rng = random.Random(5)
    made = [labelled_blocks(labelled_page(sentences, words, rng)) for _ in range(LAYOUTS * sample)]
    field = Field()
    field.train([page_features(found) for found, _ in made], [labels for _, labels in made])
    return field


def extract(pages: DataFrame, field: Field, html: str = "html", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``pages`` without its html, with the article's text and its length in code points."""
    kept = [c for c in pages.columns if c not in (html, text, n_chars)]
    schema = pages.select(*[F.col(f"`{c}`") for c in kept]).withColumns({text: F.lit(""), n_chars: F.lit(0).cast("long")}).schema

    def run(batches):
        for batch in slices(batches, 256):
            place = batch.schema.get_field_index
            found = [field.text(page) for page in batch.column(place(html)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(place(c)) for c in kept), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
                names=[*kept, text, n_chars])

    return pages.mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages, learn(pages))
