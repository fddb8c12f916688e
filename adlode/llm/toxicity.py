"""Toxicity by a small convolutional text classifier, trained in numpy.

A word is embedded as the sum of hashed vectors of itself and of its first letters. Filters over
one, two and three words, rectified, are pooled by their maximum over the whole text, and a
linear layer gives the score. The projections of a word by all filter taps are remembered, so
scoring a text means adding and comparing remembered rows.

Thresholds are calibrated by language, on labelled documents that training left out. A score
must come from the text alone, so the language is the one that the string-kernel classifier of
``langid`` predicts from the whole text, here and when documents are scored. The score is shifted
so that each language's threshold becomes THRESHOLD.

The classifier learns from every labelled document, whole texts. They are dealt to shares of about
SHARE documents, at most SHARES; in each epoch every share goes on from the same network on its
own, and the results are averaged, an embedding over the shares that moved it. Thresholds count
every held-out document, in cells of 1/CELLS of a logit, and lie between cells. The classifier of
languages is fitted on its own bounded sample.

Defined results: NULL and empty texts have no words and get the score of pooled zeros; texts
without a letter, languages with fewer than LEAST_LABELS held-out labels of either kind, and all
texts where no language can be learnt, take the threshold of all languages together; if there are
no labels of both kinds every score is 0; repeated rows score alike; a column with the name of the
score is replaced.
"""

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlode.llm import langid
from adlode.llm.common import fold, record_batch, slices, table
from adlode.session import settle

EPOCHS, RATE, THRESHOLD = 5, 0.01, 0.7
#: Labelled documents that learn one after the other before networks are averaged, about, until there are SHARES such
#: shares; documents that are mixed in memory; slots of a block that travels; cells of a logit in a calibration.
SHARE, SHARES, MIXED, SLOT_BLOCK, CELLS = 3000, 64, 4096, 1 << 12, 256
SLOTS, SIZE, WIDTHS, FILTERS = 1 << 16, 16, (1, 2, 3), 8
TAPS = sum(WIDTHS)
#: Words whose projections a worker remembers, beginnings of words whose slots it remembers, and words pooled at a time.
CACHE_WORDS, CACHE_BEGINNINGS, PIECE = 150_000, 1 << 16, 1 << 15
EDGES = b".,;:!?()[]{}\"'*%$#&|<>-_"
PREFIXES = (4, 5)
LEAST_LABELS = 20


def spoken(model, texts: list[str]) -> list[str | None]:
    """The predicted language of every text, None without a letter or a model of languages."""
    names: list[str | None] = [None] * len(texts)
    which = [i for i, t in enumerate(texts) if any(map(str.isalpha, t))] if model else []
    if which:
        kernel, languages = model
        for i, best in zip(which, kernel.scores([texts[i] for i in which]).argmax(axis=1)):
            names[i] = languages[best]
    return names


@lru_cache(CACHE_BEGINNINGS)
def beginnings(letters: str) -> bytes:
    """The slots of the beginnings of a word that starts with ``letters``."""
    return np.array([xxhash.xxh3_64_intdigest(f"{n}{letters[:n]}".encode()) % SLOTS for n in PREFIXES], np.uint16).tobytes()


def features(words: list[bytes]) -> np.ndarray:
    """Slots of every word and of its beginnings (in letters), a row per word."""
    plain = [w.strip(EDGES) for w in words]
    slots = np.empty((len(words), 1 + len(PREFIXES)), np.uint16)
    digests = b"".join([xxhash.xxh3_64_digest(b"w" + p) for p in plain])
    slots[:, 0] = np.frombuffer(digests, ">u8") % SLOTS
    letters = b" ".join(plain).decode("utf-8", "ignore").split(" ") if words else []  # words hold no blanks
    longest = max(PREFIXES)
    slots[:, 1:] = np.frombuffer(b"".join([beginnings(w[:longest]) for w in letters]), np.uint16).reshape(-1, len(PREFIXES))
    return slots


class Places(dict):
    """Words and their places in the order in which they came."""

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self)
        return place


def slots_of(texts: list[str]) -> list[np.ndarray]:
    """The slots of all words of every text, a row per word."""
    place, found = Places(), []
    for t in texts:
        words = t.lower().encode("utf-8").split()
        found.append(np.fromiter(map(place.__getitem__, words), np.int64, len(words)))
    slots = features(list(place))
    return [slots.take(index, axis=0) for index in found]


class Network:
    """Embeddings, filters and output weights; ``taps`` holds the filters as one matrix by tap."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.embedding = rng.normal(0, 0.1, (SLOTS, SIZE)).astype(np.float32)
        self.taps = rng.normal(0, 1 / np.sqrt(SIZE), (SIZE, TAPS * FILTERS)).astype(np.float32)
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.out = rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32)
        self.out_bias = np.float32(0)
        self.languages, self.shift, self.shifts = None, 0.0, {}
        self.forget()

    def forget(self) -> None:
        self.known, self.rows, self.again = Places(), np.zeros((1024, TAPS * FILTERS), np.float32), np.zeros(1024, bool)

    def forget_rare(self) -> None:
        """Only words that came again since the last time stay, unless they are too many."""
        stay = np.flatnonzero(self.again[: len(self.known)])
        if len(stay) > CACHE_WORDS // 2:
            return self.forget()
        words = list(self.known)
        self.known = Places((words[at], place) for place, at in enumerate(stay.tolist()))
        self.rows[: len(stay)] = self.rows[stay]
        self.again[:] = False

    def summed(self, tapped: np.ndarray):
        """Of every width with a position, its filters' columns and their sums over the taps, a row per filter."""
        lines, at = np.ascontiguousarray(tapped.T), 0
        for k, width in enumerate(WIDTHS):
            n = len(tapped) - width + 1
            if n > 0:
                total = lines[at: at + FILTERS, :n]
                for j in range(1, width):
                    total = total + lines[at + j * FILTERS: at + (j + 1) * FILTERS, j: n + j]
                yield slice(k * FILTERS, (k + 1) * FILTERS), total
            at += width * FILTERS

    def pooled(self, tapped: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Maximum over positions of every rectified filter, and its position, from the words' tap rows."""
        best = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        place = np.full(len(best), -1)
        for own, total in self.summed(tapped):
            top = total.argmax(axis=1)
            value = total[np.arange(FILTERS), top] + self.bias[own]
            best[own] = np.maximum(value, 0)
            place[own] = np.where(value > 0, top, -1)
        return best, place

    def peaks(self, tapped: np.ndarray) -> np.ndarray:
        """The values of ``pooled``, without the positions."""
        best = np.full(len(WIDTHS) * FILTERS, -np.inf, np.float32)
        for own, total in self.summed(tapped):
            best[own] = total.max(axis=1)
        return np.maximum(best + self.bias, 0)

    def word_rows(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) + len(words) > CACHE_WORDS:
            self.forget_rare()
        used = len(self.known)
        index = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        old = index < used
        self.again[index[old]] = True
        if len(self.known) > used:
            later = np.flatnonzero(~old)
            new = later[np.unique(index[later], return_index=True)[1]]
            while len(self.known) > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
                self.again = np.concatenate([self.again, np.zeros_like(self.again)])
            self.rows[used: len(self.known)] = self.embedded(features([words[at] for at in new.tolist()])) @ self.taps
        return index

    def embedded(self, slots: np.ndarray) -> np.ndarray:
        """The embeddings of words, sums over their slots."""
        total = self.embedding.take(slots[:, 0], axis=0)
        for column in range(1, slots.shape[1]):
            total += self.embedding.take(slots[:, column], axis=0)
        return total

    def logit(self, text: str | None) -> float:
        words = (text or "").lower().encode("utf-8").split()
        best = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        for at in range(0, len(words), PIECE):
            piece = words[at: at + PIECE + max(WIDTHS) - 1]
            index = self.word_rows(piece)
            best = np.maximum(best, self.peaks(self.rows.take(index, axis=0)))
        return float(best @ self.out + self.out_bias)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """The calibrated scores of whole texts, each by its predicted language."""
        whole = [t or "" for t in texts]
        cuts = [self.shifts.get(name, self.shift) for name in spoken(self.languages, whole)]
        z = np.array([self.logit(t) for t in whole]) - np.array(cuts)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def score(self, text: str | None) -> float:
        return float(self.scores([text])[0])

    def begin(self) -> None:
        """Nothing learnt yet: moments of the dense weights, squares of the embeddings' steps, steps taken."""
        self.moments = [(np.zeros_like(x), np.zeros_like(x)) for x in (self.taps, self.bias, self.out)]
        self.square, self.step = np.zeros(SLOTS, np.float32), 0

    def train(self, texts: list[str], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> None:
        self.begin()
        rng, documents = np.random.default_rng(seed), slots_of(texts)
        for _ in range(epochs):
            self.learn_from(documents, labels, labels.mean(), rng)
        self.forget()

    def learn_from(self, documents: list[np.ndarray], labels: np.ndarray, share_of_ones: float, rng) -> None:
        """Adam on the logistic loss, once over the documents' slots; embeddings get sparse steps, from the pooled positions alone."""
        dense, square, group = [self.taps, self.bias, self.out], self.square, 16
        weight = np.where(labels == 1, 0.5 / max(share_of_ones, 1e-6), 0.5 / max(1 - share_of_ones, 1e-6))
        # Every filter's taps: the filter, the place behind its position and its column.
        starts = np.cumsum([0, *WIDTHS[:-1]]) * FILTERS
        taps = np.array([(k * FILTERS + f, j, starts[k] + j * FILTERS + f)
                         for k, width in enumerate(WIDTHS) for f in range(FILTERS) for j in range(width)])
        order = rng.permutation(len(documents))
        for first in range(0, len(order), group):
            grads = [np.zeros_like(x) for x in dense]
            touched, moved = [], []
            for d in order[first: first + group]:
                words = documents[d]
                if len(words):
                    embedded = self.embedded(words)
                    best, place = self.pooled(embedded @ self.taps)
                else:
                    best, place = np.zeros(len(self.out), np.float32), np.full(len(self.out), -1)
                z = float(best @ self.out + self.out_bias)
                error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[d]) * weight[d] / group
                self.out_bias -= np.float32(RATE * error)
                grads[2] += error * best
                back = np.where(place >= 0, error * self.out, 0).astype(np.float32)
                grads[1] += back
                own, behind, column = taps[place[taps[:, 0]] >= 0].T
                if len(own):
                    at = place[own] + behind
                    grads[0][:, column] += (back[own][:, None] * embedded[at]).T
                    touched.append(words[at])
                    moved.append(back[own][:, None] * self.taps[:, column].T)
            self.step += 1
            for x, g, (m, v) in zip(dense, grads, self.moments):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                x -= RATE * (m / (1 - 0.9 ** self.step)) / (np.sqrt(v / (1 - 0.99 ** self.step)) + 1e-6)
            if touched:
                rows, g = np.concatenate(touched).ravel(), np.repeat(np.concatenate(moved), 1 + len(PREFIXES), axis=0)
                unique, inverse = np.unique(rows, return_inverse=True)
                total = np.zeros((len(unique), SIZE), np.float32)
                np.add.at(total, inverse, g)
                square[unique] += (total * total).mean(axis=1)
                self.embedding[unique] -= 0.1 * total / (np.sqrt(square[unique])[:, None] + 1e-6)

    def blocks(self) -> list[np.ndarray]:
        """The state in blocks that travel: embeddings with their squares, a row per slot, then all dense weights as one row."""
        table = np.column_stack([self.embedding, self.square])
        pairs = [x for pair in self.moments for x in pair]
        rest = np.concatenate([x.ravel() for x in (self.taps, self.bias, self.out, *pairs, np.array([self.out_bias, self.step], np.float32))])
        return [*(table[at: at + SLOT_BLOCK] for at in range(0, SLOTS, SLOT_BLOCK)), rest[None, :]]

    def restore(self, blocks: list[np.ndarray]) -> None:
        table, rest = np.concatenate(blocks[:-1]), blocks[-1][0].copy()
        self.embedding, self.square = np.ascontiguousarray(table[:, :SIZE]), table[:, SIZE].copy()
        parts, at = [], 0
        for x in (self.taps, self.bias, self.out, *[x for pair in self.moments for x in pair]):
            parts.append(rest[at: at + x.size].reshape(x.shape))
            at += x.size
        self.taps, self.bias, self.out = parts[:3]
        self.moments = list(zip(parts[3::2], parts[4::2]))
        self.out_bias, self.step = rest[at], int(round(float(rest[at + 1])))

    def calibrate(self, texts: list[str], labels: np.ndarray, languages=None) -> None:
        """Per predicted language the cut with the fewest errors, in the middle of the gap around it; few labels
        fall back to the cut of all. ``languages`` is a model of ``langid``."""
        z, kinds = np.array([self.logit(t) for t in texts]), np.array(spoken(languages, texts), object)
        self.calibrate_cells(kinds, z, z, np.array(labels, float), 1 - np.array(labels, float), languages)

    def calibrate_cells(self, kinds, low, high, ones, zeros, languages=None) -> None:
        """The same from cells: a language, the least and the greatest logit in it, and its documents of either label."""
        self.languages = languages
        offset = np.log(THRESHOLD / (1 - THRESHOLD))

        def cut(mask):
            order = np.argsort(low[mask], kind="stable")
            least, most, one, zero = (x[mask][order] for x in (low, high, ones, zeros))
            below = np.concatenate([[0], np.cumsum(one)])  # positives under each cut
            above = zero.sum() - np.concatenate([[0], np.cumsum(zero)])
            errors = below / max(one.sum(), 1) + above / max(zero.sum(), 1)
            edges = np.concatenate([[least[0] - 2], (least[1:] + most[:-1]) / 2, [most[-1] + 2]])
            best = np.flatnonzero(errors == errors.min())
            return float(edges[best[len(best) // 2]])

        self.shift = (cut(np.ones(len(low), bool)) if len(low) else 0.0) - offset
        self.shifts = {}
        for name in sorted(set(kinds.tolist()) - {None}):
            mine = kinds == name
            if min(ones[mine].sum(), zeros[mine].sum()) >= LEAST_LABELS:
                self.shifts[name] = cut(mine) - offset


def _held(doc_id) -> bool:
    return xxhash.xxh3_64_intdigest(str(doc_id)) % 5 == 0


def _labelled(docs: DataFrame, known: DataFrame, shares: int, every: bool) -> DataFrame:
    """The labelled documents, one file a share: the slots of those to learn from, the texts of those to calibrate by.

    Those are the fifth that training leaves out, or with ``every`` all of them.
    """
    schema = pa.schema([("sample_id", pa.int64()), ("sample_label", pa.int32()), ("slots", pa.binary()), ("sample_text", pa.string())])

    def run(batches):
        for batch in slices(batches):
            keys, labels, texts = (c.to_pylist() for c in batch.columns)
            held, texts = list(map(_held, keys)), [t or "" for t in texts]
            slots = [None if h else x.tobytes() for h, x in zip(held, slots_of(texts))]
            yield record_batch(schema, [keys, labels, slots, [t if h or every else None for h, t in zip(held, texts)]])

    met = docs.repartition(shares, "sample_id").join(known.repartition(shares, "sample_id"), "sample_id")
    return settle(met.select("sample_id", "sample_label", "sample_text").sortWithinPartitions("sample_id", "sample_text")
                  .mapInArrow(run, "sample_id long, sample_label int, slots binary, sample_text string"))


def _epoch(rows: DataFrame, network: Network, share_of_ones: float, epoch: int) -> None:
    """One pass of every share over its documents, from the same network; what they learnt is averaged."""
    before = network.blocks()
    schema = pa.schema([("block", pa.int32()), ("share", pa.int64()), ("n", pa.int64()), ("state", pa.binary())])

    def run(batches):
        mine, rng, share, n = None, None, None, 0
        documents, labels = [], []

        def mix():
            nonlocal n
            mine.learn_from(documents, np.array(labels, float), share_of_ones, rng)
            n += len(documents)
            documents.clear(), labels.clear()

        for batch in slices(batches):
            for key, label, slots in zip(*[c.to_pylist() for c in batch.columns]):
                if mine is None:
                    mine, share, rng = Network(), key, np.random.default_rng([11, epoch, key & 0xFFFFFFFF])
                    mine.begin()
                    mine.restore(before)
                documents.append(np.frombuffer(slots, np.uint16).reshape(-1, 1 + len(PREFIXES)))
                labels.append(label)
                if len(documents) == MIXED:
                    mix()
        if mine is not None:
            if documents:
                mix()
            for at, (old, new) in enumerate(zip(before, mine.blocks())):
                yield record_batch(schema, [[at], [share], [n], [(new - old).astype(np.float32).tobytes()]])

    def average(found: pa.Table) -> pa.Table:
        found = found.sort_by("share")
        at = found["block"][0].as_py()
        total, moved = np.zeros(before[at].shape), np.zeros((len(before[at]), 1))
        for n, state in zip(found["n"].to_pylist(), found["state"].to_pylist()):
            change = np.frombuffer(state, np.float32).reshape(before[at].shape)
            # a slot counts in the shares that moved it, dense weights in all by their documents
            weight = n if at == len(before) - 1 else (change != 0).any(axis=1, keepdims=True)
            total += change * weight
            moved += weight
        state = (before[at] + total / np.maximum(moved, 1)).astype(np.float32).tobytes()
        return pa.Table.from_arrays([pa.array([at], pa.int32()), pa.array([state], pa.binary())], names=["block", "state"])

    learning = rows.filter("slots IS NOT NULL").select("sample_id", "sample_label", "slots")
    merged = (learning.mapInArrow(run, "block int, share long, n long, state binary").groupBy("block")
              .applyInArrow(average, "block int, state binary").toArrow().sort_by("block"))
    for at, state in zip(merged["block"].to_pylist(), merged["state"].to_pylist()):
        before[at] = np.frombuffer(state, np.float32).reshape(before[at].shape)
    network.restore(before)


def _cells(rows: DataFrame, network: Network, languages) -> pa.Table:
    """Cells of the calibration over the documents with a text."""
    schema = pa.schema([("kind", pa.string()), ("label", pa.int32()), ("z", pa.float64())])

    def run(batches):
        for batch in slices(batches):
            labels, texts = (c.to_pylist() for c in batch.columns)
            yield record_batch(schema, [spoken(languages, texts), labels, [network.logit(t) for t in texts]])

    z = rows.filter("sample_text IS NOT NULL").select("sample_label", "sample_text").mapInArrow(run, "kind string, label int, z double")
    return z.groupBy("kind", F.floor(F.col("z") * CELLS).alias("cell")).agg(
        F.min("z").alias("low"), F.max("z").alias("high"), F.sum(F.col("label").cast("double")).alias("ones"),
        F.sum(1.0 - F.col("label")).alias("zeros")).toArrow()


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
          languages=None) -> Network | None:
    """A network from all labelled documents, calibrated by the languages that ``languages`` (a model of ``langid``)
    predicts; None unless both labels occur."""
    known = labels.groupBy(F.col(doc_id).cast("long").alias("sample_id")).agg(F.max(label).cast("int").alias("sample_label")).filter(
        "sample_label IS NOT NULL AND sample_id IS NOT NULL")
    shares = min(SHARES, max(1, -(-known.count() // SHARE)))
    texts = docs.select(F.col(doc_id).cast("long").alias("sample_id"), F.col(text).alias("sample_text"))
    rows = _labelled(texts, known, shares, False)
    n, ones = rows.agg(F.count("*"), F.sum("sample_label")).first()
    if not n or not 0 < ones < n:
        return None
    network = Network()
    network.begin()
    for epoch in range(EPOCHS):
        _epoch(rows, network, ones / n, epoch)
    cells = _cells(rows, network, languages)
    if not all(sum(cells[c].to_pylist()) for c in ("ones", "zeros")):
        cells = _cells(_labelled(texts, known, shares, True), network, languages)
    low, high, one, zero = (np.array(cells[c].to_pylist(), float) for c in ("low", "high", "ones", "zeros"))
    network.calibrate_cells(np.array(cells["kind"].to_pylist(), object), low, high, one, zero, languages)
    network.forget()
    del network.moments, network.square
    return network


def with_scores(docs: DataFrame, network: Network | None, text: str = "text", score: str = "score", keep_text: bool = False) -> DataFrame:
    """``docs`` with the score of its whole texts, without its text unless that is asked for."""
    kept = [c for c in docs.columns if (keep_text or c != text) and c != score]
    schema = docs.select(*[F.col(f"`{c}`") for c in kept]).withColumn(score, F.lit(0.0)).schema

    def run(batches):
        for batch in slices(batches):
            place = batch.schema.get_field_index
            texts = batch.column(place(text)).to_pylist()
            found = network.scores(texts) if network else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([*(batch.column(place(c)) for c in kept), pa.array(found, pa.float64())], names=[*kept, score])

    return docs.mapInArrow(run, schema)


def model_for(spark, sf_dir: str) -> Network | None:
    """The network of the registered query: fold 1 of 3 is held out, from labels and from the languages learnt."""
    seen = fold(F.col("doc_id"), 3) != 1
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(seen)
    docs = table(spark, sf_dir, "documents")
    languages = langid.learn(docs.select("doc_id", "text", "lang").filter(seen))
    return learn(docs.select("doc_id", "text").filter(seen), labels, languages=languages)


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "text")
    scored = with_scores(docs, model_for(spark, sf_dir))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
