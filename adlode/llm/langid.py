"""Language identification by a blended-spectrum string kernel.

A window of text is the set of its 1- to 3-grams of code points (hashed); the kernel of two
windows is the size of their common set over the root of the product of their sizes. Landmark
windows give the Nystroem approximation of the kernel, in which one ridge regression per
language against the rest is solved. A batch of windows is scored by matrix products: presence
times landmarks, then times coefficients. A document's scores are the means of its windows'
scores, weighted by the grams they hold, so whole texts count, however long.

The classifier is fitted on a bounded sample: SAMPLE documents, about equally many of each
language, and up to SAMPLE_WINDOWS windows of each, evenly spaced.

Defined results: NULL texts and texts without a letter are ``und`` with score 0; so is every
text if there is nothing to learn from; repeated rows score alike; ties go to the language
first in order.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlode.llm.common import balanced_sample, fold, record_batch, slices, table

WINDOW, GRAMS = 640, 3
SAMPLE, SAMPLE_WINDOWS, LANDMARKS, RIDGE = 1200, 3, 128, 1e-2
SLOT_BITS = 18
#: Windows scored by one matrix product, windows whose grams are found at a time (their numbers stay in the processor's
#: cache), and the slope of the final scores.
BLOCK, STRIP, SLOPE = 256, 16, 4.0
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def windows(text: str) -> np.ndarray:
    """A text's code points, lower case, as rows of WINDOW, filled with zeros."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    rows = -(-len(codes) // WINDOW)
    out = np.zeros((rows, WINDOW), np.uint32)
    out.ravel()[: len(codes)] = codes
    return out


def gram_slots(rows: np.ndarray):
    """Slots of all grams inside each row, and which of them are real (no filling), length by length."""
    codes = rows.astype(np.uint64)
    total = np.zeros_like(codes)
    for n in range(GRAMS):
        last = codes[:, n:]
        total = total[:, : last.shape[1]] * np.uint64(0xFF51AFD7ED558CCD)
        total += last * MULTIPLIERS[n]
        total += np.uint64(n)
        mixed = total >> np.uint64(31)
        mixed ^= total
        mixed *= MULTIPLIERS[0]
        mixed >>= np.uint64(64 - SLOT_BITS)
        yield mixed.view(np.int64), last != 0


class Kernel:
    """Scores of windows: presence over the landmarks' grams, kernel to the landmarks, ridge coefficients."""

    def __init__(self, landmarks: np.ndarray):
        used = np.unique(np.concatenate([slots[real] for slots, real in gram_slots(landmarks)]))
        self.place = np.full(1 << SLOT_BITS, len(used), np.int32)
        self.place[used] = np.arange(len(used))
        self.width = len(used)
        self.landmarks, self.coefficients = None, None
        present, sizes = self.presence(landmarks)
        self.landmarks = np.ascontiguousarray((present / np.sqrt(np.maximum(sizes, 1))[:, None]).T)

    def presence(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        flags = np.zeros((len(rows), self.width + 1), np.float32)
        cells, starts = flags.reshape(-1), np.arange(len(rows))[:, None] * (self.width + 1)
        for first in range(0, len(rows), STRIP):
            for slots, real in gram_slots(rows[first: first + STRIP]):
                at = self.place.take(slots)
                at[~real] = self.width
                cells[at + starts[first: first + STRIP]] = 1
        flags = flags[:, : self.width]
        return flags, flags.sum(axis=1)

    def to_landmarks(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        blocks = [self.presence(rows[at: at + BLOCK]) for at in range(0, len(rows), BLOCK)]
        kernels = [present @ self.landmarks / np.sqrt(np.maximum(sizes, 1))[:, None] for present, sizes in blocks]
        if not blocks:
            return np.zeros((0, self.landmarks.shape[1]), np.float32), np.zeros(0, np.float32)
        return np.concatenate(kernels), np.concatenate([sizes for _, sizes in blocks])

    def fit(self, rows: np.ndarray, targets: np.ndarray, weights: np.ndarray) -> None:
        """Ridge regressions of ``targets`` (+1/-1 by language) in the Nystroem features."""
        gram = self.landmarks.T.astype(float) @ self.landmarks
        values, vectors = np.linalg.eigh(gram)
        good = values > 1e-6 * values.max()
        half = vectors[:, good] / np.sqrt(values[good])
        x = np.column_stack([self.to_landmarks(rows)[0] @ half, np.ones(len(rows))])
        left = x.T @ (x * weights[:, None]) + RIDGE * np.eye(x.shape[1])
        solved = np.linalg.solve(left, x.T @ (targets * weights[:, None]))
        self.coefficients = np.vstack([half @ solved[:-1], solved[-1:]]).astype(np.float32)

    def scores(self, texts: list[str]) -> np.ndarray:
        """One row of scores per text."""
        out = np.zeros((len(texts), self.coefficients.shape[1]))
        weight, held, held_rows = np.zeros(len(texts)), [], 0

        def settle_held():
            owner = np.concatenate([np.full(len(r), i) for i, r in held])
            kernel, sizes = self.to_landmarks(np.concatenate([r for _, r in held]))
            found = (kernel @ self.coefficients[:-1] + self.coefficients[-1]) * sizes[:, None]
            np.add.at(out, owner, found)
            np.add.at(weight, owner, sizes)

        for i, text in enumerate(texts):
            rows = windows(text)
            for at in range(0, len(rows), BLOCK):
                held.append((i, rows[at: at + BLOCK]))
                held_rows += len(held[-1][1])
                if held_rows >= BLOCK:
                    settle_held()
                    held, held_rows = [], 0
        if held_rows:
            settle_held()
        unseen = weight == 0
        out[unseen] = self.coefficients[-1]
        return out / np.where(unseen, 1, weight)[:, None]


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE):
    """(kernel, languages) from the documents with a language; None without any."""
    named = docs.select(F.col(doc_id).alias("sample_id"), F.col(lang).cast("string").alias("sample_lang"),
                        F.col(text).alias("sample_text")).filter("sample_lang IS NOT NULL AND sample_id IS NOT NULL")
    chosen = balanced_sample(named.select("sample_id", "sample_lang"), "sample_lang", "sample_id", sample, "langid")
    schema = pa.schema([("sample_id", pa.int64()), ("lang", pa.string()), ("codes", pa.binary())])

    def some(batches):
        for batch in slices(batches):
            found = []
            for key, name, whole in zip(*[c.to_pylist() for c in batch.columns]):
                rows = windows(whole or "")
                for at in sorted({k * len(rows) // SAMPLE_WINDOWS for k in range(SAMPLE_WINDOWS)} if len(rows) else ()):
                    found.append((key, name, rows[at].tobytes()))
            if found:
                yield record_batch(schema, [list(c) for c in zip(*found)])

    # At most ``sample`` ids: a bounded broadcast.
    picked = named.join(F.broadcast(chosen.select("sample_id").distinct()), "sample_id", "left_semi")
    rows = picked.select("sample_id", "sample_lang", "sample_text").mapInArrow(some, "sample_id long, lang string, codes binary").toArrow()
    rows = rows.sort_by([("sample_id", "ascending"), ("lang", "ascending"), ("codes", "ascending")])
    if not rows.num_rows:
        return None
    codes = np.frombuffer(b"".join(rows["codes"].to_pylist()), np.uint32).reshape(-1, WINDOW)
    names = np.array(rows["lang"].to_pylist())
    languages = sorted(set(names.tolist()))
    counts = {name: int((names == name).sum()) for name in languages}
    each = max(1, LANDMARKS // len(languages))
    marks = np.concatenate([np.flatnonzero(names == name)[:: max(1, counts[name] // each)][:each] for name in languages])
    kernel = Kernel(codes[np.sort(marks)])
    targets = np.where(names[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    kernel.fit(codes, targets, np.array([len(names) / len(languages) / counts[n] for n in names]))
    return kernel, languages


def identify(docs: DataFrame, model, text: str = "text", lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` without its text, with the predicted language and its score."""
    kept = [c for c in docs.columns if c != text and c not in (lang_pred, score)]
    schema = docs.select(*[F.col(f"`{c}`") for c in kept]).withColumns({lang_pred: F.lit(""), score: F.lit(0.0)}).schema

    def run(batches):
        for batch in slices(batches, 256):
            place = batch.schema.get_field_index
            texts = [t or "" for t in batch.column(place(text)).to_pylist()]
            lettered = [any(map(str.isalpha, t)) for t in texts]
            names, scores = ["und"] * len(texts), np.zeros(len(texts))
            if model and any(lettered):
                kernel, languages = model
                which = np.flatnonzero(lettered)
                found = kernel.scores([texts[i] for i in which])
                best = found.argmax(axis=1)
                raised = np.exp(SLOPE * (found - found.max(axis=1, keepdims=True)))
                scores[which] = 1 / raised.sum(axis=1)
                for i, b in zip(which, best):
                    names[i] = languages[b]
            yield pa.RecordBatch.from_arrays([*(batch.column(place(c)) for c in kept), pa.array(names, pa.string()), pa.array(scores)],
                                             names=[*kept, lang_pred, score])

    return docs.mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = learn(docs.filter(~held_out))
    return identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
