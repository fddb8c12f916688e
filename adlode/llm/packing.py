"""Packing token sequences into windows by non-negative least squares.

Every document's ids, with an end id, are cut into whole windows and a remainder. The remainders
are counted by length, in units of UNIT ids rounded down. All combinations of at most DEPTH units'
lengths that fill a window are enumerated; non-negative least squares finds how often each is to be
repeated so that together they use the counts up, and the repeats are rounded down to what the
counts can serve. A combination's remainders stand behind one another in one window; as lengths
were rounded down they fill it, and what the last one has too much goes back. Remainders that no
combination takes and these ends are the residual: laid end to end in one line and cut at every
window; what follows the last whole window is cut into powers of two, which need no padding.

Texts are encoded once, ids are written, and only remainders of the residual and those that are
cut travel with their ids through a shuffle. The driver holds one count per unit and the plan. A
remainder's number within its unit is its number in its task plus the counts of the tasks before,
and so are places in the residual line, so no group of equal lengths, however large, meets in one task.

Defined results: a NULL or empty text is the end id alone; rows without an id and rows of equal id
are documents of their own; documents of any length are packed whole; an empty table gives no
pieces. Further columns of the input are left out.
"""

import itertools
import json
import os
import re
import unicodedata
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from adlode.llm.bpe import byte_letters
from adlode.llm.common import slices, table
from adlode.llm.records import vocabulary
from adlode.session import settle

WINDOW, UNIT, DEPTH, END_ID = 2048, 16, 4, 1
#: The pre-tokenizer's pattern, a fixed value of the vocabulary's format.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Units of the rows that count windows, and of remainders of no ids.
WINDOWS, NONE = -2, -1


def settled_characters() -> str:
    """The inside of a character class: what is a letter, a number, white space or none of them in Unicode 3.2
    and still is so today, up to the last plane that holds letters."""
    def kind(known, c: str) -> str:
        first = known.category(c)[0]
        return first if first in "LN" else "Z" if c.isspace() else ""

    ranges: list[list[int]] = []
    for n in range(0x30000):
        if not 0xD800 <= n < 0xE000 and kind(unicodedata.ucd_3_2_0, chr(n)) == kind(unicodedata, chr(n)):
            if ranges and ranges[-1][1] == n - 1:
                ranges[-1][1] = n
            else:
                ranges.append([n, n])
    return "".join(f"\\U{first:08x}-\\U{last:08x}" for first, last in ranges)


class ByteLevelEncoder:
    """Ids of texts under a byte-level vocabulary, as packed numbers.

    The ids are those of the tokenizers library. Another public library applies the same merges,
    given as ranks, several times faster, but classes characters by another version of Unicode; it
    gets the texts whose characters all versions class alike, if they hold no special tokens. The others
    go to the tokenizers library itself.
    """

    def __init__(self, definition: str):
        # A task has one core: threads of the library would take the cores of other tasks.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec, letters = json.loads(definition), byte_letters()
        special = {token["content"]: token["id"] for token in spec["added_tokens"]}
        vocab = {token: n for token, n in spec["model"]["vocab"].items() if token not in special}
        ranks = {bytes(letters[c] for c in token): n for token, n in vocab.items()}
        merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
        if merged != sorted(merged) or len(vocab) != 256 + len(merged):
            raise ValueError("the ids of this vocabulary do not rank its merges")
        self.fast = tiktoken.Encoding("byte_level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.kind = id_kind(max([*vocab.values(), *special.values()]))
        self.special = list(special)
        self.unsettled = re.compile(f"[^{settled_characters()}]")

    def odd(self, text: str) -> bool:
        return self.unsettled.search(text) is not None or any(token in text for token in self.special)

    def __call__(self, texts: list[str]) -> list[bytes]:
        odd = [i for i, text in enumerate(texts) if self.odd(text)]
        coded = dict(zip(odd, (e.ids for e in self.tokenizer.encode_batch_fast([texts[i] for i in odd], add_special_tokens=False))))
        return [np.array(coded[i] if i in coded else self.fast.encode_ordinary(text), self.kind).tobytes()
                for i, text in enumerate(texts)]


@lru_cache(maxsize=1)
def encoder_of(definition: str) -> ByteLevelEncoder:
    """The encoder that a Python worker keeps over its tasks."""
    return ByteLevelEncoder(definition)


def id_kind(largest: int) -> str:
    return "<u2" if largest < 1 << 16 else "<u4"


def with_ids(docs: DataFrame, definition: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID, window: int = WINDOW,
             unit: int = UNIT) -> DataFrame:
    """doc_id, ids (packed), n_ids, and each document's place: its task, its number there, how many whole
    windows came before it there, its remainder's unit and how many of that unit came before."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    names = ["doc_id", "ids", "n_ids", "part", "place", "windows_before", "unit", "unit_before"]
    schema = rows.select("doc_id").schema.add("ids", "binary").add("n_ids", "long").add("part", "integer")
    for name in names[4:]:
        schema = schema.add(name, "long")

    def run(batches):
        encoder = encoder_of(definition)
        end, width = np.array([end_id], encoder.kind).tobytes(), int(encoder.kind[-1])
        place = windows = 0
        seen: dict[int, int] = {}
        for batch in slices(batches, 256):
            coded = [raw + end for raw in encoder([t or "" for t in batch.column(1).to_pylist()])]
            n_ids = [len(raw) // width for raw in coded]
            before, units, unit_before = [], [], []
            for n in n_ids:
                kind = n % window // unit if n % window else NONE
                before.append(windows)
                units.append(kind)
                unit_before.append(seen.get(kind, 0))
                windows += n // window
                seen[kind] = unit_before[-1] + 1
            n = len(coded)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(coded, pa.binary()), pa.array(n_ids, pa.int64()),
                 pa.array(np.full(n, TaskContext.get().partitionId()), pa.int32()),
                 *[pa.array(x, pa.int64()) for x in (range(place, place + n), before, units, unit_before)]], names=names)
            place += n

    return rows.mapInArrow(run, schema)


def combinations(units: int, depth: int = DEPTH) -> np.ndarray:
    """All falling rows of at most ``depth`` unit lengths of at least 1 whose sum is ``units``, filled up with ``units + 1``."""
    found = []

    def extend(row: list[int], left: int, most: int) -> None:
        if left == 0:
            found.append(row + [units + 1] * (depth - len(row)))
        elif len(row) < depth:
            for part in range(min(most, left), -(-left // (depth - len(row))) - 1, -1):
                extend([*row, part], left - part, part)

    extend([], units, units - 1)
    return np.array(found, np.int64).reshape(-1, depth)


def solve(columns: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Non-negative repeats x of the columns (lists of row numbers; a number past the end is none) with the
    least squared distance of their rows' sums to ``counts``: an active-set method, one column at a time."""
    rows, x = len(counts), np.zeros(len(columns))
    usable = (np.append(counts, [1, 1])[columns] > 0).all(axis=1)
    used: list[int] = []
    matrix = np.zeros((rows, 0))
    residual = counts.astype(float)
    tolerance = 1e-9 * max(1.0, float(counts.max(initial=0)))
    for _ in range(3 * rows):
        gradient = np.where(usable, np.append(residual, [0.0, 0.0])[columns].sum(axis=1), -1.0)
        gradient[used] = -1.0
        best = int(np.argmax(gradient))
        if gradient[best] <= tolerance:
            break
        used.append(best)
        matrix = np.column_stack([matrix, np.bincount(columns[best], minlength=rows + 2)[:rows]])
        while used:
            wanted = np.linalg.lstsq(matrix, counts.astype(float), rcond=None)[0]
            if wanted.min() > 0:
                x[used] = wanted
                break
            now = x[used]
            down = np.flatnonzero(wanted <= 0)
            step = np.min(now[down] / np.maximum(now[down] - wanted[down], 1e-300))
            now = now + step * (wanted - now)
            keep = now > 1e-12
            keep[down[np.argmin(now[down])]] = False
            x[used] = np.where(keep, now, 0.0)
            used, matrix = [u for u, k in zip(used, keep) if k], matrix[:, keep]
        residual = counts - matrix @ x[used]
    return x


class Plan:
    """Which sequence and place the remainders of each unit take, by their number within the unit."""

    def __init__(self, counts: np.ndarray, first: int, window: int = WINDOW, unit: int = UNIT, depth: int = DEPTH):
        units = window // unit
        columns = combinations(units, depth)
        repeats = solve(columns, counts)
        self.first, self.sequences = first, 0
        slots: dict[int, list[tuple[int, int, int, bool]]] = {}
        taken = np.zeros(units + 2, np.int64)
        free = np.append(counts, [np.iinfo(np.int64).max // 2] * 2)
        for column in np.argsort(-repeats, kind="stable"):
            times = int(repeats[column] + 1e-6)
            if times == 0:
                break
            parts = [int(p) for p in columns[column] if p <= units]
            for part, n in itertools.groupby(parts):
                times = min(times, int(free[part] - taken[part]) // len(list(n)))
            if times <= 0:
                continue
            # Last comes the shortest that is longer than all that rounding down can have hidden.
            last = min(p for p in parts if p * unit > depth * (unit - 1))
            parts.remove(last)
            for position, part in enumerate([*parts, last]):
                slots.setdefault(part, []).append((int(taken[part]), first + self.sequences, position, position == len(parts)))
                taken[part] += times
            self.sequences += times
        self.taken = {int(p): int(taken[p]) for p in slots}
        self.slots = {p: tuple(zip(*rows)) for p, rows in slots.items()}

    def seat(self, unit: int, number: int) -> tuple[int, int, bool] | None:
        """(sequence, position, last) of a remainder, or None if it belongs to the residual."""
        if number >= self.taken.get(unit, 0):
            return None
        starts, sequences, positions, last = self.slots[unit]
        at = int(np.searchsorted(starts, number, "right")) - 1
        return sequences[at] + number - starts[at], positions[at], last[at]


def _before(sizes: DataFrame, n: str, out: str, *keys: str) -> DataFrame:
    """The sum of ``n`` over the parts before, one row per part (and key): windows over tables of that size."""
    over = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn(out, F.coalesce(F.sum(n).over(over), F.lit(0)))


PIECE = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
WINDOW_PIECE, SEATED, LAST, REST = 0, 1, 2, 3


def _schema(rows: DataFrame, *more: tuple[str, str]):
    schema = rows.select("doc_id").schema
    for name in PIECE[1:]:
        schema = schema.add(name, "long")
    for name, kind in more:
        schema = schema.add(name, kind)
    return schema


def _crc(raw: bytes, kind: str, first: int, n: int) -> int:
    return zlib.crc32(np.frombuffer(raw, kind)[first: first + n].astype("<u4").tobytes())


def _typed(batch_ids: pa.Array, take: list[int], columns: list[list], schema) -> pa.RecordBatch:
    fields = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays(
        [batch_ids.take(pa.array(take, pa.int64())), *[pa.array(c, f.type) for c, f in zip(columns, list(fields)[1:])]], names=fields.names)


def seated(coded: DataFrame, offsets: DataFrame, plan: Plan, kind: str, window: int = WINDOW) -> DataFrame:
    """Whole windows as pieces, and every remainder with its sequence and position or as part of the residual."""
    schema = _schema(coded, ("role", "integer"), ("position", "integer"), ("part", "integer"), ("place", "long"), ("ids", "binary"))

    def run(batches):
        width = int(kind[-1])
        for batch in slices(batches, 256):
            rows, take = [], []
            for i, (raw, n, part, place, windows, unit, number) in enumerate(zip(*[c.to_pylist() for c in batch.columns[1:]])):
                whole = n // window
                for k in range(whole):
                    rows.append((k * window, window, _crc(raw, kind, k * window, window), n, windows + k, 0,
                                 WINDOW_PIECE, 0, part, place, None))
                if unit != NONE:
                    at, length = whole * window, n % window
                    seat = plan.seat(unit, number)
                    if seat is None:
                        rows.append((at, length, None, n, None, None, REST, 0, part, place, raw[at * width:]))
                    elif seat[2]:
                        rows.append((at, length, None, n, seat[0], None, LAST, seat[1], part, place, raw[at * width:]))
                    else:
                        rows.append((at, length, _crc(raw, kind, at, length), n, seat[0], None, SEATED, seat[1], part, place, None))
                take += [i] * (len(rows) - len(take))
            if rows:
                yield _typed(batch.column(0), take, list(zip(*rows)), schema)

    before = lambda key: F.element_at("before", key)
    joined = coded.join(offsets, "part").select(
        "doc_id", "ids", "n_ids", "part", "place", F.col("windows_before") + before(F.lit(WINDOWS).cast("long")), "unit",
        F.col("unit_before") + before(F.col("unit")))
    return joined.mapInArrow(run, schema)


def closed(rows: DataFrame, kind: str, window: int = WINDOW) -> DataFrame:
    """Seated remainders with their offsets; the last of a sequence is cut at the window's end, the rest of it returns to the residual."""
    schema = rows.schema
    before = Window.partitionBy("sequence_id").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))

    def run(batches):
        width = int(kind[-1])
        for batch in slices(batches, 1024):
            out, take = [], []
            for i, row in enumerate(zip(*[c.to_pylist() for c in batch.columns[1:]])):
                start, length, crc, n, sequence, offset, role, position, part, place, raw = row
                if role == LAST:
                    keep = min(length, window - offset)
                    out.append((start, keep, _crc(raw, kind, 0, keep), n, sequence, offset, SEATED, position, part, place, None))
                    take.append(i)
                    if keep < length:
                        out.append((start + keep, length - keep, None, n, None, None, REST, 0, part, place, raw[keep * width:]))
                        take.append(i)
                else:
                    out.append((start, length, crc, n, sequence, offset, SEATED, position, part, place, None))
                    take.append(i)
            if out:
                yield _typed(batch.column(0), take, list(zip(*out)), schema)

    return placed.mapInArrow(run, schema)


def line_ends(total: int, window: int = WINDOW) -> list[int]:
    """The ends of the sequences behind the last whole window of a line of ``total`` ids: powers of two, falling."""
    ends, at = [], total - total % window
    for bit in reversed(range(window.bit_length())):
        if (total - at) >> bit & 1:
            at += 1 << bit
            ends.append(at)
    return ends


def cut(residual: DataFrame, first: int, kind: str, window: int = WINDOW) -> DataFrame:
    """Pieces of the residual, laid end to end in the order of its places and cut at every window."""
    sums = settle(residual.groupBy("part").agg(F.sum("length").alias("n")))
    total = sums.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    ends, whole = line_ends(total, window), total // window
    over = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("line_before") + F.coalesce(F.sum("length").over(over), F.lit(0))
    rows = (residual.join(settle(_before(sums, "n", "line_before").select("part", "line_before")), "part")
            .select("doc_id", "start", "length", "doc_tokens", "ids", at.alias("at")))
    schema = _schema(residual)

    def run(batches):
        for batch in slices(batches, 256):
            out, take = [], []
            for i, (start, length, n, raw, at) in enumerate(zip(*[c.to_pylist() for c in batch.columns[1:]])):
                done = 0
                while done < length:
                    here = at + done
                    sequence = here // window
                    opens, closes = sequence * window, (sequence + 1) * window
                    if sequence >= whole:
                        behind = int(np.searchsorted(ends, here, "right"))
                        opens = ends[behind - 1] if behind else whole * window
                        sequence, closes = whole + behind, ends[behind]
                    size = min(length - done, closes - here)
                    out.append((start + done, size, _crc(raw, kind, done, size), n, first + sequence, here - opens))
                    take.append(i)
                    done += size
            if out:
                yield _typed(batch.column(0), take, list(zip(*out)), schema)

    return rows.mapInArrow(run, schema)


def pack(docs: DataFrame, definition: str, window: int = WINDOW, unit: int = UNIT, depth: int = DEPTH, **options) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row per piece of a document in a sequence."""
    spec = json.loads(definition)
    kind = id_kind(max(itertools.chain(spec["model"]["vocab"].values(), [t["id"] for t in spec["added_tokens"]])))
    coded = settle(with_ids(docs, definition, window=window, unit=unit, **options))
    windows = coded.groupBy("part").agg(F.sum(F.floor(F.col("n_ids") / window)).alias("n")).withColumn("unit", F.lit(WINDOWS).cast("long"))
    sizes = settle(coded.groupBy("part", "unit").agg(F.count("*").alias("n")).unionByName(windows))
    offsets = settle(_before(sizes, "n", "before", "unit").groupBy("part")
                     .agg(F.map_from_entries(F.collect_list(F.struct("unit", "before"))).alias("before")))
    counts, n_windows = np.zeros(window // unit, np.int64), 0
    for number, n in sizes.groupBy("unit").agg(F.sum("n")).collect():  # one row per unit
        if number == WINDOWS:
            n_windows = n
        elif number > 0:
            counts[number] = n
    plan = Plan(counts, n_windows, window, unit, depth)
    rows = settle(seated(coded, offsets, plan, kind, window))
    full = settle(closed(rows.filter(F.col("role").isin(SEATED, LAST)), kind, window))
    residual = rows.filter(F.col("role") == REST).unionByName(full.filter(F.col("role") == REST))
    pieces = [rows.filter(F.col("role") == WINDOW_PIECE), full.filter(F.col("role") == SEATED),
              cut(residual, n_windows + plan.sequences, kind, window)]
    out = pieces[0].select(*PIECE)
    for more in pieces[1:]:
        out = out.unionByName(more.select(*PIECE))
    return out


def query(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary("byte_bpe_50k.json"))
