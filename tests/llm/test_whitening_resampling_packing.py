import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from adlode.llm import importance, packing, records, whitening
from adlode.llm.common import table
from tests.conftest import SMALL

ODD = ["", None, " ", "a", "a  b\n\nc ", "don't 'll!!'s", "é 　中文 <|endoftext|>x", "İ!? ǅ ՘", "x" * 4000, "\x1c\x85 \t\r\n", "Zé9 zé9 ÉÉ _a_"]


# Whitening

SHAPES = {
    "normal": lambda r: r.normal(size=(400, 24)), "few rows": lambda r: r.normal(size=(5, 24)),
    "graded": lambda r: r.normal(size=(300, 24)) * np.logspace(0, -7, 24), "one column": lambda r: r.normal(size=(30, 1)),
    "equal values": lambda r: np.linalg.qr(r.normal(size=(60, 12)))[0], "identity": lambda r: np.eye(9),
    "close values": lambda r: (np.linalg.qr(r.normal(size=(60, 6)))[0] * [3, 3 * (1 + 1e-11), 3 * (1 - 1e-9), 1, 1, 1]) @ np.linalg.qr(r.normal(size=(6, 6)))[0],
    "zero columns": lambda r: np.hstack([r.normal(size=(40, 3)), np.zeros((40, 4))]),
    "equal columns": lambda r: r.normal(size=(40, 3))[:, [0, 1, 1, 2]],
}


@pytest.mark.parametrize("shape", SHAPES)
def test_directions_are_singular_vectors(shape):
    a = SHAPES[shape](np.random.default_rng(1))
    r = np.linalg.qr(a, mode="r")
    values, basis = whitening.directions(r, 6)
    true = np.linalg.svd(a, compute_uv=False)
    diagonal, upper, _ = whitening.bidiagonal(r)
    every = whitening.dqds(diagonal, upper)
    assert len(every) == a.shape[1] and np.allclose(every[: len(true)], true, atol=1e-13 * true[0])
    assert len(values) == min(6, int((true > 1e-12 * true[0]).sum())) and np.allclose(values, true[: len(values)], rtol=1e-10)
    assert np.allclose(basis.T @ basis, np.eye(len(values)), atol=1e-10)
    assert np.allclose(a.T @ (a @ basis), basis * values ** 2, atol=1e-12 * true[0] ** 2)


def test_dqds_keeps_the_digits_of_small_values():
    """A bidiagonal matrix with a determinant known exactly: the product of its values is that of its diagonal."""
    diagonal, upper = np.array([1.0, 1e-4, 1e-8, 1e-3]), np.array([1.0, 1.0, 1.0])
    assert math.isclose(math.prod(whitening.dqds(diagonal, upper)), math.prod(diagonal), rel_tol=1e-12)


def plain_whitening(rows):
    usable = [(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    size = max(len(x) for _, x in usable)
    usable = [(i, x + (0,) * (size - len(x))) for i, x in usable]
    fit = sorted({x for _, x in usable})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array(fit, float) - np.array(sums) / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    return usable, n, sums, e[::-1], v[:, ::-1]


def test_whitening_equals_plain_numpy(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(300, 7)) @ rng.normal(size=(7, 7)))]
    rows += [(7, rows[7][1]), (None, rows[9][1]), (400, None), (401, [1.0, None]), (402, [float("nan")] * 7), (403, [float("inf")] * 7), (404, [1.0]), (405, [])]
    df = spark.createDataFrame([(*r, 1.5) for r in rows], "vec_id long, embedding array<double>, whitened double")
    found = defaultdict(list)
    for r in whitening.whiten(df.repartition(5)).collect():
        found[r.vec_id].append(r)
    usable, n, sums, e, v = plain_whitening(rows)
    assert {k: len(x) for k, x in found.items()} == {k: 4 * m for k, m in Counter(i for i, _ in usable).items()}
    signs = {}
    for i, x in usable:
        for r in found[i]:
            c = r.component - 1
            expected = (np.array(x) - np.array(sums) / n) @ v[:, c] / math.sqrt(e[c])
            sign = signs.setdefault(c, math.copysign(1, r.whitened * expected))
            assert abs(sign * r.whitened - expected) < 1e-9 and r.n == n
            assert r.deviation == sum((n * a - s) ** 2 for a, s in zip(x, sums))
            assert math.isclose(r.explained, e[c] / e.sum(), rel_tol=1e-9) and r.identity_error < 1e-9


def test_whitening_of_little_or_huge_input(spark):
    schema = "vec_id long, embedding array<double>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [3.0]), (2, [3.0]), (3, [3.0])], [(1, [])]):
        assert whitening.whiten(spark.createDataFrame(rows, schema)).collect() == []
    flat = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i, 1.0]) for i in range(9)], schema)).collect()
    assert len(flat) == 9 and {r.component for r in flat} == {1}
    huge = whitening.whiten(spark.createDataFrame([(i, [(-1.0) ** i * 10.0 ** (12 + i), float(i), 1e300]) for i in range(8)], schema)).collect()
    assert {r.vec_id for r in huge} == set(range(8)) and any(r.deviation is None for r in huge) and all(math.isfinite(r.whitened) for r in huge)


def test_whitening_in_a_tree_of_triangles(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.random.default_rng(6).normal(size=(200, 5)))]
    fit = whitening.integer_rows(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).select("x").repartition(7)
    n, sums = whitening.column_sums(fit, 5)
    r = whitening.triangle(fit, whitening.Centre(n, sums), 5)
    x = np.array([[math.floor(256 * c) for c in v] for _, v in rows], float)
    x -= x.mean(axis=0)
    assert np.allclose(r.T @ r, x.T @ x, rtol=1e-9) and n == 200


# Resampling

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text, max_run=1):
    words = WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return len(words), [" ".join(words[i: i + n]) for n in range(1, max_run + 1) for i in range(len(words) - n + 1)]


@pytest.mark.parametrize("max_run", [1, 3])
def test_resampling_equals_a_plain_count(spark, max_run):
    texts = [*ODD, *[r.text for r in table(spark, SMALL, "documents").select("text").limit(60).collect()]]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, texts[20], "x"), (3, "A", "y"), (3, "A", "y"), (12, texts[12], "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    target = table(spark, SMALL, "benchmark").select("text")
    buckets = 500
    number = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(number(f) for _, t, _ in rows for f in plain_features(t, max_run)[1])
    t = Counter(number(f) for r in target.collect() for f in plain_features(r.text, max_run)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    expected = []
    for i, text, _ in rows:
        n, features = plain_features(text, max_run)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[number(f)] for f in features)
        expected.append((i, n, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))))
    order = sorted((x for x in expected if x[1] >= 20), key=lambda x: (-x[4], -1 if x[0] is None else x[0]))
    drawn = Counter((*x, n if n <= 40 * len(order) // 100 else None) for n, x in enumerate(order, 1))
    drawn += Counter((*x, None) for x in expected if x[1] < 20)
    found = importance.resample(docs.repartition(5), target, share_percent=40, max_run=max_run, buckets=buckets).collect()
    assert Counter(map(tuple, found)) == drawn


def test_resampling_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    nothing = docs.limit(0)
    assert importance.resample(nothing, docs.select("text")).count() == 0
    found = {r.doc_id: r for r in importance.resample(docs, nothing.select("text"), min_words=1, share_percent=100).collect()}
    assert found[1].rank == 1 and found[2].rank is None and found[2].weight == 0


def test_places_of_rows_that_nothing_tells_apart(spark):
    rows = spark.range(0, 400, 1, 4).selectExpr("0L as a", "'s' as range_part")
    found = importance.ranked(rows, [F.col("a").desc()]).collect()
    assert sorted(r["rank"] for r in found) == list(range(1, 401)) and found[0].range_part == "s"


# Packing

def test_combinations_and_least_squares():
    found = packing.combinations(12, 3)
    assert {tuple(p for p in row if p <= 12) for row in found.tolist()} == {
        tuple(c) for n in (2, 3) for c in itertools.product(range(12, 0, -1), repeat=n) if sum(c) == 12 and list(c) == sorted(c, reverse=True)}
    rng = np.random.default_rng(3)
    matrix = np.array([np.bincount(row, minlength=14)[:12] for row in found]).T.astype(float)
    for _ in range(5):
        counts = rng.integers(0, 60, 12)
        counts[0] = 0
        usable = (np.append(counts, [1, 1])[found] > 0).all(axis=1)
        x = packing.solve(found, counts)
        gradient = matrix.T @ (counts - matrix @ x)
        # The conditions that only a least-squares solution without negative entries meets.
        assert (x >= 0).all() and np.all(x[~usable] == 0) and np.all(gradient[usable] < 1e-6) and np.allclose(gradient[x > 0], 0, atol=1e-6)


def test_plan_never_seats_more_than_there_are():
    rng = np.random.default_rng(4)
    for size in (3, 40, 5000):
        counts = np.bincount(rng.integers(1, 128, size), minlength=128)
        plan = packing.Plan(counts, 10)
        assert all(plan.taken.get(u, 0) <= counts[u] for u in range(128))
        seats = defaultdict(list)
        for unit, n in enumerate(counts.tolist()):
            for number in range(n):
                if (seat := plan.seat(unit, number)) is not None:
                    seats[seat[0]].append((seat[1], seat[2], unit))
        assert sorted(seats) == list(range(10, 10 + plan.sequences))
        for some in seats.values():
            some.sort()
            assert [p for p, _, _ in some] == list(range(len(some))) and [last for _, last, _ in some] == [False] * (len(some) - 1) + [True]
            assert sum(u for _, _, u in some) == 128 and some[-1][2] * 16 > 60


def test_encoder_equals_the_library():
    definition = records.vocabulary("byte_bpe_50k.json")
    library = Tokenizer.from_str(definition)
    encoder = packing.ByteLevelEncoder(definition)
    rng = np.random.default_rng(8)
    signs = np.array([*"ab.,!? \n'sßéé́क़\t\x1c\x85_<|>$%ꟍ中3²՘", *map(chr, rng.integers(32, 0x3000, 200))])
    texts = [t or "" for t in ODD] + ["".join(rng.choice(signs, rng.integers(1, 14))) for _ in range(5000)]
    for text, raw in zip(texts, encoder(texts)):
        assert np.frombuffer(raw, encoder.kind).tolist() == library.encode(text, add_special_tokens=False).ids, text


def checked_pieces(rows, library, found, window):
    """Pieces hold every id of every document once, and sequences are filled without gaps; the padding."""
    by_text, sequences = defaultdict(list), defaultdict(list)
    for p in found:
        by_text[p.doc_id].append(p)
        sequences[p.sequence_id].append(p)
    for doc_id, texts in rows.items():
        coded = [np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for t in texts]
        expected = Counter()
        pieces = Counter()
        for p in by_text.pop(doc_id):
            pieces[p.doc_tokens] += p.length
            assert p.length > 0 and zlib.crc32(b"") != p.ids_crc32
            assert any(len(ids) == p.doc_tokens and zlib.crc32(ids[p.start: p.start + p.length].tobytes()) == p.ids_crc32 for ids in coded)
        for ids in coded:
            expected[len(ids)] += len(ids)
        assert pieces == expected
    assert not by_text and sorted(sequences) == list(range(len(sequences)))
    padding = 0
    for some in sequences.values():
        at = 0
        for p in sorted(some, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
        padding += window - at if at & (at - 1) else 0
    return padding


@pytest.mark.parametrize("window, unit", [(2048, 16), (64, 4)])
def test_packing_holds_every_id_once(spark, window, unit):
    definition = records.vocabulary("byte_bpe_50k.json")
    texts = [r.text for r in table(spark, SMALL, "documents").select("text").limit(80).collect()]
    rows = [*enumerate([*ODD, *texts]), (None, "no id"), (None, None), (3, "a"), (3, "a b"), *[(1000 + i, "the same text " * 9) for i in range(50)]]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, length int").repartition(3)
    by_id = defaultdict(list)
    for doc_id, text in rows:
        by_id[doc_id].append(text)
    library = Tokenizer.from_str(definition)
    assert checked_pieces(by_id, library, packing.pack(docs, definition, window, unit).collect(), window) == 0
    assert packing.pack(docs.limit(0), definition).count() == 0


def test_packing_query_pads_nothing(spark):
    rows = table(spark, SMALL, "documents").select("doc_id", "text").collect()
    by_id = defaultdict(list)
    for r in rows:
        by_id[r.doc_id].append(r.text)
    assert checked_pieces(by_id, Tokenizer.from_str(records.vocabulary("byte_bpe_50k.json")), packing.query(spark, SMALL).collect(), 2048) == 0
