"""Byte-pair encoding with forced boundaries, and decoding.

A pair of neighbouring bytes that occurs inside no token of the vocabulary is a certain cut: no
merge can ever bridge it. Two kinds of cuts follow. A space between two characters that are not
white space is one (no token holds a space behind a letter, digit or mark), and the pre-tokenizer
splits there too whatever stands around, so texts fall into chunks that are encoded on their own and
remembered. Within the chunk's pre-tokens every forced pair cuts again, and merges run on the
fragments alone; their ids are concatenated.

Defined results: a NULL or empty text has no ids and decodes to an empty text; texts of any
length are encoded whole, in time n log n even if they have no cut at all; equal rows get equal
results; NULL ids in a list and ids outside the vocabulary decode to nothing. Further columns
of the input are kept unless they carry the result's names.
"""

import heapq
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlode.llm.common import record_batch, slices, table
from adlode.llm.records import vocabulary

#: The pre-tokenizer's pattern, a fixed value of the vocabulary's format.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")
#: Texts without it, and without a space at an end, have no other spaces than safe ones.
WIDE_SPACE = re.compile(r"\s | \s")
#: Chunks that one worker remembers before it starts anew, and how long they may be.
CACHE_CHUNKS, CACHE_LENGTH = 500_000, 64
#: Fragments up to here are merged by scanning for the best pair, longer ones with a heap.
SCAN_LENGTH = 48
#: Above every rank.
NEVER = 1 << 60


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for
    themselves, the others, in order, from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    shifted = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(shifted)}


class ForcedBoundaryBpe:
    """Encoder and decoder of one byte-level vocabulary (the text of its definition)."""

    def __init__(self, definition: str):
        import regex

        spec = json.loads(definition)
        letters = byte_letters()
        raw = {token: bytes(letters[c] for c in token) for token in spec["model"]["vocab"]}
        ids = {raw[token]: n for token, n in spec["model"]["vocab"].items()}
        self.start = [ids.get(bytes([b])) for b in range(256)]
        pairs = [[raw[x] for x in (p.split(" ") if isinstance(p, str) else p)] for p in spec["model"]["merges"]]
        self.ranks = {(ids[left], ids[right]): rank for rank, (left, right) in enumerate(pairs)}
        self.result = [ids[left + right] for left, right in pairs]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("added tokens with stripping or normalisation are not supported")
        self.bytes_of = {n: b for b, n in ids.items()} | {n: c.encode() for c, n in self.special.items()}
        # Longest first among those starting at one place, as added tokens are matched.
        self.special_pattern = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.inside = {pair for token in raw.values() for pair in zip(token, token[1:])}
        if any((b, 32) in self.inside for b in range(128) if b not in {9, 10, 11, 12, 13, 32}):
            raise ValueError("a space is no certain cut in this vocabulary")
        self.pretokens = regex.compile(PATTERN)
        self.spaced: dict[str, bytes] = {}  # chunks by what follows their space
        self.known: dict[str, bytes] = {}

    def merge(self, fragment: bytes) -> list[int]:
        """Ids of one fragment: neighbours are merged by rank, leftmost first."""
        ids, ranks, result = [self.start[b] for b in fragment], self.ranks, self.result
        if len(ids) > SCAN_LENGTH:
            return self.merge_long(ids)
        line = [ranks.get(p, NEVER) for p in zip(ids, ids[1:])]
        while line and (rank := min(line)) != NEVER:
            i = line.index(rank)
            ids[i: i + 2] = [result[rank]]
            del line[i]
            if i < len(line):
                line[i] = ranks.get((ids[i], ids[i + 1]), NEVER)
            if i:
                line[i - 1] = ranks.get((ids[i - 1], ids[i]), NEVER)
        return ids

    def merge_long(self, ids: list) -> list[int]:
        """The same over a linked list, with a heap of the pairs."""
        n, ranks = len(ids), self.ranks
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[p], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in ranks]
        heapq.heapify(heap)
        while heap:
            rank, i, pair = heapq.heappop(heap)
            j = after[i] if ids[i] is not None else n
            if j >= n or (ids[i], ids[j]) != pair:
                continue  # an older state of the place
            ids[i], ids[j] = self.result[rank], None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
            for left, right in ((i, k), (before[i], i)):
                if left >= 0 and right < n and (new := (ids[left], ids[right])) in ranks:
                    heapq.heappush(heap, (ranks[new], left, new))
        return [x for x in ids if x is not None]

    def fragments(self, pretoken: bytes) -> list[bytes]:
        """The pretoken, cut between all pairs of bytes that no token holds."""
        inside, at, parts = self.inside, 0, []
        for i, pair in enumerate(zip(pretoken, pretoken[1:]), 1):
            if pair not in inside:
                parts.append(pretoken[at:i])
                at = i
        return [*parts, pretoken[at:]]

    def pretoken(self, text: str) -> bytes:
        coded = np.array([n for part in self.fragments(text.encode("utf-8")) for n in self.merge(part)], "<i4").tobytes()
        if len(text) <= CACHE_LENGTH:
            self.known[text] = coded
        return coded

    def chunk(self, text: str) -> bytes:
        known = self.known
        return b"".join([known.get(p) or self.pretoken(p) for p in self.pretokens.findall(text)])

    def plain(self, text: str) -> bytes:
        """Ids of a text without special tokens: its chunks' ids, joined."""
        simple = not WIDE_SPACE.search(text) and text[:1] != " " and text[-1:] != " "
        first, *others = text.split(" ") if simple else SAFE_SPACE.split(text)
        spaced = self.spaced
        new = set(others).difference(spaced)
        for word in new:
            spaced[word] = self.chunk(" " + word)
        coded = self.chunk(first) + b"".join(map(spaced.__getitem__, others))
        for word in new:
            if len(word) > CACHE_LENGTH:
                del spaced[word]
        return coded

    def encode(self, text: str) -> bytes:
        """The ids of a text as 32-bit little-endian bytes."""
        for cache in (self.spaced, self.known):
            if len(cache) > CACHE_CHUNKS:
                cache.clear()
        out, at = [], 0
        for found in self.special_pattern.finditer(text):
            out += [self.plain(text[at:found.start()]), np.array([self.special[found[0]]], "<i4").tobytes()]
            at = found.end()
        return b"".join([*out, self.plain(text[at:])])

    def decode(self, ids: list[int]) -> str:
        get = self.bytes_of.get
        return b"".join([get(n, b"") for n in ids]).decode("utf-8", "replace")


def _int_lists(coded: list[bytes]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in coded])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(coded), "<i4")))


def _appended(df: DataFrame, run, kinds: dict) -> DataFrame:
    """``df`` with columns computed by ``run`` from each batch, in place of columns of the same names."""
    kept = [c for c in df.columns if c.lower() not in {k.lower() for k in kinds}]
    schema = df.select(*[F.col(f"`{c}`") for c in kept]).schema
    for name, kind in kinds.items():
        schema = schema.add(name, kind)

    def apply(batches):
        state = run()
        for batch in slices(batches, 512):
            new = state(batch)
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, *new], names=[*kept, *kinds])

    return df.mapInArrow(apply, schema)


def encode(docs: DataFrame, definition: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of its texts."""
    def run():
        coder = ForcedBoundaryBpe(definition)
        return lambda batch: [_int_lists([coder.encode(t or "") for t in batch.column(text).to_pylist()])]

    return _appended(docs, run, {ids: T.ArrayType(T.IntegerType())})


def decode(coded: DataFrame, definition: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``coded`` with the texts of its ids."""
    def run():
        coder = ForcedBoundaryBpe(definition)
        return lambda batch: [pa.array([coder.decode(x or []) for x in batch.column(ids).to_pylist()], pa.string())]

    return _appended(coded, run, {text: T.StringType()})


def encode_decode(docs: DataFrame, definition: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``docs`` with ids and the texts decoded from them, in one pass."""
    def run():
        coder = ForcedBoundaryBpe(definition)

        def both(batch):
            coded = [coder.encode(t or "") for t in batch.column(text).to_pylist()]
            back = [coder.decode(np.frombuffer(x, "<i4").tolist()) for x in coded]
            return [_int_lists(coded), pa.array(back, pa.string())]
        return both

    return _appended(docs, run, {ids: T.ArrayType(T.IntegerType()), decoded: T.StringType()})


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_decode(docs, vocabulary("byte_bpe_50k.json")).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
