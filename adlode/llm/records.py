"""Token ids as length-delimited binary records with a separate offset index.

A data file is a run of records::

    length of the payload (8 bytes) | masked checksum of these 8 bytes (4)
    payload: 1 byte (1: has an id, 2: ids are wide), document id (8), token ids (2 each, 4 if wide)
    masked checksum of the payload (4)

all little-endian; a record is wide if one of its ids needs more than 16 bits. The checksum is CRC-32, rotated right by 15 bits plus a constant, so that
records stored inside records cannot pass for their own frames. The index file of a data file
holds (offset, number of ids) of every record, 8 bytes each, for reads in any order.

Documents are dealt by ranges of their id and sorted, one file per range. Every attempt of a
task writes files of its own; the table of files that Spark commits names those that count, so
a lost executor leaves nothing but unused files. Files go to the shared folder through
pyarrow's file systems, which also open remote stores.

Defined results: a NULL or empty text is a sequence of the end id alone; NULL ids sort first;
rows of equal id follow one another in the order of their texts' checksums; an empty table has no
files with records and gives no rows.
"""

import json
import os
import re
import struct
import unicodedata
import uuid
import zlib
from functools import lru_cache
from posixpath import join

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlode.llm.common import record_batch, slices, table
from adlode.session import scratch_path, settle

END_ID = 1
#: The mask of the checksums, a fixed value of this record format.
MASK = 0xA282EAD8
#: Chunks whose ids one worker remembers before it begins a new generation (the last one is kept), and how long they may be.
CACHE_CHUNKS = 200_000
CACHE_LENGTH = 64
#: Marks that are cut off words where a space follows, and those that the tokenizer takes as one piece when they end a chunk.
MARKS, TRAILING = ".,;:!?", ".,;:!?%$#&*()\""
FILES = "part int, data string, offsets string, n_records long, n_ids long"


def vocabulary(name: str) -> str:
    """The definition of a public tokenizer, read on the driver; tasks get its text."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


def plain_characters() -> str:
    """The inside of a character class: letters and numbers of the basic plane that every version of
    Unicode since 3.2 knows as such and that the tokenizer's normalisation leaves letters and numbers."""
    def plain(c: str) -> bool:
        return all(old.category(x)[0] in "LN" for x in (c, *unicodedata.normalize("NFC", c).lower()))

    old, ranges = unicodedata.ucd_3_2_0, []
    for n in filter(lambda n: plain(chr(n)), range(1 << 16)):
        if ranges and ranges[-1][1] == n - 1:
            ranges[-1][1] = n
        else:
            ranges.append([n, n])
    return "".join(f"\\u{first:04x}-\\u{last:04x}" for first, last in ranges)


class Encoder:
    """Token ids of texts as 32-bit little-endian bytes.

    The tokenizer drops white space and never joins what stands on two sides of it, so a text's
    ids are those of its chunks between spaces and line ends; frequent chunks are remembered. It
    also takes a mark between a letter and a space as a piece of its own, so lines without marks
    beside other signs are cut there too. Unknown words of letters alone are encoded
    together, with spaces between them, and told apart by the tokens that end a word.
    """

    def __init__(self, definition: str):
        # A task has one core: threads of the library would take the cores of other tasks.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        suffix = json.loads(definition)["model"].get("end_of_word_suffix")
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.ends[[n for token, n in vocab.items() if suffix and token.endswith(suffix)]] = True
        #: How the tokenizer prepares texts, and what is enough for normalised words with spaces between them.
        self.for_texts = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        self.for_words = None, Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        plain = plain_characters()
        self.plain = re.compile(f"[{plain}]+")
        self.crowded = re.compile(rf"[{MARKS}](?:(?=[^{plain} \n])|(?<=[^{plain} \n][{MARKS}]))")
        self.known, self.older = {"": b""}, {}

    def prepare(self, steps: tuple) -> None:
        self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = steps

    def one_by_one(self, chunks: list[str]) -> None:
        for some in _portions(chunks, 4096):
            for chunk, coded in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                self.known[chunk] = np.array(coded.ids, "<u4").tobytes()

    def together(self, words: list[str]) -> None:
        """Each of these words is letters alone and one word to the tokenizer; were it not, the number of
        word ends would differ and they are encoded one by one."""
        normal = unicodedata.normalize("NFC", " ".join(words)).lower().split(" ")
        refused = []
        self.prepare(self.for_words)
        for many in _portions(list(zip(_portions(words, 64), _portions(normal, 64))), 64):
            for (some, _), coded in zip(many, self.tokenizer.encode_batch_fast([" ".join(n) for _, n in many], add_special_tokens=False)):
                ids = np.array(coded.ids, "<u4")
                ends = np.flatnonzero(self.ends[ids]) + 1
                if len(ends) == len(some) and ends[-1] == len(ids):
                    raw, edges = ids.tobytes(), [0, *(4 * ends).tolist()]
                    self.known.update(zip(some, [raw[a:b] for a, b in zip(edges, edges[1:])]))
                else:
                    refused += some
        self.prepare(self.for_texts)
        self.one_by_one(refused)

    def letters(self, chunk: str) -> bool:
        # A sigma's small letter depends on its place for Python, not for the tokenizer.
        return chunk.isalpha() and (chunk.isascii() or "Σ" not in chunk and self.plain.fullmatch(chunk) is not None)

    def learn(self, chunks: set[str]) -> None:
        """Chunks that an earlier generation knows move to the present one, the others are encoded."""
        known, older = self.known, self.older
        kept = chunks.intersection(older)
        known.update(zip(kept, map(older.__getitem__, kept)))
        words, others, marked = [], set(), []
        for chunk in chunks.difference(kept):
            if self.letters(chunk):
                words.append(chunk)
            elif self.letters(word := chunk.rstrip(TRAILING)):
                marked.append((chunk, word, chunk[len(word):]))
            else:
                others.add(chunk)
        for _, word, rest in marked:
            if word not in known and word not in chunks:
                words.append(word)
            others.add(rest)
        self.together(words)
        self.one_by_one([chunk for chunk in others if chunk not in known])
        for chunk, word, rest in marked:
            known[chunk] = known[word] + known[rest]

    def chunks(self, text: str) -> list[str]:
        if self.crowded.search(text):
            if "\n" in text:
                return [chunk for line in text.split("\n") for chunk in self.chunks(line)]
            return text.split(" ")
        text = text.replace("\n", " ")
        for mark in MARKS:
            text = text.replace(f"{mark} ", f" {mark} ")
        return text.split(" ")

    def __call__(self, texts: list[str]) -> list[bytes]:
        split = list(map(self.chunks, texts))
        if len(self.known) > CACHE_CHUNKS:
            self.known, self.older = {"": b""}, self.known
        wanted = set().union(*split).difference(self.known)
        self.learn(wanted)
        coded = [b"".join(map(self.known.__getitem__, chunks)) for chunks in split]
        for chunk in wanted:
            if len(chunk) > CACHE_LENGTH:
                del self.known[chunk]
        return coded


@lru_cache(maxsize=1)
def encoder_of(definition: str) -> Encoder:
    """The encoder that a Python worker keeps over its tasks, with the chunks it remembers."""
    return Encoder(definition)


def _portions(items: list, n: int):
    return (items[at: at + n] for at in range(0, len(items), n))


def encode(docs: DataFrame, definition: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID) -> DataFrame:
    """doc_id, ids (binary, 32-bit little-endian): every text's ids and the end id, in ascending id order.

    The texts are dealt by ranges and sorted before they are encoded: finding the ranges reads the
    rows once more, which is cheap for texts and not for ids. Ids that many rows share are dealt by
    their text's checksum as well, so no range has to hold them all.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])
    end = struct.pack("<I", end_id)

    def run(batches):
        encoder = encoder_of(definition)
        for batch in slices(batches, 512):
            ids = encoder([t or "" for t in batch.column(1).to_pylist()])
            yield record_batch(schema, [batch.column(0), [x + end for x in ids]])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.crc32(F.col("text").cast("binary")).asc_nulls_first()]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order, "text").mapInArrow(run, "doc_id long, ids binary")


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes) -> bytes:
    """The record of ids given as 32-bit numbers."""
    numbers = np.frombuffer(ids, "<u4")
    wide = bool(numbers.size) and int(numbers.max()) >= 1 << 16
    payload = struct.pack("<Bq", (doc_id is not None) | wide << 1, doc_id or 0) + (ids if wide else numbers.astype("<u2").tobytes())
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))))


def unframe(stream) -> tuple[int | None, bytes] | None:
    """The next record of an open file, its ids as 32-bit numbers; None at the file's end."""
    head = stream.read(12)
    if not head:
        return None
    if len(head) < 12 or struct.unpack("<I", head[8:])[0] != masked(head[:8]):
        raise ValueError("damaged record length")
    n, = struct.unpack("<Q", head[:8])
    body = stream.read(n + 4)
    if len(body) < n + 4 or struct.unpack("<I", body[n:])[0] != masked(body[:n]):
        raise ValueError("damaged record")
    kind, doc_id = struct.unpack("<Bq", body[:9])
    ids = body[9:n] if kind & 2 else np.frombuffer(body[9:n], "<u2").astype("<u4").tobytes()
    return (doc_id if kind & 1 else None), ids


def _opened(uri: str):
    return pafs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def write(sequences: DataFrame, folder: str) -> DataFrame:
    """Write (doc_id, ids), partition by partition in the order given, under ``folder``; the committed table of its files."""
    schema = pa.schema([("part", pa.int32()), ("data", pa.string()), ("offsets", pa.string()),
                        ("n_records", pa.int64()), ("n_ids", pa.int64())])

    def run(batches):
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        names = [join(folder, f"{part:05d}-{attempt}.{kind}") for kind in ("records", "index")]
        files = [_opened(name) for name in names]
        files[0][0].create_dir(files[0][1].rpartition("/")[0], recursive=True)
        offset = n_records = n_ids = 0
        with files[0][0].open_output_stream(files[0][1]) as data, files[1][0].open_output_stream(files[1][1]) as index:
            for batch in slices(batches, 512):
                coded = batch.column(1).to_pylist()
                records = [frame(*row) for row in zip(batch.column(0).to_pylist(), coded)]
                sizes = np.fromiter(map(len, records), np.int64, len(records))
                ids = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
                starts = offset + np.cumsum(sizes) - sizes
                data.write(b"".join(records))
                index.write(np.column_stack([starts, ids]).astype("<u8").tobytes())
                offset += int(sizes.sum())
                n_records += len(records)
                n_ids += int(ids.sum())
        yield record_batch(schema, [[part], *[[name] for name in names], [n_records], [n_ids]])

    return settle(sequences.mapInArrow(run, FILES))


def read(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every record, read from the files in order and checked.

    A file's first position is the sum over the files before it: a window over one row per file.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)

    def run(batches):
        for batch in batches:
            for name, start in zip(*[c.to_pylist() for c in batch.columns]):
                rows = []
                system, path = _opened(name)
                with system.open_input_stream(path, buffer_size=1 << 20) as stream:
                    while (record := unframe(stream)) is not None:
                        doc_id, ids = record
                        rows.append((doc_id, start, len(ids) // 4, zlib.crc32(ids)))
                        start += len(ids) // 4
                        if len(rows) == 4096:
                            yield record_batch(schema, [list(c) for c in zip(*rows)])
                            rows = []
                if rows:
                    yield record_batch(schema, [list(c) for c in zip(*rows)])

    firsts = files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).filter("n_records > 0")
    n = max(1, files.count())
    return (firsts.select("data", "start").repartition(n, F.col("data"))
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def read_shuffled(files: DataFrame, seed: str, tasks: int) -> DataFrame:
    """doc_id, ids of all records in an order that ``seed`` decides, fetched one by one through the index files."""
    def places(batches):
        schema = pa.schema([("data", pa.string()), ("offset", pa.int64())])
        for batch in batches:
            for name, index in zip(*[c.to_pylist() for c in batch.columns]):
                system, path = _opened(index)
                with system.open_input_stream(path) as stream:
                    while raw := stream.read(16 * 8192):
                        at = np.frombuffer(raw, "<u8").reshape(-1, 2)[:, 0].astype(np.int64)
                        yield record_batch(schema, [[name] * len(at), pa.array(at)])

    def fetch(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])
        for batch in slices(batches, 256):
            rows = []
            for name, offset in zip(*[c.to_pylist() for c in batch.columns]):
                system, path = _opened(name)
                with system.open_input_file(path) as stream:
                    stream.seek(offset)
                    rows.append(unframe(stream))
            yield record_batch(schema, [list(c) for c in zip(*rows)])

    at = files.filter("n_records > 0").select("data", "offsets").mapInArrow(places, "data string, offset long")
    order = F.xxhash64(F.lit(seed), F.regexp_extract("data", r"(\d+)-[^/]*$", 1), "offset")
    return (at.withColumn("order", order).repartitionByRange(tasks, "order").sortWithinPartitions("order")
            .select("data", "offset").mapInArrow(fetch, "doc_id long, ids binary"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    files = write(encode(docs, vocabulary("word_bpe_49k.json")), scratch_path(spark, "records"))
    return read(files)
