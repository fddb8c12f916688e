r"""Chat formatting by schema fingerprints.

A fingerprint is a hash of a record's nested field paths. It selects a declarative mapping that
turns the record, whatever its layout, into canonical turns (id, position, role, text). Paths
that no layout knows are left out before hashing, so further columns change nothing.

The template marks every turn as ``<|im_start|>role\ntext<|im_end|>\n``. Inside roles and texts
a backslash follows every ``<`` and ``[`` and every backslash is doubled, so that no control
string of this or another template (``</s>``, ``[INST]``, ``<|im_end|>``) can occur there; a line
end inside a role becomes ``[n``. The escape is undone exactly on reading. The loss mask is a list of character spans of the output.

Defined results: NULL texts and roles count as empty; turns are ordered by position (NULL
first), then role, then text; repeated rows are repeated turns; a NULL id is an id of its own;
a conversation is one output record and has to fit into one row; empty tables give no rows.
"""

import hashlib
import json
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlode.llm.common import record_batch, slices, table
from adlode.session import scratch_path

START, END = "<|im_start|>", "<|im_end|>\n"


@dataclass(frozen=True)
class Layout:
    """Where a layout keeps its turns.

    ``each``: path of an array of turns with ``role`` and ``text`` below it (and ``place``, if
    any). ``rows``: one turn per record. ``fixed``: (role, paths) in order; the texts of several
    paths are joined by an empty line and a turn without any of them is left out.
    """

    name: str
    key: str
    each: str | None = None
    rows: bool = False
    place: str | None = None
    role: str | None = None
    text: str | None = None
    fixed: tuple = ()
    roles: dict = field(default_factory=dict)

    def paths(self) -> frozenset:
        if self.fixed:
            return frozenset([self.key, *(p for _, paths in self.fixed for p in paths)])
        below = [p for p in (self.place, self.role, self.text) if p]
        return frozenset([self.key, *(f"{self.each}[].{p}" if self.each else p for p in below)])


LAYOUTS = (
    Layout("turn rows", "conv_id", rows=True, place="turn", role="role", text="text"),
    Layout("messages", "id", each="messages", role="role", text="content"),
    Layout("shared conversations", "id", each="conversations", role="from", text="value",
           roles={"human": "user", "gpt": "assistant"}),
    Layout("prompt and response", "id", fixed=(("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("system, prompt and response", "id",
           fixed=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("instruction", "id", fixed=(("user", ("instruction", "input")), ("assistant", ("output",)))),
)


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def registry(layouts=LAYOUTS) -> tuple[dict, frozenset]:
    """Layouts by fingerprint, and all paths that any of them reads."""
    return {fingerprint(x.paths()): x for x in layouts}, frozenset(p for x in layouts for p in x.paths())


def schema_paths(kind: T.DataType, at: str = "") -> set:
    if isinstance(kind, T.StructType):
        return {p for f in kind.fields for p in schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name)}
    if isinstance(kind, T.ArrayType):
        return schema_paths(kind.elementType, f"{at}[]")
    return {at}


def value_paths(value, at: str = "") -> set:
    if isinstance(value, dict):
        return {p for k, v in value.items() for p in value_paths(v, f"{at}.{k}" if at else k)}
    if isinstance(value, list):
        return {p for v in value for p in value_paths(v, f"{at}[]")}
    return {at}


def choose(paths, layouts=LAYOUTS) -> Layout | None:
    """The layout of these paths. Paths of other layouts may be present too (``text`` beside ``prompt``):
    then the layout with most paths that are all there is taken."""
    known, used = registry(layouts)
    exact = known.get(fingerprint(set(paths) & used))
    return exact or max((x for x in layouts if x.paths() <= set(paths)), key=lambda x: len(x.paths()), default=None)


def canonical(records: DataFrame, layouts=LAYOUTS) -> DataFrame:
    """Turns (conv_id, turn, role, text) of a table whose schema has one of the layouts, by expressions alone."""
    layout = choose(schema_paths(records.schema), layouts)
    if layout is None:
        raise ValueError(f"no layout has the paths {sorted(schema_paths(records.schema))}")
    key = F.col(layout.key).cast("long").alias("conv_id")

    def role(column):
        named = F.coalesce(column.cast("string"), F.lit(""))
        for old, new in layout.roles.items():
            named = F.when(column == old, new).otherwise(named)
        return named.alias("role")

    if layout.rows:
        turns = records.select(key, F.col(layout.place).cast("long").alias("turn"), role(F.col(layout.role)),
                               F.col(layout.text).alias("text"))
    elif layout.each:
        turns = (records.select(key, F.posexplode(layout.each).alias("turn", "one"))
                 .select("conv_id", F.col("turn").cast("long"), role(F.col("one")[layout.role]),
                         F.col("one")[layout.text].alias("text")))
    else:
        said = F.array(*[F.struct(F.lit(n).cast("long").alias("turn"), F.lit(name).alias("role"),
                                  F.when(F.coalesce(*[F.col(p) for p in paths]).isNotNull(),
                                         F.concat_ws("\n\n", *[F.nullif(F.col(p), F.lit("")) for p in paths])).alias("text"))
                         for n, (name, paths) in enumerate(layout.fixed)])
        turns = (records.select(key, F.explode(F.filter(said, lambda x: x["text"].isNotNull())).alias("one"))
                 .select("conv_id", "one.*"))
    return turns.withColumn("text", F.coalesce("text", F.lit("")))


def canonical_json(records: DataFrame, column: str = "record", layouts=LAYOUTS) -> DataFrame:
    """Turns of JSON records of mixed layouts in one column: every record's own paths select its mapping.

    Records that are no JSON objects or have no known layout give one row with only ``problem`` set.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()),
                        ("problem", pa.string())])

    def turns(raw: str | None):
        try:
            value = json.loads(raw or "")
        except ValueError:
            value = None
        if not isinstance(value, dict):
            return [(None, None, None, None, "not a JSON object")]
        layout = choose(value_paths(value), layouts)
        if layout is None:
            return [(None, None, None, None, f"unknown layout {fingerprint(value_paths(value))}")]
        key = value[layout.key]
        if layout.fixed:
            said = [(name, [value[p] for p in paths if value[p] is not None]) for name, paths in layout.fixed]
            pairs = [(n, name, "\n\n".join(filter(None, texts))) for n, (name, texts) in enumerate(said) if texts]
        elif layout.rows:
            pairs = [(value[layout.place], value[layout.role], value[layout.text])]
        else:
            pairs = [(n, x.get(layout.role), x.get(layout.text)) for n, x in enumerate(value[layout.each])]
        return [(key, n, layout.roles.get(who, who) or "", text or "", None) for n, who, text in pairs]

    def run(batches):
        for batch in slices(batches):
            found = [t for raw in batch.column(0).to_pylist() for t in turns(raw)]
            yield record_batch(schema, [list(c) for c in zip(*found)] if found else [[] for _ in schema])

    return records.select(column).mapInArrow(run, "conv_id long, turn long, role string, text string, problem string")


def escape(column):
    doubled = F.replace(column, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(doubled, F.lit("<"), F.lit("<\\")), F.lit("["), F.lit("[\\"))


def unescape(column):
    opened = F.replace(F.replace(column, F.lit("[\\"), F.lit("[")), F.lit("<\\"), F.lit("<"))
    return F.replace(opened, F.lit("\\\\"), F.lit("\\"))


def format_turns(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, loss: the template's text and the spans [start, end) of the assistant's texts in it."""
    one = F.struct(F.col("turn"), F.col("role"), F.col("text"))
    ordered = F.array_sort(F.collect_list(one))
    head = lambda x: F.concat(F.lit(START), F.replace(escape(x["role"]), F.lit("\n"), F.lit("[n")), F.lit("\n"))
    pieces = F.transform("turns", lambda x: F.struct(
        head(x).alias("head"), escape(x["text"]).alias("body"), (x["role"] == "assistant").alias("taught")))
    width = lambda x: F.length(x["head"]) + F.length(x["body"]) + len(END)
    # Running offsets: a fold whose state holds the next offset and the spans so far.
    spans = F.aggregate(
        "pieces",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")),
        lambda state, x: F.struct(
            (state["at"] + width(x)).alias("at"),
            F.when(x["taught"], F.concat(state["spans"], F.array(F.struct(
                (state["at"] + F.length(x["head"])).alias("start"),
                (state["at"] + F.length(x["head"]) + F.length(x["body"])).alias("end")))))
            .otherwise(state["spans"]).alias("spans")),
        lambda state: state["spans"])
    return (turns.groupBy("conv_id").agg(ordered.alias("turns")).withColumn("pieces", pieces)
            .select("conv_id",
                    F.concat_ws("", F.transform("pieces", lambda x: F.concat(x["head"], x["body"], F.lit(END)))).alias("formatted"),
                    spans.alias("loss")))


def parse(formatted: DataFrame) -> DataFrame:
    """conv_id, formatted, loss, turns (role, text) and taught (texts under the loss mask), from the template's text alone."""
    parts = F.filter(F.split("formatted", r"\Q" + END + r"\E", -1), lambda x: x != "")
    turn = lambda x: F.struct(
        unescape(F.replace(F.substring_index(F.substr(x, F.lit(len(START) + 1)), "\n", 1), F.lit("[n"), F.lit("\n"))).alias("role"),
        unescape(F.substr(x, F.instr(x, F.lit("\n")) + 1)).alias("text"))
    return formatted.select(
        "*", F.transform(parts, turn).alias("turns"),
        F.transform("loss", lambda s: unescape(F.substr("formatted", s["start"] + 1, s["end"] - s["start"]))).alias("taught"))


def query(spark, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                    "conv_id long, turn long, role string, text string")
    turns = canonical(table(spark, sf_dir, "conversations")).unionByName(planted)
    path = scratch_path(spark, "chat")
    format_turns(turns).write.parquet(path)
    back = parse(spark.read.parquet(path))
    whole = F.concat_ws("", F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))))
    taught = F.concat_ws("", "taught")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.length(taught).cast("long").alias("loss_chars"), F.sha2(taught, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
escaped AS (
  SELECT *, replace(replace(replace(role, '\', '\\'), '<', '<\'), '[', '[\') AS half_role,
    replace(replace(replace(text, '\', '\\'), '<', '<\'), '[', '[\') AS marked,
    replace(half_role, chr(10), '[n') AS marked_role FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length('<|im_start|>') + length(marked_role) + 1 + length(marked) + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
"""
