"""Similarity join on word shingles with multiple-global-order filtering, down to components.

Texts become sets of 64-bit hashes of their 5-word shingles; equal sets form a class and only one
document stands for it. Then:

1. Sampled filter. Every document gives the half of its shingles whose hash has a top bit of 0. A
   document linked to another differs from it in at most n - ceil(t n) of its n shingles, so of
   its s sampled ones at least s - (n - ceil(t n)) occur elsewhere too. Documents with fewer are
   linked to nothing and leave here. Shingles that a batch holds several times are counted in the
   batch and sent once, so no shingle, however common, gathers more rows than there are batches.
2. Orders. Linked documents share a token among their first n - ceil(t n) + 1 tokens in every
   global order of the tokens. The first order (rarest first, among the remaining documents)
   gives buckets; a pair must also share prefix tokens in two hashed orders before its sets are
   compared.
3. Components without pairs of a whole group: in each bucket documents are first compared with one
   hub only, round by round, which joins nearly all of a group of copies. Only pairs of different
   components that still share a bucket are then compared, all of them.

No step drops or caps anything, so components are those of all links.

Defined results: a NULL or empty text or one without words has an empty set and is linked with
nothing; a text of fewer than five words is one shingle; repeated rows give repeated results; a
row without an id has no component; ids are taken to name one text each; empty tables give no
rows. Further columns of the input are kept by ``one_of_each``.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlode.llm.common import fresh, record_batch, slices, table
from adlode.session import settle

WIDTH, PERCENT = 5, 75
#: Members of a bucket that are kept in one array.
CHUNK = 1024
#: Documents that a task looks at together, and words whose hashes a worker remembers before it starts anew.
BATCH, CACHE_WORDS = 4096, 200_000
#: Sampled shingles that a bucket holds, about and at most; each travels with its owner in 16 bytes. Buckets follow from it.
SHINGLES = 1_000_000
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads all bits."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Shingles:
    """The sorted distinct shingle hashes of texts."""

    def __init__(self, width: int = WIDTH):
        self.width, self.known = width, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8").lower().split()  # bytes: A-Z and the six ASCII white-space characters
        if len(words) < self.width:
            return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))] if words else [], np.uint64)
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        known = self.known
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        codes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = len(words) - self.width + 1
        total = np.zeros(n, np.uint64)
        for k in range(self.width):
            total += codes[k: k + n] * ODD[k % len(ODD)] + np.uint64(k // len(ODD))
        return np.unique(mixed(total))


def least_common(n: int, percent: int) -> int:
    """Shingles that a document of n has in common with any linked one, at least."""
    return -(-percent * n // 100)


#: Documents' rows travel as arrays, one row per batch and block of documents.
FIELDS = ("doc_id", "copies", "n", "need", "hi", "lo", "cnt")
ARRAYS = ", ".join(f"{f} array<long>" for f in FIELDS)


def _lists(offsets, columns) -> list:
    offsets = pa.array(np.asarray(offsets, np.int32))
    return [pa.ListArray.from_arrays(offsets, c) for c in columns]


def _grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by ``key`` and the offsets of its runs, the end included."""
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    runs = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(key) else np.zeros(0, np.int64)
    return order, np.append(runs, len(key))


def _block(ids: np.ndarray, blocks: int) -> np.ndarray:
    return (mixed(ids.view(np.uint64)) % np.uint64(blocks)).astype(np.int64)


def _nothing(n: int, columns: int) -> list:
    return [pa.nulls(n, pa.list_(pa.int64()))] * columns


def _sampled(buckets: int, percent: int, width: int):
    kinds = [("bucket", pa.int32()), ("block", pa.int32()), ("tokens", pa.list_(pa.int64())), ("owners", pa.list_(pa.int64()))]
    schema = pa.schema([*kinds, *[(f, pa.list_(pa.int64())) for f in FIELDS]])

    def run(batches):
        shingles = Shingles(width)
        for batch in slices(batches, BATCH):
            documents, sets, owners = {}, [], {}  # (id, set's mark) -> place; sets; mark -> place of the smallest id
            copies = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = shingles(text)
                mark = tuple(np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), "<i8").tolist())
                place = documents.setdefault((doc_id, mark), len(sets))
                if place < len(sets):
                    copies[place] += 1
                    continue
                copies.append(1)
                sets.append((len(found), found[found < np.uint64(1 << 63)].astype(np.int64)))
                if doc_id is not None and len(found) and (mark not in owners or doc_id < owners[mark][0]):
                    owners[mark] = doc_id, place
            own = sorted(place for _, place in owners.values())
            tokens = np.concatenate([np.zeros(0, np.int64), *[sets[i][1] for i in own]])
            owner = np.repeat(np.array(own, np.int64), [len(sets[i][1]) for i in own])
            order, runs = _grouped(tokens)
            tokens, owner, times = tokens[order], owner[order], np.diff(runs)
            counts = np.bincount(owner[np.repeat(times > 1, times)], minlength=len(sets))
            ids = np.array([0 if i is None else i for i, _ in documents], np.int64)
            # One entry per token: its owner, or nothing where the batch has counted it already.
            token, holder, several = tokens[runs[:-1]], ids[owner[runs[:-1]]], times > 1
            order, runs = _grouped(token % buckets)
            token, holder, several = token[order], holder[order], several[order]
            yield record_batch(schema, [
                pa.array((token[runs[:-1]] % buckets).astype(np.int32)), pa.nulls(len(runs) - 1, pa.int32()),
                *_lists(runs, [pa.array(token), pa.array(holder, mask=several)]), *_nothing(len(runs) - 1, len(FIELDS))])
            need = [s - (n - least_common(n, percent)) for n, s in ((n, len(h)) for n, h in sets)]
            hi, lo = (np.array([m[k] for _, m in documents], np.int64) for k in (0, 1))
            order, runs = _grouped(_block(ids, buckets))
            columns = [np.array(c, np.int64)[order] for c in (ids, copies, [n for n, _ in sets], need, hi, lo, counts)]
            missing = np.array([i is None for i, _ in documents], bool)[order]
            block = _block(columns[0][runs[:-1]], buckets).astype(np.int32)
            yield record_batch(schema, [
                pa.array(block), pa.array(block), *_nothing(len(block), 2),
                *_lists(runs, [pa.array(columns[0], mask=missing), *map(pa.array, columns[1:])])])

    return run


def _counted(buckets: int):
    """One bucket of tokens: how many of each document's tokens others have too, by block of documents."""
    schema = pa.schema([("block", pa.int32()), *[(f, pa.list_(pa.int64())) for f in FIELDS]])

    def run(rows: pa.Table) -> pa.Table:
        passed = rows.filter(pc.is_valid(rows["block"])).select(schema.names).cast(schema)
        lists = rows.filter(pc.is_valid(rows["tokens"]))
        tokens, owners = (pc.list_flatten(lists[c]) for c in ("tokens", "owners"))
        known, owners, tokens = pc.is_valid(owners).to_numpy(), pc.fill_null(owners, 0).to_numpy(), tokens.to_numpy()
        order, runs = _grouped(tokens)
        elsewhere = np.repeat(np.diff(runs) > 1, np.diff(runs)) & known[order]
        ids, counts = np.unique(owners[order][elsewhere], return_counts=True)
        order, runs = _grouped(_block(ids, buckets))
        ids, n = ids[order], len(runs) - 1
        sums = _lists(runs, [pa.array(ids), pa.array(counts[order].astype(np.int64))])
        mine = pa.Table.from_arrays([pa.array(_block(ids[runs[:-1]], buckets).astype(np.int32)), sums[0], *_nothing(n, 5), sums[1]],
                                    schema=schema)
        return pa.concat_tables([passed, mine])

    return run


def _summed(rows: pa.Table) -> pa.Table:
    """One block of documents: one row per id and set, with the counts of all buckets."""
    schema = pa.schema([(f, pa.int64()) for f in FIELDS])
    full = pc.is_valid(rows["n"])
    documents = pa.Table.from_arrays([pc.list_flatten(rows.filter(full)[f]) for f in FIELDS], schema=schema)
    parts = rows.filter(pc.invert(full))
    extra = pa.Table.from_arrays([pc.list_flatten(parts[c]) for c in ("doc_id", "cnt")], names=["doc_id", "more"])
    more = extra.group_by("doc_id").aggregate([("more", "sum")])
    once = documents.group_by(["doc_id", "hi", "lo"]).aggregate([("copies", "sum"), ("n", "max"), ("need", "max"), ("cnt", "max")])
    both = once.join(more, "doc_id", join_type="left outer")
    total = pc.add(both["cnt_max"], pc.fill_null(both["more_sum"], 0))
    return pa.Table.from_arrays([both["doc_id"], both["copies_sum"], both["n_max"], both["need_max"], both["hi"], both["lo"], total],
                                schema=schema)


def _buckets(docs: DataFrame, text: str, shingles: int) -> int:
    """Buckets of tokens, and blocks of documents, whose size does not follow the table's.

    A word and its space have two bytes at least and half of the shingles are sampled; a document has one entry besides.
    """
    size = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length(text)).alias("bytes")).first()
    least = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-((size.bytes or 0) + 5 * size.n) // (4 * shingles)))


def profiles(docs: DataFrame, doc_id: str, text: str, percent: int, width: int, per_bucket: int = SHINGLES) -> DataFrame:
    """doc_id, copies, n, need, hi, lo, cnt: one row per id and set; hi and lo identify the set."""
    buckets = _buckets(docs, text, per_bucket)
    sampled = (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text))
               .mapInArrow(_sampled(buckets, percent, width), f"bucket int, block int, tokens array<long>, owners array<long>, {ARRAYS}"))
    counted = sampled.groupBy("bucket").applyInArrow(_counted(buckets), f"block int, {ARRAYS}")
    return settle(counted.groupBy("block").applyInArrow(_summed, ", ".join(f"{f} long" for f in FIELDS)))


def _set_rows(percent: int, width: int):
    schema = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("tokens", pa.list_(pa.int64())),
                        ("second", pa.list_(pa.int64())), ("third", pa.list_(pa.int64()))])

    def run(batches):
        shingles = Shingles(width)
        for batch in slices(batches, 512):
            rows = []
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                h = shingles(text)
                p = len(h) - least_common(len(h), percent) + 1
                # Two more global orders: by the hash under two permutations.
                orders = [h[np.argsort(mixed(h ^ seed), kind="stable")[:p]] for seed in ODD[:2]]
                rows.append((node, len(h), *[x.view(np.int64) for x in (h, *orders)]))
            yield record_batch(schema, [list(c) for c in zip(*rows)])

    return run


def _are_stars(edges: DataFrame) -> bool:
    """Whether every larger end is in one edge only, so that all edges lead to the smallest node of their component."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up")).union(edges.select("b", F.lit(0)))
    return ends.groupBy("node").agg(F.max("up").alias("up"), F.count("*").alias("edges")).filter("up = 1 AND edges > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node of ``edges`` (a, b).

    Alternating large and small stars: every node's larger neighbours move to its smallest one,
    then its smaller neighbours do, until all edges form stars around their smallest node. Each
    round is two aggregations and joins, and is written to the shared folder.
    """
    edges = settle(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct())
    while not _are_stars(edges):
        both = edges.select("a", "b").union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("k"), F.least("a", "low").alias("low"))
        large = both.join(least, F.col("a") == F.col("k")).filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        lows = large.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("k"), "low")
        small = (large.join(lows, F.col("a") == F.col("k"))
                 .select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e"))
                 .select("e.*").filter("a > b").distinct())
        edges = settle(small)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select("b", "b").distinct())


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are linked: lengths, then the two further orders, then the sets themselves."""
    left, right = (sets.toDF(*[f"{side}_{c}" for c in sets.columns]) for side in "ab")
    near = (F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * percent)
    common = F.size(F.array_intersect("a_tokens", "b_tokens"))
    joined = pairs.join(left, F.col("a") == F.col("a_node")).join(right, F.col("b") == F.col("b_node"))
    kept = joined.filter(near).filter(F.arrays_overlap("a_second", "b_second") & F.arrays_overlap("a_third", "b_third"))
    return kept.filter(100 * common >= percent * (F.col("a_n") + F.col("b_n") - common)).select("a", "b")


def _labelled(prefixes: DataFrame, links: DataFrame | None) -> DataFrame:
    if links is None:
        return prefixes.withColumn("component", F.col("node"))
    labels = components(links).toDF("k", "component")
    return (prefixes.join(labels, F.col("node") == F.col("k"), "left")
            .select("token", "node", "n", "weight", "place", F.coalesce("component", "node").alias("component")))


def _cross_pairs(labelled: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) of different components that share a bucket and can be linked by size and place.

    Taken from the side of the documents outside their bucket's largest component. Buckets meet
    them as arrays of at most about CHUNK members, and a document's arrays are merged before
    its pairs are written out, so a pair that shares many tokens is one row.
    """
    sizes = labelled.groupBy("token", "component").agg(F.count("*").alias("members"))
    major = (sizes.groupBy("token").agg(F.max(F.struct("members", "component")).alias("major"), F.count("*").alias("parts"),
                                        F.sum("members").alias("members"))
             .filter("parts > 1").select("token", F.col("major.component").alias("major"), "members"))
    buckets = settle(labelled.join(major, "token").withColumn("minor", F.col("component") != F.col("major")))
    chunks = max(1, -(-(buckets.agg(F.max("members")).first()[0] or 0) // CHUNK))
    arrays = (buckets.withColumn("chunk", F.pmod(F.xxhash64("node"), F.lit(chunks)))
              .groupBy("token", "chunk").agg(F.collect_list(F.struct("node", "n", "place", "component", "minor")).alias("others")))
    ones = buckets.filter("minor").select("token", *[F.col(c).alias(f"a_{c}") for c in ("node", "n", "place", "component")])

    def fits(x):
        common = F.ceil((F.col("a_n") + x["n"]) * percent / (100 + percent))  # shingles that a linked pair has in common
        return ((x["component"] != F.col("a_component")) & (~x["minor"] | (F.col("a_node") < x["node"]))
                & (F.least(F.col("a_n"), x["n"]) * 100 >= F.greatest(F.col("a_n"), x["n"]) * percent)
                & (F.col("a_place") <= F.col("a_n") - common + 1) & (x["place"] <= x["n"] - common + 1))

    met = (ones.join(arrays, "token")
           .select(F.col("a_node").alias("a"), "chunk", F.transform(F.filter("others", fits), lambda x: x["node"]).alias("others"))
           .filter(F.size("others") > 0))
    merged = met.groupBy("a", "chunk").agg(F.array_distinct(F.flatten(F.collect_list("others"))).alias("others"))
    return merged.select("a", F.explode("others").alias("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def link_sets(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) between distinct sets (node, n, tokens, second, third) that join all components."""
    rows = sets.select("node", "n", F.explode("tokens").alias("token"))
    common = rows.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    shared = rows.join(common, "token")
    need = F.ceil(F.col("n") * percent / 100).cast("long")
    # Tokens of this document alone come first in the order, so they use up its prefix before the shared ones.
    left = F.greatest(F.lit(0), F.col("n") - need + 1 - (F.col("n") - F.size("line"))).cast("int")
    prefixes = settle(shared.groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("line"))
                      .withColumn("weight", (F.aggregate("line", F.lit(0).cast("long"), lambda s, x: s + x["df"]) * 16 / F.col("n")).cast("long"))
                      .select("node", "n", "weight", (F.col("n") - F.size("line")).alias("alone"),
                              F.posexplode(F.slice("line", F.lit(1), left)).alias("at", "one"))
                      .select("one.token", "node", "n", "weight", (F.col("alone") + F.col("at") + 1).cast("long").alias("place")))
    nodes, links, labelled = sets.count(), None, _labelled(prefixes, None)
    # The first hub is the document whose tokens are the most frequent, the text that copies were made from;
    # where that is missing, later rounds try others.
    spread = F.struct((-F.col("weight")).alias("h"), "node", "n", "component")
    while True:
        hubs = (labelled.groupBy("token").agg(F.min(spread).alias("hub"), F.count("*").alias("members"),
                                              F.min("component").alias("low"), F.max("component").alias("high"))
                .filter("low < high").select("token", "hub", "members"))
        pairs = (labelled.join(hubs, "token")
                 .filter((F.col("component") != F.col("hub.component"))
                         & (F.least("n", "hub.n") * 100 >= F.greatest("n", "hub.n") * percent))
                 .groupBy("node").agg(F.max(F.struct("members", "hub.node")).alias("best"))
                 .select(F.col("node").alias("a"), F.col("best.node").alias("b")))
        new = settle(_verified(pairs, sets, percent))
        found = new.count()
        if found:
            links = new if links is None else links.union(new)
            labelled = settle(_labelled(prefixes, links))
        # Further stars pay only while they still join a good part of the documents.
        if found * 50 <= nodes:
            break
        spread = F.struct(F.xxhash64("node", F.lit(found)).alias("h"), "node", "n", "component")
    pairs = _cross_pairs(labelled.drop("weight"), percent)
    last = settle(_verified(settle(pairs), sets, percent))
    return last if links is None else links.union(last)


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per document."""
    known = profiles(docs, doc_id, text, percent, width)
    named = known.filter("doc_id IS NOT NULL AND n > 0")
    classes = settle(named.groupBy("hi", "lo").agg(F.min("doc_id").alias("node")))
    open_nodes = settle(named.filter("cnt >= need").select("doc_id").join(classes.select("node"), F.col("doc_id") == F.col("node"), "left_semi"))
    texts = docs.select(F.col(doc_id).cast("long").alias("node"), F.col(text).alias("text"))
    remaining = texts.join(open_nodes, F.col("node") == F.col("doc_id"), "left_semi")
    sets = settle(remaining.mapInArrow(_set_rows(percent, width), "node long, n long, tokens array<long>, second array<long>, third array<long>")
                  .dropDuplicates(["node"]))
    labels = components(link_sets(sets, percent)).toDF("k", "component")
    of_class = settle(classes.join(labels, F.col("node") == F.col("k"), "left")
                      .select(F.col("hi").alias("c_hi"), F.col("lo").alias("c_lo"), F.coalesce("component", "node").alias("component")))
    joined = known.join(of_class, (F.col("hi") == F.col("c_hi")) & (F.col("lo") == F.col("c_lo")), "left")
    rows = joined.select("doc_id", F.col("n").alias("n_shingles"),
                         F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
                         F.col("copies"))
    return rows.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copies", "copy")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` with one document, the smallest id, of each component; rows without an id stay, repeated rows become one.

    The ids to drop, narrow and few, go against the documents: an anti-join that Spark
    broadcasts below its threshold.
    """
    key, = fresh(docs, "near_id")
    groups = near_groups(docs, doc_id, **options)
    dropped = settle(groups.filter("component_id < doc_id").select(F.col("doc_id").alias(key)).distinct())
    repeated = settle(groups.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias(key)))
    left = docs.join(dropped, F.col(doc_id) == F.col(key), "left_anti")
    once = left.join(repeated, F.col(doc_id) == F.col(key), "left_anti")
    return once.unionByName(left.join(repeated, F.col(doc_id) == F.col(key), "left_semi").dropDuplicates([doc_id]))


def query(spark, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
