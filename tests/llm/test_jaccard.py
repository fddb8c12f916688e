import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from adlode.llm import jaccard
from adlode.llm.common import WORD, table
from tests.conftest import SMALL

UPPER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string"


def brute(rows):
    """doc_id -> (n_shingles, component_id) by comparing all pairs of sets of words."""
    sets = {}
    for doc_id, text in rows:
        words = re.findall(WORD, (text or "").translate(UPPER))
        sets[doc_id] = {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {d: (len(s), root(d)) for d, s in sets.items()}


def found(frame):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in frame.collect()}


def test_whole_table_equals_brute_force(spark):
    docs = table(spark, SMALL, "documents")
    assert found(jaccard.query(spark, SMALL)) == brute([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("seed", range(3))
def test_chains_and_borderline_copies(spark, seed):
    """Copies of copies: neighbours are linked, ends are not, and similarities lie around the threshold."""
    rng = random.Random(seed)
    rows, base = [], [f"w{rng.randrange(400)}" for _ in range(60)]
    for k in range(120):
        if k % 20 == 0:
            base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 6, 12, 60]))]
        base = list(base)
        for _ in range(rng.choice([0, 1, 1, 2])):
            base[rng.randrange(len(base))] = f"w{rng.randrange(400)}"
        rows.append((1000 - k, " ".join(base)))
    rng.shuffle(rows)
    assert found(jaccard.near_groups(spark.createDataFrame(rows, SCHEMA).repartition(5))) == brute(rows)


def test_shared_passage_is_no_link_but_case_and_white_space_are_ignored(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, passage + " " + " ".join(f"own{i}x{j}" for j in range(60))) for i in range(20)]
    rows += [(100, "A b c d e f"), (101, "a  B\tc\nd e F"), (102, "a b c d É f"), (103, "a b c d é f"),
             (104, "one two"), (105, "ONE two"), (106, "two one"), (107, ""), (108, None), (109, " \n"), (110, "one  two three")]
    assert found(jaccard.near_groups(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_edges_of_the_input(spark):
    assert found(jaccard.near_groups(spark.createDataFrame([], SCHEMA))) == {}
    rows = [(3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (5, "a b c d e f"), (9, "x " * 30000)]
    frame = jaccard.near_groups(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, frame.collect()), key=str) == [(3, 2, 3), (3, 2, 3), (5, 2, 3), (9, 1, 9), (None, 2, None)]


def test_one_of_each_keeps_all_columns(spark):
    rows = [(5, "a b c d e f", 1, "n"), (3, "a b c d e f", 2, None), (3, "a b c d e f", 2, None), (None, None, 3, "x"), (7, "", 4, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, near_id int, component_id string")
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == [(3, "a b c d e f", 2, None), (7, "", 4, "y"), (None, None, 3, "x")]


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(0, 60) if i % 20 != 19]
    labels = jaccard.components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in labels.collect()} == {i: i // 20 * 20 for i in range(60)}


def test_buckets_follow_the_size_of_the_input(spark):
    docs = table(spark, SMALL, "documents").select("doc_id", "text")
    largest = []
    for copies in (1, 4):
        many = docs.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).select(
            (F.col("doc_id") * 10 + F.col("copy")).alias("doc_id"), F.expr("replace(text, ' ', concat('x', copy, ' '))").alias("text"))
        buckets = jaccard._buckets(many, "text", 1000)
        sampled = many.mapInArrow(jaccard._sampled(buckets, 75, 5), f"bucket int, block int, tokens array<long>, owners array<long>, {jaccard.ARRAYS}")
        largest.append(sampled.groupBy("bucket").agg(F.sum(F.coalesce(F.size("tokens"), F.lit(0))).alias("n")).agg(F.max("n")).first()[0])
    assert max(largest) <= 1000
    rows = [sorted(map(tuple, jaccard.profiles(docs, "doc_id", "text", 75, 5, **size).collect())) for size in ({}, {"per_bucket": 1000})]
    assert rows[0] == rows[1] and len(rows[0]) == docs.distinct().count()


def test_a_bucket_stays_small_beside_a_worker(spark):
    """A group that a Python worker loads whole holds about 16 MB of shingles and owners, not 64."""
    assert jaccard.SHINGLES * 16 <= 16 << 20
    docs = spark.createDataFrame([(i, "x" * 4000) for i in range(4000)], "doc_id long, text string")
    few = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert jaccard._buckets(docs, "text", 100_000) > few
