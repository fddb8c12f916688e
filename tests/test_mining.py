from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from adlode.operators import archetypes as A, clusters as K, rules as R


def frame(spark, baskets):
    return spark.createDataFrame(list(enumerate(baskets)), "id int, items array<string>")


def by_hand(baskets, support, sizes=(1, 2, 3)):
    baskets = [b for b in baskets if b]
    names = sorted({x for b in baskets for x in b})
    counts = {c: sum(set(c) <= set(b) for b in baskets) for k in sizes for c in combinations(names, k)}
    return {c: n for c, n in counts.items() if n and n / len(baskets) >= support}, len(baskets)


def rules_by_hand(counts, n, confidence, lift):
    found = {}
    for items, count in counts.items():
        for k in range(1, len(items)):
            for left in combinations(items, k):
                right = tuple(sorted(set(items) - set(left)))
                c = (count / n) / (counts[left] / n)
                ratio = c / (counts[right] / n)
                if c >= confidence and ratio >= lift:
                    found[left, right] = (count / n, c, ratio)
    return found


baskets_of = st.lists(st.lists(st.sampled_from("ABCDEFG"), unique=True, max_size=6), min_size=1, max_size=60)


@settings(max_examples=8, deadline=None)
@given(baskets_of, st.sampled_from([0.05, 0.07, 0.1, 0.2, 0.5]))
def test_itemsets_and_rules(spark, baskets, support):
    expected, n = by_hand(baskets, support)
    rows = frame(spark, baskets)
    found = R.itemsets(rows, support)
    assert {tuple(r["items"]): r["count"] for r in found.collect()} == expected
    rules = {(tuple(r["antecedent"]), tuple(r["consequent"])): (r["support"], r["confidence"], r["lift"])
             for r in R.association_rules(found, 0.4, 1.2).collect()}
    assert rules == rules_by_hand(expected, n, 0.4, 1.2)
    assert all(abs(rules[b, a][2] - v[2]) < 1e-12 for (a, b), v in rules.items() if (b, a) in rules)


def test_fpgrowth_gives_the_same(spark):
    baskets = [list("ABC"), list("AB"), list("AC"), list("BCD"), list("ABCD"), [], list("E")] * 20
    rows = frame(spark, [b for b in baskets if b])
    want = {tuple(r["items"]): (r["count"], r["support"]) for r in R.itemsets(rows, 0.07).collect()}
    assert want == {tuple(r["items"]): (r["count"], r["support"]) for r in R.itemsets_fpgrowth(rows, 0.07).collect()}


def test_empty_baskets_count_on_no_path(spark):
    rows = frame(spark, [list("ABC"), list("AB"), list("C"), [], [], []])
    want = {("A",): 2, ("B",): 2, ("C",): 2, ("A", "B"): 2}
    for found in (R.itemsets(rows, 0.5), R.itemsets_fpgrowth(rows, 0.5)):
        assert {tuple(r["items"]): r["count"] for r in found.collect()} == want
        assert {r["support"] for r in found.collect()} == {2 / 3}


def test_parts_of_long_baskets_give_the_same(spark, monkeypatch):
    rows = frame(spark, [list("ABCDEFG"), list("ABDG"), list("CEG")])
    want = {tuple(r["items"]): r["count"] for r in R.itemsets(rows, 0.3).collect()}
    monkeypatch.setattr(R, "PART_ITEMS", 2)
    assert want == {tuple(r["items"]): r["count"] for r in R.itemsets(rows, 0.3).collect()}


def test_long_basket(spark):
    found = R.itemsets(frame(spark, [[f"i{k}" for k in range(200)]]), 0.5)
    assert {r["size"]: r["count"] for r in found.groupBy("size").count().collect()} == {1: 200, 2: 19900, 3: 1313400}


def test_empty_and_sizes(spark):
    assert R.itemsets(frame(spark, [[], []])).count() == 0
    assert R.association_rules(R.itemsets(frame(spark, [[]]))).count() == 0
    rows = frame(spark, [list("ABC")] * 3)
    assert [R.itemsets(rows, 0.5, k).count() for k in (1, 2, 3)] == [3, 6, 7]
    with pytest.raises(ValueError):
        R.itemsets(rows, 0.5, 4)


def test_least_count():
    assert [R.least_count(100, 0.07), R.least_count(122, 0.05), R.least_count(10, 0.0), R.least_count(3, 1.0)] == [7, 7, 0, 3]


def test_rule_figures(spark):
    # 122 listings: 14 with Oracle, 11 with JavaScript and SQL, 7 with all three
    baskets = [["JavaScript", "Oracle", "SQL"]] * 7 + [["Oracle"]] * 7 + [["JavaScript", "SQL"]] * 4 + [["x"]] * 104
    table = {(r["if_skills"], r["then_skills"]): tuple(r)[2:]
             for r in R.rule_table(R.association_rules(R.itemsets(frame(spark, baskets)))).collect()}
    assert table["Oracle", "JavaScript + SQL"] == (0.057, 0.5, 5.545)
    assert table["JavaScript + SQL", "Oracle"] == (0.057, 0.636, 5.545)


@pytest.mark.parametrize("costs, k", [
    ([2847, 2156, 1623, 1334, 1145, 1001], 5), ([10, 5], 3), ([], 3), ([9, 6, 3, 0], 4), ([100, 10, 9, 8], 4)])
def test_elbow(spark, costs, k):
    rows = spark.createDataFrame([(i + 3, float(c)) for i, c in enumerate(costs)], "k int, cost double")
    assert K.elbow(rows).first()["k"] == k


@pytest.mark.parametrize("skills, label", [
    (["Docker", "AWS", "Java"], "DevOps / Cloud Engineer"),
    (["Linux", "Networking", "TCP/IP", "Monitoring"], "Systems Administrator"),
    (["Networking", "TCP/IP"], "Systems Administrator"),
    (["Java", "Flutter"], "Mobile Developer"), (["Tableau", "Flutter"], "Data Analyst"),
    (["Java"], "General IT"), (["Docker"], "General IT"), ([], "General IT")])
def test_archetype(column, skills, label):
    assert column([(skills,)], "s array<string>", A.archetype(F.col("s"))) == [label]


def test_cluster_roles(spark):
    kinds = [["Docker", "AWS", "Linux"], ["React", "CSS", "HTML"], ["Oracle", "COBOL", "DB2"]]
    rows = [(i, f"t{i}", kinds[i % 3][: 2 + i % 2]) for i in range(90)] + [(900 + i, "none", []) for i in range(5)]
    tagged = spark.createDataFrame(rows, "raw_id long, title string, skills array<string>")
    listed, profiles = K.cluster_roles(tagged, k=3, restarts=4)
    listed, profiles = listed.collect(), profiles.collect()
    assert len(listed) == 90 and {r["archetype"] for r in listed} == {
        "DevOps / Cloud Engineer", "Frontend Developer", "Enterprise/ERP Consultant"}
    assert sum(p["size"] for p in profiles) == 90 and {p["pct_of_total"] for p in profiles} == {33.3}
    for r in listed:
        assert r["archetype"] == next(p["archetype"] for p in profiles if p["cluster_id"] == r["cluster_id"])


def test_weights_are_the_cluster_centres(spark):
    rows = [(i, "", [s for j, s in enumerate("ABCDE") if (i >> j) & 1 or i % 5 == j]) for i in range(64)]
    tagged = spark.createDataFrame(rows, "raw_id long, title string, skills array<string>")
    points, words = K.weighted_points(tagged)
    model = K.fit_best(points, words, 3, 3)
    costs = [c for _, c in K.costs_by_k(points, words, 64, 2, 9, restarts=2)]
    assert costs == sorted(costs, reverse=True)
    assigned = model.transform(points)
    sizes = dict(assigned.groupBy("cluster_id").agg(F.sum("weight")).collect())
    having = assigned.select("cluster_id", "weight", F.explode("skills").alias("s")).groupBy(
        "cluster_id", "s").agg(F.sum("weight").alias("w")).collect()
    for r in having:
        assert abs(model.centres[r["cluster_id"]][words.index(r["s"])] - r["w"] / sizes[r["cluster_id"]]) < 1e-12
    assert tuple(K.misplaced(assigned).first()) == (64, 3, 0)
    wrong = assigned.withColumn("cluster_id", (F.col("cluster_id") + F.size("skills")) % 3)
    assert K.misplaced(wrong).first()["misplaced"] > 0


def test_fit_equals_plain_lloyd(spark):
    """The first start and every step beside plain numpy; the same whatever the partitions; ties and few points."""
    rng = np.random.default_rng(5)
    rows = [(i, "", [s for s, on in zip("ABCDEFG", rng.random(7) < 0.4) if on]) for i in range(150)]
    points, words = K.weighted_points(spark.createDataFrame(rows, "raw_id long, title string, skills array<string>"))
    model = K.fit_best(points, words, 4, 1)
    sets = sorted((r["skills"], r["weight"]) for r in points.collect())
    x, w = np.array([[float(s in skills) for s in words] for skills, _ in sets]), np.array([float(n) for _, n in sets])

    def away(c):
        return ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)

    centres = x[[max(range(len(w)), key=lambda i: (w[i], sets[i][0]))]]
    while len(centres) < 4:
        pull = w * away(centres).min(axis=1)
        centres = np.vstack([centres, x[max(range(len(w)), key=lambda i: (pull[i], sets[i][0]))]])
    for _ in range(300):
        nearest = away(centres).argmin(axis=1)
        moved = np.array([np.average(x[nearest == j], axis=0, weights=w[nearest == j]) for j in range(4)])
        if np.allclose(moved, centres, atol=1e-14):
            break
        centres = moved
    assert np.allclose(model.centres, centres) and abs(model.cost - (w * away(centres).min(axis=1)).sum()) < 1e-9
    again = K.fit_best(points.repartition(3), words, 4, 1)
    assert np.array_equal(again.centres, model.centres)
    assert K.fit_best(points, words, 4, 5).cost <= model.cost
    few = points.limit(2)
    fit = K.fit_best(few, words, 4, 2)
    assert len(fit.centres) == 2 and fit.cost == 0
    assert K.misplaced(fit.transform(few)).first()["misplaced"] == 0


def test_too_few_listings(spark):
    tagged = spark.createDataFrame([(1, "t", ["A"])], "raw_id long, title string, skills array<string>")
    with pytest.raises(ValueError):
        K.cluster_roles(tagged)
