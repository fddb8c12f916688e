"""Frequent itemsets and association rules over baskets ``(id, items)``.

``items`` is an array without duplicates. Equal baskets become one row with a
weight. Itemsets are then counted level by level, as only sizes up to three are
wanted, by joins over one row per basket and item: pairs of frequent items, then
triples whose pairs are all frequent. The pairs of a long basket are found in
several parts, so no array grows with a basket and no basket loads a single task;
counts are aggregated map-side by itemset.
"""

from functools import reduce
from itertools import combinations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame, functions as F

from adlode import constants as C
from adlode.functions.rounding import round_scaled
from adlode.session import settle

ITEMSETS = "items array<string>, size int, count bigint, support double"
# Items of a basket whose pairs are found in one part.
PART_ITEMS = 256


def basket_items(rows: DataFrame, key: str, item: str) -> DataFrame:
    """(key, items) from one row per item."""
    return rows.groupBy(key).agg(F.array_sort(F.collect_set(item)).alias("items")).filter(F.size("items") > 0)


def least_count(n: int, min_support: float) -> int:
    """The smallest count whose share of ``n`` reaches ``min_support``."""
    count = max(int(min_support * n) - 1, 0)
    while count / n < min_support:
        count += 1
    return count


def distinct_baskets(baskets: DataFrame, column: str = "items") -> DataFrame:
    """(column, weight): every different set of items with the number of baskets that have it, stored."""
    sets = baskets.select(F.array_sort(column).alias(column))
    return settle(sets.groupBy(column).agg(F.count(F.lit(1)).alias("weight"))).filter(F.size(column) > 0)


def _frequent(rows: DataFrame, names: list[str], n: int, least: int) -> DataFrame:
    """(*names, items, size, count, support) of the combinations of ``names`` with enough weight, stored."""
    counts = rows.groupBy(*names).agg(F.sum("weight").alias("count")).filter(F.col("count") >= least)
    return settle(counts.select(*names, F.array(*names).alias("items"), F.lit(len(names)).alias("size"), "count",
                                (F.col("count").cast("double") / n).alias("support")))


def itemsets(baskets: DataFrame, min_support: float = C.MIN_SUPPORT, max_size: int = C.MAX_ITEMSET) -> DataFrame:
    """(items, size, count, support) of all itemsets up to ``max_size`` (1 to 3) with enough support.

    Like a model fit this runs jobs: one per level. Empty baskets do not count.
    """
    if not 1 <= max_size <= 3:
        raise ValueError("max_size must be 1, 2 or 3")
    sets = distinct_baskets(baskets)
    n = sets.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    if not n:
        return sets.sparkSession.createDataFrame([], ITEMSETS)
    least = least_count(n, min_support)
    single = _frequent(sets.select("weight", F.explode("items").alias("a")), ["a"], n, least)
    levels = [single]

    if max_size >= 2:
        # numbered before its items become rows
        numbered = sets.withColumn("basket", F.monotonically_increasing_id())
        rows = numbered.select("basket", "weight", F.ceil(F.size("items") / PART_ITEMS).cast("int").alias("parts"),
                               F.explode("items").alias("a"))
        rows = settle(rows.join(single.select("a"), "a", "left_semi"))
        # an item is in one part of its basket and meets all later items there
        part = F.pmod(F.xxhash64("a"), F.col("parts")).cast("int")
        first = rows.select("basket", "weight", part.alias("part"), "a")
        second = rows.select("basket", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("a").alias("b"))
        # counted here and linked to triples below, so they are joined once
        pairs = settle(first.join(second, ["basket", "part"]).filter("a < b").select("basket", "weight", "a", "b"))
        level2 = _frequent(pairs, ["a", "b"], n, least)
        levels.append(level2)

    if max_size >= 3:
        # a basket's frequent pairs that share their first item make a triple where the third pair is frequent too
        known = level2.select("a", "b")
        linked = settle(pairs.join(known, ["a", "b"], "left_semi"))
        others = linked.select("basket", "a", F.col("b").alias("c"))
        triples = (linked.join(others, ["basket", "a"]).filter("b < c")
                   .join(known.toDF("b", "c"), ["b", "c"], "left_semi"))
        levels.append(_frequent(triples, ["a", "b", "c"], n, least))

    return reduce(DataFrame.unionByName, [level.select("items", "size", "count", "support") for level in levels])


def itemsets_fpgrowth(baskets: DataFrame, min_support: float = C.MIN_SUPPORT,
                      max_size: int = C.MAX_ITEMSET) -> DataFrame:
    """The same table from MLlib's FP-growth, as another way to the same result.

    FP-growth keeps counts of at least ceil(support * n); passing half a count less
    than the least wanted one keeps rounding from moving that limit.
    """
    baskets = baskets.filter(F.size("items") > 0)
    n = baskets.count()
    least = least_count(n, min_support)
    model = FPGrowth(itemsCol="items", minSupport=max((least - 0.5) / n, 0.0)).fit(baskets.select("items"))
    return (
        model.freqItemsets.filter(F.size("items") <= max_size)
        .select(
            F.array_sort("items").alias("items"), F.size("items").alias("size"), F.col("freq").alias("count"),
            (F.col("freq").cast("double") / F.lit(float(n))).alias("support"))
    )


def association_rules(itemsets: DataFrame, min_confidence: float = C.MIN_CONFIDENCE,
                      min_lift: float = C.MIN_LIFT) -> DataFrame:
    """(antecedent, consequent, support, confidence, lift) for every split of every itemset.

    Thresholds apply to unrounded values. The itemset table is small against the
    baskets, so the two look-ups by side are ordinary joins.
    """
    splits = F.array(*[
        F.when(F.size("items") > max(chosen),
               F.array(*[F.get("items", F.lit(i)) for i in chosen]))
        for size in (1, 2) for chosen in combinations(range(3), size)
    ])
    # a side has to be smaller than the itemset
    sides = F.filter(splits, lambda s: s.isNotNull() & (F.size(s) < F.size("items")))
    split = itemsets.filter("size > 1").select(
        "items", F.col("support").alias("support"), F.explode(sides).alias("antecedent"))
    split = split.withColumn("consequent", F.array_except("items", "antecedent"))
    known = itemsets.filter("size < 3")
    left = known.select(F.col("items").alias("antecedent"), F.col("support").alias("support_if"))
    right = known.select(F.col("items").alias("consequent"), F.col("support").alias("support_then"))
    rules = split.join(left, "antecedent").join(right, "consequent")
    rules = rules.withColumn("confidence", F.col("support") / F.col("support_if"))
    rules = rules.withColumn("lift", F.col("confidence") / F.col("support_then"))
    return (
        rules.filter((F.col("lift") >= F.lit(min_lift)) & (F.col("confidence") >= F.lit(min_confidence)))
        .select("antecedent", "consequent", "support", "confidence", "lift")
    )


def rule_table(rules: DataFrame, digits: int | None = 3) -> DataFrame:
    """Rules for display: sides joined with ' + ', figures rounded, highest lift first."""
    shown = rules.select(
        F.array_join(F.array_sort("antecedent"), " + ").alias("if_skills"),
        F.array_join(F.array_sort("consequent"), " + ").alias("then_skills"),
        *[F.col(c) if digits is None else round_scaled(F.col(c), digits).alias(c)
          for c in ("support", "confidence", "lift")],
    )
    return shown.orderBy(F.desc("lift"), F.desc("confidence"), "if_skills", "then_skills")
