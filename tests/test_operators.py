"""Operators against brute force on small fixtures with skewed keys."""

import math
import random
from collections import Counter
from itertools import combinations
from statistics import median

import pytest
from pyspark.sql import functions as F

from offerscope.operators.dedup import oldest_then_latest_arrival, two_pass
from offerscope.operators.filters import dataset_label, select_dataset, within_age
from offerscope.operators.groups import crosstab, fixed_bins, rank_by, seeded_sample, top_n_per_group, with_grand_total
from offerscope.operators.pairs import pair_lift
from offerscope.operators.premium import with_and_without
from offerscope.operators.quantiles import Quantile, quantiles, value_bucket
from offerscope.operators.skew import salted_join, spread
from offerscope.operators.terms import term_frequencies

STATS = [Quantile("med"), Quantile("q1", "nearest", 0.25), Quantile("q3", "nearest", 0.75),
         Quantile("p10", "linear", 0.1)]


def brute(values):
    v = sorted(values)
    n = len(v)
    near = lambda p: v[math.floor(p * (n - 1) + 0.5)]
    at = 0.1 * (n - 1)
    low = v[math.floor(at)]
    return n, median(v), near(0.25), near(0.75), low + (v[math.ceil(at)] - low) * (at - math.floor(at))


@pytest.fixture(scope="module")
def measures(spark):
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        group = "hot" if i % 3 else rng.choice(["a", "b", None, "c"])
        value = rng.choice([None, 0.0, -1.5, float(rng.randint(-50, 50)), rng.lognormvariate(8, 3),
                            -rng.random(), 2.0 ** rng.randint(-3, 12), 49000.0])
        rows.append((group, value))
    rows += [("one", 7.0), ("two", 1.0), ("two", 2.0), ("none", None)]
    return rows, spark.createDataFrame(rows, "g string, v double").repartition(5)


def test_quantiles_match_brute_force(measures):
    rows, df = measures
    got = {r.g: r for r in quantiles(df, ["g"], "v", STATS).collect()}
    groups = {g for g, v in rows if v is not None}
    assert set(got) == groups
    for g in groups:
        want = brute([v for x, v in rows if x == g and v is not None])
        r = got[g]
        assert (r.n, r.med, r.q1, r.q3) == want[:4]
        assert r.p10 == pytest.approx(want[4])


def test_quantiles_take_infinite_values(spark):
    df = spark.createDataFrame([(v,) for v in (float("-inf"), 3.0, float("inf"), float("inf"), float("nan"), None)], "v double")
    r = quantiles(df, [], "v", [Quantile("low", "nearest", 0.0), Quantile("mid"), Quantile("high", "nearest", 1.0)]).first()
    assert tuple(r) == (4, float("-inf"), float("inf"), float("inf"))


def test_rank_by_gives_ties_one_rank(spark):
    df = spark.createDataFrame([("a", 5, 1), ("a", 5, 2), ("a", 3, 3), ("b", 1, 4)], "g string, n long, id long")
    assert {r.id: r["rank"] for r in rank_by(df, ["g"], "n").collect()} == {1: 1, 2: 1, 3: 3, 4: 1}


def test_quantiles_without_groups(measures):
    rows, df = measures
    r = quantiles(df, [], "v", STATS).first()
    assert (r.n, r.med) == brute([v for _, v in rows if v is not None])[:2]


def test_value_bucket_is_monotone(spark):
    rng = random.Random(1)
    values = sorted([rng.lognormvariate(0, 20) * rng.choice([-1, 1]) for _ in range(2000)]
                    + [s * 2.0 ** e * (1 + d) for e in range(-40, 40) for s in (-1, 1) for d in (0, 1e-16, 1e-15, -1e-16)]
                    + [0.0])
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    buckets = [r.b for r in df.select("i", value_bucket(F.col("v")).alias("b")).orderBy("i").collect()]
    assert buckets == sorted(buckets)


def test_premium_matches_the_grid(spark):
    rng = random.Random(9)
    baskets = [(i, None if i % 7 == 0 else rng.choice([rng.randint(1, 30) * 10.0, rng.random() * 1000])) for i in range(600)]
    links = {(i, s) for i, _ in baskets for s, p in (("hot", .9), ("a", .3), ("b", .05), ("all", 1), ("c", .5)) if rng.random() < p}
    links |= {(0, "never measured")}
    got = {r.s: r for r in with_and_without(
        spark.createDataFrame(baskets, "id int, v double"), spark.createDataFrame(sorted(links), "id int, s string"),
        "id", "s", "v").collect()}
    measured = [(i, v) for i, v in baskets if v is not None]
    for s in ("hot", "a", "b", "c"):
        yes, no = [v for i, v in measured if (i, s) in links], [v for i, v in measured if (i, s) not in links]
        r = got[s]
        assert (r.n_with, r.n_without, r.median_with, r.median_without) == (len(yes), len(no), median(yes), median(no))
    assert "all" not in got and "never measured" not in got


def test_pairs_match_brute_force(spark):
    rng = random.Random(3)
    baskets = {i: {s for s in "abcdef" if rng.random() < .4} for i in range(300)}
    links = [(i, s) for i, items in baskets.items() for s in items]
    got = {(r.item_a, r.item_b): r for r in pair_lift(
        spark.createDataFrame(links, "id int, s string"), "id", "s", F.lit(300), minimum=5).collect()}
    together = Counter(p for items in baskets.values() for p in combinations(sorted(items), 2))
    single = Counter(s for _, s in links)
    assert {p: r.n for p, r in got.items()} == {p: n for p, n in together.items() if n >= 5}
    for (a, b), r in got.items():
        assert a < b and r.lift == pytest.approx(300 * r.n / (single[a] * single[b]), abs=0.006)


def test_two_pass_dedup_keeps_the_passes_apart(spark):
    # "x" loses to "y" in the first pass, so it must not win key 1 in the second.
    rows = [("A", "1", "2026-01-01", 1), ("A", "1", "2026-01-01", 2), ("B", "1", "2026-01-03", 3),
            ("C", "2", None, 4), ("D", "2", "2026-05-01", 5), ("E", "3", None, 6), ("F", "3", None, 7),
            ("G", "4", "2026-02-01", 8), ("G", "5", "2026-01-01", 9), ("H", "4", "2026-03-01", 10)]
    df = spark.createDataFrame(rows, "offer string, key string, day string, seq int") \
        .withColumn("day", F.to_date("day")).repartition(4)
    best = two_pass(df, ["offer"], ["key"], oldest_then_latest_arrival("day", ["seq"]), ["seq"])
    assert sorted(r.seq for r in best.collect()) == [2, 5, 7, 9, 10]


def test_dataset_modes(spark):
    df = spark.createDataFrame([("r", False), ("d", True), ("n", None)], "id string, is_demo boolean")
    ids = lambda x: sorted(r.id for r in x.collect())
    assert ids(select_dataset(df, "auto")) == ["n", "r"] and ids(select_dataset(df, "all")) == ["d", "n", "r"]
    demo = df.where("is_demo")
    assert ids(select_dataset(demo, "auto")) == ["d"] and ids(select_dataset(demo, "real")) == []
    label = lambda x, m: dataset_label(x, m).first()[0]
    assert label(df, "auto") == "réel" and label(demo, "auto") == "démo"
    assert label(df, "all") == "réel + démo" and label(demo, "all") == "démo" and label(df.where("id = 'r'"), "all") == "réel"
    with pytest.raises(ValueError):
        select_dataset(df, "some")


def test_age_limit_is_strict_and_keeps_undated(spark):
    df = spark.sql("SELECT * FROM VALUES (1, DATE '2026-09-01'), (2, DATE '2025-09-01'), (3, DATE '2025-08-31'), (4, NULL) t(id, day)")
    assert sorted(r.id for r in within_age(df, "day", 365).collect()) == [1, 2, 4]
    assert within_age(df, "day", None).count() == 4


def test_total_rows_are_flagged_and_null_groups_kept_apart(spark):
    df = spark.createDataFrame([("x", "s"), ("x", "s"), (None, "s"), ("y", "t")], "g string, s string")
    rows = {(r.g, r.s, r.is_total): r.n for r in with_grand_total(df, "g", ["s"], "Tous", F.count(F.lit(1))).collect()}
    assert rows == {("x", "s", False): 2, (None, "s", False): 1, ("y", "t", False): 1,
                    ("Tous", "s", True): 3, ("Tous", "t", True): 1}


def test_salted_join_equals_the_plain_join(spark):
    facts = spark.range(2000).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
        F.concat(F.lit("k"), F.col("id") % 50)).alias("k"))
    lookup = facts.select("k").distinct().where("k <> 'k7'").withColumn("v", F.length("k"))
    for how in ("inner", "left"):
        a = salted_join(facts, lookup, "k", ["id"], how).select("id", "k", "v")
        b = facts.join(lookup, "k", how).select("id", "k", "v")
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_small_reports(spark):
    df = spark.createDataFrame([("x", 5, "r"), ("x", 9, "s"), ("x", 9, "r"), ("y", 1, "r")], "g string, v int, c string")
    top = top_n_per_group(df, ["g"], [F.desc("v"), F.asc("c")], 2)
    assert sorted((r.g, r.v, r.c, r["rank"]) for r in top.collect()) == [("x", 9, "r", 1), ("x", 9, "s", 2), ("y", 1, "r", 1)]
    table = {r.g: (r.r, r.s, r.z) for r in crosstab(df, "g", "c", ["r", "s", "z"]).collect()}
    assert table == {"x": (66.6667, 33.3333, 0.0), "y": (100.0, 0.0, 0.0)}
    bins = spark.createDataFrame([(v,) for v in (19999.0, 20000.0, 24999.0, 25000.0, 99999.0, 100000.0, 100001.0)], "v double")
    assert {r.bin_start: r.n for r in fixed_bins(bins, "v", 20000.0, 100000.0, 5000.0).collect()} == {20000.0: 2, 25000.0: 1, 95000.0: 2}
    one = [r.id for r in seeded_sample(spark.range(100), "id", 5, seed=1).collect()]
    assert one == [r.id for r in seeded_sample(spark.range(100).repartition(7), "id", 5, seed=1).collect()]
    assert one != [r.id for r in seeded_sample(spark.range(100), "id", 5, seed=2).collect()]


def test_quantile_plan_never_gathers_a_group(spark, tmp_path):
    spark.range(1000).select((F.col("id") % 3).alias("g"), F.rand(1).alias("v")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = quantiles(df, ["g"], "v", STATS)._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "collect_list" not in plan and "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_term_frequencies_move_texts_once(spark):
    """No exchange of (document, term) rows: the one exchange deals whole texts; repeated ids add up."""
    docs = spark.createDataFrame([(1, "a", "rot rot blau"), (1, "a", "rot"), (2, "b", None), (None, "b", "blau")], "d long, g string, t string")
    counted = term_frequencies(docs, "d", "g", "t", [])
    assert sorted(map(str, map(tuple, counted.collect()))) == sorted(map(str, [
        (1, "a", "rot", 3), (1, "a", "blau", 1), (1, "a", "rot rot", 1), (1, "a", "rot blau", 1), (None, "b", "blau", 1)]))
    plan = counted._jdf.queryExecution().sparkPlan().toString() + counted._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(d" in plan and not [line for line in plan.splitlines() if "hashpartitioning(" in line and "term" in line]


def test_costly_work_is_spread_over_the_cores(spark):
    few = spark.range(1000).coalesce(1)
    assert spread(few, ["id"]).select(F.spark_partition_id().alias("p")).distinct().count() == 4
