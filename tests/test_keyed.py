import random
import statistics

import pytest
from pyspark.sql import functions as F

from wardlog.operators import keyed as K
from wardlog.operators.neighbors import nearest_vectors


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, missing keys, a long tail, and copies."""
    k = F.col("id")
    key = F.when(k % 3 == 0, "hot").when(k % 31 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), k % 4000))
    return spark.range(12000).select((k % 9000).alias("id"), key.alias("key"), (k % 7).alias("x"))


@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
def test_attach_keeps_every_row_and_value(spark, skewed, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        stats = skewed.where("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("x").alias("m"))
        got = K.attach_by_key(skewed, stats, ["key"], ["n", "m"], "n")
        want = skewed.join(stats, "key", "left").select("id", "key", "x", "n", "m")
        assert got.columns == ["id", "key", "x", "n", "m"]
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_hot_rows_do_not_meet_in_one_partition(spark, skewed):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        stats = skewed.where("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        sizes = [r[1] for r in K.attach_by_key(skewed, stats, ["key"], ["n"], "n").groupBy(
            F.spark_partition_id()).count().collect()]
        assert max(sizes) < 1.5 * sum(sizes) / len(sizes)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_only_limits_the_lookup(skewed):
    stats = skewed.where("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    got = K.attach_by_key(skewed, stats, ["key"], ["n"], "n", only=F.col("x") == 3)
    assert got.where("n is not null and x <> 3").isEmpty()
    assert got.where("n is null and x = 3 and key is not null").isEmpty()


def test_rank_cutoffs_with_ties(rows):
    rng = random.Random(3)
    data = [(i, rng.choice("ab"), rng.randrange(20)) for i in range(400)]
    df = rows(data, "id int, g string, v int")
    order = K.hash_order(F.col("id"), 1)
    targets = rows([("a", 1, 1), ("a", 2, 57), ("b", 1, 100), ("b", 2, 10_000), ("a", 3, 0)], "g string, target int, rank int")
    cuts = {(r.g, r.target): (r.cut_0, r.cut_1) for r in K.rank_cutoffs(df, ["g"], [F.col("v"), order], targets).collect()}
    ranked = {g: sorted((v, h) for gg, v, h in df.select("g", "v", order).collect() if gg == g) for g in "ab"}
    assert cuts == {("a", 1): ranked["a"][0], ("a", 2): ranked["a"][56], ("b", 1): ranked["b"][99]}


@pytest.mark.parametrize("values", [
    [1.0], [5.0, 5.0, 5.0], [random.Random(1).gauss(0, 1) for _ in range(501)],
    [0.0] * 300 + [1e12] + [random.Random(2).random() * 1e-6 for _ in range(200)]])
def test_exact_quantiles(rows, values):
    df = rows([(float(v),) for v in values], "x double")
    got = {r.prob: r.quantile for r in K.exact_quantiles(df, [], F.col("x"), [0.0, 0.1, 0.5, 0.9, 1.0]).collect()}
    ordered = sorted(values)
    for p, q in got.items():
        at = (len(ordered) - 1) * p
        low = int(at)
        high = min(low + 1, len(ordered) - 1)
        assert q == pytest.approx(ordered[low] + (ordered[high] - ordered[low]) * (at - low), abs=1e-12)
    assert got[0.5] == pytest.approx(statistics.median(values), abs=1e-12)


def test_brackets_leave_most_values_uncounted(spark, monkeypatch):
    monkeypatch.setattr(K, "SKETCH", 200)
    data = spark.range(20_000).select((F.col("id") % 2).alias("g"), F.xxhash64("id").cast("double").alias("x"), "id")
    near = K.bracket_counts(data, ["g"], "x", [0.25, 0.9])
    held = near.collect()
    assert len(held) < 20_000 * 2 * 0.06
    by_group = {g: sorted(r.x for r in data.collect() if r.g == g) for g in (0, 1)}
    for r in held:
        assert r.n == 10_000 and by_group[r.g][r.upto - 1] == r.x
    got = {(r.g, r.prob): r.quantile for r in K.exact_quantiles(data, ["g"], F.col("x"), [0.25, 0.9]).collect()}
    for (g, p), q in got.items():
        at = 9_999 * p
        low = by_group[g][int(at)]
        assert q == pytest.approx(low + (by_group[g][int(at) + 1] - low) * (at - int(at)), rel=1e-12)


@pytest.mark.parametrize("rank", [0, 1, 777, 49_999, 50_000, 50_001])
def test_hash_cutoffs_equal_a_sort(spark, rank):
    df = spark.range(50_000)
    order = K.hash_order(F.col("id"), 3)
    cut = K.hash_cutoffs(df, [], order, spark.range(1).select(F.lit(rank).alias("rank"), F.lit(50_000).alias("n"))).collect()
    ranked = sorted(r[0] for r in df.select(order).collect())
    assert [r.cut for r in cut] == ([ranked[rank - 1]] if 1 <= rank <= 50_000 else [])


def test_hash_cutoffs_with_one_repeated_key(spark):
    df = spark.range(1000).select(F.lit(1).alias("id"))
    marked = K.lowest_by_hash(df, [], K.hash_order(F.col("id"), 3), spark.range(1).select(F.lit(10).alias("rank")))
    assert marked.where("_picked").count() in (0, 1000)


def test_running_totals(rows):
    data = [(i, (i * 37) % 11) for i in range(500)]
    random.Random(0).shuffle(data)
    out = K.running_totals(rows(data, "k int, n int"), ["k"], {"s": "n"}).orderBy("k").collect()
    total = 0
    for r in out:
        total += r.n
        assert r.s == total


def test_lowest_by_hash_is_exact_and_stable(spark):
    df = spark.range(5000).withColumn("g", F.col("id") % 3 == 0)
    quota = spark.createDataFrame([(True, 10), (False, 333)], "g boolean, rank int")
    picks = []
    for parts in (1, 7):
        marked = K.lowest_by_hash(df.repartition(parts), ["g"], K.hash_order(F.col("id"), 5), quota)
        assert {r.g: r["count"] for r in marked.where("_picked").groupBy("g").count().collect()} == {True: 10, False: 333}
        picks.append({r.id for r in marked.where("_picked").collect()})
    assert picks[0] == picks[1]


def test_nearest_vectors_match_brute_force(rows):
    import numpy as np

    rng = np.random.default_rng(0)
    x = np.unique(np.concatenate([rng.normal(0, 1, (250, 3)), rng.normal(4, .1, (150, 3)),
                                  rng.integers(0, 3, (120, 3)).astype(float)]), axis=0)
    df = rows([(f"v{i:04d}", [float(a) for a in p], 1) for i, p in enumerate(x)], "vid string, x array<double>, mult long")
    got = nearest_vectors(df, 5, cell_rows=40).orderBy("vid").collect()
    distance = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(distance, np.inf)
    distance.sort(axis=1)
    assert np.allclose([[c.distance for c in r.near] for r in got], distance[:, :5])
    few = nearest_vectors(df.limit(3), 5, cell_rows=1).collect()
    assert [len(r.near) for r in few] == [2, 2, 2]
