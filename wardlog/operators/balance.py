"""Training-set assembly: conform, merge, rebalance, resample and split.

All sampling orders rows by ``md5(key, seed)``: the choice does not depend on
partitioning, and a quota becomes one hash bound per group (see
``keyed.lowest_by_hash``), so no rows are shuffled or sorted to draw a sample.
``key`` names a unique row key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlog.operators import keyed
from wardlog.operators.keyed import MAX_CLASSES, hash_order, lowest_by_hash, rank_cutoffs, scalar
from wardlog.schema import TRAINING, conform
from wardlog.session import materialize

# Sources whose attack rows are dropped first, in this order.
DROP_PRIORITY = ("Kaggle", "Synthetic", "Custom", "Russell Mitchell")
TARGET_ATTACK_RATIO = 0.6
SEED = 42


def conform_training(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Exactly the 21 training columns; geography numeric, null label false."""
    rows = conform(df, TRAINING, keep)
    return (rows.fillna(0.0, ["geoip_country", "geoip_city"])
            .withColumn("is_attack", F.coalesce("is_attack", F.lit(False))))


def merge_sources(sources: dict[str, DataFrame], keep: tuple[str, ...] = ()) -> DataFrame:
    """Union of conformed sources tagged with ``_source``."""
    result = None
    for name, frame in sources.items():
        tagged = conform_training(frame, keep).withColumn("_source", F.lit(name))
        result = tagged if result is None else result.unionByName(tagged)
    if result is None:
        raise ValueError("no training sources")
    return result


def attack_quotas(df: DataFrame, ratio: float = TARGET_ATTACK_RATIO) -> DataFrame:
    """Attack rows to keep per priority group (``_grp``, ``rank``, and all its ``n``), one row each.

    Group 4 holds every source outside the priority list; it is cut only if it
    alone exceeds the target.
    """
    group = F.lit(len(DROP_PRIORITY))
    for i, name in reversed(list(enumerate(DROP_PRIORITY))):
        group = F.when(F.col("_source") == name, i).otherwise(group)
    counts = df.groupBy(group.alias("_grp"), F.col("is_attack").alias("_a")).agg(F.count(F.lit(1)).alias("_n"))
    here = lambda i: F.coalesce(F.sum(F.when(F.col("_a") & (F.col("_grp") == i), F.col("_n"))), F.lit(0))
    last = len(DROP_PRIORITY)
    one = counts.agg(
        F.coalesce(F.sum(F.when(~F.col("_a"), F.col("_n"))), F.lit(0)).alias("normal"),
        *[here(i).alias(f"n{i}") for i in range(last + 1)])
    attacks = sum((F.col(f"n{i}") for i in range(1, last + 1)), F.col("n0"))
    target = F.bround(F.lit(ratio) * F.col("normal") / max(1e-9, 1.0 - ratio)).cast("bigint")
    one = one.withColumn("_target", target).withColumn("_attacks", attacks)
    untouched = (F.col("normal") <= 0) | (F.col("_attacks") <= F.col("_target"))
    need = F.when(untouched, F.lit(0)).otherwise(F.col("_attacks") - F.col("_target"))
    rows = []
    for i in range(last):
        dropped = F.least(F.col(f"n{i}"), F.greatest(need, F.lit(0)))
        rows.append(F.struct(F.lit(i).alias("_grp"), (F.col(f"n{i}") - dropped).cast("bigint").alias("rank"), F.col(f"n{i}").alias("n")))
        need = need - dropped
    rest = F.col(f"n{last}")
    kept = F.when(untouched, rest).otherwise(F.least(rest, F.col("_target")))
    rows.append(F.struct(F.lit(last).alias("_grp"), kept.cast("bigint").alias("rank"), rest.alias("n")))
    return one.select(F.explode(F.array(*rows)).alias("_q")).select("_q._grp", "_q.rank", "_q.n")


def rebalance_sources(df: DataFrame, key: str, ratio: float = TARGET_ATTACK_RATIO, seed: int = SEED) -> DataFrame:
    """Keep all normal rows and thin attack rows to ``ratio`` by source priority.

    Without a ``_source`` column every row counts as one further source.
    """
    columns = df.columns
    if "_source" not in columns:
        df = df.withColumn("_source", F.lit("Unknown"))
    group = F.lit(len(DROP_PRIORITY))
    for i, name in reversed(list(enumerate(DROP_PRIORITY))):
        group = F.when(F.col("_source") == name, i).otherwise(group)
    grouped = df.withColumn("_grp", F.when(F.col("is_attack"), group))
    marked = lowest_by_hash(grouped, ["_grp"], hash_order(F.col(key), seed), attack_quotas(df, ratio))
    return marked.where(~F.col("is_attack") | F.col("_picked")).select(*columns)


def unified_training(sources: dict[str, DataFrame], key: str, balance: bool = True,
                     ratio: float = TARGET_ATTACK_RATIO, seed: int = SEED, ordered: bool = True) -> DataFrame:
    """Merge, rebalance, untag and sort by time (missing times last)."""
    merged = merge_sources(sources, keep=(key,))
    rows = (rebalance_sources(merged, key, ratio, seed) if balance else merged).drop("_source")
    return rows.orderBy(F.col("timestamp").asc_nulls_last(), key) if ordered else rows


def merge_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows and attacks per source before and after rebalancing."""
    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.groupBy("_source").agg(F.count(F.lit(1)).alias(f"rows_{tag}"),
                                         F.count_if("is_attack").alias(f"attacks_{tag}"))
    joined = side(before, "before").join(side(after, "after"), "_source", "left")
    return joined.fillna(0, ["rows_after", "attacks_after"])


def class_quota(df: DataFrame, label: str, size: Column) -> DataFrame:
    """Per class a row quota computed from ``n`` and the extreme class sizes.

    Quotas and cutoffs are broadcast later, one row per class; a label with more
    than ``MAX_CLASSES`` values fails instead.
    """
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    bounds = scalar(counts, F.struct(
        F.min("n").alias("low"), F.max("n").alias("high"), F.count(F.lit(1)).alias("classes")))
    checked = F.when(bounds["classes"] > MAX_CLASSES, F.raise_error(F.lit(f"{label} has too many classes")).cast("bigint"))
    sized = counts.withColumn("n_min", bounds["low"]).withColumn("n_max", bounds["high"])
    return sized.select(label, checked.otherwise(size.cast("bigint")).alias("rank"), "n", "n_min", "n_max")


def undersample(df: DataFrame, label: str, key: str, seed: int = SEED) -> DataFrame:
    """Every class cut to the size of the smallest."""
    quota = class_quota(df, label, F.col("n_min")).select(label, "rank", "n")
    marked = lowest_by_hash(df, [label], hash_order(F.col(key), seed), quota)
    return marked.where("_picked").select(*df.columns)


def oversample(df: DataFrame, label: str, key: str, seed: int = SEED) -> DataFrame:
    """Every class grown to the size of the largest by repeating rows.

    Each row appears ``n_max div n`` times; the remainder falls to the rows first
    in hash order. ``copy`` numbers the repeats.
    """
    quota = class_quota(df, label, F.col("n_max") % F.col("n"))
    marked = lowest_by_hash(df, [label], hash_order(F.col(key), seed), quota.select(label, "rank", "n"))
    times = quota.select(label, F.floor(F.col("n_max") / F.col("n")).alias("_times"))
    counted = marked.join(F.broadcast(times), label, "left")
    copies = F.coalesce("_times", F.lit(1)) + F.col("_picked").cast("int")
    return counted.select(*df.columns, F.explode(F.sequence(F.lit(1), copies.cast("int"))).alias("copy"))


def stratified_split(df: DataFrame, label: str, key: str, test_share: float = 0.2, seed: int = SEED) -> DataFrame:
    """Add ``is_test``: the same share of every class, rounded up."""
    quota = class_quota(df, label, F.ceil(F.col("n") * test_share)).select(label, "rank", "n")
    return lowest_by_hash(df, [label], hash_order(F.col(key), seed), quota, flag="is_test")


def stratified_folds(df: DataFrame, label: str, key: str, folds: int = 5, seed: int = SEED) -> DataFrame:
    """Add ``fold`` (0..folds-1), classes spread evenly, larger folds first.

    Fold borders are hash bounds: ``folds - 1`` of them per class.
    """
    n, k = F.col("n"), folds
    sizes = class_quota(df, label, F.lit(0)).select(label, "n").withColumn(
        "_f", F.explode(F.sequence(F.lit(1), F.lit(k - 1))))
    upto = F.floor(n / k) * F.col("_f") + F.least(F.col("_f"), n % k)
    targets = sizes.select(label, F.col("_f").alias("target"), upto.cast("bigint").alias("rank"))
    order = hash_order(F.col(key), seed)
    cuts = rank_cutoffs(df, [label], keyed.hash_levels(order), targets)
    bounds = cuts.groupBy(label).agg(*[
        F.max(F.when(F.col("target") == i, F.col("cut_1"))).alias(f"_b{i}") for i in range(1, k)])
    joined = df.join(F.broadcast(bounds), label, "left").withColumn("_h", order)
    above = sum((F.coalesce(F.col("_h") > F.col(f"_b{i}"), F.lit(False)).cast("int") for i in range(2, k)),
                F.coalesce(F.col("_h") > F.col("_b1"), F.lit(False)).cast("int"))
    return joined.withColumn("fold", above).select(*df.columns, "fold")


def time_split(df: DataFrame, key: str, ratio: float = 0.7, ts: str = "timestamp", seed: int = SEED) -> DataFrame:
    """Add ``is_train``: the first ``int(n * ratio)`` rows by time.

    Equal timestamps are ordered by row hash; rows without a time are last. With
    an empty side there is no split: every row trains.
    """
    far = F.coalesce(F.col(ts), F.lit("9999-12-31 00:00:00").cast("timestamp"))
    tie = hash_order(F.col(key), seed)
    near = keyed.bracket_counts(df.select(far.alias("_at")), [], "_at", [ratio])
    rank = F.floor(F.col("n") * ratio).cast("bigint")
    # The moment that holds the last training row, and how many of its rows train.
    last = near.where((F.col("upto") >= rank) & (F.col("upto") - F.col("count") < rank)).select(
        F.col("_at").alias("_last"), (rank - F.col("upto") + F.col("count")).alias("rank"), F.col("count").alias("n"))
    last = materialize(last, "time-split")
    moment = scalar(last, F.max("_last"))
    cut = keyed.hash_cutoffs(df.where(far == moment), [], tie, last.select("rank", "n"))
    inside = (far < moment) | ((far == moment) & (tie <= scalar(cut, F.max("cut"))))
    return df.withColumn("is_train", F.coalesce(inside, F.lit(True)))
