"""Synthetic minority oversampling (Chawla et al., 2002)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlog.operators.balance import SEED, class_quota, oversample, undersample
from wardlog.operators.features import numeric_columns
from wardlog.operators.keyed import hash_order, lowest_by_hash
from wardlog.operators.neighbors import nearest_vectors
from wardlog.session import materialize

# One input row makes at most this many synthetic rows before the work is spread.
SPREAD = 10_000


def smote(df: DataFrame, features: list[str], label: str, key: str, k: int = 5, seed: int = SEED) -> DataFrame:
    """Original rows plus synthetic minority rows until both classes are even.

    Returns ``features, label, synthetic``. Each minority row starts the same
    number of synthetic rows, the remainder falling to the rows first in hash
    order; neighbour and mixing weight come from a hash, so a rerun agrees.
    A class of at most ``k`` rows has too few neighbours and stays as it is.
    """
    flag = F.col(label).cast("boolean")
    base = df.select(F.col(key).cast("string").alias("_key"), flag.alias("_y"),
                     *[F.col(c).cast("double").alias(c) for c in features])
    quota = class_quota(base, "_y", (F.col("n_max") - F.col("n")) % F.col("n"))
    marked = lowest_by_hash(base, ["_y"], hash_order(F.col("_key"), seed), quota.select("_y", "rank", "n"))
    each = quota.where((F.col("n") < F.col("n_max")) & (F.col("n") > k)).select("_y", F.floor((F.col("n_max") - F.col("n")) / F.col("n")).alias("_each"))
    minority = marked.join(F.broadcast(each), "_y").withColumn("_copies", F.col("_each") + F.col("_picked").cast("int"))
    vectors = minority.groupBy(F.array(*features).alias("x")).agg(
        F.min("_key").alias("vid"), F.count(F.lit(1)).alias("mult"), F.sum("_copies").alias("copies"),
        F.first("_y").alias("_y"))
    vectors = materialize(vectors, "minority-vectors")
    found = nearest_vectors(vectors, k)
    # Copies of a vector are its own nearest neighbours; other vectors follow, each
    # as often as it occurs.
    copies_of = lambda v, n: F.array_repeat(v, F.least(n, F.lit(k)).cast("int"))
    others = F.flatten(F.transform("near", lambda c: copies_of(c["x"], c["mult"])))
    near = F.slice(F.concat(copies_of(F.col("x"), F.col("mult") - 1), others), 1, k)
    starts = (found.select("vid", "x", near.alias("near"))
              .join(vectors.select("vid", "copies", "_y"), "vid").where("copies > 0"))
    spread = starts.withColumn("_part", F.explode(F.sequence(F.lit(0), ((F.col("copies") - 1) / SPREAD).cast("int"))))
    spread = spread.repartition("vid", "_part")
    last = F.least(F.col("copies"), (F.col("_part") + 1) * SPREAD) - 1
    numbered = spread.withColumn("_i", F.explode(F.sequence((F.col("_part") * SPREAD).cast("bigint"), last.cast("bigint"))))
    draw = lambda name: F.pmod(F.xxhash64("vid", "_i", F.lit(name), F.lit(seed)), F.lit(1 << 30))
    chosen = F.coalesce(F.get("near", F.pmod(draw("neighbour"), F.greatest(F.size("near"), F.lit(1))).cast("int")), F.col("x"))
    mixed = (numbered.withColumn("_n", chosen).withColumn("_u", draw("weight") / float(1 << 30))
             .withColumn("_s", F.zip_with("x", "_n", lambda a, b: a + (b - a) * F.col("_u"))))
    made = mixed.select(*[F.col("_s")[i].alias(c) for i, c in enumerate(features)],
                        F.col("_y").alias(label), F.lit(True).alias("synthetic"))
    given = base.select(*features, F.col("_y").alias(label), F.lit(False).alias("synthetic"))
    return given.unionByName(made)


def handle_imbalance(df: DataFrame, label: str, key: str, method: str = "undersample",
                     features: list[str] | None = None, seed: int = SEED) -> DataFrame:
    """Even the classes by ``undersample``, ``oversample`` or ``smote``.

    A missing label column or an unknown method leaves the input unchanged.
    """
    if label not in df.columns:
        return df
    if method == "undersample":
        return undersample(df, label, key, seed)
    if method == "oversample":
        return oversample(df, label, key, seed).drop("copy")
    if method == "smote":
        names = features or [c for c in numeric_columns(df) if c not in (label, key)]
        return smote(df, names, label, key, seed=seed).drop("synthetic")
    return df
