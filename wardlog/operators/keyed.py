"""Building blocks that stay balanced when one key dominates the data.

* ``attach_by_key``  maps per-key statistics back to rows.
* ``rank_cutoffs``   finds the row at a given rank without a global sort.
* ``hash_cutoffs``   does so for hash order in one scan, as hashes are uniform.
* ``bracket_counts`` exact ranks near given shares, bracketed by a sketch; ``exact_quantiles`` on top of it.
* ``running_totals`` cumulative sums over a total order, in parallel.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from wardlog.session import materialize

# A key is heavy when it owns at least this share of the rows, so there can be
# no more than 1/HEAVY_SHARE heavy keys: the heavy table is always small.
HEAVY_SHARE = 1.0 / 1024
# Sampling and splitting work per class; more classes than this is a wrong column.
MAX_CLASSES = 10_000
# Quantile sketches answer a rank within this fraction of the rows.
SKETCH = 10_000
# Standard deviations of a uniform hash's rank that a bracket spans on both sides.
HASH_SPREADS = 8.0


def scalar(df: DataFrame, value: Column) -> Column:
    """A one-row aggregate as a scalar subquery (evaluated once, no join)."""
    return df.select(value.alias("v")).scalar()


def attach_by_key(df: DataFrame, stats: DataFrame, keys: list[str], values: list[str],
                  weight: str, only: Column | None = None) -> DataFrame:
    """Left-join ``stats`` (one row per key) to ``df`` without hot partitions.

    ``weight`` is a column of ``stats`` holding the row count of the key. The heavy keys, at
    most ``1 / HEAVY_SHARE``, travel by broadcast; the others go through an ordinary equi-join (which
    adaptive execution may turn into a broadcast by its bytes), in which rows already answered and rows
    with a null key are spread by a content hash instead of meeting in one partition. Rows outside ``only``
    take no part in the join and are not shuffled. Nothing runs before the result is used.
    """
    stats = stats.select(*dict.fromkeys([*keys, weight, *values]))
    if only is not None:
        asks = F.coalesce(only, F.lit(False))
        types = dict(stats.dtypes)
        others = df.where(~asks).select(*df.columns, *[F.lit(None).cast(types[v]).alias(v) for v in values])
        return attach_by_key(df.where(asks), stats, keys, values, weight).unionByName(others)
    is_heavy = F.col(weight) >= scalar(stats, F.sum(weight)) * F.lit(HEAVY_SHARE)
    packed = F.struct(*values)
    heavy = stats.where(is_heavy).select(*keys, packed.alias("_heavy"))
    # Slot and key form one struct: as separate join keys the constant slot of the
    # light side would be turned into a filter and no longer spread the rows.
    def slotted(slot: Column) -> Column:
        return F.struct(slot.alias("slot"), *keys)

    light = stats.where(~is_heavy).select(
        slotted(F.lit(0).cast("bigint")).alias("_key"), packed.alias("_light"))
    rows = df.join(F.broadcast(heavy), keys, "left")
    hashable = [f.name for f in df.schema.fields if not isinstance(f.dataType, MapType)]
    searching = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys], F.col("_heavy").isNull())
    spread = F.xxhash64(*hashable).bitwiseOR(F.lit(1).cast("bigint"))
    slot = F.when(searching, F.lit(0).cast("bigint")).otherwise(spread)
    joined = rows.withColumn("_key", slotted(slot)).join(light, "_key", "left")
    found = F.coalesce(F.col("_heavy"), F.col("_light"))
    return joined.select(*df.columns, *[found.getField(v).alias(v) for v in values])


def rank_cutoffs(df: DataFrame, by: list[str], levels: list[Column], targets: DataFrame) -> DataFrame:
    """Locate order-key values by rank.

    ``levels`` refine one another (coarse to fine) and together give the sort
    order; ``targets`` has one small row per ``(by..., target)`` with the
    1-based ``rank`` wanted. Returns ``by, target, cut_0 .. cut_n``: the level
    values of the row holding that rank.

    Every level is a histogram (partial aggregation before a tiny shuffle)
    restricted to the one bucket that still contains the wanted row, so no task
    ever sorts a whole group. Ranks outside 1..n simply yield no row.
    """
    n = len(levels)
    keys = df.select(*by, *[level.alias(f"cut_{i}") for i, level in enumerate(levels)])
    state = targets.select(*by, "target", F.col("rank").cast("bigint").alias("rank"))
    if not by:
        by = ["_all"]
        keys = keys.withColumn("_all", F.lit(0))
        state = state.withColumn("_all", F.lit(0))
    # The first level counts all rows once, whatever the number of targets.
    counted = keys.groupBy(*by, "cut_0").agg(F.count(F.lit(1)).alias("_n"))
    ordered = Window.partitionBy(*by).orderBy("cut_0").rowsBetween(Window.unboundedPreceding, 0)
    upto = counted.withColumn("_upto", F.sum("_n").over(ordered)).join(F.broadcast(state), by)
    for i in range(n):
        fixed = [f"cut_{j}" for j in range(i)]
        if i:
            # Only the bucket a target points into; the small state is used once, so plans stay short.
            inside = keys.join(F.broadcast(state), [*by, *fixed])
            counted = inside.groupBy(*by, "target", "rank", *fixed, f"cut_{i}").agg(F.count(F.lit(1)).alias("_n"))
            ordered = Window.partitionBy(*by, "target", "rank", *fixed).orderBy(f"cut_{i}").rowsBetween(Window.unboundedPreceding, 0)
            upto = counted.withColumn("_upto", F.sum("_n").over(ordered))
        state = (upto.where((F.col("_upto") >= F.col("rank")) & (F.col("_upto") - F.col("_n") < F.col("rank")))
                 .select(*by, "target", (F.col("rank") - F.col("_upto") + F.col("_n")).alias("rank"), *fixed, f"cut_{i}"))
    return state.drop("rank", "_all")


def hash_order(key: Column, seed: int | str) -> Column:
    """Reproducible shuffle order: md5 of the row key and the seed."""
    return F.md5(F.concat(key.cast("string"), F.lit(f"#{seed}")))


def hash_levels(order: Column) -> list[Column]:
    """Levels for an md5 order: 65,536 even buckets, then the exact value."""
    return [F.substring(order, 1, 4), order]


def hash_share(order: Column) -> Column:
    """Where an md5 lies between the smallest (0) and the largest (1); never falls as the md5 grows."""
    return F.conv(F.substring(order, 1, 13), 16, 10).cast("double") / float(2 ** 52)


def hash_cutoffs(df: DataFrame, by: list[str], order: Column, quota: DataFrame) -> DataFrame:
    """``by, cut``: the md5 of the ``quota.rank``-th row of each group in hash order, none where the rank is not in ``1..n``.

    ``quota`` has one row per group (``by..., rank, n``), ``n`` being the size of the group (counted, if not given). Hashes are uniform, so the
    row wanted lies within ``HASH_SPREADS`` standard deviations of ``rank / n`` (but for one case in 10**14). One scan counts
    the rows below that bracket and the hashes inside, about ``16 * sqrt(n)`` of them, and the count settles the
    row exactly. Repeated keys have one hash; where they spoil the bracket its end is the cut.
    """
    if "n" not in quota.columns:
        sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
        quota = quota.join(F.broadcast(sizes), by) if by else quota.withColumn("n", scalar(sizes, F.max("n")))
    at = F.col("rank") / F.col("n")
    slack = (HASH_SPREADS * F.sqrt(at * F.greatest(F.lit(0.0), 1 - at) * F.col("n")) + 4 * HASH_SPREADS) / F.col("n")
    asked = quota.where("rank between 1 and n").select(*by, "rank", (at - slack).alias("_low"), (at + slack).alias("_high"))
    keys = df.select(*by, order.alias("_h"))
    joined = keys.join(F.broadcast(asked), by) if by else keys.crossJoin(F.broadcast(asked))  # a row for each class
    share = hash_share(F.col("_h"))
    inside = F.when(share >= F.col("_low"), F.col("_h"))
    counted = (joined.where(share <= F.col("_high")).groupBy(*by, "rank", inside.alias("_in"))
               .agg(F.count(F.lit(1)).alias("_n"), F.max("_h").alias("_top")))
    upto = F.sum("_n").over(Window.partitionBy(*by).orderBy(F.col("_in").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0))
    hit = (F.col("_upto") >= F.col("rank")) & (F.col("_upto") - F.col("_n") < F.col("rank"))
    found = counted.withColumn("_upto", upto).groupBy(*by)
    return found.agg(F.coalesce(F.max(F.when(hit, F.col("_top"))), F.max("_top")).alias("cut")).where("cut is not null")


def lowest_by_hash(df: DataFrame, by: list[str], order: Column, quota: DataFrame,
                   flag: str = "_picked") -> DataFrame:
    """Flag, per group, the ``quota.rank`` rows that come first in hash order.

    ``quota`` has one row per group (``by..., rank`` and, if known, its size ``n``). The rows themselves are
    never shuffled: they are compared with one broadcast cutoff per group.
    Row keys must be unique for the count to be exact, groups few (classes).
    """
    cuts = hash_cutoffs(df, by, order, quota).withColumnRenamed("cut", "_cut")
    if by:
        marked = df.join(F.broadcast(cuts), by, "left")
    else:
        marked = df.withColumn("_cut", scalar(cuts, F.max("_cut")))
    return marked.withColumn(flag, F.coalesce(order <= F.col("_cut"), F.lit(False))).drop("_cut")


def bracket_counts(rows: DataFrame, by: list[str], value: str, probs: list[float]) -> DataFrame:
    """``by, n, value, count, upto``: exact counts of the values near given shares of each group, in order.

    A first scan sizes the groups and brackets each share by a quantile sketch, whose rank error is at most
    ``1 / SKETCH`` of the rows; the brackets are four times as wide on both sides. A second scan counts the values
    inside the brackets one by one and the rows between two brackets as a whole, under their largest value. So
    ``upto``, the number of rows up to a value, is exact for every value inside. Groups must be few.
    """
    margin = 4.0 / SKETCH
    edges = [min(1.0, max(0.0, p + m)) for p in sorted(probs) for m in (-margin, margin)]
    sized = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_size"), F.percentile_approx(value, edges, SKETCH).alias("_edges"))
    groups = materialize(sized, "rank-brackets")
    low = [F.get("_edges", F.lit(2 * i)) for i in range(len(probs))]
    high = [F.get("_edges", F.lit(2 * i + 1)) for i in range(len(probs))]
    x = F.col(value)
    inside = reduce(lambda a, b: a | b, [x.between(a, b) for a, b in zip(low, high)])
    passed = reduce(lambda a, b: a + b, [(x > b).cast("int") for b in high])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(by)], F.lit(True))
    keyed = groups.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)], "_edges")
    joined = rows.join(F.broadcast(keyed), same) if by else rows.crossJoin(F.broadcast(keyed))
    counted = (joined.groupBy(*by, F.when(inside, x).alias("_in"), F.when(~inside, passed).alias("_between"))
               .agg(F.count(F.lit(1)).alias("_n"), F.max(x).alias(value)).select(*by, value, "_n"))
    ranked = running_totals(counted, [*by, value], {"_upto": "_n"})
    before = F.coalesce(F.sum("_size").over(Window.orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) if by else F.lit(0)
    sizes = groups.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)], F.col("_size").alias("n"), before.alias("_before"))
    told = ranked.join(F.broadcast(sizes), same) if by else ranked.crossJoin(F.broadcast(sizes))
    return told.select(*by, "n", value, F.col("_n").alias("count"), (F.col("_upto") - F.col("_before")).alias("upto"))


def exact_quantiles(df: DataFrame, by: list[str], value: Column, probs: list[float]) -> DataFrame:
    """Linear-interpolated percentiles per group as ``by..., prob, quantile``, in two scans.

    Groups must be few (metric names, models); rows per group are unlimited.
    """
    rows = df.select(*by, value.cast("double").alias("_x")).where(F.col("_x").isNotNull())
    near = bracket_counts(rows, by, "_x", probs)
    asked = near.withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
    asked = asked.withColumn("_pos", (F.col("n") - 1) * F.col("prob"))

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("upto") >= rank) & (F.col("upto") - F.col("count") < rank), F.col("_x")))
    found = asked.groupBy(*by, "prob").agg(at(F.floor("_pos") + 1).alias("_a"), at(F.ceil("_pos") + 1).alias("_b"),
                                           F.max(F.col("_pos") - F.floor("_pos")).alias("_t"))
    return found.select(*by, "prob", (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_t")).alias("quantile"))


def running_totals(df: DataFrame, order: list[str], sums: dict[str, str]) -> DataFrame:
    """Add inclusive running sums over a total order of distinct keys.

    The range-partitioned rows are written to the shared folder first, so the
    partition number is data and cannot change if an executor is lost; each
    partition then only needs the totals of those before it (one row per
    partition). ``sums`` maps new column names to the columns they accumulate.
    """
    ranged = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    stored = materialize(ranged, "running-totals")
    totals = stored.groupBy("_part").agg(
        *[F.sum(src).alias(f"_t_{dst}") for dst, src in sums.items()])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_part", *[F.coalesce(F.sum(f"_t_{d}").over(before), F.lit(0)).alias(f"_o_{d}") for d in sums])
    within = (Window.partitionBy("_part").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, 0))
    out = stored.join(F.broadcast(offsets), "_part")
    return out.select(
        *df.columns,
        *[(F.sum(src).over(within) + F.col(f"_o_{dst}")).alias(dst) for dst, src in sums.items()])
