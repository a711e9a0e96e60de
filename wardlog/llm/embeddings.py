"""Embedding near-dedup by collision-counting projections.

A vector is projected on ``projections`` random directions. For a pair at the cosine threshold the
difference of two projections is normal with a known spread, so the chance to lie within a
query-centred window of one projection, and the number of windows a pair collides in, are known too:
the count to demand follows from the recall asked for. Pairs passing it are verified by their cosine in
double precision.

Windows of single projections are wide, so the sorted lists are cut into cells first: each of several
tables sorts the vectors by the signs of ``bits`` projections of its own and, within a cell of equal signs,
by a further projection. More vectors give more bits, cells keep their size, and the number of tables
follows from the recall, so the work grows a little faster than the number of vectors, not with its square.

No pair is ever a row. A cell counts collisions block by block in its task and returns, for every
vector, how many it is linked with and a spanning forest of the links; a pair that meets in several
tables is counted in the first of them, which both vectors' codes tell. A cell larger than a block is cut
along its sorted projection, and each pair of segments is a task of its own. Equal vectors are one
vector with a multiplicity.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlog.llm.common import components
from wardlog.session import materialize

THRESHOLD = 0.9
RECALL = 0.998  # of pairs exactly at the threshold; closer pairs are found more often
PROJECTIONS = 32
CELL = 512  # vectors wanted in a cell
SEGMENT = 2048  # vectors of one segment of a large cell
CHUNK = 256  # queries counted at once
SEED = 20


def normal_mass(x: float) -> float:
    """Probability that a standard normal lies within ``x`` of zero."""
    return math.erf(x / math.sqrt(2))


def calibrate(threshold: float, recall: float, projections: int, window: float = 2.0) -> tuple[float, int]:
    """Half-width of the windows, and the collisions to demand, for pairs at the threshold.

    The window is ``window`` spreads of the difference; the count is the largest that such a pair reaches
    with probability ``recall``.
    """
    spread = math.sqrt(2 - 2 * threshold)
    hit = normal_mass(window)
    chance = [math.comb(projections, c) * hit ** c * (1 - hit) ** (projections - c) for c in range(projections + 1)]
    least = max(c for c in range(projections + 1) if sum(chance[c:]) >= recall)
    return window * spread, least


def tables_for(threshold: float, recall: float, bits: int, window: float) -> int:
    """Tables needed so that a pair at the threshold shares a cell and its window in one of them."""
    same = (1 - math.acos(threshold) / math.pi) ** bits * normal_mass(window)
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - same))) if same < 1 else 1


def usable(vector: Column) -> Column:
    """Vectors that can have a cosine: no null or non-finite component, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def directions(size: int, count: int, stream: int) -> np.ndarray:
    return np.random.default_rng([SEED, size, stream]).standard_normal((size, count))


def unit_rows(raw: np.ndarray) -> np.ndarray:
    unit = raw / np.abs(raw).max(axis=1, keepdims=True)
    return unit / np.sqrt((unit ** 2).sum(axis=1, keepdims=True))


POSTING = "cell bigint, size int, node bigint, copies bigint, along float, codes binary, vector binary"


def postings(vectors: DataFrame, bits: int, tables: int) -> DataFrame:
    """One row per vector and table, with the cells of all tables and the window projections."""
    def run(batches):
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            arrays = [np.array(v, np.float64) for v in batch.column(2).to_pylist()]
            sizes = np.array([len(a) for a in arrays])
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                raw = np.stack([arrays[i] for i in rows])
                unit = unit_rows(raw)
                single = raw.astype(np.float32)
                exact = (single == raw).all(axis=1)
                signs = (unit @ directions(size, max(1, bits * tables), 1) > 0)[:, :bits * tables].reshape(len(rows), tables, bits)
                codes = (signs * (1 << np.arange(bits))).sum(axis=2).astype(np.int64)
                along = (unit @ directions(size, tables, 2)).astype(np.float32)
                shared = codes.astype("<i4")
                windows = along.astype("<f4")
                for k, i in enumerate(rows):
                    node, copies = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                    code, vector = shared[k].tobytes() + windows[k].tobytes(), (single if exact[k] else raw)[k].tobytes()
                    for t in range(tables):
                        out[0].append((int(codes[k, t]) * tables + t) * 1024 + int(size) % 1024)
                        out[1].append(int(size))
                        out[2].append(node)
                        out[3].append(copies)
                        out[4].append(float(along[k, t]))
                        out[5].append(code)
                        out[6].append(vector)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float32(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=[c.split()[0] for c in POSTING.split(", ")])
    return vectors.select("node", "copies", "embedding").mapInArrow(run, POSTING)


def forest(a: np.ndarray, b: np.ndarray, n: int) -> list[tuple[int, int]]:
    """A spanning forest of the links of one cell."""
    root = list(range(n))
    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        while root[y] != y:
            root[y] = root[root[y]]
            y = root[y]
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((x, y))
    return out


FOUND = "node bigint, other bigint, links bigint"


def count_cell(part: pa.Table, table: int, tables: int, threshold: float, half: float, least: int, projections: int,
               pair: tuple[int, int] | None) -> pa.Table:
    """Links of one cell, or between two segments of it, that no earlier table has.

    Rows of the result either count links of a node, or name a link of the forest.
    """
    order = np.argsort(part.column("along").to_numpy(), kind="stable")
    node = part.column("node").to_numpy()[order]
    copies = part.column("copies").to_numpy()[order]
    along = part.column("along").to_numpy()[order].astype(np.float64)
    codes = np.stack([np.frombuffer(c, "<i4") for c in part.column("codes").take(pa.array(order)).to_pylist()])
    codes, lines = codes[:, :tables], np.ascontiguousarray(codes[:, tables:]).view("<f4")
    size = part.column("size")[0].as_py()
    unit = unit_rows(np.stack([np.frombuffer(v, np.float32 if len(v) == 4 * size else np.float64).astype(np.float64)
                               for v in part.column("vector").take(pa.array(order)).to_pylist()]))
    segment = part.column("segment").to_numpy()[order]
    n = len(node)
    places = (unit @ directions(unit.shape[1], projections, 3)).astype(np.float32)
    links = np.zeros(n, np.int64)
    edges: list[tuple[int, int]] = []
    ends = np.searchsorted(along, along + half, side="right")
    for begin in range(0, n, CHUNK):
        stop = min(n, begin + CHUNK)
        last = int(ends[stop - 1])
        rows, columns = np.arange(begin, stop), np.arange(begin, last)
        counted = np.zeros((len(rows), len(columns)), np.uint8)
        for j in range(projections):
            counted += np.abs(places[rows, j, None] - places[columns, j]) <= half
        counted[(columns <= rows[:, None]) | (columns >= ends[rows][:, None])] = 0
        if pair is not None and pair[0] != pair[1]:
            counted[segment[rows][:, None] == segment[columns]] = 0
        x, y = np.nonzero(counted >= least)
        x, y = rows[x], columns[y]
        if not len(x):
            continue
        keep = np.zeros(len(x), bool)
        for k in range(0, len(x), 1 << 16):
            s = slice(k, k + (1 << 16))
            keep[s] = np.einsum("ij,ij->i", unit[x[s]], unit[y[s]]) >= threshold
        x, y = x[keep], y[keep]
        if table:
            met = np.zeros(len(x), bool)
            for t in range(table):
                met |= (codes[x, t] == codes[y, t]) & (np.abs(lines[x, t].astype(np.float64) - lines[y, t]) <= half)
            x, y = x[~met], y[~met]
        np.add.at(links, x, copies[y])
        np.add.at(links, y, copies[x])
        edges += forest(x, y, n)
    some = np.flatnonzero(links)
    a = np.array([e[0] for e in edges], np.int64)
    b = np.array([e[1] for e in edges], np.int64)
    return pa.table({"node": pa.array(np.concatenate([node[some], node[a]]), pa.int64()),
                     "other": pa.array(np.concatenate([node[some], node[b]]), pa.int64()),
                     "links": pa.array(np.concatenate([links[some], np.zeros(len(a), np.int64)]), pa.int64())})


def near_pairs(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, projections: int = PROJECTIONS,
               window: float = 2.5) -> DataFrame:
    """``node, other, links``: link counts (``other = node``) and links of a spanning forest (``links = 0``)."""
    half, least = calibrate(threshold, math.sqrt(recall), projections, window)
    n = vectors.count()
    bits = max(0, round(math.log2(max(1, n / CELL))))
    tables = tables_for(threshold, math.sqrt(recall), bits, window)
    posted = materialize(postings(vectors, bits, tables), "postings")
    # Cells beyond a segment are cut along their own projection; every pair of segments meets once.
    sizes = posted.groupBy("cell", "size").agg(F.count(F.lit(1)).alias("n"), F.min("along").alias("low"), F.max("along").alias("high"))
    sizes = sizes.withColumn("cuts", F.ceil(F.col("n") / SEGMENT).cast("int")).drop("n")
    placed = posted.join(sizes, ["cell", "size"])
    # Rows of a large cell are spread by hash over its segments: near copies may share one projection.
    segment = F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int")
    placed = placed.withColumn("segment", segment).drop("low", "high")
    others = F.sequence(F.lit(0), F.col("cuts") - 1)
    spread = placed.withColumn("met", F.explode(others)).withColumn("first", F.least("segment", "met")).withColumn(
        "second", F.greatest("segment", "met")).drop("met", "cuts")

    def run(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        cell, _, first, second = (k.as_py() for k in key)
        return count_cell(part, cell // 1024 % tables, tables, threshold, half, least, projections, (first, second))
    return spread.groupBy("cell", "size", "first", "second").applyInArrow(run, FOUND)


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row of ``vectors`` (``vec_id, embedding``).

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, and so do vectors
    of different sizes. Equal vectors are always linked. A row without an id takes part but cannot name a
    component; if all ids of a component are null so is ``component_id``, and ``kept`` is then true.
    """
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    fit = rows.where(usable(F.col("embedding")))
    groups = fit.groupBy("embedding").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
    groups = materialize(groups.withColumn("node", F.monotonically_increasing_id()), "vectors")
    found = materialize(near_pairs(groups, threshold, recall), "vector-links")
    roots = components(found.where("node <> other").select(F.col("node").alias("a"), F.col("other").alias("b")))
    counts = found.where("node = other").groupBy("node").agg(F.sum("links").alias("links"))
    joined = groups.join(counts, "node", "left").join(roots, "node", "left").select(
        "embedding", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("root"))
    joined = materialize(joined, "vector-groups")
    least = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    told = joined.join(least, "root").select("embedding", "n_links", "component_id")
    alone = rows.where(~usable(F.col("embedding"))).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = fit.join(told, "embedding").select("vec_id", "n_links", "component_id").union(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()))
