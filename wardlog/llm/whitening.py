"""Whitening of embeddings from a covariance weighted by multiplicities.

Components are brought to integers first, ``floor(scale * c)``. Equal integer vectors become one vector with a count, and the
fit takes each of them once (``weights="one"``) or as often as it occurs (``weights="copies"``). The covariance is a
centred product of matrices, summed over the partitions; only sums of the size of one vector, and the
covariance itself, reach the driver. Every distinct vector is whitened once, and the result joined back to the rows.

Vectors of different sizes cannot share a covariance: each size is whitened on its own, with figures of its own.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlog.llm.common import finite
from wardlog.session import materialize

SCALE = 256
COMPONENTS = 4
LONG = 2 ** 63 - 1
# Eigenvalues below this share of the largest are rounding: their component has no spread to divide by.
NO_SPREAD = 1e-12


def integer_vector(vector: Column, scale: int) -> Column:
    """``floor(scale * c)`` of every component; what does not fit into a long becomes the nearest long."""
    return F.transform(vector.cast("array<double>"), lambda c: F.floor(c * F.lit(float(scale))).cast("bigint"))


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """``size, x, copies``: each integer vector once. Copies are counted before the shuffle."""
    groups = rows.groupBy("x").agg(F.count(F.lit(1)).alias("copies"))
    return materialize(groups.select(F.size("x").alias("size"), "x", "copies"), "x-vectors")


def by_size(batch: pa.RecordBatch):
    """``size, rows, matrix`` for the vectors of a batch, whose columns begin with ``size`` and ``x``."""
    sizes = batch.column(0).to_numpy()
    flat, offsets = batch.column(1).flatten().to_numpy(), batch.column(1).offsets.to_numpy()
    offsets = offsets - offsets[0]
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield int(size), rows, flat[offsets[rows][:, None] + np.arange(size)].reshape(len(rows), size)


def weight_column(weights: str) -> Column:
    if weights not in ("one", "copies"):
        raise ValueError("weights are 'one' or 'copies'")
    return F.lit(1).cast("bigint") if weights == "one" else F.col("copies")


class Fit(NamedTuple):
    n: int
    sums: list[int]  # exact
    values: np.ndarray  # of the leading components, falling
    vectors: np.ndarray  # a column each
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])  # quotients of integers are rounded once


def totals(groups: DataFrame, weights: str) -> dict[int, tuple[int, list[int]]]:
    """Of every size: total weight, and exact weighted sums by dimension."""
    def run(batches):
        held: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            weight = batch.column(2).to_numpy()
            for size, rows, x in by_size(batch):
                w = weight[rows]
                # Sums of halves cannot overflow for fewer than 2**31 of them; Python integers hold the rest.
                high, low = x >> 32, x & 0xFFFFFFFF
                if w.max(initial=1) > 1:
                    part = (x.astype(object) * w.astype(object)[:, None]).sum(axis=0)
                else:
                    part = high.sum(axis=0).astype(object) * (1 << 32) + low.sum(axis=0).astype(object)
                n, sums = held.get(size, (0, 0))
                held[size] = (n + int(w.sum()), sums + part)
        for size, (n, sums) in held.items():
            yield pa.RecordBatch.from_pylist([{"size": size, "n": n, "at": k, "total": str(s)} for k, s in enumerate(sums)],
                                             schema=pa.schema([("size", pa.int32()), ("n", pa.int64()), ("at", pa.int32()), ("total", pa.string())]))
    parts = groups.select("size", "x", weight_column(weights).alias("w")).mapInArrow(run, "size int, n bigint, at int, total string")
    summed = parts.groupBy("size", "at").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    found: dict[int, tuple[int, list[int]]] = {}
    for row in summed.orderBy("size", "at").collect():
        found.setdefault(row.size, (row.n, []))[1].append(int(row.total))
    return found


def covariances(groups: DataFrame, weights: str, means: dict[int, np.ndarray], n: dict[int, int]) -> dict[int, np.ndarray]:
    """Of every size: the covariance, centred before multiplying, divisor the total weight."""
    def run(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            weight = batch.column(2).to_numpy()
            for size, rows, x in by_size(batch):
                centred = x - means[size]
                part = (centred * weight[rows][:, None]).T @ centred
                held[size] = held.get(size, 0) + part
        for size, product in held.items():
            yield pa.RecordBatch.from_pydict({
                "size": pa.array(np.full(size * size, size), pa.int32()), "cell": pa.array(np.arange(size * size), pa.int32()),
                "product": pa.array(product.ravel(), pa.float64())})
    parts = groups.select("size", "x", weight_column(weights).alias("w")).mapInArrow(run, "size int, cell int, product double")
    summed = parts.groupBy("size", "cell").agg(F.sum("product").alias("product"))
    found = {size: np.zeros(size * size) for size in means}
    for size, cell, product in summed.collect():
        found[size][cell] = product / n[size]
    return {size: (c := cells.reshape(size, size), (c + c.T) / 2)[1] for size, cells in found.items()}


def fit(groups: DataFrame, weights: str = "one", components: int = COMPONENTS) -> dict[int, Fit]:
    """Means and leading components of the distinct vectors, by size. The driver holds one covariance for each size."""
    sums = totals(groups, weights)
    means = {size: np.array([s / n for s in total]) for size, (n, total) in sums.items()}
    found = {}
    for size, covariance in covariances(groups, weights, means, {size: n for size, (n, _) in sums.items()}).items():
        values, vectors = np.linalg.eigh(covariance)
        leading = slice(None, -min(components, size) - 1, -1)
        found[size] = Fit(*sums[size], values[leading], vectors[:, leading], float(np.trace(covariance)))
    return found


WHITENED = "x array<bigint>, copies bigint, weight bigint, size int, n bigint, deviation decimal(38,0), whitened array<double>, explained array<double>"


def whiten(groups: DataFrame, fits: dict[int, Fit], weights: str) -> DataFrame:
    """Every distinct vector on the components of its size, with its squared distance from the mean times ``n``."""
    fits = {size: (f, f.mean) for size, f in fits.items()}

    def run(batches):
        for batch in batches:
            out: list[list] = [[None] * batch.num_rows for _ in range(5)]
            for size, rows, x in by_size(batch):
                model, mean = fits[size]
                spread = model.values > NO_SPREAD * max(model.values[0], 1e-300)
                scale = np.sqrt(np.where(spread, model.values, 1.0))
                placed = (x - mean) @ model.vectors / scale
                largest = max(abs(int(x.max())), abs(int(x.min()))) * model.n + max(abs(s) for s in model.sums)
                kind = np.int64 if largest ** 2 * size <= LONG else object
                apart = x.astype(kind) * model.n - np.array(model.sums, kind)
                deviation = (apart * apart).sum(axis=1).tolist()
                share = [float(v / model.trace) if model.trace > 0 else None for v in model.values]
                for k, row in enumerate(rows):
                    out[0][row], out[1][row] = size, model.n
                    out[2][row] = str(deviation[k]) if deviation[k] < 10 ** 38 else None
                    out[3][row] = [float(v) if s else None for v, s in zip(placed[k], spread)]
                    out[4][row] = share
            kinds = [pa.int32(), pa.int64(), pa.string(), pa.list_(pa.float64()), pa.list_(pa.float64())]
            size, n, deviation, placed, share = (pa.array(c, t) for c, t in zip(out, kinds))
            given = [batch.column("x"), batch.column("copies"), batch.column("w")]
            yield pa.RecordBatch.from_arrays([*given, size, n, deviation.cast(pa.decimal128(38, 0)), placed, share],
                                             names=[c.split()[0] for c in WHITENED.split(", ")])
    return groups.select("size", "x", weight_column(weights).alias("w"), "copies").mapInArrow(run, WHITENED)


def identity_errors(whitened: DataFrame, components: int) -> DataFrame:
    """``size, identity_error``: largest entry of the whitened fit list's covariance less the identity.

    Components without spread are left out; the value is null where all are.
    """
    sums = [F.sum("weight").alias("total")]
    at = [F.get("whitened", F.lit(k)) for k in range(components)]
    for i in range(components):
        sums.append(F.sum(F.col("weight") * at[i]).alias(f"s{i}"))
        sums += [F.sum(F.col("weight") * at[i] * at[j]).alias(f"p{i}_{j}") for j in range(i + 1)]
    summed = whitened.groupBy("size").agg(*sums)

    def off(i: int, j: int) -> Column:
        mean = F.col(f"s{i}") / F.col("total") * (F.col(f"s{j}") / F.col("total"))
        return F.abs(F.col(f"p{i}_{j}") / F.col("total") - mean - F.lit(float(i == j)))
    entries = [off(i, j) for i in range(components) for j in range(i + 1)]
    worst = F.greatest(*entries) if len(entries) > 1 else entries[0]
    return summed.select("size", worst.alias("identity_error"))


def whiten_embeddings(vectors: DataFrame, components: int = COMPONENTS, weights: str = "one", scale: int = SCALE) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error, copies, deviation_exact`` for each row and component.

    Rows of ``vectors`` (``vec_id, embedding``) whose vector is null or holds null or non-finite components are
    dropped; so are empty vectors, which have no component. Each size of vectors is fitted on its own, with as many
    components as it has dimensions if these are fewer. A component without spread has ``whitened`` null, and
    ``explained`` is null if nothing varies. Repeated rows give repeated results, and a row without an id keeps its null. ``deviation``
    is null where it exceeds a long; ``deviation_exact`` (38 digits) holds it then. No rows give no rows.
    """
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").alias("embedding"))
    rows = rows.where(finite(F.col("embedding")) & (F.size("embedding") > 0)).select("vec_id", integer_vector(F.col("embedding"), scale).alias("x"))
    groups = distinct_vectors(rows)
    fits = fit(groups, weights, components)
    whitened = materialize(whiten(groups, fits, weights), "whitened")
    told = whitened.join(F.broadcast(identity_errors(whitened, components)), "size")  # a row for each size
    joined = rows.join(told.drop("size", "weight"), "x").select("vec_id", "n", "deviation", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "of"),
                                         "identity_error", "copies")
    return joined.select("vec_id", (F.col("at") + 1).alias("component"), "n", F.expr("try_cast(deviation as bigint)").alias("deviation"),
                         F.col("of.whitened").alias("whitened"), F.col("of.explained").alias("explained"), "identity_error", "copies",
                         F.col("deviation").alias("deviation_exact"))
