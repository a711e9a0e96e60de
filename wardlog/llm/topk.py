"""Exact top-k search by inner product, term at a time.

Vectors become sparse rows of integer weights, one term for each dimension. A task takes candidates in blocks;
a block holds, for each term, the postings of the candidates whose weight is not zero. A query is answered by adding up
its terms: each scatters its weighted postings into a dense array of scores, one entry for each candidate of the
block. The best of the array are selected by partitioning it, merged over the blocks of the task, and the
findings of all tasks are merged by a window for each query.

Every query meets every candidate: that is the work asked for. Queries are packed into blocks of bounded size, and a wave of at most
``WAVE_BYTES`` of them is broadcast at a time, so that candidates are never moved and a wave of any corpus fits into a
task; the number of waves grows with the queries.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardlog.llm.common import finite
from wardlog.session import materialize

SCALE = 256
K = 5
QUERY_ROWS = 1024  # queries of a block
BLOCK_ROWS = 4096  # candidates of a block
BLOCK_BYTES = 1 << 20  # of the integers of a block, of candidates or of queries, unless a single vector is larger
WAVE_BYTES = 32 << 20  # of all query blocks broadcast at once
LONG = np.iinfo(np.int64)


def weights_of(vectors: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """All components as integers (the nearest long, if one does not fit), and the bounds of the rows."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    offsets = vectors.offsets.to_numpy().astype(np.int64)
    with np.errstate(over="ignore"):
        scaled = np.floor(vectors.flatten().to_numpy().astype(np.float64) * scale)
    out = np.clip(scaled, -2.0 ** 63, 2.0 ** 63 - 1024).astype(np.int64)  # the doubles next to the bounds
    out[scaled >= 2.0 ** 63] = LONG.max
    return out, offsets - offsets[0]


def blocks_of(batches, rows: int, scale: int):
    """``ids, nulls, weights, bounds`` of up to ``rows`` vectors, or ``BLOCK_BYTES`` of them, at a time."""
    ids, parts, held, size = [], [], 0, 0

    def block():
        number = pa.concat_arrays(ids)
        out, bounds = weights_of(pa.concat_arrays(parts), scale)
        return number.fill_null(LONG.max).to_numpy(), number.is_null().to_numpy(zero_copy_only=False), out, bounds
    for batch in batches:
        vectors = batch.column(1)
        ends = vectors.offsets.to_numpy().astype(np.int64)
        begin = 0
        while begin < batch.num_rows:
            fits = int(np.searchsorted(ends, ends[begin] + (BLOCK_BYTES - size) // 8, side="right")) - 1
            stop = min(batch.num_rows, begin + rows - held, max(fits, begin + (not held)))
            if stop > begin:
                ids.append(batch.column(0).slice(begin, stop - begin))
                parts.append(vectors.slice(begin, stop - begin))
                held, size, begin = held + stop - begin, size + int(ends[stop] - ends[begin]) * 8, stop
            if begin < batch.num_rows or held >= rows:
                yield block()
                ids, parts, held, size = [], [], 0, 0
    if held:
        yield block()


class Postings:
    """Candidates of a block by term, ordered by id with those without an id last."""

    def __init__(self, ids: np.ndarray, nulls: np.ndarray, weights: np.ndarray, bounds: np.ndarray):
        order = np.lexsort((ids, nulls))
        self.ids, self.nulls = ids[order], nulls[order]
        self.named = int((~nulls).sum())
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.largest = int(np.abs(weights.astype(np.float64)).max(initial=0))
        owner = np.repeat(place, np.diff(bounds))
        term = np.arange(len(weights)) - np.repeat(bounds[:-1], np.diff(bounds))
        some = np.flatnonzero(weights)
        some = some[np.lexsort((owner[some], term[some]))]
        self.terms = int(np.diff(bounds).max(initial=0))
        self.edges = np.searchsorted(term[some], np.arange(self.terms + 1))
        self.owner, self.weight = owner[some], weights[some]
        self.lists: dict[type, list] = {}

    def of(self, kind: type) -> list[tuple]:
        """Postings of every term: positions and weights. A list that most candidates are on is spread over all positions."""
        if kind not in self.lists:
            found = []
            for low, high in zip(self.edges[:-1], self.edges[1:]):
                at, weight = self.owner[low:high], self.weight[low:high].astype(kind)
                if 2 * len(at) > len(self.ids):
                    full = np.zeros(len(self.ids), kind)
                    full[at] = weight
                    at, weight = None, full
                found.append((at, weight))
            self.lists = {kind: found}
        return self.lists[kind]


def kind_for(largest: int, other: int, terms: int) -> type:
    """Smallest type that no sum of products can leave; Python's integers beyond a long."""
    most = max(1, largest) * max(1, other) * max(1, terms)
    return np.int32 if most < 2 ** 30 else np.int64 if most < 2 ** 62 else object


def best_in_block(postings: Postings, query_id: int, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and scores of the ``k`` best candidates of a block, ties to smaller ids."""
    kind = kind_for(postings.largest, int(np.abs(weights.astype(np.float64)).max(initial=0)), len(terms))
    lists = postings.of(kind)
    scores = np.zeros(len(postings.ids), kind)
    for term, weight in zip(terms.tolist(), weights.tolist()):
        if term < len(lists):
            at, posted = lists[term]
            if at is None:
                scores += posted * kind(weight) if kind is not object else posted * weight
            elif len(at):
                scores[at] += posted * weight
    if kind is object:
        scores = np.array([min(max(s, -LONG.max), LONG.max) for s in scores], np.int64)
    own = slice(*np.searchsorted(postings.ids[:postings.named], [query_id, query_id + 1]))
    rest = np.concatenate([np.arange(own.start), np.arange(own.stop, len(scores))]) if own.start < own.stop else None
    offered = scores if rest is None else scores[rest]
    if len(offered) > k:
        least = np.partition(offered, len(offered) - k)[len(offered) - k]
        above = np.flatnonzero(offered > least)
        chosen = np.concatenate([above, np.flatnonzero(offered == least)[:k - len(above)]])
    else:
        chosen = np.arange(len(offered))
    return (chosen if rest is None else rest[chosen]), offered[chosen]


FOUND = "query bigint, query_id bigint, vec_id bigint, score bigint"


def merged(found: list[tuple], k: int) -> list[tuple]:
    """The ``k`` best of each query of what was found so far."""
    query, query_id, vec_id, null, score = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((vec_id, null, -score, query))
    place = query[order]
    rank = np.arange(len(order)) - np.searchsorted(place, place)
    keep = order[rank < k]
    return [(query[keep], query_id[keep], vec_id[keep], null[keep], score[keep])]


def search_block(postings: Postings, row: dict, k: int) -> tuple | None:
    """The best candidates of a block for each query of a query block."""
    ids, numbers = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["numbers"], np.int64)
    weights, bounds = np.frombuffer(row["weights"], np.int64), np.frombuffer(row["bounds"], np.int64)
    found: list[list] = [[], [], [], [], []]
    for q in range(len(ids)):
        mine = weights[bounds[q]:bounds[q + 1]]
        terms = np.flatnonzero(mine)
        at, score = best_in_block(postings, int(ids[q]), terms, mine[terms], k)
        found[0].append(np.full(len(at), numbers[q]))
        found[1].append(np.full(len(at), ids[q]))
        found[2].append(postings.ids[at])
        found[3].append(postings.nulls[at])
        found[4].append(score.astype(np.int64))
    return tuple(np.concatenate(c) for c in found) if found[0] else None


def query_blocks(queries: DataFrame, scale: int) -> DataFrame:
    """Queries packed into blocks of bounded size; every query row has a number of its own."""
    def run(batches):
        for ids, _, weights, bounds in blocks_of(batches, QUERY_ROWS, scale):
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (ids, weights, bounds)] + [pa.array([len(ids)], pa.int64())],
                                             names=["ids", "weights", "bounds", "size"])
    packed = queries.mapInArrow(run, "ids binary, weights binary, bounds binary, size bigint")
    return materialize(packed.withColumn("block", F.monotonically_increasing_id()), "query-blocks")


def search(candidates: DataFrame, queries: DataFrame, k: int = K, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` candidates of largest inner product for each row of ``queries``.

    Both frames have ``vec_id`` and ``embedding``; components are taken as ``floor(scale * c)``. Vectors that are null
    or hold null or non-finite components take no part, on either side; an empty vector scores 0 everywhere. Of vectors of
    different sizes the common dimensions count. A query never finds a row of its own id. Rows without an id are candidates,
    last among ties, and no queries. Repeated rows are rows of their own: a repeated query is answered
    each time, and repeated candidates fill a rank each. Fewer than ``k`` candidates give fewer ranks. Components and scores beyond
    a long are the nearest long.
    """
    spark = candidates.sparkSession

    def usable(df: DataFrame) -> DataFrame:
        rows = df.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
        return rows.where(finite(F.col("embedding")))
    blocks = query_blocks(usable(queries).where("vec_id is not null"), scale)
    # Waves: blocks in order, cut where the running size passes the bound; a small table of sizes.
    sized = blocks.select("block", (F.length("weights") + F.length("ids") * 2 + F.length("bounds")).alias("bytes"), "size").orderBy("block").collect()
    waves, room, numbers = [], 0, 0
    for block, size, rows in sized:
        if not waves or room + size > WAVE_BYTES:
            waves.append([])
            room = 0
        waves[-1].append((block, numbers))
        room, numbers = room + size, numbers + rows
    offered = usable(candidates)
    found = None
    for wave in waves:
        starts = {block: first for block, first in wave}
        rows = blocks.where(F.col("block").isin(list(starts))).collect()
        carried = spark.sparkContext.broadcast([
            {"ids": bytes(r.ids), "weights": bytes(r.weights), "bounds": bytes(r.bounds),
             "numbers": np.arange(starts[r.block], starts[r.block] + r.size).tobytes()} for r in rows])

        def run(batches, carried=carried):
            held: list[tuple] = []
            for ids, nulls, weights, bounds in blocks_of(batches, BLOCK_ROWS, scale):
                postings = Postings(ids, nulls, weights, bounds)
                held += [f for row in carried.value if (f := search_block(postings, row, k)) is not None]
                held = merged(held, k) if held else held
            if held:
                query, query_id, vec_id, null, score = held[0]
                yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(query_id), pa.array(vec_id, pa.int64(), mask=null), pa.array(score)],
                                                 names=[c.split()[0] for c in FOUND.split(", ")])
        part = materialize(offered.mapInArrow(run, FOUND), "found")
        found = part if found is None else found.union(part)
        carried.unpersist()
    if found is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
