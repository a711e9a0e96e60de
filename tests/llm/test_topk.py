"""Exact search against plain inner products."""

import math

import numpy as np
import pytest

from wardlog.llm import queries, topk

SF = "/root/testdata/sf0.001"


def plain(candidates, asked, k=5):
    """``(query_id, rank, vec_id, score)`` of vectors given as ``(vec_id, components)``."""
    def whole(rows):
        return [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    offered = whole(candidates)
    out = []
    for i, q in whole(asked):
        if i is None:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(q, v)), j is None, j or 0) for j, v in offered if j != i))[:k]
        out += [(i, r + 1, None if null else j, -s) for r, (s, null, j) in enumerate(scored)]
    return out


def told(frame):
    return sorted(map(str, (tuple(r) for r in frame.select("query_id", "rank", "vec_id", "score").collect())))


def test_query_equals_plain_search(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = plain(rows, [r for r in rows if r[0] % 50 == 0])
    assert told(queries.QUERIES["op13_exact_topk"](spark, SF)) == sorted(map(str, want)) and want


@pytest.mark.parametrize("bounds", [(1024, 4096, 1 << 20, 32 << 20), (3, 5, 1 << 20, 1 << 20), (4, 7, 300, 900)])
def test_blocks_waves_and_ties(spark, monkeypatch, bounds):
    for name, value in zip(("QUERY_ROWS", "BLOCK_ROWS", "BLOCK_BYTES", "WAVE_BYTES"), bounds):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(2)
    rows = [(int(i), (rng.integers(-2, 3, 6) * (rng.random(6) < 0.4) / 256).tolist()) for i in rng.permutation(90)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    got = topk.search(frame, frame.where("vec_id % 10 = 0"), k=7)
    assert told(got) == sorted(map(str, plain(rows, [r for r in rows if r[0] % 10 == 0], 7)))


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (1, [0.5, 0.5], None), (1, [0.5, 0.5], 1), (2, None, 1), (3, [], 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1),
            (6, [None, 1.0], 1), (50, [0.1, 0.2, 0.3], 1), (None, [2.0, 2.0], 1), (None, [0.5, 0.5], 1), (100, [], 1), (150, [-0.001, -1.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, score int")
    bare = [r[:2] for r in rows]
    want = plain(bare, [r for r in bare if r[0] is not None and r[0] % 50 == 0])
    assert told(topk.search(frame, frame.where("vec_id % 50 = 0"))) == sorted(map(str, want))
    assert topk.search(frame.where("false"), frame).count() == 0 and topk.search(frame, frame.where("false")).count() == 0


def test_large_components(spark):
    rows = [(0, [1e12, 3.0]), (1, [1e12, -1.0]), (2, [2e12, 2.0]), (3, [-5.0, 1e5]), (4, [1e300, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = [tuple(r) for r in topk.search(frame, frame.where("vec_id in (0, 3)"), k=2).orderBy("query_id", "rank").collect()]
    most = 2 ** 63 - 1
    assert got[:2] == [(0, 1, 1, most), (0, 2, 2, most)]  # equal once they are the nearest long
    assert got[2] == (3, 1, 0, math.floor(256e12) * -1280 + 768 * 25_600_000) and got[3][:3] == (3, 2, 1)
