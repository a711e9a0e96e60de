"""Embedding links against brute force, and their recall at the threshold."""

import numpy as np
import pytest

from wardlog.llm import embeddings, queries

SF = "/root/testdata/sf0.001"


def brute(ids, matrix, threshold=0.9):
    unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    linked = unit @ unit.T >= threshold
    np.fill_diagonal(linked, False)
    root = np.array(ids)
    while True:
        new = np.array([min(root[i], root[linked[i]].min(initial=root[i])) for i in range(len(ids))])
        if (new == root).all():
            break
        root = new
    return {i: (int(n), int(r), bool(i == r)) for i, n, r in zip(ids, linked.sum(axis=1), root)}


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    want = brute([r.vec_id for r in rows], np.array([r.embedding for r in rows], float))
    got = queries.QUERIES["op9_embedding_near_dedup"](spark, SF).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == want and len(got) == len(rows)


def clustered(n, size, rng):
    base = rng.standard_normal((n // 10, size))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    pick = base[rng.integers(0, len(base), n)]
    noise = rng.standard_normal((n, size))
    noise -= (noise * pick).sum(axis=1, keepdims=True) * pick
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    cos = rng.uniform(0.9, 1.0, (n, 1))
    return cos * pick + np.sqrt(1 - cos ** 2) * noise


def test_recall_of_random_pairs(spark):
    rng = np.random.default_rng(4)
    matrix = clustered(4000, 24, rng)
    want = brute(range(4000), matrix)
    got = embeddings.near_duplicates(spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(matrix)], "vec_id bigint, embedding array<double>")).collect()
    found, all_of = sum(r.n_links for r in got), sum(w[0] for w in want.values())
    assert all(r.n_links <= want[r.vec_id][0] for r in got)
    assert found >= 0.995 * all_of > 1000


def test_large_cells_are_counted_once(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "SEGMENT", 50)
    rng = np.random.default_rng(5)
    matrix = np.ones(16) + 0.05 * rng.standard_normal((300, 16))
    want = brute(range(300), matrix)
    got = embeddings.near_duplicates(spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(matrix)], "vec_id bigint, embedding array<double>")).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == want


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 5), (2, [2.0, 0.0], 5), (3, [1.0, 0.0], None), (4, None, 1), (5, [], 1), (6, [0.0, 0.0], 1), (7, [nan, 1.0], 1),
            (8, [inf, 1.0], 1), (9, [None, 1.0], 1), (10, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.01], 1), (11, [-1.0, 0.0], 1), (1, [1.0, 0.0], 5)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").withColumnRenamed("label", "component_id")
    got = sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(frame).collect())
    assert got == sorted([("1", 4, 1, True), ("1", 4, 1, True), ("2", 4, 1, False), ("3", 4, 1, False), ("None", 4, 1, False),
                          *[(str(k), 0, k, True) for k in (4, 5, 6, 7, 8, 9, 10, 11)]])
    assert embeddings.near_duplicates(frame.where("false")).count() == 0


@pytest.mark.parametrize("bits", [0, 4, 12])
def test_calibration_reaches_the_recall(bits):
    half, least = embeddings.calibrate(0.9, 0.999, 32)
    rng = np.random.default_rng(1)
    difference = np.sqrt(0.2) * rng.standard_normal((20_000, 32))
    assert ((np.abs(difference) <= half).sum(axis=1) >= least).mean() > 0.998
    assert embeddings.tables_for(0.9, 0.999, bits, 2.5) >= 1
