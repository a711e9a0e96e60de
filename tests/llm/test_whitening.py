"""Whitening against plain matrices."""

import math

import numpy as np
import pytest

from wardlog.llm import queries, whitening

SF = "/root/testdata/sf0.001"


def plain(vectors, copies=False):
    x = np.array([[math.floor(256 * float(c)) for c in v] for v in vectors])
    distinct, counts = np.unique(x, axis=0, return_counts=True)
    weight = counts if copies else np.ones(len(distinct), int)
    n, sums = int(weight.sum()), (distinct * weight[:, None]).sum(axis=0)
    centred = distinct - sums / n
    covariance = (centred * weight[:, None]).T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    return n, deviation, (x - sums / n) @ axes / np.sqrt(np.maximum(values, 1e-30)), values / np.trace(covariance)


def check(rows, ids, vectors, copies=False):
    n, deviation, whitened, explained = plain(vectors, copies)
    at = {i: k for k, i in enumerate(ids)}
    k = min(4, whitened.shape[1])
    assert sorted((r.vec_id, r.component) for r in rows) == sorted((i, c) for i in ids for c in range(1, k + 1))
    signs = {}
    for r in rows:
        want = whitened[at[r.vec_id], r.component - 1]
        if abs(want) > 1e-3:
            signs.setdefault(r.component, np.sign(want) * np.sign(r.whitened))
        assert abs(r.whitened - signs.get(r.component, 1) * want) < 1e-6
        assert (r.n, r.deviation) == (n, deviation[at[r.vec_id]])
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9


def test_query_equals_plain_matrices(spark):
    given = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    rows = queries.QUERIES["op12_embedding_whitening"](spark, SF).collect()
    check(rows, [r.vec_id for r in given], [r.embedding for r in given])


@pytest.mark.parametrize("weights", ["one", "copies"])
def test_multiplicities(spark, weights):
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((60, 3))
    vectors[20:50] = vectors[0]
    vectors[50:] += 7
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    rows = whitening.whiten_embeddings(frame.repartition(7), weights=weights).collect()
    check(rows, range(60), vectors, weights == "copies")
    assert {r.copies for r in rows if r.vec_id == 25} == {31}
    with pytest.raises(ValueError):
        whitening.whiten_embeddings(frame, weights="two")


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 0.0], 5), (1, [0.5, 0.0], 5), (2, [-0.0, 0.25], None), (None, [0.0, 0.25], 1), (3, None, 1), (4, [], 1), (5, [nan, 1.0], 1),
            (6, [inf, 1.0], 1), (7, [None, 1.0], 1), (8, [1.0, 2.0, 3.0], 1), (9, [1e300], 1), (10, [1.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").withColumnRenamed("label", "copies")
    got = whitening.whiten_embeddings(frame.withColumnRenamed("copies", "n")).collect()
    by = {(r.vec_id, r.component): r for r in got}
    assert len(got) == 4 * 2 + 3 + 2
    # Two distinct vectors vary along one line only: the second component has no spread.
    assert abs(by[1, 1].whitened) == pytest.approx(1) and by[1, 1].whitened == -by[2, 1].whitened == -by[None, 1].whitened
    assert by[1, 2].whitened is None and by[1, 1].explained == pytest.approx(1) and by[1, 1].identity_error < 1e-9
    assert (by[1, 1].n, by[1, 1].deviation, by[1, 1].copies) == (2, (2 * 128 - 128) ** 2 + 64 ** 2, 2)
    assert [by[8, c].whitened for c in (1, 2, 3)] == [None] * 3 and by[8, 1].explained is None and by[8, 1].deviation == 0
    assert by[9, 1].deviation is None and abs(by[9, 1].whitened) == pytest.approx(1)
    assert by[9, 1].deviation_exact == (2 * (2 ** 63 - 1) - (2 ** 63 - 1 + 256)) ** 2 or by[9, 1].deviation_exact is None
    assert whitening.whiten_embeddings(frame.where("false")).count() == 0
    assert whitening.whiten_embeddings(spark.createDataFrame([(1, [1.0])], "vec_id int, embedding array<float>")).first().identity_error is None
