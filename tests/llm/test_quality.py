"""The additive model: features, fitting, held-out accuracy."""

import collections
import math
import random

import duckdb
import numpy as np
import pytest

from tests.llm.helpers import awkward, empty
from tests.llm.test_toxicity import area
from wardlog.llm import quality, queries

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op4_quality"](spark, SF).collect()}
    labels = duckdb.sql(f"select doc_id, quality from '{SF}/labels.parquet'").fetchall()
    held = [(got[d].score, y) for d, y in labels if got[d].held_out]
    scores, truth = (np.array(x) for x in zip(*held))
    assert area(scores, truth) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())


def test_features_of_a_text_do_not_depend_on_its_neighbours():
    texts = [b"", b"One two two.\nOne TWO! | 5\n", "é ß two".encode(), b" ", b"a a a a\na a a a", b"x" * 5000]

    def read(some):
        data = np.frombuffer(b"".join(some), np.uint8)
        return quality.features(data, np.concatenate([[0], np.cumsum([len(t) for t in some])]).astype(np.int64))
    together = read(texts)
    for t, row in zip(texts, together):
        np.testing.assert_allclose(read([t])[0], row, rtol=1e-5, atol=1e-6)
    at = {n: k for k, n in enumerate(quality.FEATURES)}
    assert together[1, at["log_words"]] == pytest.approx(np.log1p(7))
    assert together[1, at["distinct_words"]] == pytest.approx(6 / 7)
    assert together[4, at["top_word"]] == 1 and together[4, at["distinct_lines"]] == 1
    assert not together[0].any()


def plain_features(text):
    """The features of an ASCII text, counted word by word and line by line."""
    words, lines = text.split(), text.splitlines(keepends=True)
    n, counts = len(words), collections.Counter(words)
    wide = [len(w) for w in words]
    out = {"log_bytes": math.log1p(len(text)), "log_words": math.log1p(n), "distinct_words": len(counts) / max(1, n),
           "top_word": max(counts.values(), default=0) / max(1, n), "distinct_lines": len(set(lines)) / max(1, len(lines)),
           "mean": sum(wide) / max(1, n), "short": sum(w <= 3 for w in wide) / max(1, n), "long": sum(w >= 12 for w in wide) / max(1, n),
           "capital": sum(w[0].isupper() for w in words) / max(1, n), "same": sum(a == b for a, b in zip(words, words[1:])) / max(1, n),
           "marked": sum(not w[-1].isalnum() for w in words) / max(1, n)}
    mean = out["mean"]
    out["spread"] = math.sqrt(sum((w - mean) ** 2 for w in wide) / max(1, n))
    return out


def test_features_equal_a_plain_count():
    rng = random.Random(3)
    texts = ["".join(rng.choice(["the ", "Word ", "word ", "extraordinarily ", "a, ", "end.\n", "X ", "12 ", "\n"]) for _ in range(rng.randrange(80))) for _ in range(60)]
    data = [t.encode() for t in texts]
    got = quality.features(np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in data])]).astype(np.int64))
    first = len(quality.CLASSES)
    order = ["log_bytes", "log_words", "mean", "spread", "short", "long", "capital", "distinct_words", "top_word", "same", None, "distinct_lines", None, "marked"]
    for row, text in zip(got, texts):
        want = plain_features(text)
        for k, name in enumerate(order):
            if name:
                assert row[first + k] == pytest.approx(want[name], rel=1e-4, abs=1e-5), (name, text)


def test_margins_equal_a_plain_loop_over_tables():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 5)).astype(np.float32).round(1)  # values fall on the borders of bins, too
    model = quality.fit_tables(x, ((x[:, 0] * x[:, 1] + x[:, 2]) > 0).astype(float))
    assert model.pairs
    for row, got in zip(x[:200], model.margin(x[:200])):
        total = model.bias
        for j, value in enumerate(row):
            total += model.tables[j][sum(value >= e for e in model.edges[j])]
        for k, (a, b) in enumerate(model.pairs):
            total += model.pair_tables[k][sum(row[a] >= e for e in model.pair_edges[a])][sum(row[b] >= e for e in model.pair_edges[b])]
        assert got == pytest.approx(total, abs=1e-9)


def test_pairs_learn_what_single_tables_cannot():
    rng = np.random.default_rng(1)
    x = rng.uniform(-1, 1, (4000, 4)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.1)).astype(float)
    model = quality.fit_tables(x[:3000], y[:3000])
    assert (0, 1) in model.pairs
    assert area(model.margin(x[3000:]), y[3000:]) > 0.97


@pytest.mark.parametrize("frame", [awkward, empty])
def test_awkward_input(spark, frame):
    docs = frame(spark)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (4, 7), (99, 1)], "doc_id bigint, quality int")
    assert quality.classify(docs, labels).count() == docs.count()
    assert quality.classify(docs, labels.where("false")).count() == docs.count()
