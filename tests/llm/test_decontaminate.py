"""Leaks of benchmark items against brute force."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import awkward, empty
from wardlog.llm import decontaminate, queries

SF = "/root/testdata/sf0.001"


def edit_distance_within(text, pattern, k):
    """Whether ``pattern`` aligns somewhere in ``text`` with at most ``k`` edits (plain dynamic programming)."""
    row = np.zeros(len(text) + 1, int)
    letters = np.array(list(text))
    steps = np.arange(len(text) + 1)
    for c in pattern:
        new = np.concatenate([[row[0] + 1], np.minimum(row[:-1] + (letters != c), row[1:] + 1)])
        row = np.minimum.accumulate(new - steps) + steps
    return row.min() <= k


def brute(text, item):
    text, item = decontaminate.normal(text), decontaminate.normal(item)
    size, k, _ = decontaminate.budget(len(item))
    # By definition an item shorter than a q-gram is not looked for.
    return bool(text) and len(item) >= decontaminate.Q and any(edit_distance_within(text, item[s:s + size], k) for s in range(0, len(item) - size + 1))


def test_query_finds_exact_passages_and_no_stranger(spark):
    docs = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    items = duckdb.sql(f"select item_id, text from '{SF}/benchmark.parquet'").fetchall()
    norm = {d: decontaminate.normal(t) for d, t in docs}
    exact = {(d, i) for d, t in norm.items() for i, x in items if decontaminate.normal(x) in t}
    got = queries.QUERIES["op1_decontamination"](spark, SF).collect()
    pairs = {(r.doc_id, r.item_id) for r in got}
    assert len(pairs) == len(got) and exact and exact <= pairs
    item = dict(items)
    for d, i in pairs - exact:
        assert brute(norm[d], item[i])


def changed(text, rng, edits):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.random()
        if kind < 0.4:
            out[at] = rng.choice("xyzé")
        elif kind < 0.7:
            del out[at]
        else:
            out.insert(at, rng.choice("xyz"))
    return "".join(out)


def test_edited_passages_equal_brute_force(spark):
    rng = random.Random(7)
    def prose(n):
        return "".join(rng.choice("abcdefghij    ") for _ in range(n)).strip()
    items = [(k, prose(rng.choice([14, 22, 40, 90, 150]))) for k in range(12)]
    docs = []
    for d in range(90):
        item = decontaminate.normal(rng.choice(items)[1])
        piece = item if d % 3 else item[:rng.randint(10, len(item))]
        docs.append((d, prose(rng.randint(0, 80)) + " " + changed(piece, rng, rng.randint(0, 7)) + " " + prose(rng.randint(0, 60))))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(frame, bench).collect()}
    assert got == {(d, i) for d, t in docs for i, x in items if brute(t, x)}
    assert got


@pytest.mark.parametrize("frame", [awkward, empty])
def test_awkward_input(spark, frame):
    docs = frame(spark)
    bench = spark.createDataFrame([(1, "alpha beta gamma delta alpha beta gamma"), (2, None), (None, "no id here at all"), (3, ""), (4, "short")],
                                  "item_id bigint, text string").withColumn("row", F.lit("x"))
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect()}
    assert got == ({(1, 1), (2, 1)} if docs.count() else set())
    unnamed = decontaminate.without_leaks(docs, bench.withColumn("item_id", F.lit(None).cast("bigint")))
    assert unnamed.columns == docs.columns and unnamed.count() == max(0, docs.count() - 3)
    assert decontaminate.leaks(docs, bench.where("false")).count() == 0
