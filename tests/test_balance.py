import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wardlog.operators import balance as bal

T0 = dt.datetime(2024, 1, 1)


def _tagged(rows, counts):
    """counts: source -> (normal, attack)."""
    data, i = [], 0
    for source, (normal, attack) in counts.items():
        for hostile in [False] * normal + [True] * attack:
            data.append((i, hostile, source))
            i += 1
    return rows(data, "id int, is_attack boolean, _source string")


@pytest.mark.parametrize("counts,kept", [
    ({"Kaggle": (10, 50), "Synthetic": (10, 20)}, {"Kaggle": 10, "Synthetic": 20}),
    ({"Kaggle": (2, 50), "Synthetic": (2, 20), "Custom": (0, 3)}, {"Synthetic": 3, "Custom": 3}),
    ({"Other": (4, 30), "Kaggle": (0, 5)}, {"Other": 6}),
    ({"Kaggle": (0, 9)}, {"Kaggle": 9}),
    ({"Kaggle": (9, 0)}, {}),
    ({"Kaggle": (100, 5)}, {"Kaggle": 5}),
    ({"Russell Mitchell": (3, 9), "Custom": (0, 1)}, {"Russell Mitchell": 4})])
def test_rebalance_quotas(rows, counts, kept):
    df = _tagged(rows, counts)
    out = bal.rebalance_sources(df, "id")
    assert out.where("not is_attack").count() == sum(n for n, _ in counts.values())
    got = {r._source: r["count"] for r in out.where("is_attack").groupBy("_source").count().collect()}
    # Custom is dropped before Russell Mitchell; an exact half rounds to even.
    assert got == kept


def test_conform_training(rows):
    df = rows([("h", "12.5", "Hanoi", None), ("h", "VN", None, True)], "host string, geoip_country string, geoip_city string, is_attack boolean")
    out = bal.conform_training(df)
    assert len(out.columns) == 21 and "host" not in out.columns
    assert [(r.geoip_country, r.geoip_city, r.is_attack) for r in out.collect()] == [(12.5, 0.0, False), (0.0, 0.0, True)]


def test_unified_training_is_sorted_nulls_last(rows):
    a = rows([(1, T0, True), (2, None, False)], "id int, timestamp timestamp, is_attack boolean")
    b = rows([(3, T0 - dt.timedelta(days=1), False)], "id int, timestamp timestamp, is_attack boolean")
    out = bal.unified_training({"Custom": a, "Kaggle": b}, "id")
    assert [r.id for r in out.collect()] == [3, 1, 2] and "_source" not in out.columns


@pytest.mark.parametrize("small,large", [(7, 100), (1, 13), (20, 20)])
def test_resampling_evens_classes(spark, small, large):
    df = spark.range(small + large).select("id", (F.col("id") < small).alias("y"))
    count = lambda frame: {r.y: r["count"] for r in frame.groupBy("y").count().collect()}
    assert count(bal.undersample(df, "y", "id")) == {True: small, False: small}
    over = bal.oversample(df, "y", "id")
    assert count(over) == {True: max(small, large), False: max(small, large)}
    assert over.select("id").distinct().count() == small + large


def test_folds_are_even(spark):
    df = spark.range(103).select("id", (F.col("id") % 4 == 0).alias("y"))
    out = bal.stratified_folds(df, "y", "id", 5).groupBy("y", "fold").count().collect()
    sizes = {y: sorted(r["count"] for r in out if r.y == y) for y in (True, False)}
    assert sizes == {True: [5, 5, 5, 5, 6], False: [15, 15, 15, 16, 16]}


def test_stratified_split(spark):
    df = spark.range(50).select("id", (F.col("id") < 10).alias("y"))
    out = bal.stratified_split(df, "y", "id").groupBy("y", "is_test").count().collect()
    assert {(r.y, r.is_test): r["count"] for r in out} == {(True, True): 2, (True, False): 8, (False, True): 8, (False, False): 32}


@pytest.mark.parametrize("n,ratio", [(10, 0.7), (33, 0.5), (1, 0.7), (5, 1.0)])
def test_time_split(rows, n, ratio):
    rng = random.Random(n)
    data = [(i, T0 + dt.timedelta(hours=rng.randrange(4))) for i in range(n)]
    out = bal.time_split(rows(data, "id int, timestamp timestamp"), "id", ratio).collect()
    size = int(n * ratio)
    train = [r.timestamp for r in out if r.is_train]
    test = [r.timestamp for r in out if not r.is_train]
    assert len(train) == (size if 0 < size < n else n)
    assert not test or max(train) <= min(test)


def test_hot_timestamp_is_split_exactly(spark):
    df = spark.range(300).select("id", F.lit(T0).alias("timestamp"))
    assert bal.time_split(df, "id", 0.7).where("is_train").count() == 210


def test_too_many_classes_fail(spark, monkeypatch):
    monkeypatch.setattr(bal, "MAX_CLASSES", 5)
    with pytest.raises(Exception, match="too many classes"):
        bal.undersample(spark.range(10).withColumn("y", F.col("id")), "y", "id").count()
