"""Label statistics and classification quality."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlog.operators.keyed import exact_quantiles, running_totals


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def describe_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: count, mean, std, min, quartiles, max (exact)."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns]))
    tall = df.select(pairs.alias("_p")).select("_p.column", "_p.x").where("x is not null")
    basics = tall.groupBy("column").agg(
        F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"), F.max("x").alias("max"))
    quarters = exact_quantiles(tall, ["column"], F.col("x"), [0.25, 0.5, 0.75])
    at = lambda p: F.max(F.when(F.col("prob") == p, F.col("quantile")))
    spread = quarters.groupBy("column").agg(at(0.25).alias("p25"), at(0.5).alias("p50"), at(0.75).alias("p75"))
    return basics.join(F.broadcast(spread), "column")


def dataset_profile(df: DataFrame) -> DataFrame:
    """Row, column, label and address counts of one dataset as a single row."""
    names = set(df.columns)
    zero = F.lit(0).cast("bigint")
    attack = F.col("is_attack").cast("string") if "is_attack" in names else None
    hostile = F.lower(attack).isin("true", "1") if attack is not None else None
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.lit("timestamp" in names).alias("has_timestamp"),
        (F.count_if(hostile) if hostile is not None else zero).alias("attack_rows"),
        (F.count_if(~hostile) if hostile is not None else zero).alias("normal_rows"),
        (F.count_distinct("source_ip") if "source_ip" in names else zero).alias("unique_ips"))


def column_types(df: DataFrame) -> DataFrame:
    """Column names and types of a dataset."""
    schema = T.StructType([T.StructField("position", T.IntegerType()), T.StructField("name", T.StringType()),
                           T.StructField("type", T.StringType())])
    rows = [(i, n, t) for i, (n, t) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, schema)


def top_values(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """Most frequent values; ties go to the smaller value."""
    return (df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), F.col(column)).limit(k))


def confusion_matrix(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """All four cells of a binary confusion matrix, zeros included."""
    cells = df.agg(*[
        F.count_if((F.col(label).cast("int") == a) & (F.col(predicted).cast("int") == b)).alias(f"c{a}{b}")
        for a in (0, 1) for b in (0, 1)])
    rows = F.array(*[F.struct(F.lit(a).alias("label"), F.lit(b).alias("predicted"), F.col(f"c{a}{b}").alias("n"))
                     for a in (0, 1) for b in (0, 1)])
    return cells.select(F.explode(rows).alias("_c")).select("_c.*")


def _counts(df: DataFrame, label: str, predicted: str) -> DataFrame:
    y, p = F.col(label).cast("int"), F.col(predicted).cast("int")
    return df.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"))


def _ratio(a, b):
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def _scores(tp, fp, fn):
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    return precision, recall, _ratio(2 * precision * recall, precision + recall)


def binary_metrics(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Precision, recall and F1 of the positive class; an empty denominator gives 0."""
    precision, recall, f1 = _scores(F.col("tp"), F.col("fp"), F.col("fn"))
    return _counts(df, label, predicted).select(
        precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "tp", "fp", "fn", "tn")


def classification_report(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Per class, accuracy, macro and weighted averages: ``name, precision, recall, f1, support``."""
    c = {k: F.col(k) for k in ("tp", "fp", "fn", "tn")}
    neg = _scores(c["tn"], c["fn"], c["fp"])
    pos = _scores(c["tp"], c["fp"], c["fn"])
    n0, n1 = c["tn"] + c["fp"], c["tp"] + c["fn"]
    total = n0 + n1
    accuracy = _ratio(c["tp"] + c["tn"], total)
    macro = [(a + b) / 2 for a, b in zip(neg, pos)]
    weighted = [_ratio(a * n0 + b * n1, total) for a, b in zip(neg, pos)]
    def line(name, values, support):
        p, r, f = values
        return F.struct(F.lit(name).alias("name"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1"), support.alias("support"))
    table = F.array(line("0", neg, n0), line("1", pos, n1), line("accuracy", [accuracy] * 3, total),
                    line("macro avg", macro, total), line("weighted avg", weighted, total))
    return _counts(df, label, predicted).select(F.explode(table).alias("_r")).select("_r.*")


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve by average ranks, null with a single class.

    Rows collapse to distinct scores first; only those are put in order.
    """
    y = F.col(label).cast("int")
    tied = df.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("score")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
    ranked = running_totals(tied, ["score"], {"neg_upto": "neg"})
    below = F.col("neg_upto") - F.col("neg") / 2
    return ranked.agg(F.sum(F.col("pos") * below).alias("_w"), F.sum("pos").alias("_p"), F.sum("neg").alias("_n")).select(
        F.try_divide(F.col("_w"), F.col("_p").cast("double") * F.col("_n")).alias("roc_auc"))


def score_threshold(df: DataFrame, score: str, contamination: float, mode: str = "reference") -> DataFrame:
    """Score bound below which a row is an anomaly (low scores are anomalous).

    ``reference`` mode takes the (1 - contamination) percentile; ``tail`` takes
    the contamination percentile, flagging only that share of the rows.
    """
    prob = 1.0 - contamination if mode == "reference" else contamination
    return exact_quantiles(df, [], F.col(score), [prob]).select(F.col("quantile").alias("threshold"))


def anomaly_rate(df: DataFrame, flag: str = "ml_anomaly") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col(flag)).alias("anomalies")).withColumn(
        "rate", F.try_divide("anomalies", "total"))


def detection_accuracy(df: DataFrame, predicted: str = "ml_anomaly", label: str = "is_attack") -> DataFrame:
    """Share of rows where prediction and label agree, in percent with one decimal."""
    same = F.col(predicted).cast("boolean") == F.col(label).cast("boolean")
    return df.agg(F.round(F.avg(same.cast("double")) * 100, 1).alias("accuracy"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
