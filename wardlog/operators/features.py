"""Cleaning and feature columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlog.functions import values as V
from wardlog.functions.parsing import is_failed
from wardlog.operators.keyed import attach_by_key, running_totals, scalar
from wardlog.operators.windows import failed_login_window
from wardlog.schema import has

# The model's input columns in order, and columns never scaled.
BASE_FEATURES = ("hour", "day_of_week", "is_weekend", "requests_per_ip", "failed_login_count")
WEB_FEATURES = ("request_length", "has_query_string", "is_4xx", "is_5xx",
                "error_rate_per_ip", "response", "count_4xx_per_ip", "count_5xx_per_ip")
ENCODED_COLUMNS = ("user", "geoip_country", "geoip_city")
NOT_NORMALIZED = ("is_attack", "ml_anomaly", "status")
WORK_START, WORK_END, SATURDAY = 9, 17, 5


def dedup_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def fill_missing(df: DataFrame) -> DataFrame:
    """Numbers to 0 and text to ``unknown``; flags and timestamps stay as they are."""
    numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.fillna(0, numbers).fillna("unknown", texts)


def clean(df: DataFrame) -> DataFrame:
    return fill_missing(dedup_rows(df))


def drop_unusable(df: DataFrame) -> DataFrame:
    """Rows with neither address nor status are useless for training."""
    return df.dropna(how="all", subset=["source_ip", "status"])


def time_features(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Calendar parts (Monday is 0) and the weekend and working-hour flags."""
    stamp = F.col(ts)
    flag = lambda cond: F.coalesce(cond, F.lit(False)).cast("int")
    return (df.withColumn("hour", F.hour(stamp)).withColumn("day_of_week", F.weekday(stamp))
            .withColumn("day_of_month", F.dayofmonth(stamp)).withColumn("month", F.month(stamp))
            .withColumn("is_weekend", flag(F.col("day_of_week") >= SATURDAY))
            .withColumn("is_business_hours", flag(F.col("hour").between(WORK_START, WORK_END))))


def ip_features(df: DataFrame, ip: str = "source_ip") -> DataFrame:
    """``requests_per_ip`` (null for a null address) and ``ip_hash``."""
    stats = df.where(F.col(ip).isNotNull()).groupBy(ip).agg(F.count(F.lit(1)).alias("requests_per_ip"))
    rows = attach_by_key(df, stats, [ip], ["requests_per_ip"], "requests_per_ip")
    return rows.withColumn("ip_hash", V.ip_hash(F.col(ip)))


def failed_login_count(df: DataFrame, ip: str = "source_ip") -> DataFrame:
    stats = df.where(is_failed(F.col("status")) & F.col(ip).isNotNull()).groupBy(ip).agg(
        F.count(F.lit(1)).alias("failed_login_count"))
    rows = attach_by_key(df, stats, [ip], ["failed_login_count"], "failed_login_count")
    return rows.fillna(0, ["failed_login_count"])


def attack_type_frequency(df: DataFrame, source: DataFrame | None = None) -> DataFrame:
    known = (df if source is None else source).where("attack_type is not null")
    stats = known.groupBy("attack_type").agg(F.count(F.lit(1)).alias("attack_type_frequency"))
    rows = attach_by_key(df, stats, ["attack_type"], ["attack_type_frequency"], "attack_type_frequency")
    return rows.fillna(0, ["attack_type_frequency"])


def attack_features(df: DataFrame, window_minutes: int = 5) -> DataFrame:
    """Failed logins per address, in the trailing window, and attack-type frequency."""
    rows = df
    if has(df, "status") and has(df, "source_ip"):
        rows = failed_login_window(failed_login_count(rows), window_minutes, source=df)
    return attack_type_frequency(rows, df) if has(df, "attack_type") else rows


def ssh_features(df: DataFrame, window_minutes: int = 5) -> DataFrame:
    """All SSH features with one per-address aggregate instead of two.

    Every statistic is computed from ``df`` itself, never from rows that already
    went through a join, so the input is read once per statistic and once more.
    """
    stats = df.where("source_ip is not null").groupBy("source_ip").agg(
        F.count(F.lit(1)).alias("requests_per_ip"),
        F.count_if(is_failed(F.col("status"))).alias("failed_login_count"))
    rows = attach_by_key(time_features(df), stats, ["source_ip"],
                         ["requests_per_ip", "failed_login_count"], "requests_per_ip")
    rows = rows.withColumn("ip_hash", V.ip_hash(F.col("source_ip"))).fillna(0, ["failed_login_count"])
    rows = failed_login_window(rows, window_minutes, source=df)
    return attack_type_frequency(rows, df) if has(df, "attack_type") else rows


def request_features(df: DataFrame) -> DataFrame:
    """Per-row web features; missing input columns give zeros."""
    text = F.coalesce(F.col("request"), F.lit("")) if has(df, "request") else F.lit("")
    code = F.coalesce(F.col("response").try_cast("double").try_cast("int"), F.lit(0)) if has(df, "response") else F.lit(0)
    return (df.withColumn("request_length", F.length(text))
            .withColumn("has_query_string", text.contains("?").cast("int"))
            .withColumn("response", code)
            .withColumn("is_4xx", F.col("response").between(400, 499).cast("int"))
            .withColumn("is_5xx", (F.col("response") >= 500).cast("int")))


def web_features(df: DataFrame, ip: str = "source_ip") -> DataFrame:
    """Request features plus request, error counts and error rate per address."""
    rows = request_features(df)
    if not has(df, ip):
        return rows
    stats = rows.where(F.col(ip).isNotNull()).groupBy(ip).agg(
        F.count(F.lit(1)).alias("requests_per_ip"),
        F.sum("is_4xx").alias("count_4xx_per_ip"), F.sum("is_5xx").alias("count_5xx_per_ip"))
    names = ["requests_per_ip", "count_4xx_per_ip", "count_5xx_per_ip"]
    rows = rows.drop(*[n for n in names if has(rows, n)])
    rows = attach_by_key(rows, stats, [ip], names, "requests_per_ip").fillna(0, names)
    errors = F.col("count_4xx_per_ip") + F.col("count_5xx_per_ip")
    return rows.withColumn("error_rate_per_ip", F.coalesce(
        F.try_divide(errors, F.col("requests_per_ip")), F.lit(0.0)))


def feature_set(df: DataFrame, log_type: str = "auto") -> tuple[bool, bool]:
    """Which feature families apply: ``(ssh, web)``."""
    web = has(df, "request") and has(df, "response")
    ssh = has(df, "status") and has(df, "source_ip")
    if log_type == "auto":
        return ssh or not web, web
    return log_type in ("ssh", "both"), log_type in ("web", "both")


def preprocess(df: DataFrame, log_type: str = "auto", window_minutes: int = 5,
               cleaned: bool = True, normalize: bool = False) -> DataFrame:
    """Clean, then derive every feature the columns allow."""
    rows = clean(df) if cleaned else df
    _, web = feature_set(df, log_type)
    ip = "source_ip" if has(df, "source_ip") else "clientip"
    logins = has(df, "status") and has(df, "source_ip")
    if logins and has(df, "timestamp"):
        rows = ssh_features(rows, window_minutes)
    else:
        rows = time_features(rows) if has(df, "timestamp") else rows
        rows = ip_features(rows, ip) if has(df, ip) else rows
    if web:
        rows = web_features(rows, ip)
    return minmax_normalize(rows) if normalize else rows


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in NOT_NORMALIZED]


def minmax_normalize(df: DataFrame, columns: list[str] | None = None,
                     drop_constant: bool = False) -> DataFrame:
    """Add ``<col>_normalized``; one pass finds all bounds.

    A constant column has no normalised form: it is null, or absent with
    ``drop_constant``, which looks at the bounds (one row) while building.
    """
    names = [c for c in (columns or numeric_columns(df)) if has(df, c)]
    if drop_constant and names:
        bounds = df.agg(*[(F.max(c) > F.min(c)).alias(c) for c in names]).first()
        names = [c for c in names if bounds[c]]
    if not names:
        return df
    stats = scalar(df, F.struct(*[F.min(c).alias(f"lo_{c}") for c in names],
                                *[F.max(c).alias(f"hi_{c}") for c in names]))
    lo = lambda c: stats.getField(f"lo_{c}")
    hi = lambda c: stats.getField(f"hi_{c}")
    return df.withColumns({
        f"{c}_normalized": F.when(hi(c) > lo(c), (F.col(c) - lo(c)) / (hi(c) - lo(c))) for c in names})


def standard_scale(df: DataFrame, columns: list[str]) -> DataFrame:
    """``<col>_scaled``: mean 0 and population deviation 1; a constant gives 0."""
    stats = scalar(df, F.struct(*[F.avg(c).alias(f"m_{c}") for c in columns],
                                *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]))
    def scaled(c: str) -> Column:
        spread = stats.getField(f"s_{c}")
        return (F.col(c) - stats.getField(f"m_{c}")) / F.when(spread > 0, spread).otherwise(1.0)
    return df.withColumns({f"{c}_scaled": scaled(c) for c in columns})


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """``column, code, n``: 0-based codes of the sorted distinct values.

    Only the distinct values are sorted, and in parallel.
    """
    known = df.groupBy(F.coalesce(F.col(column), F.lit("unknown")).alias(column)).agg(
        F.count(F.lit(1)).alias("n")).withColumn("_one", F.lit(1).cast("bigint"))
    coded = running_totals(known, [column], {"_rank": "_one"})
    return coded.select(column, (F.col("_rank") - 1).alias("code"), "n")


def label_encode(df: DataFrame, column: str, codes: DataFrame | None = None, known: bool = False,
                 unseen: str = "next") -> DataFrame:
    """Add ``<column>_encoded``. Values missing from ``codes`` get the next free code.

    With ``unseen="refit"`` one missing value makes all rows be coded anew by the values at hand; the distinct values
    are looked at while building. ``known`` says that ``codes`` were fitted on these rows, so none is missing.
    """
    if unseen not in ("next", "refit"):
        raise ValueError("unseen must be next or refit")
    filled = df.withColumn(column, F.coalesce(F.col(column), F.lit("unknown")))
    if codes is not None and not known and unseen == "refit":
        if not filled.select(column).distinct().join(codes, column, "left_anti").isEmpty():
            codes, known = label_codes(df, column), True
    fitted = codes if codes is not None else label_codes(df, column)
    rows = attach_by_key(filled, fitted, [column], ["code"], "n")
    if codes is not None and not known:
        rows = rows.withColumn("code", F.coalesce("code", scalar(fitted, F.max("code")) + 1))
    return rows.withColumnRenamed("code", f"{column}_encoded")


def model_columns(df: DataFrame) -> list[str]:
    """The feature columns present in ``df``, in model order."""
    order = [*BASE_FEATURES, *WEB_FEATURES, "ip_hash", *[f"{c}_encoded" for c in ENCODED_COLUMNS]]
    return [c for c in order if has(df, c)]


def prepare_features(df: DataFrame, codes: dict[str, DataFrame] | None = None, unseen: str = "next") -> DataFrame:
    """Columns a model reads, missing values as 0. Per-address counts are
    relative to the rows given, as in batch scoring.

    ``codes`` reuses fitted encodings by column; ``unseen`` says how values missing there are coded (see ``label_encode``).
    """
    rows = df
    if has(rows, "timestamp"):
        rows = rows.withColumn("hour", F.coalesce(F.hour("timestamp"), F.lit(0)))
        rows = rows.withColumn("day_of_week", F.coalesce(F.weekday("timestamp"), F.lit(0)))
        rows = rows.withColumn("is_weekend", (F.col("day_of_week") >= SATURDAY).cast("int"))
    if has(rows, "source_ip"):
        rows = rows.drop("requests_per_ip", "failed_login_count").withColumn(
            "ip_hash", V.ip_hash(F.col("source_ip"), blank_is_zero=True))
        aggs = [F.count(F.lit(1)).alias("requests_per_ip")]
        if has(rows, "status"):
            aggs.append(F.count_if(is_failed(F.col("status"))).alias("failed_login_count"))
        stats = rows.where("source_ip is not null").groupBy("source_ip").agg(*aggs)
        names = [c for c in stats.columns if c != "source_ip"]
        rows = attach_by_key(rows, stats, ["source_ip"], names, "requests_per_ip")
    for column in ENCODED_COLUMNS:
        if has(rows, column):
            text = rows.withColumn(column, F.col(column).cast("string"))
            fitted = (codes or {}).get(column)
            if fitted is None:
                fitted = label_codes(df.select(F.col(column).cast("string")), column)
                rows = label_encode(text, column, fitted, known=True)
            else:
                rows = label_encode(text, column, fitted, unseen=unseen)
    names = model_columns(rows)
    return rows.fillna(0, names)


def align_features(df: DataFrame, columns: list[str]) -> DataFrame:
    """Make the training columns exist, missing ones as 0."""
    absent = {c: F.lit(0.0) for c in columns if not has(df, c)}
    return (df.withColumns(absent) if absent else df).fillna(0, columns)
