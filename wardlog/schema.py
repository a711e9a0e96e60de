"""Declared schemas and the transform that makes a frame match one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

GEO = T.StructType([
    T.StructField("country_name", T.StringType()),
    T.StructField("city_name", T.StringType()),
])

# One stored log document: every field optional, strays kept in ``extra``.
RAW_DOCUMENT = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("message", T.StringType()),
    T.StructField("log_type", T.StringType()),
    T.StructField("fields", T.StructType([T.StructField("log_type", T.StringType())])),
    T.StructField("source", T.StructType([T.StructField("ip", T.StringType())])),
    T.StructField("geoip", GEO),
    T.StructField("source_ip", T.StringType()),
    T.StructField("clientip", T.StringType()),
    T.StructField("user", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("is_attack", T.BooleanType()),
    T.StructField("attack_type", T.StringType()),
    T.StructField("request", T.StringType()),
    T.StructField("response", T.IntegerType()),
    T.StructField("bytes", T.LongType()),
    T.StructField("verb", T.StringType()),
    T.StructField("extra", T.MapType(T.StringType(), T.StringType())),
])

CANONICAL_EVENT = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("source_ip", T.StringType()),
    T.StructField("user", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("attack_type", T.StringType()),
    T.StructField("is_attack", T.BooleanType()),
    T.StructField("geoip_country", T.StringType()),
    T.StructField("geoip_city", T.StringType()),
    T.StructField("log_type", T.StringType()),
])

# The training table: event columns plus derived features. Geography is numeric
# here: text that is not a number counts as 0.
TRAINING = T.StructType([
    *[f for f in CANONICAL_EVENT.fields[:7]],
    T.StructField("geoip_country", T.DoubleType()),
    T.StructField("geoip_city", T.DoubleType()),
    T.StructField("log_type", T.StringType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("day_of_week", T.IntegerType()),
    T.StructField("day_of_month", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("is_weekend", T.IntegerType()),
    T.StructField("is_business_hours", T.IntegerType()),
    T.StructField("requests_per_ip", T.LongType()),
    T.StructField("ip_hash", T.LongType()),
    T.StructField("failed_login_count", T.LongType()),
    T.StructField("failed_login_count_window", T.LongType()),
    T.StructField("attack_type_frequency", T.LongType()),
])

ALERT = T.StructType([
    T.StructField("@timestamp", T.TimestampType()),
    T.StructField("source_ip", T.StringType()),
    T.StructField("ml_anomaly", T.BooleanType()),
    T.StructField("ml_anomaly_score", T.DoubleType()),
    T.StructField("ml_model", T.StringType()),
    T.StructField("is_attack", T.BooleanType()),
    T.StructField("attack_type", T.StringType()),
    T.StructField("defense_recommendations", T.StringType()),
    T.StructField("geoip", GEO),
])

LABEL_LINE = T.StructType([
    T.StructField("line", T.LongType()),
    T.StructField("labels", T.ArrayType(T.StringType())),
])

LABELLED_CSV = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("source_ip", T.StringType()),
    T.StructField("username", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("label", T.StringType()),
])


def has(df: DataFrame, name: str) -> bool:
    return name in df.columns


def col_or_null(df: DataFrame, name: str, type_: T.DataType) -> Column:
    """The named column, or a typed null where the input lacks it."""
    return F.col(f"`{name}`") if has(df, name) else F.lit(None).cast(type_)


def conform(df: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Select exactly the declared columns, adding missing ones as typed nulls.

    Casts are tolerant: an unparsable cell becomes null, not a failed job.
    ``keep`` names extra input columns to carry along.
    """
    picked = []
    for field in schema.fields:
        value = col_or_null(df, field.name, field.dataType)
        if has(df, field.name) and df.schema[field.name].dataType != field.dataType:
            value = value.try_cast(field.dataType)
        picked.append(value.alias(field.name))
    return df.select(*[F.col(name) for name in keep], *picked)
