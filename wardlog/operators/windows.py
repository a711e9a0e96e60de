"""Trailing time windows per address."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardlog.functions.parsing import is_failed
from wardlog.operators.keyed import attach_by_key

# A block spans this many windows, so at most 1/12 of the keys are copied as context.
WINDOWS_PER_BLOCK = 12


def trailing_counts(events: DataFrame, key: str, ts: str, minutes: int) -> DataFrame:
    """Events per ``key`` in ``[ts - minutes, ts]`` as ``key, ts, n_here, n_window``.

    Equal timestamps collapse before the shuffle. Time is cut into blocks and
    the last window of a block is repeated as context in the next one, so an
    address that never stops is still spread over one task per block. Inside a
    block every moment adds its events when it comes and takes them back when
    the window has passed; one running sum then answers all windows in linear
    time, where a sliding frame would add up each window anew.
    """
    width = minutes * 60 * 1_000_000
    block = width * WINDOWS_PER_BLOCK
    at = F.unix_micros(ts)
    here = (events.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
            .groupBy(key, ts).agg(F.count(F.lit(1)).alias("n_here")))
    own = F.floor(at / F.lit(block)).cast("bigint")
    spills = at >= (own + 1) * block - width
    blocks = F.when(spills, F.array(own, own + 1)).otherwise(F.array(own))
    placed = here.select(key, ts, "n_here", at.alias("_us"), own.alias("_own"), F.explode(blocks).alias("_block"))
    change = lambda moment, n, arrives: F.struct(
        moment.alias("at"), n.alias("n"), F.lit(arrives).alias("arrives"))
    us, n = F.col("_us"), F.col("n_here")
    changes = placed.withColumn("_c", F.explode(F.array(change(us, n, True), change(us + width + 1, -n, False))))
    upto = (Window.partitionBy(key, "_block").orderBy(F.col("_c.at"))
            .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return (changes.withColumn("n_window", F.sum("_c.n").over(upto))
            .where("_c.arrives and _own = _block").select(key, ts, "n_here", "n_window"))


def failed_login_window(df: DataFrame, window_minutes: int = 5, ip: str = "source_ip",
                        ts: str = "timestamp", source: DataFrame | None = None) -> DataFrame:
    """Add ``failed_login_count_window``: 0 for rows that are no failed login.

    ``source`` may name an earlier, cheaper form of the same rows to count from.
    """
    failed = is_failed(F.col("status")) & F.col(ip).isNotNull() & F.col(ts).isNotNull()
    counts = trailing_counts((df if source is None else source).where(failed), ip, ts, window_minutes)
    rows = attach_by_key(df, counts, [ip, ts], ["n_window"], "n_here", only=failed)
    return (rows.withColumn("failed_login_count_window", F.coalesce("n_window", F.lit(0).cast("bigint")))
            .drop("n_window"))


def failed_by_window(df: DataFrame, minutes: int, slide: int | None = None, ip: str = "source_ip",
                     ts: str = "timestamp") -> DataFrame:
    """Failed logins per address and tumbling (or sliding) window; batch or stream."""
    bucket = F.window(ts, f"{minutes} minutes", f"{slide or minutes} minutes")
    return (df.where(is_failed(F.col("status"))).groupBy(ip, bucket).agg(F.count(F.lit(1)).alias("failed"))
            .select(ip, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "failed"))


def failed_session_stream(df: DataFrame, gap_minutes: int, ip: str = "source_ip",
                          ts: str = "timestamp") -> DataFrame:
    """Bursts of failed logins per address, split by quiet gaps; for streams."""
    burst = F.session_window(ts, f"{gap_minutes} minutes")
    return (df.where(is_failed(F.col("status"))).groupBy(ip, burst).agg(F.count(F.lit(1)).alias("failed"))
            .select(ip, F.col("session_window.start").alias("session_start"),
                    F.col("session_window.end").alias("session_end"), "failed"))


def failed_sessions(df: DataFrame, gap_minutes: int, ip: str = "source_ip",
                    ts: str = "timestamp") -> DataFrame:
    """The batch twin of ``failed_session_stream``, safe for a busy address.

    Bursts are first built inside time blocks and then chained across block
    borders. A block holds at most a dozen bursts of an address, so the chaining
    step sees a short list even where the address has most of the rows.
    """
    gap = gap_minutes * 60 * 1_000_000
    at = F.unix_micros(ts)
    failed = df.where(is_failed(F.col("status")) & F.col(ts).isNotNull() & F.col(ip).isNotNull())
    moments = failed.groupBy(F.col(ip).alias("ip"), at.alias("us")).agg(F.count(F.lit(1)).alias("n")).withColumn(
        "block", F.floor(F.col("us") / F.lit(gap * WINDOWS_PER_BLOCK)))
    in_block = Window.partitionBy("ip", "block").orderBy("us")
    opens = F.coalesce(F.col("us") - F.lag("us").over(in_block) > gap, F.lit(True))
    pieces = (moments.withColumn("opens", opens.cast("int")).withColumn("piece", F.sum("opens").over(in_block))
              .groupBy("ip", "block", "piece")
              .agg(F.min("us").alias("first"), F.max("us").alias("last"), F.sum("n").alias("n")))
    across = Window.partitionBy("ip").orderBy("first")
    chained = F.coalesce(F.col("first") - F.lag("last").over(across) > gap, F.lit(True))
    return (pieces.withColumn("opens", chained.cast("int")).withColumn("session", F.sum("opens").over(across))
            .groupBy("ip", "session")
            .agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("failed"))
            .select(F.col("ip").alias(ip), F.timestamp_micros("first").alias("session_start"),
                    F.timestamp_micros(F.col("last") + gap).alias("session_end"), "failed"))
