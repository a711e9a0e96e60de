"""Helpers of the text operators: Arrow access, hashing of symbol arrays, slots and components.

Hashes are polynomials modulo 2**64 with an odd random multiplier, scrambled at the end.
Equal sequences always hash alike; different ones collide about as often as random
64-bit numbers do.
"""

from __future__ import annotations

import ctypes
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardlog.session import configure, materialize

MULTIPLIER = 0x9E3779B97F4A7C15
NULL_ID = -(2 ** 63)  # a document without an id, inside numpy arrays
# Rows of a batch handed to Python: text batches stay at a few MB.
BATCH_ROWS = 512
# Nor does a batch of long texts, or of blocks, take more bytes than this by much.
BATCH_BYTES = 16 << 20
# Tables of whole texts are written in row groups of this size: every writing task holds one in memory.
ROW_GROUP_BYTES = 16 << 20
# Separators of words in the dealt contracts: space, tab, line feed, vertical tab, form feed, return.
SPACES = b" \t\n\v\f\r"


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the text operators."""
    configure(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", None) != str(BATCH_ROWS):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    if spark.conf.get("parquet.block.size", None) is None:
        spark.conf.set("parquet.block.size", str(ROW_GROUP_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """Only ``doc_id`` and ``text`` of a frame, whatever else it holds."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def utf8_bytes(text: Column) -> Column:
    """Size of a text in bytes; null counts as empty."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")


def finite(vector: Column) -> Column:
    """True for vectors that are not null and hold no null or non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


@cache
def _trim():
    """The C library's call that returns freed memory to the system, where it has one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return freed memory of this process to the system: workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    if (trim := _trim()) is not None:
        trim(0)


def text_column(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows (nulls are empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def ids_column(column: pa.Array) -> np.ndarray:
    return pc.fill_null(column.cast(pa.int64()), NULL_ID).to_numpy(zero_copy_only=False)


def ids_back(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == NULL_ID)


def scramble(x: np.ndarray) -> np.ndarray:
    """Mix the bits of 64-bit values (in place on a private copy)."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


def power(k: int) -> np.uint64:
    return np.uint64(pow(MULTIPLIER, k, 1 << 64))


GRAM_SLICE = 1 << 17  # positions hashed at once: temporary arrays stay at a megabyte each


def gram_hashes(symbols: np.ndarray, g: int) -> np.ndarray:
    """Hash of the ``g`` symbols from every position (``len - g + 1`` values)."""
    n = max(0, len(symbols) - g + 1)
    out = np.empty(n, np.uint64)
    for begin in range(0, n, GRAM_SLICE):
        stop = min(n, begin + GRAM_SLICE)
        out[begin:stop] = _gram_hashes(symbols[begin:stop + g - 1], g)
    return out


def grams_at(symbols: np.ndarray, g: int, at: np.ndarray) -> np.ndarray:
    """``gram_hashes`` at some positions only, which are in order."""
    out = np.empty(len(at), np.uint64)
    edges = np.searchsorted(at, np.arange(0, len(symbols) + GRAM_SLICE, GRAM_SLICE))
    for k in np.flatnonzero(np.diff(edges)):
        a, b, begin = edges[k], edges[k + 1], int(k) * GRAM_SLICE
        out[a:b] = _gram_hashes(symbols[begin:begin + GRAM_SLICE + g - 1], g)[at[a:b] - begin]
    return out


def _gram_hashes(symbols: np.ndarray, g: int) -> np.ndarray:
    """By doubling; there are at least ``g`` symbols."""
    n = len(symbols) - g + 1
    level, span, total, done = symbols.astype(np.uint64), 1, None, 0
    while True:
        if g & span:
            part = level[done:done + n]
            total = part.copy() if total is None else total + power(done) * part
            done += span
        if done == g:
            return scramble(total)
        level = level[:-span] + power(span) * level[span:]
        span *= 2


def _powers(size: int) -> np.ndarray:
    return _small_powers()[:size] if size <= 1 << 16 else _computed_powers(size)


@cache
def _small_powers() -> np.ndarray:
    return _computed_powers(1 << 16)


def _computed_powers(size: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, MULTIPLIER, np.uint64)]))


HASH_BYTES = 1 << 18  # bytes of slices hashed at once, so that temporary arrays stay in the cache


def slice_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each slice ``data[start:end]``, none of them empty; the length takes part."""
    wide = ends - starts
    out = np.empty(len(starts), np.uint64)
    before = np.concatenate([[0], np.cumsum(wide)])
    powers = _powers(1 << max(8, int(wide.max(initial=1)).bit_length()))
    begin = 0
    while begin < len(starts):
        stop = max(begin + 1, int(np.searchsorted(before, before[begin] + HASH_BYTES, side="right")) - 1)
        size, first = wide[begin:stop], before[begin:stop] - before[begin]
        inside = np.arange(before[stop] - before[begin]) - np.repeat(first, size)
        terms = (data[np.repeat(starts[begin:stop], size) + inside].astype(np.uint64) + np.uint64(1)) * powers[inside]
        out[begin:stop] = np.add.reduceat(terms, first)
        begin = stop
    return scramble(out + wide.astype(np.uint64) * power(7))


IS_SPACE = np.isin(np.arange(256), np.frombuffer(SPACES, np.uint8))


def word_slices(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words of all rows, and the number of words before each row."""
    solid = ~IS_SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    first[inner] = solid[inner]
    last[inner - 1] = solid[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def slots(df: DataFrame, key: str, order: list[str], name: str, bucket_rows: int = 20_000) -> DataFrame:
    """Number the rows of every ``key`` from 0 without gaps, in no promised order.

    A key may hold any share of the rows: it is cut into buckets by a hash of ``order``
    (which must identify a row), each bucket is numbered on its own and shifted by the
    sizes of the buckets before it.
    """
    stored = materialize(df, "slots")
    buckets = max(1, stored.count() // bucket_rows)
    placed = stored.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    sizes = placed.groupBy(key, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select(key, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy(key, "_bucket").orderBy(*order)
    numbered = placed.withColumn("_row", F.row_number().over(within) - 1)
    joined = numbered.join(shift, [key, "_bucket"])
    return joined.select(*df.columns, (F.col("_row") + F.col("_before")).cast("bigint").alias(name))


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """Smallest reachable node of every linked node: ``(node, component)``.

    ``links`` has columns ``a`` and ``b`` (bigint). Each round every node points its larger
    neighbours, and then its smaller ones, at the smallest node it knows; paths shorten
    geometrically. Rounds are written to the shared folder, nothing reaches the driver but
    two sums. A node with very many links is an aggregation key and the skewed side of a
    join that adaptive execution can split, never one group in a task.
    """
    def stars(edges: DataFrame, upward: bool) -> DataFrame:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if not upward:
            both = both.where("b < a")
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        pointed = both.join(least, "a")
        if upward:
            out = pointed.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = pointed.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
                least.select("a", F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    normal = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = materialize(normal, "links")
    seen = state(edges)
    for _ in range(rounds):
        if not seen[0]:
            break
        edges = materialize(stars(stars(edges, True), False), "links")
        now = state(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
