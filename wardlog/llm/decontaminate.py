"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

A document leaks an item when some ``span`` consecutive characters of the item (the whole item, if it is
shorter) align with the document at no more than ``error * span`` edits, in lower case and with single blanks.
If ``s`` characters align with ``k`` edits they share at least ``s + 1 - q * (k + 1)`` q-grams, on
diagonals at most ``k`` apart. So

1. every document is read once; its q-grams are looked up in a bit array of the benchmark's (fixed size,
   wrong hits possible, misses not), and only regions with enough hits close together go on;
2. hits of these regions are joined with the benchmark's q-grams and counted per diagonal band, bands
   overlapping by half so that every run of ``k + 1`` diagonals lies in one;
3. bands with enough hits are verified by a banded alignment of all item segments at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlog.llm.common import gram_hashes, ids_back, ids_column
from wardlog.session import materialize

Q = 12
SPAN = 80
ERROR = 0.05
FILTER_BITS = 24  # 2 MB on every executor, whatever the benchmark's size


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def characters(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def budget(length: int, span: int = SPAN, error: float = ERROR, q: int = Q) -> tuple[int, int, int]:
    """Segment length, allowed edits and least shared q-grams for an item of ``length`` characters."""
    size = min(span, length)
    edits = max(0, min(int(error * size), size // q - 1))
    return size, edits, size + 1 - q * (edits + 1)


def signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.astype(np.int64))


def item_texts(benchmark: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([normal(t) for t in batch.column(1).to_pylist()], pa.string())],
                                             names=["item_id", "item"])
    return benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").mapInArrow(run, "item_id bigint, item string")


def item_grams(items: DataFrame) -> DataFrame:
    """``item_id, at, gram`` of normalised items."""
    def run(batches):
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                grams = gram_hashes(characters(text), Q)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(grams), item, np.int64)), pa.array(np.arange(len(grams), dtype=np.int32)), signed(grams)],
                    names=["item_id", "at", "gram"])
    return items.mapInArrow(run, "item_id bigint, at int, gram bigint")


def gram_filter(grams: DataFrame) -> np.ndarray:
    """Bits of the q-grams met, united from one array per task."""
    def run(batches):
        bits = np.zeros(1 << FILTER_BITS >> 3, np.uint8)
        for batch in batches:
            at = slot(batch.column(0).to_numpy().astype(np.uint64))
            np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array([bits.tobytes()], pa.binary())], names=["bits"])
    out = np.zeros(1 << FILTER_BITS >> 3, np.uint8)
    for row in grams.select("gram").mapInArrow(run, "bits binary").toLocalIterator():
        out |= np.frombuffer(row.bits, np.uint8)
    return out


def slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def hits(values: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Q-gram hashes of a text and which of them the filter knows."""
    grams = gram_hashes(values, Q)
    at = slot(grams)
    return grams, (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


REGION = "doc_id bigint, row bigint, start bigint, region string"


def regions(docs: DataFrame, bits, size: int, edits: int, least: int) -> DataFrame:
    """Stretches of normalised documents with ``least`` hits within the reach of one segment."""
    reach = size + edits - Q + 1  # gram positions a segment can take in a document
    gap = "\0" * (reach + Q)

    def run(batches):
        known = bits.value
        for batch in batches:
            texts = [normal(t) for t in batch.column(2).to_pylist()]
            ids, rows = ids_column(batch.column(0)), ids_column(batch.column(1))
            joined = characters(gap.join(texts))
            begins = np.cumsum([0] + [len(t) + len(gap) for t in texts])
            if len(joined) < Q:
                continue
            _, found = hits(joined, known)
            sums = np.concatenate([[0], np.cumsum(found)])
            ends = np.minimum(np.arange(len(found)) + reach, len(found))
            full = np.flatnonzero(sums[ends] - sums[:-1] >= least)
            if not len(full):
                continue
            cuts = np.flatnonzero(np.diff(full) > reach) + 1
            out: list[tuple] = []
            for first, last in zip(full[np.concatenate([[0], cuts])], full[np.concatenate([cuts - 1, [len(full) - 1]])]):
                doc = int(np.searchsorted(begins, first, side="right")) - 1
                if doc + 1 < len(begins) and first >= begins[doc] + len(texts[doc]):
                    doc += 1  # the window opens in the gap before a document
                while doc < len(texts) and begins[doc] <= last + reach:
                    a = max(0, int(first) - int(begins[doc]) - edits)
                    b = min(len(texts[doc]), int(last) - int(begins[doc]) + reach + Q + edits)
                    if b - a >= Q:
                        out.append((ids[doc], rows[doc], a, texts[doc][a:b]))
                    doc += 1
            if out:
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays([
                    ids_back(np.array(columns[0], np.int64)), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()),
                    pa.array(columns[3], pa.string())], names=["doc_id", "row", "start", "region"])
    return docs.select("doc_id", "row", "text").mapInArrow(run, REGION)


def region_hits(found: DataFrame, bits) -> DataFrame:
    def run(batches):
        known = bits.value
        for batch in batches:
            for region, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                grams, mask = hits(characters(text), known)
                at = np.flatnonzero(mask)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(at), region, np.int64)), pa.array(at.astype(np.int32)), signed(grams[at])],
                    names=["region_id", "place", "gram"])
    return found.select("region_id", "region").mapInArrow(run, "region_id bigint, place int, gram bigint")


def align(text: np.ndarray, item: np.ndarray, diagonal: int, width: int, size: int, edits: int) -> tuple[int, int, int] | None:
    """First and last-end item position and least edits of segments that align within a diagonal band.

    All segments of ``size`` characters are aligned together, one character a step. Cell ``j`` of a segment stands
    for the diagonal ``diagonal + j``; a document start anywhere in the band is free.
    """
    starts = np.arange(len(item) - size + 1)
    offsets = np.arange(width)
    padded = np.concatenate([text, np.full(1, 2 ** 32 - 1, np.uint32)])
    cost = np.zeros((len(starts), width), np.int32)
    inside = starts[:, None] + diagonal + offsets
    cost[(inside < 0) | (inside > len(text))] = 1 << 20
    for i in range(size):
        place = starts[:, None] + i + diagonal + offsets
        letter = padded[np.where((place >= 0) & (place < len(text)), place, len(text))]
        change = cost + (letter != item[starts + i][:, None])
        change[:, :-1] = np.minimum(change[:, :-1], cost[:, 1:] + 1)  # a character of the item is missing
        cost = np.minimum.accumulate(change - offsets, axis=1) + offsets  # characters are inserted
        if cost.min() > edits:
            return None
    least = cost.min(axis=1)
    good = np.flatnonzero(least <= edits)
    return (int(good[0]), int(good[-1]) + size, int(least.min())) if len(good) else None


LEAK = "doc_id bigint, row bigint, item_id bigint, item_start int, item_end int, doc_start bigint, doc_end bigint, edits int"


def verify(pairs: DataFrame, span: int, error: float) -> DataFrame:
    """``pairs``: doc_id, row, start, region, item_id, item, band; rows that do not align vanish."""
    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                size, edits, _ = budget(len(r["item"]), span, error)
                at = r["region"].find(r["item"])
                if at >= 0:
                    match = (0, len(r["item"]), 0)
                else:
                    at = r["band"] * (edits + 1)
                    match = align(characters(r["region"]), characters(r["item"]), at, 2 * (edits + 1), size, edits)
                if match:
                    a, b, e = match
                    first = max(0, r["start"] + at + a)
                    out.append((r["doc_id"], r["row"], r["item_id"], a, b, first, first + b - a, e))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
            columns = list(zip(*out)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[c.split()[0] for c in LEAK.split(", ")])
    return pairs.mapInArrow(run, LEAK)


def leaks(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, error: float = ERROR, row: Column | None = None) -> DataFrame:
    """One row per document row and leaked item: ``doc_id, row, item_id`` and where, with the fewest ``edits``.

    ``docs`` has ``doc_id, text`` and ``benchmark`` has ``item_id, text``; other columns play no part. ``row`` is an expression over
    ``docs`` that tells rows of one id apart (0 if not given). Places count characters of the normalised texts; those in documents
    are exact up to the edits. Documents without text leak nothing. Items without text, or shorter than a q-gram,
    cannot be found. Rows of equal ``doc_id`` and ``row`` are reported once; missing ids are reported as null, and
    so are those of items, which count as one item together.
    """
    spark = docs.sparkSession
    number = F.lit(0) if row is None else row
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), number.cast("bigint").alias("row"), F.col("text").cast("string").alias("text"))
    named = item_texts(benchmark).where(F.length("item") >= Q).distinct().withColumnRenamed("item_id", "named")
    named = materialize(named.withColumn("item_id", F.monotonically_increasing_id()), "items")  # items are told apart by number
    items = named.select("item_id", "item")
    shortest = items.agg(F.min(F.length("item"))).first()[0]
    if shortest is None:
        return spark.createDataFrame([], LEAK)
    grams = materialize(item_grams(items), "item-grams")
    bits = spark.sparkContext.broadcast(gram_filter(grams))
    # The least demanding of all items decides which regions are looked at.
    found = regions(rows, bits, *weakest(shortest, span, error))
    found = materialize(found.withColumn("region_id", F.monotonically_increasing_id()), "regions")
    size_of = F.least(F.length("item"), F.lit(span))
    edits_of = F.greatest(F.lit(0), F.least(F.floor(size_of * F.lit(error)).cast("int"), F.floor(size_of / Q).cast("int") - 1))
    demand = items.select("item_id", (edits_of + 1).alias("step"), (size_of + 1 - Q * (edits_of + 1)).alias("least"))
    index = grams.join(demand, "item_id")
    diagonal = F.col("place") - F.col("at")
    lower = F.floor(diagonal / F.col("step")).cast("int")
    # A band covers two steps of diagonals; each hit lies in two bands.
    counted = (region_hits(found, bits).join(index, "gram")
               .select("region_id", "item_id", "least", F.explode(F.array(lower, lower - 1)).alias("band"))
               .groupBy("region_id", "item_id", "least", "band").agg(F.count(F.lit(1)).alias("n")).where("n >= least"))
    pairs = counted.select("region_id", "item_id", "band").join(found, "region_id").join(items, "item_id")
    proven = verify(pairs.select("doc_id", "row", "start", "region", "item_id", "item", "band"), span, error)
    best = F.max_by(F.struct("item_start", "item_end", "doc_start", "doc_end", "edits"),
                    F.struct(F.col("item_end") - F.col("item_start"), -F.col("edits"), -F.col("doc_start"))).alias("best")
    proven = proven.join(named.select("item_id", "named"), "item_id")
    return proven.groupBy("doc_id", "row", "named").agg(best).select("doc_id", "row", F.col("named").alias("item_id"), "best.*")


def weakest(shortest: int, span: int, error: float) -> tuple[int, int, int]:
    """Longest reach and smallest demand over all item lengths from ``shortest`` on."""
    all_of = [budget(n, span, error) for n in range(shortest, max(shortest, span) + 1)]
    return max(s for s, _, _ in all_of), max(e for _, e, _ in all_of), min(t for _, _, t in all_of)


def without_leaks(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, error: float = ERROR) -> DataFrame:
    """The rows of ``docs`` that leak no item, with all their columns.

    Whether a row leaks depends on its text alone, so a hash of the text leads back to the rows.
    """
    digest = F.xxhash64(F.col("text").cast("string"))
    found = leaks(docs, benchmark, span, error, row=digest)
    leaking = found.select(F.col("doc_id").alias("k_doc"), F.col("row").alias("k_digest")).distinct()
    return docs.join(leaking, docs.doc_id.eqNullSafe(leaking.k_doc) & (digest == leaking.k_digest), "left_anti")
