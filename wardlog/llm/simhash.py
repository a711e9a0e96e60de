"""SimHash fingerprints and near-duplicate groups by covering locality-sensitive hashing.

Fingerprints: texts are lower-cased (A-Z only), cut into words, and every run of three
words votes with the bits of its XXH64 (fewer words: the whole sequence votes; no words:
fingerprint zero).

Candidates: bit ``i`` of a fingerprint gets a nonzero label of ``radius + 1`` bits. For each
nonzero vector ``v`` of that size one table keeps the bits whose label has odd overlap with
``v`` and hides the others. Two fingerprints that differ in at most ``radius`` bits constrain
``v`` by at most ``radius`` equations, so some nonzero ``v`` hides all differing bits: the
pair meets in that table, always.

Linking within a bucket: a hot bucket may hold a third of all fingerprints, so no pairs are
formed. Fingerprints at distance at most two share a midpoint that differs from each of them
in at most one bit, and all fingerprints around one midpoint are within distance two of each
other. Each member emits its midpoints over the hidden bits, and a midpoint links everything
around it to the smallest one. The links found this way are exactly the pairs within radius 2.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlog.llm.common import components, texts
from wardlog.session import materialize

BITS = 64
RADIUS = 2
SHINGLE = 3
SEED = 42
CHUNK = 200_000  # hashes whose bits are unpacked at once


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority bits of the hashed shingles of one text."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(shingle, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:len(words) - size + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts, ends[size - 1:].tolist())], np.uint64)
    votes = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), CHUNK):
        bits = np.unpackbits(hashes[k:k + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(votes * 2 > len(hashes)).tolist()))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, digest, fp`` (signed 64-bit) of every row; a null text has no words.

    The digest is a hash of the text, by which rows are told apart that share an id or have none.
    """
    def run(batches):
        for batch in batches:
            found = [fingerprint(t or b"", shingle) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            signed = np.array(found, np.uint64).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(signed)], names=["doc_id", "digest", "fp"])
    return texts(docs).withColumn("digest", F.xxhash64("text")).mapInArrow(run, "doc_id bigint, digest bigint, fp bigint")


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """Kept bits of each of the ``2 ** (radius + 1) - 1`` tables.

    Labels go round all nonzero values, so every table hides about the same number of bits.
    """
    size = 1 << (radius + 1)
    labels = [1 + i % (size - 1) for i in range(bits)]
    return [sum(1 << i for i, label in enumerate(labels) if (label & v).bit_count() & 1) for v in range(1, size)]


def signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def near_links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Star links ``a, b`` among the distinct values of ``prints.fp``, exact for radius 1 and 2.

    A pair within ``radius`` is joined through the smallest member around a midpoint.
    """
    if radius not in (1, 2):
        raise ValueError("midpoints join radius 1 and 2")
    masks = covering_masks(radius)
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("kept"))
                       for t, m in enumerate(masks)])
    keyed = prints.select("fp").distinct().select("fp", F.explode(tables).alias("k")).select("fp", "k.t", "k.kept")
    # Buckets with company; their members are joined back, never gathered.
    shared = keyed.groupBy("t", "kept").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    members = keyed.join(shared, ["t", "kept"], "left_semi")
    hidden: list[Column] = []
    for t, mask in enumerate(masks):
        flips = [F.lit(signed(1 << i)) for i in range(BITS) if not mask >> i & 1]
        hidden.append(F.array(F.lit(0).cast("bigint"), *flips))
    choice = F.element_at(F.array(*hidden), F.col("t") + 1)
    around = members.select("fp", F.explode(choice).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("mid"))
    around = materialize(around.distinct(), "midpoints")
    centre = around.groupBy("mid").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return around.join(centre, "mid").where("fp <> b").select(F.col("fp").alias("a"), "b").distinct()


def grouped(docs: DataFrame, shingle: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """Stored fingerprints, and the root fingerprint ``fp, root`` of each."""
    prints = materialize(fingerprints(docs, shingle), "fingerprints")
    roots = components(near_links(prints, radius))
    values = prints.select("fp").distinct()
    rooted = values.join(roots, values.fp == roots.node, "left").select("fp", F.coalesce("component", "fp").alias("root"))
    return prints, materialize(rooted, "simhash-groups")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``doc_id, fp, component_id`` per row: the smallest id reachable over links.

    Rows with equal fingerprints are copies and always linked; documents without words share
    fingerprint zero. A row without an id is returned with a null id and takes part in its
    group's links; a group of such rows only has a null component. Repeated ids stay repeated.
    """
    prints, rooted = grouped(docs, shingle, radius)
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least")).join(rooted, "fp").groupBy("root").agg(
        F.min("least").alias("component_id"))
    return prints.join(rooted.join(least, "root"), "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that stay when each group of near-duplicates keeps one.

    The smallest id stays (a row without id only if its group has none with one; then, and among repeated ids, the
    smallest text hash). Of wholly repeated rows one stays.
    """
    prints, rooted = grouped(docs, shingle, radius)
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "digest")
    first = prints.groupBy("fp").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
    kept = first.join(rooted, "fp").groupBy("root").agg(F.min("first").alias("first"))
    copies = prints.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("copies"))
    keys = kept.select(F.col("first.doc_id").alias("k_doc"), F.col("first.digest").alias("k_digest"))
    keys = materialize(keys.join(copies, keys.k_doc.eqNullSafe(copies.doc_id) & (keys.k_digest == copies.digest)).select(
        "k_doc", "k_digest", "copies"), "kept-keys")
    digest = F.xxhash64(F.col("text").cast("string"))

    def matching(some: DataFrame) -> DataFrame:
        return docs.join(some, docs.doc_id.eqNullSafe(some.k_doc) & (digest == some.k_digest), "left_semi")
    out = matching(keys.where("copies = 1"))
    if keys.where("copies > 1").limit(1).count():
        out = out.union(matching(keys.where("copies > 1")).dropDuplicates(["doc_id", "text"]))
    return out


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def pairs_within(values: list[int], radius: int) -> set[tuple[int, int]]:
    """Brute force for tests: all pairs of a small list within ``radius`` bits."""
    return {(a, b) for a, b in combinations(sorted(set(values)), 2) if (a ^ b).bit_count() <= radius}
