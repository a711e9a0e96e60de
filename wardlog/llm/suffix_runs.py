"""Suffix-array dedup: distributed merge sort of suffixes that knows common prefixes.

Each block sorts its suffixes and sends front-coded runs (length of the prefix shared with the row
before, then only the rest) to the range each suffix falls in; ranges are cut at sampled grams. A
range merges the runs with a loser tree whose nodes remember how many bytes a loser shared with the
last winner: the run sharing more is smaller without a look at the text, and where two share equally
the comparison starts behind that prefix. The merged order and its common prefixes are the
suffix array of the range, from which ``repeats.resolve`` reads the repeated windows.

Bytes covered by a ``length``-byte string that also starts in a document with a smaller id go.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlog.llm.repeats import (
    BLOCK_BYTES, Block, Spec, Suffixes, answers, common_prefix, null_ids, opened, remove_repeats, resolve, runs_of, shut,
    span_counts, totals)

LENGTH = 50
GRAM = 24
OWNER = np.dtype([("doc", "<i8"), ("pos", "<i8"), ("member", "<i4"), ("alone", "?")])


def front_code(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shared prefixes of sorted rows and the bytes behind them."""
    prefix = common_prefix(table)
    return prefix.astype(np.uint8), table[np.arange(table.shape[1]) >= prefix[:, None]]


def front_decode(prefix: np.ndarray, rest: np.ndarray, size: int) -> np.ndarray:
    table = np.zeros((len(prefix), size), np.uint8)
    given = np.arange(size) >= prefix[:, None]
    table[given] = rest
    rows = np.arange(len(prefix))
    for j in range(size):
        table[:, j] = table[np.maximum.accumulate(np.where(given[:, j], rows, 0)), j]
    return table


def match(a: bytes, b: bytes, start: int) -> int:
    """Common prefix of two different strings that agree up to ``start``."""
    step = 8
    while a[start:start + step] == b[start:start + step]:
        start += step
    while a[start] == b[start]:
        start += 1
    return start


def merge_runs(runs: list[tuple[list[bytes], list[int]]]) -> Iterator[tuple[int, int, int]]:
    """Order of all strings of sorted runs: ``(run, index, prefix shared with the string before)``.

    A run is its strings of equal length and their prefixes shared with the one before.
    """
    k = len(runs)
    size = 1 << max(0, (k - 1).bit_length())
    at = [0] * k
    current: list[bytes | None] = [r[0][0] if r[0] else None for r in runs] + [None] * (size - k)
    length = len(next((c for c in current if c is not None), b""))
    losers, shared = [0] * size, [0] * size

    def play(x: int, sx: int, y: int, sy: int) -> tuple[int, int, int, int]:
        """Winner and loser; each comes with the prefix it shares with the last winner."""
        a, b = current[x], current[y]
        if b is None:
            return x, sx, y, sy
        if a is None or sy > sx:
            return y, sy, x, sx
        if sx > sy:
            return x, sx, y, sy
        if a == b:
            return (x, sx, y, length) if x < y else (y, sy, x, length)
        common = match(a, b, sx)
        return (x, sx, y, common) if a[common] < b[common] else (y, sy, x, common)

    level = [(i, 0) for i in range(size)]
    node = size
    while len(level) > 1:  # the first tournament fills the tree from its leaves
        node //= 2
        up = []
        for i in range(0, len(level), 2):
            winner, sw, loser, sl = play(*level[i], *level[i + 1])
            losers[node + i // 2], shared[node + i // 2] = loser, sl
            up.append((winner, sw))
        level = up
    winner, common = level[0]
    while current[winner] is not None:
        yield winner, at[winner], common
        strings, prefixes = runs[winner]
        at[winner] += 1
        if at[winner] < len(strings):
            current[winner], common = strings[at[winner]], prefixes[at[winner]]
        else:
            current[winner], common = None, 0
        node = (winner + size) >> 1
        while node:
            winner, common, losers[node], shared[node] = play(winner, common, losers[node], shared[node])
            node >>= 1


def remove_substrings(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block_bytes: int = BLOCK_BYTES,
                      carry: list[str] | None = None, decode: bool = False) -> DataFrame:
    """``doc_id, kept`` (binary), ``n_bytes, n_removed, n_spans`` per row.

    With ``decode``, ``kept`` is a text without the characters that a cut left in parts. Other columns named in
    ``carry`` follow as ``carried_<name>``. A null text is empty; a missing id counts as smaller than all others;
    rows with equal ids do not count as earlier than one another. Texts shorter than ``length`` stay whole. No rows give no rows.
    """
    spec = Spec(length, gram, words=False, within=False)

    def deal(blocks: DataFrame, parts: int):
        grams = [opened(r.sample, f"S{gram}") for r in blocks.select("sample").toLocalIterator()]
        grams = np.sort(np.concatenate(grams)) if grams else np.zeros(0, f"S{gram}")
        cuts = np.unique(grams[np.linspace(0, len(grams) - 1, parts + 1).astype(int)[1:-1]]) if len(grams) else grams

        def send(found: Suffixes) -> list[tuple[int, bytes]]:
            heads = np.ascontiguousarray(found.table[:, :gram]).view(f"S{gram}").ravel()
            edges = np.concatenate([[0], np.searchsorted(heads, cuts), [len(heads)]])
            out = []
            for part in np.flatnonzero(np.diff(edges)):
                a, b = edges[part], edges[part + 1]
                prefix, rest = front_code(found.table[a:b])
                owner = np.empty(b - a, OWNER)
                owner["doc"], owner["alone"] = found.doc[a:b], found.alone[a:b]
                owner["pos"] = 0  # the place within the owner does not matter here
                owner["member"] = np.diff(np.arange(a, b), prepend=0)  # as differences: all but the first are one
                columns = b"".join(np.ascontiguousarray(owner[c]).tobytes() for c in OWNER.names)
                out.append((int(part), shut(np.concatenate([
                    np.array([b - a], "<i8").view(np.uint8), prefix, np.frombuffer(columns, np.uint8), rest]))))
            return out
        return send

    size = length + spec.reach - 1 + 2

    def combine(blobs: list[bytes], of: list[int]) -> tuple[list[int], list[bytes]]:
        tables, owners, runs = [], [], []
        for blob in blobs:
            raw = opened(blob, np.uint8)
            n = int(raw[:8].view("<i8")[0])
            prefix, at = raw[8:8 + n], 8 + n
            owner = np.empty(n, OWNER)
            for c in OWNER.names:
                wide = OWNER[c].itemsize * n
                owner[c] = raw[at:at + wide].copy().view(OWNER[c])
                at += wide
            owner["member"] = np.cumsum(owner["member"])
            table = front_decode(prefix, raw[at:], size)
            flat = table.tobytes()
            runs.append(([flat[i:i + size] for i in range(0, n * size, size)], prefix.tolist()))
            tables.append(table)
            owners.append(owner)
        merged = np.array(list(merge_runs(runs)), np.int64)
        start = np.cumsum([0] + [len(t) for t in tables])[:-1]
        place = start[merged[:, 0]] + merged[:, 1]
        table, owner = np.concatenate(tables)[place], np.concatenate(owners)[place]
        prefix, block = merged[:, 2], np.array(of, np.int64)[merged[:, 0]]
        found = resolve(table, prefix, owner["doc"], owner["pos"], spec, runs_of(prefix, gram))
        return answers(found, block, owner["member"], owner["doc"], owner["pos"], owner["alone"])

    def cut(block: Block, mask: np.ndarray) -> pa.RecordBatch:
        bounds = block.offsets
        removed = totals(mask, bounds)
        kept = block.data[~mask]
        offsets = np.concatenate([[0], np.cumsum(np.diff(bounds) - removed)]).astype(np.int32)
        left = pa.Array.from_buffers(pa.binary(), len(removed), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
        if decode:
            left = pa.array((b.as_py().decode("utf-8", "ignore") for b in left), pa.string(), size=len(left))
        return pa.RecordBatch.from_arrays([
            null_ids(block.ids), left, pa.array(np.diff(bounds), pa.int64()), pa.array(removed, pa.int64()),
            pa.array(span_counts(mask, bounds), pa.int64())], names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    schema = f"doc_id bigint, kept {'string' if decode else 'binary'}, n_bytes bigint, n_removed bigint, n_spans bigint"
    return remove_repeats(docs, spec, deal, combine, cut, schema, carry or [], block_bytes)


def cut_texts(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with repeated substrings cut out of ``text``; all rows and columns stay. A null text becomes an empty one.

    Where a cut leaves part of a character, the part goes too. ``n_chars``, if there, is counted anew.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    found = remove_substrings(docs, length, carry=others, decode=True)
    out = found.select("doc_id", F.col("kept").alias("text"), *[F.col(f"`carried_{c}`").alias(c) for c in others])
    if "n_chars" in others:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
