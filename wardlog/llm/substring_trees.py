"""Substring dedup on words: suffix trees of prefix-partitioned suffixes.

Suffixes of words are dealt by a prefix of variable length. One word is enough where few suffixes begin
with it; where more do than fit a task's memory, the prefix grows to two, four and eight words.
Prefixes are counted over all anchors of the corpus (hashed to a number of codes that follows its size),
so every group is bounded before any suffix is sent. A group builds the suffix tree of its suffixes
from their order and common prefixes. An internal node at least as deep as a gram is a repeat; the topmost
such nodes are handed to ``repeats.resolve``, which reads the windows of full length below them.

Words covered by a window of ``length`` words that also starts earlier go.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wardlog.llm.repeats import (
    BLOCK_BYTES, Block, Spec, Suffixes, answers, common_prefix, null_ids, open_block, opened, record_rows, remove_repeats,
    resolve, shut, span_counts, totals)

LENGTH = 20
GRAM = 10
LEVELS = (1, 2, 4, 8)  # words of a prefix
GROUPS_PER_PART = 64  # codes of a level for each task; a prefix is extended beyond eight times its even share
OWNER = np.dtype([("doc", "<i8"), ("pos", "<i8"), ("member", "<i4"), ("alone", "?")])


def prefix_codes(words: np.ndarray, codes: int) -> list[np.ndarray]:
    """Code of the prefix of each level, for rows of word hashes."""
    out = []
    for size in LEVELS:
        total = np.zeros(len(words), np.uint64)
        for j in range(size):
            total = (total + words[:, j] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        out.append(((total >> np.uint64(33)) % np.uint64(codes)).astype(np.int64))
    return out


def heavy_prefixes(blocks: DataFrame, spec: Spec, codes: int) -> np.ndarray:
    """For each level but the last, which codes hold too many anchors for one group.

    A code with more than eight even shares of all anchors has more than eight even shares of those of some
    task, so a task only reports its own heavy codes, fewer than ``codes / 8`` and mostly a handful. A code
    that is heavy in one task alone gets a longer prefix too, which does no harm.
    """
    def count(batches):
        sums = np.zeros((len(LEVELS) - 1, codes), np.int64)
        for row in record_rows(batches):
            block = open_block(row, spec)
            head = np.minimum(block.anchors[:, None] + np.arange(max(LEVELS)), max(0, len(block.symbols.values) - 1))
            words = block.symbols.values[head]
            for level, found in enumerate(prefix_codes(words, codes)[:-1]):
                sums[level] += np.bincount(found, minlength=codes)
        level, code = np.nonzero(sums > 8 * sums.sum(axis=1, keepdims=True) / codes)
        yield pa.RecordBatch.from_arrays([pa.array(level, pa.int32()), pa.array(code, pa.int64())], names=["level", "code"])
    heavy = blocks.select("block", "ids", "sizes", "text", "anchors").mapInArrow(count, "level int, code bigint").distinct()
    out = np.zeros((len(LEVELS) - 1, codes), bool)
    for r in heavy.toLocalIterator():
        out[r.level, r.code] = True
    return out


def deep_nodes(prefix: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Internal nodes ``(first row, last row + 1, depth)`` of the suffix tree at least ``least`` deep, children first.

    Rows are suffixes in order, ``prefix`` what each shares with the one before; a node is a stretch of
    rows that share more than its surroundings do.
    """
    nodes: list[tuple[int, int, int]] = []
    stack: list[tuple[int, int]] = []  # first row and depth of the open nodes
    for row, depth in enumerate([*prefix[1:].tolist(), 0]):
        first = row
        while stack and stack[-1][1] > depth:
            first, deep = stack.pop()
            nodes.append((first, row + 1, deep))
        if depth >= least and (not stack or stack[-1][1] < depth):
            stack.append((first, depth))
    return nodes


def topmost(nodes: list[tuple[int, int, int]], rows: int) -> list[tuple[int, int]]:
    """Stretches below the topmost nodes; a row below none stands alone."""
    end = np.arange(1, rows + 1)
    for first, last, _ in nodes:  # parents come after their children
        end[first] = max(end[first], last)
    out, row = [], 0
    while row < rows:
        out.append((row, int(end[row])))
        row = int(end[row])
    return out


def remove_windows(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block_bytes: int = BLOCK_BYTES,
                   carry: list[str] | None = None) -> DataFrame:
    """``doc_id, kept`` (binary, words joined by blanks), ``n_words, n_removed, n_spans`` per row.

    Other columns named in ``carry`` follow as ``carried_<name>``. A null text has no
    words; a missing id counts as smaller than all others; rows with equal ids are compared by position.
    Words are compared by 64 bits of their hash.
    """
    spec = Spec(length, gram, words=True, within=True)
    size = (length + spec.reach - 1) * spec.width + 2

    def deal(blocks: DataFrame, parts: int):
        codes = 1 << max(10, (parts * GROUPS_PER_PART - 1).bit_length())
        heavy = heavy_prefixes(blocks, spec, codes)

        def send(found: Suffixes) -> list[tuple[int, bytes]]:
            letters = np.ascontiguousarray(found.table[:, :-2]).view(">u4")
            words = found.letters[letters[:, :max(LEVELS)]]
            by_level = prefix_codes(words, codes)
            level, group = np.zeros(len(words), np.int64), by_level[0].copy()
            for k in range(len(LEVELS) - 1):
                longer = (level == k) & heavy[k][by_level[k]]
                level[longer], group[longer] = k + 1, by_level[k + 1][longer]
            part = (group * len(LEVELS) + level) * 2654435761 % (1 << 32) % parts
            order = np.argsort(part, kind="stable")
            edges = np.searchsorted(part[order], np.arange(parts + 1))
            out = []
            for p in np.flatnonzero(np.diff(edges)):
                rows = order[edges[p]:edges[p + 1]]
                owner = np.empty(len(rows), OWNER)
                owner["doc"], owner["pos"], owner["member"], owner["alone"] = found.doc[rows], found.pos[rows], rows, found.alone[rows]
                # Full hashes travel; codes hold within a block only.
                out.append((int(p), shut(np.concatenate([
                    np.array([len(rows)], "<i8").view(np.uint8), owner.view(np.uint8).ravel(),
                    found.letters[letters[rows]].astype("<u8").view(np.uint8).ravel(), found.table[rows, -2:].ravel()]))))
            return out
        return send

    def combine(blobs: list[bytes], of: list[int]) -> tuple[list[int], list[bytes]]:
        owners, words, shifts, blocks = [], [], [], []
        for blob, block in zip(blobs, of):
            raw = opened(blob, np.uint8)
            n = int(raw[:8].view("<i8")[0])
            ends = np.cumsum([8, n * OWNER.itemsize, n * (size - 2) // spec.width * 8, n * 2])
            owner, hashes, shift = (raw[a:b] for a, b in zip(ends[:-1], ends[1:]))
            owners.append(owner.copy().view(OWNER))
            words.append(hashes.copy().view("<u8"))
            shifts.append(shift.reshape(n, 2))
            blocks.append(np.full(n, block, np.int64))
        # Words become codes of the part, in the order of their hashes; 0 stays 0.
        letters = np.unique(np.concatenate([np.zeros(1, np.uint64), *[np.unique(w) for w in words]]))
        tables = []
        for k, shift in enumerate(shifts):
            table = np.empty((len(shift), size), np.uint8)
            table[:, :-2] = np.searchsorted(letters, words[k]).astype(">u4").view(np.uint8).reshape(len(shift), size - 2)
            table[:, -2:] = shift
            tables.append(table)
            words[k] = None
        table, owner, block = np.concatenate(tables), np.concatenate(owners), np.concatenate(blocks)
        order = np.argsort(table.view(f"S{size}").ravel(), kind="stable")
        table, owner, block = table[order], owner[order], block[order]
        prefix = common_prefix(table)
        runs = topmost(deep_nodes(prefix // spec.width, gram), len(table))
        found = resolve(table, prefix, owner["doc"], owner["pos"], spec, runs)
        return answers(found, block, owner["member"], owner["doc"], owner["pos"], owner["alone"])

    def cut(block: Block, mask: np.ndarray) -> pa.RecordBatch:
        bounds = block.symbols.bounds
        removed, words = totals(mask, bounds), np.diff(bounds)
        starts, wide = block.symbols.starts[~mask], (block.symbols.ends - block.symbols.starts)[~mask]
        # Each kept word and a blank behind it; the last blank of a document is left out of its slice.
        steps = wide + 1
        begin = np.cumsum(steps) - steps
        index = np.int32 if len(block.data) < 2 ** 30 else np.int64
        source = np.repeat((starts - begin).astype(index), steps)
        source += np.arange(len(source), dtype=index)
        joined = np.concatenate([block.data, np.zeros(1, np.uint8)])[source]
        del source
        joined[begin + wide] = 32
        ends = np.concatenate([[0], np.cumsum(words - removed)])
        edge = np.concatenate([begin, [len(joined)]])[ends]
        some = ends[1:] > ends[:-1]
        drop = edge[1:][some] - 1
        kept = np.delete(joined, drop)
        offsets = np.concatenate([[0], np.cumsum(np.diff(edge) - some)]).astype(np.int32)
        binary = pa.Array.from_buffers(pa.binary(), len(removed), [None, pa.py_buffer(offsets), pa.py_buffer(kept.tobytes())])
        return pa.RecordBatch.from_arrays([
            null_ids(block.ids), binary, pa.array(words, pa.int64()), pa.array(removed, pa.int64()),
            pa.array(span_counts(mask, bounds), pa.int64())], names=["doc_id", "kept", "n_words", "n_removed", "n_spans"])

    schema = "doc_id bigint, kept binary, n_words bigint, n_removed bigint, n_spans bigint"
    return remove_repeats(docs, spec, deal, combine, cut, schema, carry or [], block_bytes)

