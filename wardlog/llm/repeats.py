"""Exact repeats of fixed length: what the two substring deduplications share.

A text is a row of symbols (bytes or hashed words). A window of ``length`` symbols is *repeated* if
the same symbols also start at an earlier place. Looking at every window would move many times
the corpus, so the work is cut down without losing a window:

1. Texts are packed into blocks of some megabytes, as they are read. In every block the *anchors* are
   chosen: of the ``reach`` grams (``gram`` symbols) in a window the one with the least hash, ties
   included. The choice depends on the window's symbols alone, so equal windows have equal anchors,
   and ``gram + reach - 1 = length`` makes every window hold one.
2. The gram hashes of all anchors are exchanged, as sorted 32-bit runs dealt by their other bits. Grams
   met once only cannot be part of a repeat (this is the distinguishing-prefix step of distributed string
   sorting); a chance collision merely keeps an anchor too many.
3. For the others the suffix from the anchor (``length`` symbols) and the ``reach - 1`` symbols before it are
   exchanged, equal ones of a block once, with the earliest owner. Where they are brought together and
   how they are ordered is the method of the operator (see ``suffix_runs`` and ``substring_trees``).
4. ``resolve`` finds, for each suffix and each shift of the window over its anchor, the earliest owner.
5. Owners return to their blocks, where windows with an earlier owner are marked and cut.

A passage that every document holds is one row per block after step 3, so no task grows with its copies.

What is exchanged is packed by block and part; with ``b`` blocks there are about ``b * b / 3`` packages. For corpora beyond
some hundred gigabytes pass a larger ``block_bytes`` (64 MB blocks need about 1 GB in a task), so that packages stay large.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardlog.llm.common import NULL_ID, give_back, gram_hashes, grams_at, ids_column, slice_hashes, text_column, word_slices
from wardlog.session import materialize, scratch_path

BLOCK_BYTES = 4 << 20
BLOCKS_PER_PART = 3  # so many blocks' worth of suffixes meet in one task
TOP = np.uint64(2 ** 64 - 1)


class Spec(NamedTuple):
    length: int
    gram: int
    words: bool  # symbols are words, else bytes
    within: bool  # an earlier start in the same document counts

    @property
    def reach(self) -> int:
        return self.length - self.gram + 1

    @property
    def width(self) -> int:
        """Bytes of a symbol in rows: a byte, or the code of a word."""
        return 4 if self.words else 1


def shut(array: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(array).tobytes(), 1)


def opened(blob: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(blob), dtype)


def slide(op, values: np.ndarray, width: int) -> np.ndarray:
    """``op`` over every ``width`` neighbours, by doubling."""
    span, out = 1, values
    while span * 2 <= width:
        out = op(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return op(out[:-rest], out[rest:]) if rest else out


class Symbols(NamedTuple):
    values: np.ndarray  # uint8 or uint64
    bounds: np.ndarray  # symbols before each document, and their total
    starts: np.ndarray | None  # of words, in bytes
    ends: np.ndarray | None


def read_symbols(data: np.ndarray, offsets: np.ndarray, spec: Spec) -> Symbols:
    if not spec.words:
        return Symbols(data, offsets, None, None)
    starts, ends, bounds = word_slices(data, offsets)
    return Symbols(slice_hashes(data, starts, ends), bounds, starts, ends)


WINDOW_SLICE = 1 << 17  # windows whose anchors are looked for at once


def find_anchors(symbols: Symbols, spec: Spec) -> np.ndarray:
    """Positions of the least grams of all windows that lie within one document."""
    values, ends = symbols.values, symbols.bounds[1:]
    windows = len(values) - spec.length + 1
    found = [np.zeros(0, np.int64)]
    for begin in range(0, windows, WINDOW_SLICE):
        part = values[begin:min(begin + WINDOW_SLICE, windows) + spec.length - 1]
        inner = ends[np.searchsorted(ends, begin, side="right"):np.searchsorted(ends, begin + len(part))]
        found.append(begin + _anchors(part, inner - begin, spec))
    return np.unique(np.concatenate(found))  # windows of two slices may share an anchor


def _anchors(values: np.ndarray, ends: np.ndarray, spec: Spec) -> np.ndarray:
    """Anchors of a slice; documents end before the positions ``ends``."""
    hashes = gram_hashes(values, spec.gram)
    cut = (ends[:, None] - np.arange(1, spec.gram)).ravel()
    hashes[cut[(cut >= 0) & (cut < len(hashes))]] = TOP
    least = slide(np.minimum, hashes, spec.reach)
    cut = (ends[:, None] - np.arange(1, spec.length)).ravel()
    least[cut[(cut >= 0) & (cut < len(least))]] = 0  # these windows leave their document
    pad = np.zeros(spec.reach - 1, np.uint64)
    return np.flatnonzero(slide(np.maximum, np.concatenate([pad, least, pad]), spec.reach) == hashes)


BLOCK = "block bigint, ids binary, others binary, sizes binary, text binary, anchors binary, sample binary"
SAMPLE = 32


def pack_blocks(docs: DataFrame, spec: Spec, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of documents with their anchors, stored. ``docs``: doc_id, text, and what else is to be carried along."""
    def run(batches):
        texts: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        others: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            data, offsets = text_column(batch.column(1))
            keys, rest = ids_column(batch.column(0)), batch.select(batch.schema.names[2:])
            begin = 0
            for k in range(len(keys)):
                texts.append(data[offsets[k]:offsets[k + 1]])
                size += len(texts[-1])
                if size >= block_bytes or k + 1 == len(keys):
                    ids.append(keys[begin:k + 1])
                    others.append(rest.slice(begin, k + 1 - begin))
                    begin = k + 1
                if size >= block_bytes:
                    yield block(texts, ids, others)
                    texts, ids, others, size = [], [], [], 0
        if texts:
            yield block(texts, ids, others)

    def block(texts: list[np.ndarray], ids: list[np.ndarray], others: list[pa.RecordBatch]) -> pa.RecordBatch:
        data = np.concatenate(texts)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        symbols = read_symbols(data, offsets, spec)
        anchors = find_anchors(symbols, spec)
        sample = np.zeros(0, np.uint8)
        if not spec.words and len(anchors):
            some = anchors[np.linspace(0, len(anchors) - 1, min(SAMPLE, len(anchors))).astype(np.int64)]
            sample = symbols.values[some[:, None] + np.arange(spec.gram)]
        carried = pa.BufferOutputStream()
        with pa.ipc.new_stream(carried, others[0].schema) as stream:
            for part in others:
                stream.write_batch(part)
        columns = [np.concatenate(ids), np.frombuffer(carried.getvalue(), np.uint8), np.diff(offsets), data,
                   np.diff(anchors, prepend=0).astype(np.uint32), sample]
        return pa.RecordBatch.from_arrays([pa.array([shut(c)], pa.binary()) for c in columns],
                                          names=["ids", "others", "sizes", "text", "anchors", "sample"])

    packed = docs.mapInArrow(run, BLOCK.replace("block bigint, ", ""))
    return bucketed(packed.withColumn("block", F.monotonically_increasing_id()).select(
        *[c.split()[0] for c in BLOCK.split(", ")]))


def bucketed(blocks: DataFrame) -> DataFrame:
    """Blocks as a table bucketed by their number, in the shared folder.

    What comes back for a block is joined to it twice; the texts then need no shuffle.
    """
    spark = blocks.sparkSession
    path = scratch_path(spark, "blocks")
    name = f"blocks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks.write.bucketBy(buckets, "block").option("path", path).saveAsTable(name)
    return spark.table(name)


class Block(NamedTuple):
    ids: np.ndarray
    data: np.ndarray
    offsets: np.ndarray
    symbols: Symbols
    anchors: np.ndarray

    def document(self, at: np.ndarray) -> np.ndarray:
        """Documents of symbol positions."""
        return np.searchsorted(self.symbols.bounds, at, side="right") - 1


def open_block(row: dict, spec: Spec) -> Block:
    data = opened(row["text"], np.uint8)
    offsets = np.concatenate([[0], np.cumsum(opened(row["sizes"], np.int64))]).astype(np.int64)
    anchors = np.cumsum(opened(row["anchors"], np.uint32).astype(np.int64))
    return Block(opened(row["ids"], np.int64), data, offsets,
                 read_symbols(data, offsets, spec), anchors)


def gram_keys(block: Block, spec: Spec, buckets: int) -> np.ndarray:
    """Bucket and 32 further bits of each anchor's gram."""
    hashes = grams_at(block.symbols.values, spec.gram, block.anchors)
    return ((hashes >> np.uint64(32)) % np.uint64(buckets)) << np.uint64(32) | hashes & np.uint64(0xFFFFFFFF)


def record_rows(batches):
    """Rows one at a time: each holds some megabytes, which go back to the system before the next."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield {n: batch.column(i)[k].as_py() for i, n in enumerate(batch.schema.names)}
            give_back()


def shared_grams(blocks: DataFrame, spec: Spec, buckets: int) -> DataFrame:
    """``block, bucket, lows``: grams of a block that are met a second time somewhere."""
    def send(batches):
        for row in record_rows(batches):
            block = open_block(row, spec)
            keys = gram_keys(block, spec, buckets)
            if not len(keys):
                continue
            order = np.argsort(keys, kind="stable")
            ordered = keys[order]
            first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
            last = np.concatenate([first[1:], [len(ordered)]]) - 1
            places = order if spec.within else block.document(block.anchors)[order]
            again = places[first] != places[last]
            unique = ordered[first]
            lows = (unique & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            edges = np.searchsorted(unique, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32))
            used = np.flatnonzero(np.diff(edges))
            yield pa.RecordBatch.from_arrays([
                pa.array(used, pa.int64()), pa.array(np.full(len(used), row["block"]), pa.int64()),
                pa.array([lows[edges[b]:edges[b + 1]].tobytes() for b in used], pa.binary()),
                pa.array([np.packbits(again[edges[b]:edges[b + 1]]).tobytes() for b in used], pa.binary()),
            ], names=["bucket", "block", "lows", "again"])

    def meet(part: pa.Table) -> pa.Table:
        parts = [np.frombuffer(b, np.uint32) for b in part.column("lows").to_pylist()]
        again = [np.unpackbits(np.frombuffer(b, np.uint8), count=len(p)).astype(bool)
                 for b, p in zip(part.column("again").to_pylist(), parts)]
        lows = np.concatenate(parts)
        merged = np.sort(lows)
        twice = merged[1:][merged[1:] == merged[:-1]]
        wanted = np.unique(np.concatenate([twice, lows[np.concatenate(again)]]))
        found = [p[np.isin(p, wanted, assume_unique=True)] for p in parts]
        keep = [k for k, f in enumerate(found) if len(f)]
        return pa.table({"block": part.column("block").take(pa.array(keep, pa.int64())),
                         "bucket": part.column("bucket").take(pa.array(keep, pa.int64())),
                         "lows": pa.array([found[k].tobytes() for k in keep], pa.binary())})

    sent = blocks.select("block", "ids", "sizes", "text", "anchors").mapInArrow(
        send, "bucket bigint, block bigint, lows binary, again binary")
    return sent.groupBy("bucket").applyInArrow(meet, "block bigint, bucket bigint, lows binary")


class Suffixes(NamedTuple):
    """Distinct suffixes of a block with their surroundings, in byte order."""
    table: np.ndarray  # rows of bytes: suffix, symbols before it (nearest first), first and last shift
    letters: np.ndarray  # of words: the hash of each code in ``table``; code 0 stands outside the document
    doc: np.ndarray  # earliest owner
    pos: np.ndarray
    alone: np.ndarray  # a single anchor of the block has it


SLICE = 16_384  # anchors whose surroundings are looked up at once


def collect_suffixes(block: Block, spec: Spec, wanted: np.ndarray, buckets: int) -> tuple[Suffixes, np.ndarray, np.ndarray]:
    """Suffixes at anchors whose gram is in ``wanted``; also the anchors and the suffix of each.

    Words are written as the rank of their 64-bit hash in the block, which keeps rows short and in the order of the hashes.
    """
    keys = gram_keys(block, spec, buckets)
    at = block.anchors[np.isin(keys, wanted)]
    document = block.document(at)
    low, high = block.symbols.bounds[document], block.symbols.bounds[document + 1]
    values, letters = block.symbols.values, np.zeros(0, np.uint64)
    if spec.words:
        letters, codes = np.unique(values, return_inverse=True)
        letters, values = np.concatenate([np.zeros(1, np.uint64), letters]), (codes + 1).astype(">u4")
    side = spec.reach - 1
    steps = np.concatenate([np.arange(spec.length), -np.arange(1, side + 1)])
    rows = np.empty((len(at), len(steps) * spec.width + 2), np.uint8)
    for begin in range(0, len(at), SLICE):
        part = slice(begin, begin + SLICE)
        places = at[part, None] + steps
        outside = (places < low[part, None]) | (places >= high[part, None])
        held = values[np.clip(places, 0, max(0, len(values) - 1), out=places)]
        held[outside] = 0
        rows[part, :-2] = held.view(np.uint8).reshape(len(held), -1)
    rows[:, -2] = np.maximum(0, at + spec.length - high)
    rows[:, -1] = np.minimum(side, at - low)
    distinct, member = np.unique(rows.view(f"S{rows.shape[1]}").ravel(), return_inverse=True)
    del rows
    doc, pos = block.ids[document], at - low
    order = np.lexsort((pos, doc, member))
    lead = order[np.searchsorted(member[order], np.arange(len(distinct)))] if len(order) else order
    alone = np.bincount(member, minlength=len(distinct)) == 1
    table = distinct.view(np.uint8).reshape(len(distinct), len(steps) * spec.width + 2)
    return Suffixes(table, letters, doc[lead], pos[lead], alone), at, member.astype(np.int32)


def common_prefix(table: np.ndarray) -> np.ndarray:
    """Equal leading bytes of each row and the one before it (all, if equal); the first row has none."""
    if not len(table):
        return np.zeros(0, np.int64)
    differs = np.hstack([table[1:] != table[:-1], np.ones((len(table) - 1, 1), bool)])
    return np.concatenate([[0], differs.argmax(axis=1)])


def resolve(table: np.ndarray, prefix: np.ndarray, doc: np.ndarray, pos: np.ndarray, spec: Spec,
            runs: list[tuple[int, int]]) -> tuple[np.ndarray, ...]:
    """Earliest owners of windows, for suffixes in byte order.

    ``prefix`` counts the leading bytes a row shares with the row before; ``runs`` are the stretches of rows
    that share a gram. Returns arrays ``row, first, last, doc, pos``: windows shifted by ``first`` to ``last`` before
    the row's anchor have the owner ``(doc, pos)``.
    """
    n, size = table.shape
    side = spec.reach - 1
    fresh = prefix < size
    rep = np.cumsum(fresh) - 1  # equal rows of several blocks are one
    order = np.lexsort((pos, doc, rep))
    lead = order[np.searchsorted(rep[order], np.arange(rep[-1] + 1))] if n else order
    rep_doc, rep_pos, rep_row = doc[lead], pos[lead], np.flatnonzero(fresh)
    first, last = table[rep_row, size - 2].astype(np.int64), table[rep_row, size - 1].astype(np.int64)
    run_of = np.full(n, -1, np.int64)
    for k, (a, b) in enumerate(runs):
        run_of[a:b] = k
    rep_run = run_of[rep_row]
    crowd = np.bincount(rep_run[rep_run >= 0], minlength=len(runs)) if len(runs) else np.zeros(0, np.int64)
    plain = rep_run >= 0
    plain[plain] = crowd[rep_run[plain]] == 1
    out = [(np.flatnonzero(plain), first[plain], last[plain], rep_doc[plain], rep_pos[plain])]
    mixed = np.flatnonzero((rep_run >= 0) & ~plain)
    if len(mixed):
        rows = rep_row[mixed]
        share = np.zeros(len(rows), np.int64)  # symbols shared with the row before among ``rows``
        if len(rows) > 1:
            share[1:] = np.minimum.reduceat(prefix[:rows[-1] + 1], rows[:-1] + 1) // spec.width
        left = table[rows, spec.length * spec.width:size - 2]
        left = left if spec.width == 1 else np.ascontiguousarray(left).view(">u4").astype(np.uint64)
        sums = np.zeros((len(rows), side + 1), np.uint64)
        mult = np.cumprod(np.full(max(1, side), 0x9E3779B97F4A7C15, np.uint64))
        np.cumsum((left.astype(np.uint64) + np.uint64(1)) * mult[:side], axis=1, out=sums[:, 1:])
        rank = np.empty(len(rows), np.int64)
        rank[np.lexsort((rep_pos[mixed], rep_doc[mixed]))] = np.arange(len(rows))
        owner = np.full((len(rows), side + 1), -1, np.int64)
        for shift in range(side + 1):
            valid = np.flatnonzero((first[mixed] <= shift) & (shift <= last[mixed]))
            if not len(valid):
                continue
            same = np.cumsum(share < spec.length - shift)[valid]
            order = np.lexsort((rank[valid], sums[valid, shift], same))
            a, b = same[order], sums[valid, shift][order]
            start = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
            owner[valid[order], shift] = valid[order][np.flatnonzero(start)[np.cumsum(start) - 1]]
        opens = owner >= 0
        opens[:, 1:] &= owner[:, 1:] != owner[:, :-1]
        ends = owner >= 0
        ends[:, :-1] &= owner[:, 1:] != owner[:, :-1]
        r, a = np.nonzero(opens)
        b = np.nonzero(ends)[1]
        who = owner[r, a]
        out.append((mixed[r], a, b, rep_doc[mixed][who], rep_pos[mixed][who]))
    reps, a, b, d, p = (np.concatenate(x) for x in zip(*out))
    # Back to the rows of every block.
    members = np.argsort(rep, kind="stable")
    begin = np.searchsorted(rep[members], np.arange(rep[-1] + 2)) if n else np.zeros(1, np.int64)
    count = begin[reps + 1] - begin[reps]
    which = np.repeat(np.arange(len(reps)), count)
    inner = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    return members[begin[reps][which] + inner], a[which], b[which], d[which], p[which]


def runs_of(prefix: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Stretches of at least two neighbouring rows, or one row that stands for several, sharing ``least`` bytes."""
    edges = np.flatnonzero(prefix < least)
    return list(zip(edges.tolist(), np.concatenate([edges[1:], [len(prefix)]]).tolist()))


RESULT = np.dtype([("member", "<i4"), ("first", "u1"), ("last", "u1"), ("doc", "<i8"), ("pos", "<i8")])


def answers(found: tuple, block: np.ndarray, member: np.ndarray, doc: np.ndarray, pos: np.ndarray,
            alone: np.ndarray) -> tuple[list[int], list[bytes]]:
    """Results by block, without those that say nothing new to it."""
    row, first, last, owner_doc, owner_pos = found
    news = ~alone[row] | (owner_doc != doc[row]) | (owner_pos != pos[row])
    row, first, last, owner_doc, owner_pos = (x[news] for x in (row, first, last, owner_doc, owner_pos))
    out = np.empty(len(row), RESULT)
    out["member"], out["first"], out["last"], out["doc"], out["pos"] = member[row], first, last, owner_doc, owner_pos
    order = np.lexsort((member[row], block[row]))
    out, of = out[order], block[row][order]
    edges = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else np.zeros(0, np.int64)
    stops = np.concatenate([edges[1:], [len(of)]]) if len(of) else edges
    return of[edges].tolist(), [shut(out[a:b]) for a, b in zip(edges, stops)]


MEMBER = np.dtype([("at", "<i8"), ("member", "<i4")])


def covered(block: Block, spec: Spec, members: np.ndarray, results: list[np.ndarray]) -> np.ndarray:
    """Which symbols of a block lie in a window with an earlier owner."""
    n = len(block.symbols.values)
    if not results or not len(members):
        return np.zeros(n, bool)
    found = np.concatenate(results)
    members = members[np.argsort(members["member"], kind="stable")]
    begin = np.searchsorted(members["member"], found["member"])
    count = np.searchsorted(members["member"], found["member"], side="right") - begin
    which = np.repeat(np.arange(len(found)), count)
    at = members["at"][begin[which] + np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)]
    result = found[which]
    document = block.document(at)
    own, pos = block.ids[document], at - block.symbols.bounds[document]
    earlier = result["doc"] < own
    if spec.within:
        earlier |= (result["doc"] == own) & (result["pos"] < pos)
    at, result = at[earlier], result[earlier]
    starts, stops = at - result["last"].astype(np.int64), at - result["first"].astype(np.int64) + spec.length
    return mask_of(starts, stops, n)


def mask_of(starts: np.ndarray, stops: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` symbols lie in one of the stretches ``[start, stop)``."""
    if not len(starts):
        return np.zeros(n, bool)
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], np.maximum.accumulate(stops[order])
    opens = np.flatnonzero(np.concatenate([[True], starts[1:] > stops[:-1]]))
    edges = np.column_stack([starts[opens], stops[np.concatenate([opens[1:] - 1, [len(stops) - 1]])]]).ravel()
    sizes = np.diff(np.concatenate([[0], edges, [n]]))
    return np.repeat(np.arange(len(sizes)) % 2 == 1, sizes)


def with_lists(blocks: DataFrame, lists: DataFrame, name: str, *columns: str) -> DataFrame:
    """Blocks with the rows that came back to them as one list; blocks are the streamed side."""
    gathered = lists.groupBy("block").agg(F.collect_list(F.struct(*columns)).alias(name))
    return blocks.join(gathered.hint("shuffle_hash"), "block", "left")


def remove_repeats(docs: DataFrame, spec: Spec, deal: Callable, combine: Callable, cut: Callable, schema: str,
                   carry: list[str], block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The steps above around an operator's own exchange.

    ``deal(blocks, parts)`` returns a function that maps the sorted suffixes of a block to ``(part, blob)`` pairs;
    ``combine(blobs, blocks)`` brings one part together and returns answers by block; ``cut(block, mask)``
    gives the columns of ``schema`` for the documents of a block. Columns named in ``carry`` are added to the result
    with the prefix ``carried_``.
    """
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        *[F.col(f"`{c}`").alias(f"carried_{c}") for c in carry])
    blocks = pack_blocks(keyed, spec, block_bytes)
    parts = max(1, -(-blocks.count() // BLOCKS_PER_PART))
    shared = materialize(shared_grams(blocks, spec, parts), "shared-grams")
    content = blocks.drop("sample")
    sender = deal(blocks, parts)

    def send(batches):
        for row in record_rows(batches):
            came = row["came"] or []
            if not came:
                continue
            block = open_block(row, spec)
            wanted = np.concatenate([np.frombuffer(c["lows"], np.uint32).astype(np.uint64)
                                     | np.uint64(c["bucket"]) << np.uint64(32) for c in came])
            suffixes, at, member = collect_suffixes(block, spec, wanted, parts)
            kept = np.empty(len(at), MEMBER)
            kept["at"], kept["member"] = at, member
            rows = [(-1 - row["block"], shut(kept)), *sender(suffixes)]
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows], pa.int64()), pa.array([row["block"]] * len(rows), pa.int64()),
                pa.array([r[1] for r in rows], pa.binary())], names=["part", "block", "blob"])

    def meet(part: pa.Table) -> pa.Table:
        of, blobs = part.column("block").to_pylist(), part.column("blob").to_pylist()
        if part.column("part")[0].as_py() < 0:  # what a block keeps for itself
            return pa.table({"block": pa.array(of, pa.int64()), "own": pa.array([True] * len(of)), "blob": pa.array(blobs, pa.binary())})
        to, found = combine(blobs, of)
        give_back()
        return pa.table({"block": pa.array(to, pa.int64()), "own": pa.array([False] * len(to), pa.bool_()),
                         "blob": pa.array(found, pa.binary())})

    def finish(batches):
        for row in record_rows(batches):
            block = open_block(row, spec)
            came = row["came"] or []
            members = [opened(c["blob"], MEMBER) for c in came if c["own"]]
            results = [opened(c["blob"], RESULT) for c in came if not c["own"]]
            mask = covered(block, spec, members[0] if members else np.zeros(0, MEMBER), results)
            result = cut(block, mask)
            carried = pa.ipc.open_stream(zstandard.decompress(row["others"])).read_all().combine_chunks().to_batches()
            if carry:
                result = pa.RecordBatch.from_arrays(result.columns + carried[0].columns, names=result.schema.names + carried[0].schema.names)
            yield result

    sent = with_lists(content, shared, "came", "bucket", "lows").mapInArrow(send, "part bigint, block bigint, blob binary")
    back = sent.groupBy("part").applyInArrow(meet, "block bigint, own boolean, blob binary")
    fields = StructType([*StructType.fromDDL(schema).fields, *keyed.schema.fields[2:]])
    return with_lists(content, back, "came", "own", "blob").mapInArrow(finish, fields)


def null_ids(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == NULL_ID)


def span_counts(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Maximal covered stretches within each document."""
    starts = mask.copy()
    starts[1:] &= ~mask[:-1]
    inner = bounds[1:-1]
    inner = inner[inner < len(mask)]
    starts[inner] = mask[inner]
    return totals(starts, bounds)


def totals(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.int32)
    np.cumsum(values, dtype=np.int32, out=sums[1:])
    return (sums[bounds[1:]] - sums[bounds[:-1]]).astype(np.int64)
