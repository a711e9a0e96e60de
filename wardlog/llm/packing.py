"""Packing of documents into fixed windows: best-fit decreasing on a capacity tree.

Every document is tokenised in the task that reads it and cut into full windows, which are
sequences of their own, and one shorter rest. Rests are dealt into groups of a few
thousand by a hash of the document, so groups do not grow with the data; inside a group the
longest rest goes first into the tightest open window. Windows of equal remaining capacity
form one stack, and a segment tree over capacities says which stacks are not empty, so the
tightest fitting window is found in ``log2(window)`` steps.

Token ids never leave the task: pieces carry their position, length and checksum only.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlog.llm.common import texts
from wardlog.session import materialize

WINDOW = 1024
END_ID = 0
GROUP_PIECES = 4096  # rests packed together; padding lost per group is about half a window
CACHE_WORDS = 400_000  # words whose ids a task remembers before it starts afresh
VOCABULARY = "byte_bpe_50k"


@cache
def encoder(tiktoken_path: str, pattern: str) -> Callable[[str], list[int]]:
    """Encoder of a byte-level vocabulary given as ranks."""
    import base64

    import tiktoken
    with open(tiktoken_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


@cache
def tokenizer(path: str):
    """The tokenizer of a JSON file, added tokens and all."""
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def added_tokens(path: str) -> tuple[str, ...]:
    """Texts that the tokenizer of a JSON file takes as one token wherever they occur."""
    return tuple(t.content for t in tokenizer(path).get_added_tokens_decoder().values())


SPACE_RUN = re.compile(r"\s\s")


class WordIds:
    """Ids of a text as little-endian bytes, one lookup per word.

    The split pattern never joins a word with the blank that follows it, so where blanks are
    single the ids of a text are those of its pieces between blanks, each with its leading
    blank. Texts with longer runs of white space are encoded whole, and so are texts that hold
    an added token, by ``encode_added``.
    """

    def __init__(self, encode: Callable[[str], list[int]], added: tuple[str, ...] = (),
                 encode_added: Callable[[str], list[int]] | None = None):
        self.encode, self.added, self.encode_added, self.known = encode, added, encode_added, {}

    def of(self, piece: str) -> bytes:
        ids = np.array(self.encode(piece), "<u4").tobytes()
        if len(self.known) >= CACHE_WORDS:
            self.known.clear()
        if len(piece) <= 64:
            self.known[piece] = ids
        return ids

    def __call__(self, text: str) -> bytes:
        for token in self.added:
            if token in text:
                return np.array(self.encode_added(text), "<u4").tobytes()
        if SPACE_RUN.search(text):
            return np.array(self.encode(text), "<u4").tobytes()
        pieces = text.replace(" ", "\0 ").split("\0") if "\0" not in text else None
        if pieces is None:
            return np.array(self.encode(text), "<u4").tobytes()
        known, of = self.known.get, self.of
        return b"".join([known(p) or of(p) for p in pieces])


PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def pieces(docs: DataFrame, tiktoken_path: str, pattern: str, window: int = WINDOW,
           tokenizer_path: str | None = None) -> DataFrame:
    """Full windows and the rest of every document, ids closed by ``END_ID``.

    The ranks know no added tokens; those of the JSON file ``tokenizer_path`` are honoured where it is given.
    """
    added = added_tokens(tokenizer_path) if tokenizer_path else ()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = WordIds(encoder(tiktoken_path, pattern), added,
                         lambda text: tokenizer(tokenizer_path).encode(text, add_special_tokens=False).ids)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = (ids_of(text) if text else b"") + end
                total = len(ids) // 4
                for start in range(0, total, window):
                    part = ids[4 * start:4 * (start + window)]
                    out.append((doc, start, len(part) // 4, zlib.crc32(part), total))
            columns = [pa.array(c, pa.int64()) for c in zip(*out)] if out else [pa.array([], pa.int64())] * 5
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
    return texts(docs).mapInArrow(run, PIECES)


def best_fit(lengths: list[int], window: int = WINDOW) -> tuple[list[int], list[int]]:
    """Bin and offset of each length; ``lengths`` come longest first.

    The tree over capacities 0..window holds in each node whether some open window below it
    has that capacity; the search is for the smallest capacity that is large enough.
    """
    size = 1 << window.bit_length()
    tree = [0] * (2 * size)
    stacks: list[list[int]] = [[] for _ in range(window + 1)]
    bins, offsets, opened = [], [], 0
    for length in lengths:
        node = length + size
        if not tree[node]:
            while node > 1 and (node & 1 or not tree[node + 1]):  # up to a right sibling with windows
                node >>= 1
            if node > 1:
                node += 1
                while node < size:
                    node *= 2
                    if not tree[node]:
                        node += 1
            else:
                node = 0
        if node:
            room = node - size
            chosen = stacks[room].pop()
            if not stacks[room]:
                while node and tree[node]:
                    tree[node] = 0
                    if node & 1 == 0 and tree[node + 1] or node & 1 and tree[node - 1]:
                        break
                    node >>= 1
        else:
            chosen, room, opened = opened, window, opened + 1
        bins.append(chosen)
        offsets.append(window - room)
        left = room - length
        if left:
            stacks[left].append(chosen)
            node = left + size
            while node and not tree[node]:
                tree[node] = 1
                node >>= 1
    return bins, offsets


def pack(docs: DataFrame, tiktoken_path: str, pattern: str, window: int = WINDOW,
         group_pieces: int = GROUP_PIECES, tokenizer_path: str | None = None) -> DataFrame:
    """One row per piece with its ``sequence_id`` and ``offset``.

    Null and empty texts are one end id. Repeated and missing document ids are packed like any
    other row. Sequence ids are unique, not dense. An empty table gives an empty result.
    """
    cut = materialize(pieces(docs, tiktoken_path, pattern, window, tokenizer_path), "pieces")
    full, rest = cut.where(F.col("length") == window), cut.where(F.col("length") < window)
    groups = max(1, -(-rest.count() // group_pieces))
    keys = F.xxhash64("doc_id", "start", "ids_crc32", "doc_tokens")
    dealt = rest.withColumn("grp", F.pmod(keys, F.lit(groups)).cast("bigint"))

    def run(part: pa.Table) -> pa.Table:
        part = part.sort_by([("length", "descending"), ("doc_id", "ascending"), ("ids_crc32", "ascending")])
        bins, offsets = best_fit(part.column("length").to_pylist(), window)
        # Odd ids for packed windows: the group number spreads them, even ids are full windows.
        group = part.column("grp")[0].as_py()
        ids = 2 * (np.array(bins, np.int64) * groups + group) + 1
        return part.drop_columns(["grp"]).append_column("sequence_id", pa.array(ids)).append_column(
            "offset", pa.array(offsets, pa.int64()))

    packed = dealt.groupBy("grp").applyInArrow(run, PIECES + ", sequence_id bigint, offset bigint")
    alone = full.select(full.columns + [
        (F.monotonically_increasing_id() * 2).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")])
    return packed.unionByName(alone)
