"""Quality classifier: a generalised additive model with pairwise interactions.

Texts become a few dozen numeric features (shares of kinds of characters, lengths, repetition).
Every feature is cut into bins. Cyclic boosting goes round the features: a shallow tree on the bins of one feature
fits the current residual and is added to that feature's lookup table. Pairs that explain what is
left get two-dimensional tables in the same way. A score is the sum of one table entry per feature and
pair, passed through the logistic function: bins by binary search, entries by indexing, all
vectorised.

Features and scores cover whole texts of all documents; the tables are fitted on a bounded sample of
labelled ones.
"""

from __future__ import annotations

from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlog.llm.common import ids_back, ids_column, slice_hashes, text_column, word_slices
from wardlog.llm.toxicity import is_training
from wardlog.session import materialize

SAMPLE_ROWS = 30_000  # labelled documents used to fit, at most (in expectation)
BINS = 32
PAIR_BINS = 8
PAIRS = 12
ROUNDS = 150
PAIR_ROUNDS = 60
RATE = 0.1

CLASSES = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "high": range(128, 256), "line": (10,), "blank": (32, 9),
    "stop": (46, 63), "shout": (33,), "comma": (44, 59, 58), "bar": (124,), "sign": tuple(b"#$%&*+=<>@\\^_`~"), "bracket": tuple(b"()[]{}"),
    "quote": (34, 39), "dash": (45, 47),
}
FEATURES = (*[f"share_{c}" for c in CLASSES], "log_bytes", "log_words", "word_length", "word_spread", "short_words", "long_words",
            "capital_words", "distinct_words", "top_word", "repeated_neighbours", "log_line", "distinct_lines", "line_ends", "marked_words",
            "upper_of_letters", "words_per_stop")


def per_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def distinct_and_top(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of different values, and count of the most frequent one, in each row."""
    rows = len(bounds) - 1
    if not len(hashes):
        return np.zeros(rows), np.zeros(rows)
    shift = np.uint64(max(1, (rows - 1).bit_length()))
    row = np.repeat(np.arange(rows, dtype=np.uint64), np.diff(bounds))
    keys = np.sort(row << (np.uint64(64) - shift) | hashes >> shift)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    counts = np.diff(np.concatenate([first, [len(keys)]]))
    at = (keys[first] >> (np.uint64(64) - shift)).astype(np.int64)
    top = np.zeros(rows, np.int64)
    np.maximum.at(top, at, counts)
    return np.bincount(at, minlength=rows).astype(float), top.astype(float)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Feature rows of texts given as one array of bytes; empty texts are all zero."""
    size = np.diff(offsets).astype(float)
    some = np.maximum(size, 1)
    columns, shares = [], {}
    for name, codes in CLASSES.items():
        mask = np.zeros(256, bool)
        mask[list(codes)] = True
        shares[name] = per_row(mask[data], offsets)
        columns.append(shares[name] / some)
    starts, ends, bounds = word_slices(data, offsets)
    wide = (ends - starts).astype(float)
    words = np.diff(bounds).astype(float)
    each = np.maximum(words, 1)
    hashes = slice_hashes(data, starts, ends)
    mean = per_row(wide, bounds) / each
    spread = np.sqrt(np.maximum(0, per_row(wide ** 2, bounds) / each - mean ** 2))
    capital = (data[starts] >= 65) & (data[starts] <= 90) if len(starts) else np.zeros(0, bool)
    final = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    marked = ~((final >= 97) & (final <= 122) | (final >= 65) & (final <= 90) | (final >= 48) & (final <= 57) | (final >= 128))
    distinct, top = distinct_and_top(hashes, bounds)
    same = np.concatenate([[False], hashes[1:] == hashes[:-1]]) if len(hashes) else np.zeros(0, bool)
    same[bounds[:-1][bounds[:-1] < len(same)]] = False
    # Lines: cut at line feeds and at the ends of texts.
    breaks = np.unique(np.concatenate([offsets, np.flatnonzero(data == 10) + 1])) if len(data) else np.zeros(1, np.int64)
    line_of = np.searchsorted(breaks, offsets)
    lines = np.diff(line_of).astype(float)
    if len(breaks) > 1:
        line_hash = slice_hashes(data, breaks[:-1], breaks[1:])
        distinct_lines, _ = distinct_and_top(line_hash, line_of)
    else:
        distinct_lines = np.zeros(len(size))
    letters = np.maximum(1, shares["upper"] + shares["lower"])
    columns += [np.log1p(size), np.log1p(words), mean, spread, per_row(wide <= 3, bounds) / each, per_row(wide >= 12, bounds) / each,
                per_row(capital, bounds) / each, distinct / each, top / each, per_row(same, bounds) / each,
                np.log1p(words / np.maximum(lines, 1)), distinct_lines / np.maximum(lines, 1), shares["stop"] / np.maximum(lines, 1),
                per_row(marked, bounds) / each, shares["upper"] / letters, words / (1 + shares["stop"])]
    return np.stack(columns, axis=1).astype(np.float32)


def feature_table(docs: DataFrame) -> DataFrame:
    """``doc_id, features`` of every row."""
    def run(batches):
        for batch in batches:
            found = features(*text_column(batch.column(1)))
            flat = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), len(FEATURES)).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([ids_back(ids_column(batch.column(0))), flat], names=["doc_id", "features"])
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id bigint, features array<float>")


class Additive(NamedTuple):
    edges: list[np.ndarray]  # inner bin borders of each feature
    tables: np.ndarray  # (features, BINS)
    pairs: list[tuple[int, int]]
    pair_edges: list[np.ndarray]
    pair_tables: np.ndarray  # (pairs, PAIR_BINS, PAIR_BINS)
    bias: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        for j, edges in enumerate(self.edges):
            out += self.tables[j][np.searchsorted(edges, x[:, j], side="right")]
        for k, (a, b) in enumerate(self.pairs):
            i = np.searchsorted(self.pair_edges[a], x[:, a], side="right")
            j = np.searchsorted(self.pair_edges[b], x[:, b], side="right")
            out += self.pair_tables[k][i, j]
        return out


def borders(values: np.ndarray, bins: int) -> np.ndarray:
    """Inner borders of bins of about equal population."""
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1], method="lower")).astype(np.float32)


def best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a row of bins (the cut is before the place)."""
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    total_g, total_h = g.sum(), h.sum()
    gain = left_g ** 2 / (left_h + 1) + (total_g - left_g) ** 2 / (total_h - left_h + 1) - total_g ** 2 / (total_h + 1)
    at = int(gain.argmax())
    return float(gain[at]), at + 1


def shallow_tree(g: np.ndarray, h: np.ndarray, leaves: int = 4) -> np.ndarray:
    """Values of the bins from a tree of at most ``leaves`` leaves on gradient and curvature sums."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        cuts = [(*best_cut(g[a:b], h[a:b]), a, b) for a, b in parts]
        gain, at, a, b = max(cuts)
        if gain <= 1e-9:
            break
        parts.remove((a, b))
        parts += [(a, a + at), (a + at, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = -g[a:b].sum() / (h[a:b].sum() + 1)
    return out


def quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Best cut on each axis of a table of bins, and its gain: a tree of depth two."""
    cum_g, cum_h = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    row_g, row_h, col_g, col_h = cum_g[:, -1:], cum_h[:, -1:], cum_g[-1:, :], cum_h[-1:, :]
    blocks = [(cum_g, cum_h), (row_g - cum_g, row_h - cum_h), (col_g - cum_g, col_h - cum_h),
              (cum_g[-1, -1] - row_g - col_g + cum_g, cum_h[-1, -1] - row_h - col_h + cum_h)]
    gain = sum(bg ** 2 / (bh + 1) for bg, bh in blocks)[:-1, :-1]
    if not gain.size:
        return 0.0, np.zeros_like(g)
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    values = [-bg[i, j] / (bh[i, j] + 1) for bg, bh in blocks]
    out = np.empty_like(g)
    out[:i + 1, :j + 1], out[:i + 1, j + 1:], out[i + 1:, :j + 1], out[i + 1:, j + 1:] = values
    return float(gain[i, j] - cum_g[-1, -1] ** 2 / (cum_h[-1, -1] + 1)), out


def fit_tables(x: np.ndarray, y: np.ndarray) -> Additive:
    """Cyclic boosting of feature tables, then of the tables of the most telling pairs."""
    n, width = x.shape
    rate = min(max(y.mean(), 1e-3), 1 - 1e-3) if n else 0.5
    bias = float(np.log(rate / (1 - rate)))
    edges = [borders(x[:, j], BINS) for j in range(width)] if n else [np.zeros(0, np.float32)] * width
    pair_edges = [borders(x[:, j], PAIR_BINS) for j in range(width)] if n else edges
    tables, pair_tables = np.zeros((width, BINS)), np.zeros((PAIRS, PAIR_BINS, PAIR_BINS))
    if n == 0 or y.min() == y.max():
        return Additive(edges, tables, [], pair_edges, pair_tables[:0], bias)
    bins = [np.searchsorted(edges[j], x[:, j], side="right") for j in range(width)]
    margin = np.full(n, bias)

    def residual() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        return p - y, np.maximum(p * (1 - p), 1e-6)

    for _ in range(ROUNDS):
        for j in range(width):
            g, h = residual()
            step = RATE * shallow_tree(np.bincount(bins[j], g, BINS), np.bincount(bins[j], h, BINS))
            tables[j] += step
            margin += step[bins[j]]
    coarse = [np.searchsorted(pair_edges[j], x[:, j], side="right") for j in range(width)]
    g, h = residual()
    cells = {(a, b): coarse[a] * PAIR_BINS + coarse[b] for a, b in combinations(range(width), 2)}
    def sums(cell: np.ndarray, v: np.ndarray) -> np.ndarray:
        return np.bincount(cell, v, PAIR_BINS ** 2).reshape(PAIR_BINS, PAIR_BINS)
    gains = sorted(((quadrants(sums(c, g), sums(c, h))[0], p) for p, c in cells.items()), reverse=True)
    pairs = [p for _, p in gains[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for k, p in enumerate(pairs):
            g, h = residual()
            _, step = quadrants(sums(cells[p], g), sums(cells[p], h))
            pair_tables[k] += RATE * step
            margin += RATE * step.ravel()[cells[p]]
    return Additive(edges, tables, pairs, pair_edges, pair_tables[:len(pairs)], bias)


def fit(table: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Additive:
    training = labels.where(is_training(F.col("doc_id")) & F.col("quality").isin(0, 1)).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    rate = min(1.0, sample_rows / max(1, training.count()))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = table.join(training.where(drawn < rate), "doc_id").select("features", "quality")
    found = chosen.toArrow()  # bounded: the sample
    x = np.array(found["features"].combine_chunks().flatten().to_numpy(), np.float32).reshape(-1, len(FEATURES))
    return fit_tables(x, found["quality"].to_numpy().astype(float))


def score(table: DataFrame, model: Additive) -> DataFrame:
    shared = table.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            out = 1 / (1 + np.exp(-shared.value.margin(x)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], names=["doc_id", "score"])
    return table.mapInArrow(run, "doc_id bigint, score double")


def classify(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per row of ``docs``; the score is the chance of label 1.

    A null text counts as empty and is scored like any other. Labels that are null or neither 0 nor 1 are
    ignored; without labels, or with labels of one kind only, every score is the same. Rows without an id are
    scored but never held out.
    """
    table = materialize(feature_table(docs), "features")
    return score(table, fit(table, labels, sample_rows)).select(
        "doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
