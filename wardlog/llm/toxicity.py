"""Toxicity with noisy-channel deobfuscation.

1. A character model (trigrams of lower-case letters) is counted over all documents, exactly: counts are an
   aggregation in Spark that grows with the input, and of it only the grams met in lattices are handed out.
2. Words that look disguised - letters mixed with digits or signs, letters repeated, single letters set
   apart - become lattices: every place may stand for the letters it resembles, a repeated letter for
   one or two of its kind, a separator for nothing. A run of single letters is one lattice in which every
   blank stands for nothing or for a word border. The Viterbi path of the lattice under the character
   model, times a channel cost per replacement, is the restored text.
3. Documents are scored on restored words. Units (words, and their first four and five letters) that
   tell toxic from clean labelled documents apart are chosen by a likelihood-ratio test and weighed by the
   logarithm of their rates; a logistic regression on a text's strongest evidence gives the score.

The regression is fitted on a bounded, stratified sample of labelled documents; counting and scoring
cover whole texts of all documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlog.llm.common import give_back, texts
from wardlog.session import materialize

SAMPLE_ROWS = 4000  # labelled documents of each class used to fit, at most (in expectation)
CODE_BITS = 21  # of a code point; three of them make one key
PAIR = (1 << CODE_BITS) - 1  # no code point: stands for any letter after two others
PENDING = 1 << 20  # keys a task holds before it sends their counts on
CHANCE_UNITS = 20  # units that may pass the likelihood-ratio test by chance
MAX_UNITS = 5000
CACHE_WORDS = 300_000
CHANNEL_COST = 1.5  # nats for each replaced character

# Signs and the letters they resemble.
RESEMBLES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
    "!": "i", "|": "il", "+": "t", "€": "e", "(": "c", "£": "l", "¡": "i",
}
SEPARATORS = "._-*~'`^,"
EDGE = re.compile(r"^[^\w$@€£!|+(]+|[^\w$@€£]+$")  # an exclamation mark can open a word in disguise, hardly close one
SIGN_RUN = re.compile(r"([$@€£!|+(])\1{2,}$|^([$@€£!|+(])\2{2,}")
LETTER_RUN = re.compile(r"([^\W\d_])\1{2,}|([^\W\d_])\2.*([^\W\d_])\3")  # one letter three times, or several doubled letters
LETTER = re.compile(r"[^\W\d_]")
MIXED = re.compile(r"[^\W\d_][\d@$!|+€(£¡]|[\d@$!|+€(£¡][^\W\d_]|[^\W\d_][._\-*~'`^,]+[^\W\d_]")
SPACED = re.compile(r"(?<!\S)(?:[^\W_]|[@$!|+€])(?:\s+(?:[._\-]\s*)?(?:[^\W_]|[@$!|+€])){2,}(?!\S)")
SPACE = re.compile(r"\s+(?:[._\-]\s*)?")  # what is between two letters of a spaced run


def is_training(doc_id: Column) -> Column:
    """Rows whose label may be learnt from; rows without an id may not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 != 0, F.lit(False))


def letter_codes(text: str) -> np.ndarray:
    """Code points of the letters of a lower-case text; 0 for anything else."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    plain = ((codes >= 97) & (codes <= 122)) | ((codes >= 0xDF) & (codes != 0xF7) & (codes < 0x2000)) | (codes >= 0x3000)
    return np.where(plain, codes, 0).astype(np.int64)


def gram_keys(a, b, c):
    """One number for three codes; no two triples share one."""
    return (a << CODE_BITS | b) << CODE_BITS | c


class CharacterModel:
    """Log probabilities of a letter after two others, with a floor for what was never seen.

    ``keys`` are sorted and hold trigrams, and bigrams closed by ``PAIR``.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts = keys, counts
        self.known: dict[tuple[int, int, int], float] = {}

    def count(self, key: int) -> int:
        at = int(np.searchsorted(self.keys, np.int64(key)))
        return int(self.counts[at]) if at < len(self.keys) and self.keys[at] == key else 0

    def log_probability(self, a: int, b: int, c: int) -> float:
        key = (a, b, c)
        value = self.known.get(key)
        if value is None:
            joint, before = self.count(gram_keys(a, b, c)), self.count(gram_keys(a, b, PAIR))
            value = self.known[key] = math.log((joint + 0.1) / (before + 10.0))
        return value


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts[order], first) if len(keys) else counts


def text_grams(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of the trigrams of a text and of the bigrams that begin them."""
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    word = (b > 0) | (c > 0)
    keys, counts = np.unique(gram_keys(a[word], b[word], c[word]), return_counts=True)
    pairs, pair_counts = summed(keys | PAIR, counts)
    return np.concatenate([keys, pairs]), np.concatenate([counts, pair_counts])


def character_counts(docs: DataFrame, of_lattices: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of trigrams and bigrams and their counts over all texts.

    With ``of_lattices`` only those that decoding these texts asks for are returned; the others never leave the
    aggregation. Without, all are, which suits small tables only.
    """
    def run(batches):
        names = ["key", "n", "asked"]

        def rows(keys, counts, asked):
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(counts, pa.int64()),
                                               pa.array(np.full(len(keys), asked))], names=names)
        held, size, seen, asked = [], 0, set(), set()
        for batch in batches:
            lower = [t.lower() for t in batch.column(0).to_pylist() if t]
            codes = letter_codes("\n\n".join(lower))
            if len(codes) > 2:
                held.append(text_grams(codes))
                size += len(held[-1][0])
            if size > PENDING:
                held = [summed(*map(np.concatenate, zip(*held)))]
                size = len(held[0][0])
                if size > PENDING // 2:
                    yield rows(*held[0], False)
                    held, size = [], 0
            if not of_lattices:
                continue
            for text in lower:
                fresh = tokens_of(text) - seen
                for token in fresh:
                    word = hidden(token)
                    if word is not None:
                        lattice_keys(word, asked)
                seen |= fresh
                if len(seen) > CACHE_WORDS:
                    seen.clear()
                if len(asked) > PENDING:
                    yield rows(np.fromiter(asked, np.int64, len(asked)), np.zeros(len(asked), np.int64), True)
                    asked.clear()
        if held:
            yield rows(*summed(*map(np.concatenate, zip(*held))), False)
        yield rows(np.fromiter(asked, np.int64, len(asked)), np.zeros(len(asked), np.int64), True)
    counted = docs.select("text").mapInArrow(run, "key bigint, n bigint, asked boolean").groupBy("key").agg(
        F.sum("n").alias("n"), F.max("asked").alias("asked")).where("n > 0")
    if of_lattices:
        counted = counted.where("asked")
    found = counted.select("key", "n").toArrow()
    return summed(found["key"].to_numpy(), found["n"].to_numpy())


def lattice(word: str) -> list[tuple[tuple[str, float], ...]]:
    """Choices of text and cost at each place of a lower-case word."""
    places = []
    at = 0
    while at < len(word):
        c = word[at]
        end = at
        while end < len(word) and word[end] == c:
            end += 1
        run, at = end - at, end
        if c.isalpha():
            if run == 1:
                places.append(((c, 0.0),))
            elif run == 2:
                places.append(((c + c, 0.0), (c, CHANNEL_COST)))
            else:
                places.append(((c, CHANNEL_COST), (c + c, CHANNEL_COST)))
        elif c in RESEMBLES:
            single = [(x, CHANNEL_COST) for x in RESEMBLES[c]]
            double = [(x + x, 2 * CHANNEL_COST) for x in RESEMBLES[c]] if run > 1 else []
            places.append((*single, *double))
        elif c in SEPARATORS:
            if c == "*":
                places.append((("", CHANNEL_COST), *[(x, 2 * CHANNEL_COST) for x in "aeioustcn"]))
            else:
                places.append((("", CHANNEL_COST),))
        elif c == " ":  # only in spaced runs, where letters and words are set apart alike
            places.append((("", 0.0), (" ", 0.0)))
        else:
            places.append(((" ", CHANNEL_COST),))
    return places


def lattice_keys(word: str, keys: set[int]) -> None:
    """Add the keys of all grams that decoding ``word`` asks for."""
    states = {(0, 0)}
    for choices in lattice(word):
        after = set()
        for a, b in states:
            for piece, _ in choices:
                x, y = a, b
                for ch in piece:
                    code = ord(ch) if ch != " " else 0
                    keys.add(gram_keys(x, y, code))
                    keys.add(gram_keys(x, y, PAIR))
                    x, y = y, code
                after.add((x, y))
        states = after
    for a, b in states:
        keys.add(gram_keys(a, b, 0))
        keys.add(gram_keys(a, b, PAIR))


def viterbi(word: str, model: CharacterModel) -> str:
    """Most likely restored text of a disguised word."""
    # Texts are chains of pieces, so that long runs are not copied at every place.
    states: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
    score = model.log_probability
    for choices in lattice(word):
        after: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (a, b), (total, chain) in states.items():
            for piece, cost in choices:
                x, y, value = a, b, total - cost
                for ch in piece:
                    code = ord(ch) if ch != " " else 0
                    value += score(x, y, code)
                    x, y = y, code
                held = after.get((x, y))
                if held is None or value > held[0]:
                    after[x, y] = (value, (chain, piece))
        states = after
    chain = max(states.items(), key=lambda s: s[1][0] + score(*s[0], 0))[1][1]
    pieces = []
    while chain:
        chain, piece = chain
        pieces.append(piece)
    return "".join(reversed(pieces))


def bare(token: str) -> str:
    return EDGE.sub("", SIGN_RUN.sub("", token))


def hidden(token: str) -> str | None:
    """The bare word of a lower-case token, or the spaced run, if it looks disguised."""
    if " " in token:
        return token
    word = bare(token)
    return word if LETTER_RUN.search(word) or not word.isalpha() and MIXED.search(word) else None


def restore(token: str, model: CharacterModel) -> str:
    """Bare lower-case word, decoded if it looks disguised; the words of a spaced run."""
    word = hidden(token)
    if word is not None:
        return viterbi(word, model)
    word = bare(token)
    return word if word.isalpha() else re.sub(r"[\W\d_]+", "", word)


def tokens_of(text: str) -> set[str]:
    """Distinct words of a lower-case text, and its spaced runs with single blanks.

    A run without any letter is a row of numbers and holds no word.
    """
    tokens = set(text.split())
    for spread in SPACED.finditer(text):
        if LETTER.search(spread.group()):
            tokens.add(SPACE.sub(" ", spread.group()))
    return tokens


def units(word: str) -> tuple[str, ...]:
    if len(word) < 3:
        return ()
    return (word, "4:" + word[:4], "5:" + word[:5])


class Reader:
    """Restored units of texts; remembers the words met by a task."""

    def __init__(self, model: CharacterModel, keep=None):
        self.model, self.keep, self.known = model, keep, {}

    def of(self, token: str) -> tuple:
        found = tuple(u for w in dict.fromkeys(restore(token, self.model).split()) for u in units(w))
        if self.keep is not None:
            found = tuple(self.keep[u] for u in found if u in self.keep)
        if len(token) <= 64:
            if len(self.known) >= CACHE_WORDS:
                self.known.clear()
            self.known[token] = found
        return found

    def __call__(self, text: str | None) -> Counter:
        """How many distinct words of a text hold each unit."""
        if not text:
            return Counter()
        known, out = self.known, Counter()
        for token in tokens_of(text.lower()):
            found = known.get(token)
            if found is None:
                found = self.of(token)
            if found:
                out.update(found)
        return out


class Model(NamedTuple):
    keys: np.ndarray  # of the character model
    counts: np.ndarray
    units: dict  # unit -> column
    weights: np.ndarray  # log ratio of the unit's rates among toxic and clean documents
    coefficients: np.ndarray  # of the evidence of a text, and the bias


def sampled_labels(labels: DataFrame, rows: int) -> DataFrame:
    """Training labels thinned by hash to about ``rows`` of each class, with the weight that undoes it."""
    training = labels.where(is_training(F.col("doc_id")) & F.col("toxic").isin(0, 1)).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    sizes = {r.toxic: r.n for r in training.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    rate = F.when(F.col("toxic") == 1, min(1.0, rows / max(1, sizes.get(1, 0)))).otherwise(min(1.0, rows / max(1, sizes.get(0, 0))))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return training.where(drawn < rate).withColumn("weight", 1 / rate)


def choose_units(names: list[str], have: np.ndarray, totals: np.ndarray) -> dict:
    """Columns of the units whose presence depends on the class.

    ``have`` counts the clean and the toxic documents with each unit, ``totals`` all of them.
    """
    if not names:
        return {}
    rate = have.sum(axis=1) / totals.sum()
    expected = np.stack([rate * totals[0], rate * totals[1]], axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        statistic = 2 * (np.where(have > 0, have * np.log(have / expected), 0).sum(axis=1)
                         + np.where(totals - have > 0, (totals - have) * np.log((totals - have) / (totals - expected)), 0).sum(axis=1))
    bound = 2 * math.log(max(2.0, len(names) / CHANCE_UNITS))
    telling = np.flatnonzero((statistic > bound) & (have[:, 1] / totals[1] > have[:, 0] / totals[0]))
    telling = telling[np.lexsort((np.array(names)[telling], -statistic[telling]))][:MAX_UNITS]
    return {names[i]: k for k, i in enumerate(telling)}


def unit_counts(sample: DataFrame, counts) -> DataFrame:
    """``unit, clean, toxic``: documents of the sample that hold a unit, for units of three toxic ones or more."""
    def run(batches):
        reader = Reader(CharacterModel(*counts.value))
        seen: dict[str, list[int]] = {}
        for batch in batches:
            for y, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                for unit in reader(text):
                    seen.setdefault(unit, [0, 0])[y] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array([v[0] for v in seen.values()], pa.int64()),
                                          pa.array([v[1] for v in seen.values()], pa.int64())], names=["unit", "clean", "toxic"])
    counted = sample.mapInArrow(run, "unit string, clean bigint, toxic bigint").groupBy("unit").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    return counted.where("toxic >= 3")


def evidence(found: dict[int, int], weights: np.ndarray) -> tuple[float, float, float]:
    """Strongest evidence of a text and the means of its three and eight strongest.

    Each distinct word counts once for each of its units. Only the strongest evidence counts, so a long text does
    not become toxic by adding up weak hints.
    """
    strongest = sorted((w for u, n in found.items() for w in [float(weights[u])] * min(n, 8)), reverse=True)[:8]
    strongest += [0.0] * (8 - len(strongest))
    return strongest[0], sum(strongest[:3]) / 3, sum(strongest) / 8


def regression(x: np.ndarray, toxic: np.ndarray, weight: np.ndarray, steps: int = 30, ridge: float = 1.0) -> np.ndarray:
    """Weighted logistic regression by damped Newton steps; the last coefficient is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    pull = ridge * np.eye(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - toxic)) + pull @ w
        step = np.linalg.solve(x.T @ (x * (weight * np.maximum(p * (1 - p), 1e-4))[:, None]) + pull, slope)
        w -= step * min(1.0, 2.0 / max(1e-9, float(np.abs(step).max())))
    return w


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from training labels of given documents, to score these documents.

    The character model holds what their own lattices ask for. Without labels, every score is the same low one.
    """
    docs = texts(docs)
    keys, gram_counts = character_counts(docs, of_lattices=True)
    chosen = sampled_labels(labels, sample_rows).collect()  # bounded: the sample
    spark = docs.sparkSession
    if not chosen:
        return Model(keys, gram_counts, {}, np.zeros(0), np.array([0.0, 0.0, 0.0, -3.0]))
    wanted = spark.createDataFrame([(r.doc_id, r.toxic, float(r.weight)) for r in chosen], "doc_id bigint, toxic int, weight double")
    sample = materialize(docs.join(F.broadcast(wanted), "doc_id").select("toxic", "weight", "text"), "toxicity-sample")
    counts = spark.sparkContext.broadcast((keys, gram_counts))
    sizes = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    totals = np.array([max(1, sizes.get(0, 0)), max(1, sizes.get(1, 0))], float)
    found = unit_counts(sample, counts).toArrow()
    have = np.stack([found["clean"].to_numpy(), found["toxic"].to_numpy()], axis=1).astype(float)
    listed = found["unit"].to_pylist()
    names = choose_units(listed, have, totals)
    chosen_rows = have[[i for i, u in enumerate(listed) if u in names]]
    order = np.argsort([names[u] for u in listed if u in names])
    shares = (chosen_rows[order] + 0.5) / (totals + 1) if names else np.ones((0, 2))
    weights = np.log(shares[:, 1] / shares[:, 0])
    del found, listed, have

    def run(batches):
        reader = Reader(CharacterModel(*counts.value), names)
        for batch in batches:
            read = [reader(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([list(c.keys()) for c in read], pa.list_(pa.int32())),
                pa.array([list(c.values()) for c in read], pa.list_(pa.int32()))], names=["toxic", "weight", "units", "times"])
    # Bounded: the sample, and of its texts the chosen units only.
    rows = sample.mapInArrow(run, "toxic int, weight double, units array<int>, times array<int>").toArrow()
    if not rows.num_rows:
        return Model(keys, gram_counts, {}, np.zeros(0), np.array([0.0, 0.0, 0.0, -3.0]))
    toxic, weight = rows["toxic"].to_numpy().astype(float), rows["weight"].to_numpy()
    x = np.array([evidence(dict(zip(u, n)), weights) for u, n in zip(rows["units"].to_pylist(), rows["times"].to_pylist())])
    return Model(keys, gram_counts, names, weights, regression(x, toxic, weight))


class Rater:
    """Scores texts; a text without telling words gets the base rate."""

    def __init__(self, model: Model):
        self.model = model
        self.read = Reader(CharacterModel(model.keys, model.counts), model.units)

    def __call__(self, text: str | None) -> float:
        a, b, c, bias = self.model.coefficients
        x, y, z = evidence(self.read(text), self.model.weights)
        margin = a * x + b * y + c * z + bias
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, margin))))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every row; a text without telling words gets the base rate."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        rate = Rater(shared.value)
        for batch in batches:
            out = [rate(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], names=["doc_id", "score"])
    return texts(docs).mapInArrow(run, "doc_id bigint, score double")


def classify(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, threshold: float = 0.5) -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per row of ``docs``, whatever its other columns are called.

    Null and empty texts get the base rate. Labels that are null or neither 0 nor 1 are ignored; a document
    labelled twice counts twice. Rows without an id are scored but never held out.
    """
    model = fit(docs, labels, sample_rows)
    return score(docs, model).select(
        "doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample_rows))
    at = docs.columns.index("text")

    def run(batches):
        rate = Rater(model.value)
        for batch in batches:
            clean = [rate(t) < threshold for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(clean, pa.bool_()))
            give_back()
    return docs.mapInArrow(run, docs.schema)
