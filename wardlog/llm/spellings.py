"""Spelling variants by finite-state composition.

Words are counted over whole texts, and the frequent ones form a vocabulary. Two words are near if one edit (a
code point inserted, deleted or replaced) turns one into the other. Near words are the pairs accepted by the
composition of three machines: the minimised acceptor of the vocabulary, a transducer that makes one edit, and the
acceptor again. A state of the composition is a state of the left acceptor, a state of the right one, and
whether the edit was made.

The composition is enumerated apart for every initial state: a prefix that both sides have read without an edit. A
word takes part once by its prefix and once, reversed, by its suffix: with words of at least twice that length,
an edit within the prefix leaves the suffix alone. A pair whose prefixes are equal is taken from the first machine,
any other from the second, so each pair is met once. Where too many words share a prefix the composition takes a
further step in Spark: pairs whose edit is made at the next code point continue with equal rests, which is a join on the
rest; all others have a longer prefix in common, and are dealt out by that.

No pair is sent anywhere: a partition tells, for each of its words, the number of near words and the best of them.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlog.llm.common import texts
from wardlog.session import materialize

RUN = re.compile(rb"(?:[a-z]+|(?:\xc3[\x80-\xbf])+)+")  # a-z and U+00C0 to U+00FF, in UTF-8
HELD = 200_000  # distinct words a task holds before it hands over its counts
GROUP = 20_000  # words of one initial state
LENGTHS = (1 << 64) - 1


def shortened(word: bytes, drawn: int) -> bytes:
    """A word without the code point that ``drawn`` selects."""
    letters = word.decode()
    at = drawn % len(letters)
    return (letters[:at] + letters[at + 1:]).encode()


def word_counts(docs: DataFrame, divisor: int) -> DataFrame:
    """``word, n`` over all texts; a run of a document loses a letter where ``divisor`` divides its checksum."""
    def told(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()).cast(pa.string()),
                                           pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()).to_pylist()):
                if not text:
                    continue
                found = RUN.findall(text.lower())  # bytes: only A to Z change
                counts.update(found)
                start = zlib.crc32(b"" if doc_id is None else b"%d" % doc_id)
                start = zlib.crc32(b":", start)
                for word in set(found):
                    drawn = zlib.crc32(word, start)
                    if drawn % divisor == 0:
                        times = found.count(word)
                        counts[word] -= times
                        counts[shortened(word, drawn)] += times
            if len(counts) > HELD:
                yield told(counts)
                counts = Counter()
        if counts:
            yield told(counts)

    counted = texts(docs).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where("n > 0")


class Acceptor:
    """Minimal acceptor of words given in ascending order; every word has a number, its place in that order.

    States are numbered children first. ``words_of[s]`` is how many words lead on from ``s``; a word's number is the sum of the
    words passed by on its way.
    """

    def __init__(self, words: list[str]):
        self.final: list[bool] = []
        self.arcs: list[tuple] = []  # (letter, state, words passed by)
        self.words_of: list[int] = []
        self.lengths: list[int] = []  # lengths of the words that lead on, modulo 64, as a bit set
        known: dict[tuple, int] = {}

        def settle(node: list) -> int:
            final, arcs = node
            key = (final, tuple(arcs))
            state = known.get(key)
            if state is None:
                known[key] = state = len(self.final)
                passed, lengths, out = int(final), int(final), []
                for letter, child in arcs:
                    out.append((letter, child, passed))
                    passed += self.words_of[child]
                    bits = self.lengths[child]
                    lengths |= (bits << 1 | bits >> 63) & LENGTHS
                self.final.append(final)
                self.arcs.append(tuple(out))
                self.words_of.append(passed)
                self.lengths.append(lengths)
            return state

        path: list[list] = [[False, []]]  # nodes of the latest word, not settled yet
        before = ""
        for word in words:
            same = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                same += 1
            for at in range(len(before), same, -1):
                node = path.pop()
                path[-1][1].append((before[at - 1], settle(node)))
            for _ in range(same, len(word)):
                path.append([False, []])
            path[-1][0] = True
            before = word
        for at in range(len(before), 0, -1):
            node = path.pop()
            path[-1][1].append((before[at - 1], settle(node)))
        self.start = settle(path.pop())


def compose(machine: Acceptor, depth: int) -> list[tuple[int, int]]:
    """Numbers of all pairs of words that one edit at ``depth`` or later parts, each pair once.

    A pair is found at its first difference: there either both letters are replaced by each other, or the letter of the longer
    word is deleted and the shorter word goes on differently.
    """
    arcs, lengths, final = machine.arcs, machine.lengths, machine.final
    after: dict[tuple[int, int], list] = {}  # common words of two states, by their numbers

    def common(left: int, right: int) -> list:
        """Words both states accept: the composition once the edit is made."""
        stack = [(left, right)]
        while stack:
            pair = stack[-1]
            if pair in after:
                stack.pop()
                continue
            p, q = pair
            if p == q:
                after[pair] = [(k, k) for k in range(machine.words_of[p])]
                continue
            if not lengths[p] & lengths[q]:
                after[pair] = []
                continue
            other = {letter: (state, passed) for letter, state, passed in arcs[q]}
            steps = [(child, passed, *other[letter]) for letter, child, passed in arcs[p] if letter in other]
            missing = [(a, b) for a, _, b, _ in steps if (a, b) not in after]
            if missing:
                stack += missing
                continue
            found = [(0, 0)] if final[p] and final[q] else []
            for a, passed, b, by in steps:
                found += [(x + passed, y + by) for x, y in after[a, b]]
            after[pair] = found
        return after[left, right]

    def parted(state: int) -> list[tuple[int, int]]:
        """Pairs from one state whose first difference is there."""
        found = []
        for k, (letter, child, passed) in enumerate(arcs[state]):
            for _, sibling, by in arcs[state][k + 1:]:
                if lengths[child] & lengths[sibling]:
                    found += [(x + passed, y + by) for x, y in common(child, sibling)]
            if lengths[child] & lengths[state]:
                # The shorter word goes on with another letter than the deleted one, or ends.
                again = (passed, passed + machine.words_of[child])
                found += [(x + passed, y) for x, y in common(child, state) if not again[0] <= y < again[1]]
        return found

    local: dict[int, list[tuple[int, int]]] = {}
    pairs = []
    stack = [(machine.start, 0, 0)]
    while stack:
        state, passed, read = stack.pop()
        if read >= depth:
            if state not in local:
                local[state] = parted(state)
            pairs += [(x + passed, y + passed) for x, y in local[state]]
        stack += [(child, passed + by, read + 1) for _, child, by in arcs[state]]
    return pairs


BEST = "text string, n_near bigint, best_n bigint, best string"


def links_of(words: list[str], counts: list[int], depth: int, backward: bool) -> pa.Table:
    """Number of near words, and the best of them, of all words of one initial state that have any."""
    order = sorted(range(len(words)), key=words.__getitem__)
    words, counts = [words[k] for k in order], [counts[k] for k in order]
    n_near = [0] * len(words)
    best: list[tuple | None] = [None] * len(words)
    whole = [w[::-1] for w in words] if backward else words
    for a, b in compose(Acceptor(words), depth):
        if backward and whole[a][:depth] == whole[b][:depth]:
            continue  # the machine of prefixes has it
        for x, y in ((a, b), (b, a)):
            n_near[x] += 1
            key = (-counts[y], whole[y])
            if best[x] is None or key < best[x]:
                best[x] = key
    some = [k for k in range(len(words)) if n_near[k]]
    return pa.table({"text": pa.array([whole[k] for k in some], pa.string()), "n_near": pa.array([n_near[k] for k in some], pa.int64()),
                     "best_n": pa.array([-best[k][0] for k in some], pa.int64()),
                     "best": pa.array([best[k][1] for k in some], pa.string())})


def best_of(rows: DataFrame, key: str) -> DataFrame:
    """Partial findings of each word put together."""
    merged = rows.groupBy(key).agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("top"))
    return merged.select(key, "n_near", (-F.col("top.less")).alias("best_n"), F.col("top.best").alias("best"))


def parted_at(words: DataFrame, at: int, depth: int) -> DataFrame:
    """Near words whose first difference is at code point ``at`` of texts that agree before it, as a join on what is left.

    Each text is met with that code point deleted, and each as it is; texts of equal key differ by one edit, and at most one
    text for each letter has a key.
    """
    cut = F.concat(F.substring("text", 1, at), F.expr(f"substring(text, {at + 2})"))
    letter = F.substring("text", at + 1, 1)
    cuts = words.where(F.length("text") > at).select("backward", "text", "n", cut.alias("rest"), letter.alias("letter"))
    whole = words.select("backward", "text", "n", F.col("text").alias("rest"), letter.alias("letter"))

    def whole_word(backward: Column, text: Column) -> Column:
        return F.when(backward, F.reverse(text)).otherwise(text)

    def met(a: DataFrame, b: DataFrame) -> DataFrame:
        joined = a.alias("a").join(b.alias("b"), ["backward", "rest"]).where(F.col("a.letter") != F.col("b.letter"))
        heads = (F.substring(whole_word(F.col("backward"), F.col(f"{s}.text")), 1, depth) for s in "ab")
        first, second = heads
        joined = joined.where(~F.col("backward") | (first != second))
        return joined.select(whole_word(F.col("backward"), F.col("a.text")).alias("text"), F.lit(1).cast("bigint").alias("n_near"),
                             F.col("b.n").alias("best_n"), whole_word(F.col("backward"), F.col("b.text")).alias("best"))
    return met(cuts, cuts).union(met(cuts, whole)).union(met(whole, cuts))


def near_words(vocabulary: DataFrame, depth: int, group: int = GROUP) -> DataFrame:
    """``text, n_near, best_n, best``: words that have near words, the number of these and the most frequent one.

    ``vocabulary`` has ``word, n``, every word once and at least ``2 * depth`` code points long.
    """
    both = vocabulary.select(F.lit(False).alias("backward"), F.col("word").alias("text"), "n").union(
        vocabulary.select(F.lit(True), F.reverse("word"), "n"))
    read, left, found = depth, both, []
    while True:
        keyed = left.withColumn("state", F.substring("text", 1, read))
        sizes = keyed.groupBy("backward", "state").agg(F.count(F.lit(1)).alias("words"))
        crowded = materialize(sizes.where(F.col("words") > group), "crowded-states")
        small = keyed.join(crowded, ["backward", "state"], "left_anti")

        def run(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
            return links_of(part.column("text").to_pylist(), part.column("n").to_pylist(), depth, key[0].as_py())
        # All words of a state agree on what was read; an edit can only follow.
        found.append(small.groupBy("backward", "state").applyInArrow(run, BEST))
        if crowded.isEmpty():
            break
        left = materialize(keyed.join(crowded, ["backward", "state"], "left_semi").drop("state"), "crowded-words")
        found.append(parted_at(left, read, depth))
        read += 1
    rows = found[0]
    for more in found[1:]:
        rows = rows.union(more)
    return best_of(rows, "text")


def last_forms(forms: DataFrame) -> DataFrame:
    """``word, root``: the end of the chain of forms from each word of ``word, form``; counts rise along it, so it ends."""
    roots = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = materialize(roots.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                       F.col("next").isNotNull().alias("moved")), "roots")
        roots = stepped.select("word", "root")
        if stepped.where("moved").isEmpty():
            return roots


def variants(docs: DataFrame, min_length: int = 6, min_count: int = 5, factor: int = 5, divisor: int = 199,
             group: int = GROUP) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for all words of ``docs`` (``doc_id, text``) that are long and frequent enough.

    Null and empty texts have no words; a row without an id counts as one with an empty id in the checksum, and repeated
    rows count each time. Words of any length take part. Of near words with equal counts the form is the smallest
    in code-point order; no documents give no rows. Other columns of ``docs`` play no part.
    """
    if min_length < 2:
        raise ValueError("words of a single letter have no prefix beside their suffix")
    long = word_counts(docs, divisor).where((F.length("word") >= min_length) & (F.col("n") >= min_count))
    words = materialize(long, "vocabulary")
    near = materialize(near_words(words, min_length // 2, group), "near-words")
    told = words.join(near.withColumnRenamed("text", "word"), "word", "left")
    frequent = F.col("best_n") >= factor * F.col("n")
    told = materialize(told.select("word", F.when(frequent, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
                                   F.when(frequent, F.col("best_n")).alias("form_n")), "word-forms")
    roots = last_forms(told.where("form is not null").select("word", "form"))
    return told.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
