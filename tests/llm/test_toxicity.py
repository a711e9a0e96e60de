"""Deobfuscation on known disguises and accuracy on held-out labels."""

import itertools
import math

import duckdb
import numpy as np
import pytest

from tests.llm.helpers import awkward, empty
from wardlog.llm import queries, toxicity

SF = "/root/testdata/sf0.1"  # about a hundred toxic documents are held out; smaller tables have a handful


def area(scores, labels):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(1, len(scores) + 1)
    for v in np.unique(scores):
        ranks[scores == v] = ranks[scores == v].mean()
    pos = labels == 1
    return (ranks[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op8_toxicity"](spark, SF).collect()}
    labels = duckdb.sql(f"select doc_id, toxic from '{SF}/labels.parquet'").fetchall()
    held = [(got[d].score, t, got[d].predicted) for d, t in labels if got[d].held_out]
    scores, truth, predicted = (np.array(x) for x in zip(*held))
    assert area(scores, truth) > 0.9
    assert (predicted == truth).mean() > 0.9
    assert all(0 <= r.score <= 1 for r in got.values())


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.createDataFrame([(i, "the idiot said stupid words while the loser was a pathetic fool in the house " * 3) for i in range(50)],
                                 "doc_id bigint, text string")
    return toxicity.CharacterModel(*toxicity.character_counts(docs))


@pytest.mark.parametrize("disguised, plain", [
    ("1d10t", "idiot"), ("id!ot", "idiot"), ("l0$er", "loser"), ("i.d.i.o.t", "idiot"), ("stuuuupid", "stupid"), ("p4th3tic!!!", "pathetic"),
    ("house,", "house"), ("word%%%", "word"), ("st*pid", "stupid"), ("“words”", "words"),
])
def test_disguises_are_restored(model, disguised, plain):
    assert toxicity.restore(disguised, model) == plain


def path_value(model, pieces):
    """Log probability and channel cost of one path through a lattice, letter by letter."""
    a = b = 0
    total = 0.0
    for piece, cost in pieces:
        total -= cost
        for ch in piece:
            code = ord(ch) if ch != " " else 0
            total += model.log_probability(a, b, code)
            a, b = b, code
    return total + model.log_probability(a, b, 0)


@pytest.mark.parametrize("word", ["1d10t", "st*pid", "l0$er", "i.d.i.o.t", "stuuupid", "m 0 r 0 n", "iiddiioott", "!|+€$", "6r41n", "1*1*1", "f00l!sh", "a", "日1本"])
def test_decoding_finds_the_best_of_all_paths(model, word):
    values = {}
    for pieces in itertools.product(*toxicity.lattice(word)):
        text = "".join(p for p, _ in pieces)
        values[text] = max(values.get(text, -math.inf), path_value(model, pieces))
    found = toxicity.viterbi(word, model)
    assert values[found] == pytest.approx(max(values.values()), abs=1e-9)


def test_spaced_letters_are_joined(model):
    assert toxicity.Reader(model)("you i d i o t now")["idiot"] == 1


@pytest.fixture(scope="module")
def prose(spark):
    text = "you are such a moron and the idiot i am said that a moron is not an idiot so you said stupid words to the committee at this address "
    docs = spark.createDataFrame([(i, text * 3) for i in range(50)], "doc_id bigint, text string")
    return toxicity.CharacterModel(*toxicity.character_counts(docs))


@pytest.mark.parametrize("text, words", [
    ("such a m o r o n", {"such", "moron"}), ("y o u i d i o t", {"you", "idiot"}), ("i d i o t i am", {"idiot"}), ("m\no\nr\no\nn", {"moron"}),
    ("a\u2003m  o\r\nr\to n", {"moron"}), ("y o u a r e s u c h a m 0 r 0 n", {"you", "are", "such", "moron"}), ("i . d . i . o . t", {"idiot"}),
    ("iiddiioott", {"idiot"}), ("the committee address", {"the", "committee", "address"}), ("1 2 3 4", set()),
])
def test_word_borders_in_spaced_and_doubled_letters(prose, text, words):
    assert {u for u in toxicity.Reader(prose)(text) if ":" not in u} == words


def test_long_spaced_run_is_decoded_in_linear_time(prose):
    assert toxicity.Reader(prose)("y o u i d i o t " * 20_000)["idiot"] == 1


def test_counts_are_exact_whatever_the_alphabet(spark):
    # More distinct trigrams of another script than a table of 2 ** 18 slots has.
    other = [(i, " ".join(chr(0x4E00 + (i * 131 + k) % 20_000) + chr(0x4E00 + (i * 7 + k * k) % 20_000) * (k % 2) + chr(0x4E00 + (k * 17 + i) % 20_000)
                          for k in range(400))) for i in range(500)]
    docs = spark.createDataFrame([*other, *[(-i, "the idiot said 1d10t i d i o t stuuupid words") for i in range(1, 51)]], "doc_id bigint, text string")
    whole = toxicity.CharacterModel(*toxicity.character_counts(docs))
    asked = toxicity.CharacterModel(*toxicity.character_counts(docs, of_lattices=True))
    assert len(whole.keys) > 2 ** 18 and len(asked.keys) < 200
    for gram, n in (("idi", 50), ("iot", 50), ("dio", 50), ("qzx", 0), ("zqj", 0), ("iod", 0), ("ido", 0)):
        key = toxicity.gram_keys(*map(ord, gram))
        assert whole.count(key) == n and asked.count(key) in (0, n)
    for token in ("1d10t", "i d i o t", "stuuupid"):
        assert toxicity.restore(token, whole) == toxicity.restore(token, asked)
        keys = set()
        toxicity.lattice_keys(toxicity.hidden(token), keys)
        assert all(whole.count(k) == asked.count(k) for k in keys)
    assert toxicity.restore("1d10t", asked) == toxicity.restore("i d i o t", asked) == "idiot"


@pytest.mark.parametrize("frame", [awkward, empty])
def test_awkward_input(spark, frame):
    docs = frame(spark)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (4, 7), (99, 1)], "doc_id bigint, toxic int")
    assert toxicity.classify(docs, labels).count() == docs.count()
    assert toxicity.classify(docs, labels.where("false")).count() == docs.count()
