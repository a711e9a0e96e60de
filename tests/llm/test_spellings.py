"""Spelling variants against a plain search over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from tests.llm.helpers import awkward, empty
from wardlog.llm import queries, spellings

SF = "/root/testdata/sf0.001"


def vocabulary(rows, min_length=6, min_count=5):
    counts = Counter()
    for doc_id, text in rows:
        for found in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in found)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 199 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}


def brute(words, factor=5):
    near = {w: set() for w in words}
    cuts = {}
    for w in words:
        for k in range(len(w)):
            cuts.setdefault((k, w[:k] + w[k + 1:]), set()).add(w)
            if (cut := w[:k] + w[k + 1:]) in near:
                near[w].add(cut)
                near[cut].add(w)
    for group in cuts.values():
        for a in group:
            near[a] |= group - {a}
    best = {w: min(near[w], key=lambda v: (-words[v], v)) for w in words if near[w]}
    form = {w: v if (v := best.get(w)) and words[v] >= factor * words[w] else None for w in words}
    out = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None)
    return out


def told(frame):
    rows = frame.collect()
    assert len(rows) == len({r.word for r in rows})
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = brute(vocabulary(docs))
    got = told(queries.QUERIES["op11_spelling_variants"](spark, SF))
    assert got == want and len(want) > 100 and any(w[0] for w in want.values())


def random_words(rng, n, letters="abc", low=6, high=12):
    return {"".join(rng.choice(letters) for _ in range(rng.randint(low, high))) for _ in range(n)}


@pytest.mark.parametrize("depth", [0, 1, 3])
def test_composition_equals_all_pairs(depth):
    rng = random.Random(depth)
    words = sorted({"aaab" [:depth] + w for w in random_words(rng, 400, low=1, high=6)})
    machine = spellings.Acceptor(words)
    assert machine.words_of[machine.start] == len(words)
    got = spellings.compose(machine, depth)
    near = brute(dict.fromkeys(words, 1))
    found = Counter()
    for a, b in got:
        found[words[a]] += 1
        found[words[b]] += 1
    assert len({frozenset(p) for p in got}) == len(got)
    assert {w: near[w][3] for w in words} == {w: found[w] for w in words}


def test_acceptor_is_minimal():
    machine = spellings.Acceptor(sorted(["tap", "taps", "top", "tops"]))
    assert len(machine.final) == 5


@pytest.mark.parametrize("group", [5, 40, 100_000])
def test_crowded_states_are_split(spark, group):
    rng = random.Random(9)
    words = {w: rng.choice([5, 6, 30, 30, 200]) for w in random_words(rng, 500, "ab") | {"prefix" + w for w in random_words(rng, 200, "aé", 0, 5)}}
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint").repartition(5)
    got = {r.text: (r.n_near, r.best if r.best_n >= 5 * words[r.text] else None) for r in spellings.near_words(frame, 3, group).collect()}
    want = brute(words)
    assert got == {w: (v[3], v[0]) for w, v in want.items() if v[3]}


def test_long_chains_and_ties(spark):
    text = " ".join(["aaaaaa"] * 5 + ["aaaaaaa"] * 25 + ["aaaaaaaa"] * 125 + ["baaaaa"] * 25 + ["z" * 3000] * 5 + ["z" * 3001] * 25)
    rows = [(10, text, 1)]
    want = brute(vocabulary([r[:2] for r in rows]))
    got = told(spellings.variants(spark.createDataFrame(rows, "doc_id bigint, text string, word int")))
    assert got == want and got["aaaaaa"][:2] == ("aaaaaaa", "aaaaaaaa")


def test_letters_and_lower_case(spark):
    rows = [(k, "Étoile étoile ETOILE etoile cafœ ×÷Àÿéè абвгде don't") for k in range(40)]
    want = brute(vocabulary(rows))
    assert told(spellings.variants(spark.createDataFrame(rows, "doc_id bigint, text string"))) == want
    assert "Étoile" in want and "×÷Àÿéè" in want


def test_awkward_documents(spark):
    frame = awkward(spark).withColumnRenamed("fp", "word").withColumnRenamed("shard", "n_near").withColumnRenamed("score", "root")
    want = brute(vocabulary([(r.doc_id, r.text) for r in frame.collect()], 4, 2))
    assert told(spellings.variants(frame, min_length=4, min_count=2)) == want and want
    assert spellings.variants(empty(spark)).count() == 0
