"""Substring deduplication of words and of bytes against brute force."""

import hashlib
import random

import duckdb
import numpy as np
import pytest

from tests.llm.helpers import awkward, empty
from wardlog.llm import queries, substring_trees, suffix_runs
from wardlog.llm.repeats import common_prefix

SF = "/root/testdata/sf0.001"


def covered_words(docs, length):
    """docs: (id, text); windows whose words start earlier, by a plain dictionary."""
    first, out = {}, {}
    order = sorted((d, i) for i, (d, _) in enumerate(docs))
    words = [t.encode().split() for _, t in docs]
    for d, i in order:
        for k in range(len(words[i]) - length + 1):
            first.setdefault(tuple(words[i][k:k + length]), (d, k))
    for i, (d, _) in enumerate(docs):
        mask = [False] * len(words[i])
        for k in range(len(words[i]) - length + 1):
            if first[tuple(words[i][k:k + length])] < (d, k):
                mask[k:k + length] = [True] * length
        out[i] = (len(words[i]), sum(mask), b" ".join(w for w, m in zip(words[i], mask) if not m))
    return out


def covered_bytes(docs, length):
    first, out = {}, {}
    for d, t in docs:
        data = t.encode()
        for k in range(len(data) - length + 1):
            key = data[k:k + length]
            first[key] = min(first.get(key, d), d)
    for i, (d, t) in enumerate(docs):
        data = t.encode()
        mask = np.zeros(len(data), bool)
        for k in range(len(data) - length + 1):
            if first[data[k:k + length]] < d:
                mask[k:k + length] = True
        spans = int(mask[:1].sum() + (mask[1:] & ~mask[:-1]).sum())
        out[i] = (len(data), int(mask.sum()), spans, bytes(np.frombuffer(data, np.uint8)[~mask]))
    return out


def sha(data):
    return hashlib.sha256(data).hexdigest()


def documents():
    return [(d, t or "") for d, t in duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet' order by 1").fetchall()]


def test_word_query_equals_brute_force(spark):
    docs = documents()
    want = {docs[i][0]: (n, r, sha(k)) for i, (n, r, k) in covered_words(docs, 20).items()}
    got = queries.QUERIES["op3_substring_dedup"](spark, SF).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == want and len(got) == len(docs)
    assert sum(v[1] for v in want.values()) > 0


def test_byte_query_equals_brute_force(spark):
    docs = documents()
    want = {docs[i][0]: (n, r, s, sha(k)) for i, (n, r, s, k) in covered_bytes(docs, 50).items()}
    got = queries.QUERIES["op5_suffix_dedup"](spark, SF).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want and len(got) == len(docs)
    assert sum(v[1] for v in want.values()) > 0


def mixed(seed, n=160):
    """Texts of few words with shared passages, edits, periods and short remains."""
    rng = random.Random(seed)
    stock = ["".join(rng.choice("abcdé\0") for _ in range(rng.randint(1, 5))) for _ in range(60)]
    passages = [[rng.choice(stock) for _ in range(rng.randint(8, 70))] for _ in range(12)]
    docs = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 4)):
            kind = rng.random()
            if kind < 0.5:
                passage = rng.choice(passages)
                a = rng.randint(0, len(passage) // 2)
                words += passage[a:a + rng.randint(5, 60)]
            elif kind < 0.6:
                words += [rng.choice(stock)] * rng.randint(1, 60)
            elif kind < 0.7:
                words += [stock[0], stock[1], stock[2]] * rng.randint(1, 15)
            else:
                words += [rng.choice(stock) for _ in range(rng.randint(1, 30))]
            if words and rng.random() < 0.5:
                words[rng.randrange(len(words))] = rng.choice(stock)
        docs.append((rng.randint(0, n), rng.choice([" ", "  ", "\n"]).join(words)))
    return list({d: t for d, t in docs}.items())


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("block_bytes", [300, 5000])
def test_random_texts_equal_brute_force(spark, seed, block_bytes):
    docs = mixed(seed)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    got = substring_trees.remove_windows(frame, block_bytes=block_bytes).collect()
    want = {docs[i][0]: v for i, v in covered_words(docs, 20).items()}
    assert {r.doc_id: (r.n_words, r.n_removed, bytes(r.kept)) for r in got} == want
    got = suffix_runs.remove_substrings(frame, block_bytes=block_bytes).collect()
    want = {docs[i][0]: v for i, v in covered_bytes(docs, 50).items()}
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got} == want


def test_runs_merge_like_a_sort():
    rng = random.Random(1)
    for k in (1, 2, 3, 7):
        runs = []
        for _ in range(k):
            rows = sorted({bytes(rng.choice(b"ab") for _ in range(9)) for _ in range(rng.randint(1, 40))})
            table = np.frombuffer(b"".join(rows), np.uint8).reshape(-1, 9)
            prefix, rest = suffix_runs.front_code(table)
            assert (suffix_runs.front_decode(prefix, rest, 9) == table).all()
            runs.append((rows, prefix.tolist()))
        merged = list(suffix_runs.merge_runs(runs))
        rows = [runs[r][0][i] for r, i, _ in merged]
        assert rows == sorted(s for r in runs for s in r[0])
        table = np.frombuffer(b"".join(rows), np.uint8).reshape(-1, 9)
        assert [p for _, _, p in merged] == common_prefix(table).tolist()


def test_deep_nodes_are_all_shared_prefixes():
    rng = random.Random(2)
    rows = sorted(bytes(rng.choice(b"ab") for _ in range(8)) for _ in range(50))
    prefix = common_prefix(np.frombuffer(b"".join(rows), np.uint8).reshape(-1, 8))
    want = set()
    for i in range(50):
        for j in range(i + 1, 50):
            d = min(prefix[i + 1:j + 1])
            if d >= 2:
                a, b = i, j
                while a and prefix[a] >= d:
                    a -= 1
                while b + 1 < 50 and prefix[b + 1] >= d:
                    b += 1
                want.add((a, b + 1, int(d)))
    assert set(substring_trees.deep_nodes(prefix, 2)) == want


@pytest.mark.parametrize("frame", [awkward, empty])
def test_awkward_input_has_one_result_per_row(spark, frame):
    docs = frame(spark)
    for op in (substring_trees.remove_windows, suffix_runs.remove_substrings):
        assert op(docs).count() == docs.count()


def test_words_that_agree_in_32_bits_are_told_apart(spark):
    rows = [(1, " ".join(["w58564", *[f"k{i}" for i in range(19)]])), (2, " ".join(["w384818", *[f"k{i}" for i in range(19)]])),
            (3, " ".join([*[f"k{i}" for i in range(10)], "w58564", *[f"m{i}" for i in range(19)]])),
            (4, " ".join([*[f"k{i}" for i in range(10)], "w384818", *[f"m{i}" for i in range(19)]]))]
    got = substring_trees.remove_windows(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.n_removed for r in got} == dict.fromkeys(range(1, 5), 0)


def test_wanted_anchors_in_slices(spark, monkeypatch):
    from wardlog.llm import repeats
    monkeypatch.setattr(repeats, "SLICE", 7)
    rng = np.random.default_rng(0)
    data = rng.integers(97, 100, 3000).astype(np.uint8)
    offsets = np.array([0, 900, 900, 1000, 3000])
    spec = repeats.Spec(50, 24, words=False, within=False)
    symbols = repeats.read_symbols(data, offsets, spec)
    anchors = repeats.find_anchors(symbols, spec)
    block = repeats.Block(np.array([4, 1, 3, 2]), data, offsets, symbols, anchors)
    wanted = repeats.gram_keys(block, spec, 5)
    found, at, member = repeats.collect_suffixes(block, spec, wanted, 5)
    bounds = [(0, 900), (900, 900), (900, 1000), (1000, 3000)]
    for k, m in zip(at, member):
        low, high = next((a, b) for a, b in bounds if a <= k < b)
        ahead = bytes(data[k:min(high, k + 50)]).ljust(50, b"\0")
        behind = bytes(data[max(low, k - 26):k][::-1]).ljust(26, b"\0")
        assert bytes(found.table[m]) == ahead + behind + bytes([max(0, k + 50 - high), min(26, k - low)])


def test_anchors_and_hashes_do_not_depend_on_slices(monkeypatch):
    from wardlog.llm import common, repeats
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 4000).astype(np.uint8)
    for offsets in ([0, 4000], [0, 0, 49, 99, 1000, 1063, 1064, 4000, 4000]):
        for spec in (repeats.Spec(50, 24, words=False, within=False), repeats.Spec(20, 10, words=False, within=True)):
            symbols = repeats.read_symbols(data, np.array(offsets), spec)
            whole, hashes = repeats.find_anchors(symbols, spec), common.gram_hashes(data, spec.gram)
            assert (common.grams_at(data, spec.gram, whole) == hashes[whole]).all()
            for size in (1, 64, 1000):
                with monkeypatch.context() as m:
                    m.setattr(repeats, "WINDOW_SLICE", size)
                    m.setattr(common, "GRAM_SLICE", size)
                    assert (repeats.find_anchors(symbols, spec) == whole).all()
                    assert (common.gram_hashes(data, spec.gram) == hashes).all()
                    assert (common.grams_at(data, spec.gram, whole) == hashes[whole]).all()


def test_mask_of_stretches():
    from wardlog.llm.repeats import mask_of
    rng = np.random.default_rng(2)
    for n, k in ((0, 0), (10, 0), (10, 1), (200, 3), (200, 30), (60, 60)):
        starts = rng.integers(0, max(1, n - 9), k)
        stops = starts + rng.integers(1, 10, k)
        expected = np.zeros(n, bool)
        for a, b in zip(starts, stops):
            expected[a:b] = True
        assert (mask_of(starts, stops, n) == expected).all()
