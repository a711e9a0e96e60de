"""Licences, packing, SimHash and sharding against brute force and contracts."""

import collections
import hashlib
import itertools
import random
import textwrap
import zlib
from pathlib import Path

import duckdb
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from tests.llm.helpers import awkward, empty
from tools.check_queries import compare  # noqa: F401
from wardlog.llm import licenses, packing, queries, sharding, simhash

SF = "/root/testdata/sf0.001"


def documents():
    return dict(duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall())


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, radius=2):
    root = {k: k for k in values}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    keys = sorted(values)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (values[a] ^ values[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def test_simhash_query_equals_brute_force(spark):
    values = {k: brute_fingerprint(t) for k, t in documents().items()}
    want = brute_components(values)
    got = queries.QUERIES["op7_simhash_near_dedup"](spark, SF).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {
        k: (f"{v:016x}", want[k]) for k, v in values.items()}
    assert len(got) == len(values)


def test_covering_masks_catch_every_pair():
    masks = simhash.covering_masks()
    assert len(masks) == 7
    for i in range(64):
        for j in range(64):
            assert any(not m >> i & 1 and not m >> j & 1 for m in masks)


def test_near_links_connect_exactly_the_close_pairs(spark):
    rng = random.Random(3)
    values = []
    for _ in range(40):
        base = rng.getrandbits(64)
        values += [base] + [base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))) for _ in range(6)]
    frame = spark.createDataFrame([(simhash.signed(v),) for v in values], "fp bigint")
    links = {(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in simhash.near_links(frame).collect()}
    assert all((a ^ b).bit_count() <= 2 for a, b in links)
    ids = dict(enumerate(sorted(set(values))))
    want = brute_components(ids)
    place = {v: k for k, v in ids.items()}
    root = {k: k for k in ids}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    for a, b in links:
        x, y = find(place[a]), find(place[b])
        root[max(x, y)] = min(x, y)
    assert {k: find(k) for k in ids} == want


def test_packing_query_keeps_every_id_once(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = queries.QUERIES["op6_packing"](spark, SF).collect()
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc, text in documents().items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        at = 0
        for r in sorted(by_doc.pop(doc), key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            part = ids[at:at + r.length]
            assert r.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))
            at += r.length
        assert at == len(ids)
    assert not by_doc
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    used = sum(r.length for r in got)
    assert 1 - used / (1024 * len(by_sequence)) < 0.01


def test_best_fit_picks_the_tightest_window():
    rng = random.Random(5)
    lengths = sorted((rng.randint(1, 1023) for _ in range(700)), reverse=True)
    bins, offsets = packing.best_fit(lengths)
    room = {}
    for length, b, at in zip(lengths, bins, offsets):
        tightest = min((r for r in room.values() if r >= length), default=None)
        assert (room.get(b, 1024) == tightest) if tightest is not None else b not in room
        assert at == 1024 - room.get(b, 1024)
        room[b] = room.get(b, 1024) - length


def test_word_ids_equal_the_whole_encoding():
    encode = packing.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    ids_of = packing.WordIds(encode)
    for text in ["a b", " a  b\n\nc ", "x\n y", "don't stop", "a\tb c", "é ü  ß", "", " ", "\0 a", "1 22 %%% a's \n", "a \nb"]:
        assert ids_of(text) == b"".join(i.to_bytes(4, "little") for i in encode(text)), text


def test_added_tokens_in_running_text_keep_their_id(spark, tmp_path):
    import corpus_pipeline
    texts = ["foo <|endoftext|> bar", "<|endoftext|><|endoftext|>a", "a\n<|endoftext|>\n b", "  <|endoftext|>  ", "<|endoftext| >", "plain",
             "long words " * 900 + "<|endoftext|>" + " more words" * 900]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for packed in (queries.QUERIES["op6_packing"](spark, str(tmp_path)), dict(corpus_pipeline.STAGES)["packing"](spark, docs, str(tmp_path))):
        got = packed.collect()
        for doc, text in enumerate(texts):
            ids = tokenizer.encode(text, add_special_tokens=False).ids + [0]
            assert (50256 in ids) == ("<|endoftext|>" in text)
            want = {(at, zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[at:at + 1024])), len(ids)) for at in range(0, len(ids), 1024)}
            assert {(r.start, r.ids_crc32, r.doc_tokens) for r in got if r.doc_id == doc} == want, text


def test_shards_are_even_and_keep_groups(spark):
    got = queries.QUERIES["op10_sharding"](spark, SF).collect()
    text = documents()
    assert sorted(r.doc_id for r in got) == sorted(text)
    by_shard = collections.defaultdict(list)
    for r in got:
        data = (text[r.doc_id] or "").encode()
        assert r.size == len(data) + 1 and r.text_crc32 == zlib.crc32(data) and r.law == "rows"
        by_shard[r.shard].append(r.slot)
    counts = [len(by_shard[s]) for s in range(16)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())


def test_groups_move_together_and_a_large_one_is_spread(spark):
    texts = ["hot"] * 300 + [f"pair {i % 60}" for i in range(120)] + [f"single {i}" for i in range(580)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = sharding.shard_documents(docs, shards=8).collect()
    counts = collections.Counter(r.shard for r in got)
    assert set(counts.values()) == {125}
    where = collections.defaultdict(collections.Counter)
    for r in got:
        where[texts[r.doc_id]][r.shard] += 1
    cut = sum(len(w) > 1 for t, w in where.items() if t.startswith("pair"))
    assert cut <= 6
    assert sum(n * (n - 1) for n in where["hot"].values()) > 2 * 300 * 300 / 8


def test_license_forms_and_lines(spark):
    docs = spark.createDataFrame([
        (1, "Copyright 2020 Somebody\nreleased UNDER the “MIT” licence!"), (2, "Prose first\nLicensed under the Apache License, Version 2.0.\nmore"),
        (3, None), (4, "(c) me"), (2, "Prose first\nLicensed under the Apache License, Version 2.0.\nmore"), (None, "Licensed under CC BY-NC 4.0")],
        "doc_id bigint, text string")
    got = sorted((str(r.doc_id), r.license_id, r.notices, r.n_notice_lines) for r in licenses.scan(docs, licenses.catalogue(spark)).collect())
    assert got == [("1", "MIT", "MIT", 1), ("2", None, "Apache-2.0", 1), ("2", None, "Apache-2.0", 1), ("3", None, "", 0),
                   ("4", None, "", 0), ("None", "CC-BY-NC-4.0", "CC-BY-NC-4.0", 1)]


MIT_GRANT = licenses.KNOWN[5][1].replace("\n", " ")
PUBLISHED = {"Apache-2.0": "Apache-2.0", "BSD": "BSD-3-Clause", "CC0-1.0": "CC0-1.0", "GFDL-1.3": "GFDL-1.3", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0",
             "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0"}


def test_few_links_are_cut_against_the_best_of_all_splits(spark):
    """Paths and rings of linked nodes on two shards: the least cut of an even split is found by trying all."""
    rng = random.Random(8)
    edges = [(i, i + 1) for i in (0, 1, 2, 4, 5, 6)] + [(8, 9), (9, 10), (10, 8), (11, 12), (12, 13), (13, 11)]
    nodes = 14
    least = min(sum((a in side) != (b in side) for a, b in edges) for side in map(set, itertools.combinations(range(nodes), nodes // 2)))
    chance = sum(sum((a in side) != (b in side) for a, b in edges) for side in (set(rng.sample(range(nodes), nodes // 2)) for _ in range(500))) / 500
    # Many copies of the graph, so that quotas of a few nodes do not decide.
    copies = 50
    rows = spark.range(nodes * copies).withColumnRenamed("id", "node")
    members = spark.createDataFrame([(c * nodes + n, c * 1000 + h) for c in range(copies) for h, e in enumerate(edges) for n in e], "node bigint, hub bigint")
    got = {r.node: r.shard for r in sharding.balanced_shards(rows, members, 2).collect()}
    assert collections.Counter(got.values()) == {0: nodes * copies // 2, 1: nodes * copies // 2}
    cut = sum(got[c * nodes + a] != got[c * nodes + b] for c in range(copies) for a, b in edges)
    assert least * copies <= cut <= 0.5 * chance * copies


@pytest.mark.parametrize("room, wishes, want", [
    ([0, 0], {(0, 1): 10, (1, 0): 5}, [1.0, 0.5]), ([3, 0], {(1, 0): 6}, [0.5, 0.0]), ([-4, 0], {(1, 0): 6}, [0.0, 0.0]),
    ([0, 0, 0], {(0, 1): 4, (1, 2): 4, (2, 0): 4}, [1.0, 1.0, 1.0]), ([0, 2, 0], {(0, 1): 4, (2, 0): 9}, [2 / 9, 0.5, 0.0]),
])
def test_shards_accept_what_room_and_leavers_allow(room, wishes, want):
    assert sharding.acceptance(room, wishes) == pytest.approx(want, abs=1e-3)


def test_licence_files_as_published(spark):
    """With title and copyright lines, wrapped anywhere; where the system has whole licence files, those too."""
    want = {}
    for title in ("MIT License", "The MIT License (MIT)", "The MIT License", ""):
        for width in (50, 62, 78, 1000):
            for grant, licence in ((MIT_GRANT, "MIT"), (MIT_GRANT.replace("without restriction", "with restrictions"), None)):
                want[f"{title}\n\nCopyright (c) 2020 Some Body and others\nAll rights reserved.\n\n{textwrap.fill(grant, width)}\n"] = licence
    for name, licence in PUBLISHED.items():
        path = Path("/usr/share/common-licenses") / name
        if path.exists():
            want[path.read_text()] = licence
    listed = list(want)
    docs = spark.createDataFrame(list(enumerate(listed)), "doc_id bigint, text string")
    got = {listed[r.doc_id]: r.license_id for r in licenses.scan(docs, licenses.catalogue(spark)).collect()}
    assert {t[:80]: v for t, v in got.items() if v != want[t]} == {} and len(got) == len(want)


def test_known_digests_stand_for_texts(spark):
    known = spark.createDataFrame([("own", None, hashlib.sha256(b"my terms").hexdigest()), ("other", "Those terms.", None)], licenses.CATALOGUE)
    docs = spark.createDataFrame([(1, "MY TERMS"), (2, "those terms"), (3, "")], "doc_id bigint, text string")
    assert {r.doc_id: r.license_id for r in licenses.scan(docs, known).collect()} == {1: "own", 2: "other", 3: None}


@pytest.mark.parametrize("frame", [awkward, empty])
def test_awkward_input_has_one_result_per_row(spark, frame):
    docs = frame(spark)
    n = docs.count()
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    assert licenses.scan(docs, licenses.catalogue(spark)).count() == n
    assert simhash.near_duplicates(docs).count() == n
    assert sharding.shard_documents(docs).count() == n
    firsts = packing.pack(docs, ranks, public_tokenizers.PATTERN).where("start = 0").count()
    assert firsts == n
