"""The pipeline, stage by stage, against brute force on small tables."""

import pytest

import corpus_pipeline
from tests.llm.helpers import awkward, empty
from tests.llm.test_repeats import covered_bytes
from tests.llm.test_simple_operators import brute_components, brute_fingerprint
from wardlog.llm import decontaminate, toxicity
from wardlog.session import materialize

SF = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}

    out = materialize(stages["toxicity"](spark, docs, SF), "t")
    toxic = {r.doc_id for r in toxicity.classify(docs, spark.read.parquet(f"{SF}/labels.parquet")).where("predicted = 1").collect()}
    assert {r.doc_id: r for r in out.collect()} == {d: r for d, r in rows.items() if d not in toxic} and toxic
    rows = {r.doc_id: r for r in out.collect()}

    out = materialize(stages["simhash_near_dedup"](spark, out, SF), "t")
    root = brute_components({d: brute_fingerprint(r.text) for d, r in rows.items()})
    assert {r.doc_id: r for r in out.collect()} == {d: r for d, r in rows.items() if root[d] == d}
    assert out.count() < len(rows)
    rows = {r.doc_id: r for r in out.collect()}

    out = materialize(stages["suffix_dedup"](spark, out, SF), "t")
    pairs = [(d, r.text or "") for d, r in rows.items()]
    kept = {pairs[i][0]: v[3].decode("utf-8", "ignore") for i, v in covered_bytes(pairs, 50).items()}
    got = {r.doc_id: r for r in out.collect()}
    assert {d: r.text for d, r in got.items()} == kept
    assert all((r.lang, r.source, r.n_chars) == (rows[d].lang, rows[d].source, len(r.text)) for d, r in got.items())
    rows = got

    out = materialize(stages["decontamination"](spark, out, SF), "t")
    items = [decontaminate.normal(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    whole = {d for d, r in rows.items() if any(i in decontaminate.normal(r.text) for i in items)}
    left = {r.doc_id for r in out.collect()}
    assert whole and not whole & left
    assert len(rows) - len(left) <= len(whole) + 3

    packed = stages["packing"](spark, out, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == left
    assert corpus_pipeline.run(spark, SF).count() == packed.count()


@pytest.mark.parametrize("frame", [awkward, empty])
def test_stages_keep_rows_and_columns(spark, frame):
    docs = materialize(frame(spark), "t")
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, docs, SF), "t")
        if name == "packing":
            break
        assert out.columns == docs.columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]
        want = {"simhash_near_dedup": 6}.get(name, docs.count()) if docs.count() else 0
        assert out.count() == want, name
        docs = out
