"""Corpus pipeline: toxic documents go, then near-copies, repeated substrings and leaks; the rest is packed.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept; ``run`` writes the result of
every stage to the shared folder and reads it again for the next. All stages but the last return the columns
of ``docs``, whatever they are besides ``doc_id`` and ``text``.

Rows without text are clean, have fingerprint zero (of which one document stays) and pack as one end id. Rows
without an id are treated like others: they stay unless they are toxic, a copy or a leak themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardlog.llm import decontaminate, packing, simhash, suffix_runs, toxicity
from wardlog.llm.common import prepare, table
from wardlog.session import materialize


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more are dropped."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints at most two bits apart stays."""
    prepare(spark)
    return simhash.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes covered by a 50-byte string of a document with a smaller id are cut out; the rows stay."""
    prepare(spark)
    return suffix_runs.cut_texts(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage are dropped."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of 1,024 tokens."""
    import public_tokenizers
    prepare(spark)
    return packing.pack(docs, public_tokenizers.path(f"{packing.VOCABULARY}.tiktoken"), public_tokenizers.PATTERN,
                        tokenizer_path=public_tokenizers.path(f"{packing.VOCABULARY}.json"))


STAGES = [("toxicity", reject_toxic), ("simhash_near_dedup", drop_near_copies), ("suffix_dedup", cut_repeats),
          ("decontamination", drop_leaks), ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
