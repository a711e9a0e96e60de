"""Registered queries of the text operators: thin projections of what the operators return."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlog.llm import decontaminate, embeddings, licenses, packing, quality, sharding, simhash, spellings, substring_trees, suffix_runs, topk, toxicity, whitening
from wardlog.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(spark, sf_dir.rstrip("/"))
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run
    return register


@query("op1_decontamination")
def leaked_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row")


@query("op2_license_scan", licenses.duckdb_sql())
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.catalogue(spark))


@query("op3_substring_dedup")
def repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_trees.remove_windows(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op4_quality")
def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_suffix_dedup")
def repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_runs.remove_substrings(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op6_packing")
def pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    ranks = public_tokenizers.path(f"{packing.VOCABULARY}.tiktoken")
    return packing.pack(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN,
                        tokenizer_path=public_tokenizers.path(f"{packing.VOCABULARY}.json"))


@query("op7_simhash_near_dedup")
def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


@query("op8_toxicity")
def toxic_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_embedding_near_dedup")
def near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op10_sharding")
def shard_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


@query("op11_spelling_variants")
def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spellings.variants(table(spark, sf_dir, "documents"))


@query("op12_embedding_whitening")
def whitened_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten_embeddings(table(spark, sf_dir, "embeddings")).drop("copies", "deviation_exact")


@query("op13_exact_topk", """
with usable as (
  select vec_id, [floor(256 * c::double) for c in embedding] as x from embeddings
  where embedding is not null and not list_bool_or([c is null or not isfinite(c) for c in embedding])),
scored as (
  select q.vec_id as query_id, c.vec_id, list_dot_product(q.x, c.x)::bigint as score
  from usable q join usable c on c.vec_id <> q.vec_id where q.vec_id % 50 = 0),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 5
""")
def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.search(vectors, vectors.where(F.col("vec_id") % 50 == 0))
