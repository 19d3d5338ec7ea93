"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partatlas.llm.align import align
from partatlas.llm.chunks import repeated_spans
from partatlas.llm.exact import EXACT_SQL, exact_groups
from partatlas.llm.hnsw import nearest
from partatlas.llm.licenses import license_scan
from partatlas.llm.mixing import mix_table
from partatlas.llm.periodic import periodic_runs, run_lines, strongest, with_planted_runs
from partatlas.llm.pieces import encode_decode
from partatlas.llm.quality import quality_table
from partatlas.llm.simhash import simhash_groups
from partatlas.llm.sql import QUALITY_SQL
from partatlas.llm.surrogates import with_surrogates
from partatlas.llm.tokenfile import token_documents, with_start, write_token_file
from partatlas.llm.toxicity import toxicity
from partatlas.session import work_dir
from workload.registry import query


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_license_scan")
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_table(spark, sf_dir, "documents"))


@query("op2_chunk_dedup")
def op2_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(_table(spark, sf_dir, "documents"))


@query("op3_quality_rules", QUALITY_SQL)
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return quality_table(_table(spark, sf_dir, "documents")).select(
        "doc_id", *measures, "base_failed", "kept")


@query("op4_pii_surrogates")
def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_surrogates(docs).select(
        "row.doc_id", F.coalesce(F.size("spans"), F.lit(0)).alias("n_replaced"),
        F.transform("spans", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind")))
        .alias("spans"), "row.text")


@query("op5_hnsw_search")
def op5_hnsw_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"))


@query("op6_sentencepiece")
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_decode(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", F.size("ids").alias("n_ids"), "ids", "decoded")


@query("op7_pfor_tokens")
def op7_pfor_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "tokens")
    write_token_file(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    # Digests are taken before documents meet the sums of the segments before them.
    docs = token_documents(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return with_start(docs, path).select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op8_simhash_groups")
def op8_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op9_source_mix")
def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_table(_table(spark, sf_dir, "documents"))


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    digest = lambda groups: F.when(groups == "", "").otherwise(F.sha2(groups, 256))
    return align(_table(spark, sf_dir, "documents"), *files, keep=digest).withColumnRenamed("groups", "groups_sha256")


@query("op12_exact_dedup", EXACT_SQL)
def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_runs(_table(spark, sf_dir, "documents").select("doc_id", "text")))
    best = found.withColumn("best", strongest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(run_lines(F.col("runs")), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
