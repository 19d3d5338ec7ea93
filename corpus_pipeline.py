"""A corpus pipeline of five stages, each one operator over all that came before.

Rejected documents go, one document of each near-duplicate group stays, personal data
is replaced, sources are mixed to their target weights, and the mix is encoded. Every
stage is written as Parquet below the session's shared folder and read back, so a lost
executor costs the tasks it ran, not the stages before.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partatlas.llm.mixing import mix_rows
from partatlas.llm.nearcopies import near_copy_filter
from partatlas.llm.pieces import encode_decode
from partatlas.llm.quality import quality_filter
from partatlas.llm.surrogates import surrogate_rows
from partatlas.session import work_dir
from workload.registry import query

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_filter(docs.select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copy_filter(docs.select(*COLUMNS))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return surrogate_rows(docs.select(*COLUMNS))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_rows(docs.select(*COLUMNS))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", F.size("ids").alias("n_ids"), "ids")


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_duplicates", near_duplicates),
    ("pii_surrogates", personal_data),
    ("source_mix", source_mix),
    ("sentencepiece", encoding),
]

#: Bit sketches, surrogates, hashes of Spark and the segmentation are not SQL.
ORACLE_SQL = None


@query("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
