"""Incremental forms: files are taken in once, the portfolio is kept up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partatlas.operators.releases import is_family_entry, portfolio_of_pairs
from partatlas.sources.trees import tree_columns

_BINARY_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def tree_stream(spark: SparkSession, root: str, max_files: int = 10_000) -> DataFrame:
    """Files below ``root`` as a stream of ``tree`` rows."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(_BINARY_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files)
        .load(root)
    )
    return tree_columns(files)


def incremental_ingest(stream: DataFrame, sink: str, checkpoint: str) -> None:
    """Append what is new to ``sink`` and stop.

    The checkpoint remembers which files have been taken; a stored release never
    changes, so there is nothing to update. The file sink commits each batch
    once, also when the job is restarted.
    """
    (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def streaming_portfolio(listing: DataFrame) -> DataFrame:
    """New (release, family) pairs of a stream of listing rows.

    State is one row per pair, whatever releases are published so far: which of a
    family's releases counts is decided on reading, so a listing may come before its
    release is published. No watermark is needed, a pair is never taken back.
    """
    return (
        listing.filter(is_family_entry())
        .select("release", F.col("name").alias("family"))
        .dropDuplicates(["release", "family"])
    )


def run_portfolio_stream(portfolio: DataFrame, log: str, checkpoint: str) -> None:
    """Append each batch's new pairs to a log table and stop.

    A pair is written once, so the log is no larger than the state. The file sink
    commits a batch once, also when it is repeated.
    """
    incremental_ingest(portfolio, log, checkpoint)


def read_portfolio_log(spark: SparkSession, log: str, releases: DataFrame,
                       include_unpublished: bool = False) -> DataFrame:
    """Portfolio of the pairs seen so far and of the releases as they are now."""
    pairs = spark.read.schema("release string, family string").parquet(log)
    return portfolio_of_pairs(releases, pairs, include_unpublished)
