"""Stored tables: catalogue with its meta row, snapshots, mirror, records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from partatlas.constants import SOURCE_VERSION


def catalog_meta(catalog: DataFrame, built_at: Column | None = None,
                 source_version: str = SOURCE_VERSION) -> DataFrame:
    """One row: build time, source label, number of parts and of families."""
    return catalog.agg(
        F.count("*").alias("part_count"), F.countDistinct("family").alias("family_count")
    ).select(
        (F.current_timestamp() if built_at is None else built_at).alias("built_at"),
        F.lit(source_version).alias("source_version"),
        "part_count",
        "family_count",
    )


def write_catalog(catalog: DataFrame, path: str) -> None:
    """Replace the stored catalogue and its meta row.

    Rows are range-partitioned by ``part_lower`` so that case-insensitive
    lookups skip row groups by their minimum and maximum.
    """
    (
        catalog.withColumn("part_lower", F.lower("part"))
        .repartitionByRange("part_lower", "part")
        .sortWithinPartitions("part_lower", "part")
        .write.mode("overwrite")
        .parquet(f"{path}/parts")
    )
    stored = catalog.sparkSession.read.parquet(f"{path}/parts")
    catalog_meta(stored).write.mode("overwrite").parquet(f"{path}/meta")


def _read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" in str(missing):
            return None
        raise


def read_catalog(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored catalogue, or None if none has been built."""
    return _read_or_none(spark, f"{path}/parts")


def read_catalog_meta(spark: SparkSession, path: str) -> DataFrame | None:
    return _read_or_none(spark, f"{path}/meta")


def read_release_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """JSON snapshots of release lists: one file holds ``fetched_at`` and ``versions``."""
    schema = (
        "fetched_at string, versions array<struct<api_id:bigint,name:string,version:string>>"
    )
    rows = spark.read.option("multiLine", "true").schema(schema).json(path)
    return rows.select(F.explode("versions").alias("v")).select("v.*")


def read_portfolio_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """JSON snapshots of the portfolio: one object of family to release name."""
    rows = spark.read.text(path, wholetext=True)
    return rows.select(
        F.explode(F.from_json("value", "map<string,string>")).alias("family", "version")
    )


def record_json(df: DataFrame) -> DataFrame:
    """Each row as one JSON text with its nulls kept."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def write_records(df: DataFrame, path: str) -> None:
    record_json(df).write.mode("overwrite").text(path)


def write_mirror(mirror: DataFrame, path: str) -> None:
    """One JSON record per converted file, in one folder per release.

    A record names its part and variant, and ``path`` is its place in a tree of files. A
    folder per part and variant would be a file for every few records, made, moved and
    listed one by one. The rebalance hint spreads a part that holds most files over many
    tasks and keeps small parts together, so the number of files written stays low; inside
    a file the records of a part and variant lie together.
    """
    key = ("release", "part", "variant")
    (
        mirror.hint("rebalance", *key)
        .sortWithinPartitions(*key, "relpath")
        .write.mode("overwrite")
        .partitionBy("release")
        .json(path)
    )
