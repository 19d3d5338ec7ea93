"""ZIP corpora: one row per member, bad input in a separate table."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partatlas.functions.pyudf import ARCHIVE_SCHEMA, read_archives
from partatlas.functions.text import normalize_member


class ArchiveScan(NamedTuple):
    members: DataFrame  # archive, path, size, content
    quarantine: DataFrame  # archive, member, error


def archive_members(archives: DataFrame) -> DataFrame:
    """(archive, content) rows to all members with their normalised path.

    An unsafe member is an error row. Directories stay in, marked as such.
    """
    rows = archives.select("archive", "content").mapInArrow(read_archives, ARCHIVE_SCHEMA)
    return rows.withColumn("norm", normalize_member("member")).select(
        "archive",
        "member",
        "directory",
        F.col("norm.path").alias("path"),
        "size",
        "content",
        F.coalesce(
            "error", F.when(F.col("norm.unsafe"), F.lit("unsafe member path"))
        ).alias("error"),
    )


def scan_archive_rows(archives: DataFrame) -> ArchiveScan:
    rows = archive_members(archives)
    good = rows.filter(F.col("error").isNull() & ~F.col("directory") & F.col("path").isNotNull())
    bad = rows.filter(F.col("error").isNotNull())
    return ArchiveScan(
        good.select("archive", "path", "size", "content"),
        bad.select("archive", "member", "error"),
    )


def scan_archives(spark: SparkSession, path: str) -> ArchiveScan:
    """All ``*.zip`` files below ``path``."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.zip")
        .load(path)
    )
    return scan_archive_rows(files.select(F.col("path").alias("archive"), "content"))
