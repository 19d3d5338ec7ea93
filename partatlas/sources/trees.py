"""File trees ``<release>/processors/<part>/<variant>/...`` as a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partatlas.constants import STORE_ROOT

TREE_KEY = ("release", "part", "variant")
_LAYOUT = rf"(?:^|/)([^/]+)/{STORE_ROOT}/([^/]+)/([^/]+)/(.+)\z"


def split_store_path(path: Column | str) -> list[Column]:
    """release, part, variant and relpath of a stored file, '' if not in a tree."""
    path = F.col(path) if isinstance(path, str) else path
    names = (*TREE_KEY, "relpath")
    return [F.regexp_extract(path, _LAYOUT, i).alias(n) for i, n in enumerate(names, 1)]


def tree_columns(files: DataFrame) -> DataFrame:
    """Rows of the binary file source to the ``tree`` schema."""
    return files.select(
        *split_store_path("path"),
        F.col("length"),
        F.col("modificationTime").alias("mtime"),
        F.col("content"),
    ).filter(F.col("relpath") != "")


def scan_tree(spark: SparkSession, root: str) -> DataFrame:
    """Every file of every tree below ``root``.

    ``content`` is read only if a later step uses it. For corpora of many small
    files, run this once and keep the table with ``write_tree``.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return tree_columns(reader.load(root))


def write_tree(tree: DataFrame, path: str) -> None:
    """Compact a scanned tree to Parquet, one folder per release.

    The rebalance hint lets Spark split a release that holds most of the data
    and put small ones together.
    """
    tree.hint("rebalance", "release").write.mode("overwrite").partitionBy("release").parquet(path)


def read_tree(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def tree_keys(tree: DataFrame) -> DataFrame:
    """The distinct (release, part, variant) directories."""
    return tree.select(*TREE_KEY).distinct()
