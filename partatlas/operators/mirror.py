"""XML corpus to JSON records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partatlas.functions.pyudf import xml_to_json
from partatlas.functions.text import glob_match
from partatlas.operators.corpus import is_xml
from partatlas.sources.trees import TREE_KEY

KEY = list(TREE_KEY)


def glob_filter(
    files: DataFrame, include: Sequence[str] = (), exclude: Sequence[str] = ()
) -> DataFrame:
    """Keep files that match an include (if any is given) and no exclude."""
    if include:
        files = files.filter(glob_match("relpath", list(include)))
    if exclude:
        files = files.filter(~glob_match("relpath", list(exclude)))
    return files


def mirror_path() -> Column:
    """``<release>/<part>/json/<variant>/<relpath>`` with the suffix ``.json``."""
    return F.concat_ws(
        "/", "release", "part", F.lit("json"), "variant", F.regexp_replace("relpath", r"\.xml\z", ".json")
    )


def mirror(
    xml_files: DataFrame,
    xml: str = "xml",
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
) -> DataFrame:
    """(tree key, relpath, path, json, parse_ok) of the XML files that pass the globs.

    The filters run before Python sees a row, and only the XML text is sent to
    it. Files that do not parse stay as rows with ``parse_ok`` false.
    """
    chosen = glob_filter(xml_files.filter(is_xml()), include, exclude)
    return chosen.select(
        *KEY, "relpath", mirror_path().alias("path"), xml_to_json(xml).alias("json")
    ).withColumn("parse_ok", F.col("json").isNotNull())


def mirror_counts(mirrored: DataFrame) -> DataFrame:
    """JSON documents written per tree."""
    return mirrored.groupBy(*KEY).agg(
        F.count_if("parse_ok").alias("files_written")
    )


def part_layout(summary: DataFrame, counts: DataFrame) -> DataFrame:
    """Per release and part: its variants, whether anything was mirrored, and documents per variant."""
    trees = summary.select(*KEY).distinct()
    return (
        trees.join(counts, KEY, "left")
        .groupBy("release", "part")
        .agg(
            F.sort_array(F.collect_set("variant")).alias("xml_variants"),
            F.coalesce(F.bool_or(F.col("files_written") > 0), F.lit(False)).alias("mirrored"),
            F.map_from_entries(
                F.sort_array(F.collect_list(
                    F.when(F.col("files_written").isNotNull(),
                           F.struct("variant", "files_written"))
                ))
            ).alias("files_written"),
        )
    )
