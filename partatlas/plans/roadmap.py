"""Roadmap: what lies where in a tree, as one nested record per tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partatlas.constants import (
    CANONICAL_VARIANT,
    DEVICETREE_SCRIPTS,
    KEY_FILES,
    OPTIONAL_SECTIONS,
)
from partatlas.operators.corpus import (
    KEY,
    key_file_name,
    manifest_stem,
    namespace_inventory,
    top_directory,
)

def _step(code: str, *args: Column) -> Column:
    """A step of the guide: a code and what it is about, for a caller to word."""
    values = F.array(*[F.coalesce(a, F.lit("")) for a in args]) if args else F.array().cast("array<string>")
    return F.struct(F.lit(code).alias("code"), values.alias("args"))


def _layout(tree: DataFrame) -> DataFrame:
    """All layout facts of a tree in one aggregation over its paths."""
    sub = F.nullif(F.regexp_extract("relpath", r"^scripts/([^/]+)/", 1), F.lit(""))
    key_file = F.when(
        key_file_name().isNotNull(), F.struct(key_file_name().alias("name"), "relpath")
    )
    scripts = [
        F.when(F.bool_or(F.col("relpath") == rel), F.struct(F.lit(label), F.lit(rel)))
        for label, rel in DEVICETREE_SCRIPTS.items()
    ]
    sections = [
        F.bool_or(F.startswith("relpath", F.lit(f"{s}/"))).alias(s) for s in OPTIONAL_SECTIONS
    ]
    return tree.groupBy(*KEY).agg(
        F.map_from_entries(F.sort_array(F.collect_set(key_file))).alias("key_files"),
        F.struct(*sections).alias("optional_sections"),
        F.sort_array(
            F.array_intersect(F.collect_set(manifest_stem()), F.collect_set(top_directory()))
        ).alias("packages"),
        F.struct(
            F.when(F.bool_or(F.startswith("relpath", F.lit("scripts/"))), "scripts/")
            .alias("scripts_root"),
            F.sort_array(F.collect_set(sub)).alias("categories"),
            F.map_from_entries(F.array_compact(F.array(*scripts))).alias("devicetree"),
        ).alias("codegen"),
    )


def _guide() -> Column:
    """What a tree offers, as codes: where to begin, what is there, what is special."""
    sections = F.array_join(F.array_compact(F.array(*[
        F.when(F.col(f"optional_sections.{s}"), s) for s in OPTIONAL_SECTIONS])), " ")
    packages, scripts = F.array_join("packages", " "), F.array_join(F.map_keys("codegen.devicetree"), " ")
    return F.array_compact(F.array(
        _step("tree", F.col("part"), F.col("variant")),
        _step("header", F.concat("part", F.lit(".xml"))),
        _step("cores", F.lit(KEY_FILES["cores_info"])),
        _step("canonical", (F.col("variant") == CANONICAL_VARIANT).cast("string")),
        F.when(packages != "", _step("packages", packages)),
        F.when(scripts != "", _step("devicetree", scripts)),
        F.when(sections != "", _step("sections", sections)),
        _step("namespaces", F.size("xml_namespaces").cast("string")),
    ))


def roadmap(tree: DataFrame, xml_files: DataFrame, xml: str = "xml") -> DataFrame:
    """Layout and namespaces of every tree, with a guide made of codes.

    Layout reads paths only. Namespaces are made distinct before they are
    gathered, and both sides are partitioned by the tree key when they meet.
    """
    spaces = (
        namespace_inventory(xml_files, xml)
        .groupBy(*KEY)
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct(
                        F.coalesce("family", F.lit("")).alias("family"),
                        F.coalesce("version", F.lit("")).alias("version"),
                        "prefix", "uri", "label",
                    )
                )
            ).alias("xml_namespaces")
        )
    )
    empty = F.array().cast(
        "array<struct<family:string,version:string,prefix:string,uri:string,label:string>>"
    )
    package = lambda p: F.struct(
        p.alias("variant"),
        F.concat(p, F.lit("/")).alias("directory"),
        F.concat(p, F.lit(".xml")).alias("manifest"),
    )
    rows = _layout(tree).join(spaces, KEY, "left")
    return rows.withColumn("xml_namespaces", F.coalesce("xml_namespaces", empty)).select(
        *KEY,
        _guide().alias("guide"),
        "key_files",
        "optional_sections",
        F.transform("packages", package).alias("package_variants"),
        "codegen",
        "xml_namespaces",
    )
