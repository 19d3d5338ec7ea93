"""Profile of a corpus: layout, sizes, namespaces, differences.

Every operator is one scan and one shuffle on the tree key with partial
aggregation; rows arrive at the shuffle already reduced per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partatlas.constants import (
    CANONICAL_VARIANT,
    DEVICETREE_SCRIPTS,
    KEY_FILES,
    OPTIONAL_SECTIONS,
)
from partatlas.functions.markup import ns_family, ns_label, ns_version, xmlns_pairs
from partatlas.sources.trees import TREE_KEY

KEY = list(TREE_KEY)


# --- row-wise parts of the layout --------------------------------------------


def top_directory() -> Column:
    """First directory of the relpath, NULL for a file at the top."""
    return F.nullif(F.regexp_extract("relpath", r"^([^/]+)/", 1), F.lit(""))


def manifest_stem() -> Column:
    """``D`` of a top-level ``D.xml``, else NULL."""
    return F.nullif(F.regexp_extract("relpath", r"^([^/]+)\.xml\z", 1), F.lit(""))


def is_xml() -> Column:
    return F.endswith("relpath", F.lit(".xml"))


def key_file_name() -> Column:
    """Logical name of a key file, else NULL."""
    out = None
    for name, pattern in KEY_FILES.items():
        before, slot, after = pattern.partition("{part}")
        path = F.concat(F.lit(before), F.col("part"), F.lit(after)) if slot else F.lit(pattern)
        hit = F.col("relpath") == path
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


# --- sizes and counts --------------------------------------------------------


def total_size(tree: DataFrame) -> DataFrame:
    return tree.agg(F.coalesce(F.sum("length"), F.lit(0)).cast("bigint").alias("size_bytes"))


def variant_summary(tree: DataFrame) -> DataFrame:
    """Files and bytes of every (release, part, variant)."""
    return tree.groupBy(*KEY).agg(
        F.count("*").alias("files"), F.sum("length").alias("size_bytes")
    )


def summary_totals(summary: DataFrame) -> DataFrame:
    """The summary rows and one total row (``is_total``) with distinct parts.

    Totals come from the summary, one row per tree, not from files. They are there
    also when nothing is stored.
    """
    columns = ("is_total", *KEY, "parts", "variants", "files", "size_bytes")
    one = F.lit(1).cast("bigint")
    rows = summary.select(
        F.lit(False).alias("is_total"), *KEY, one.alias("parts"), one.alias("variants"), "files",
        "size_bytes")
    total = summary.agg(
        F.countDistinct("part").alias("parts"), F.count("*").alias("variants"), *_sums("files", "size_bytes"))
    return rows.select(*columns).union(_total_row(total, KEY).select(*columns))


def _sums(*names: str) -> list[Column]:
    return [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in names]


def _total_row(total: DataFrame, keys: list[str]) -> DataFrame:
    none = F.lit(None).cast("string")
    return total.select("*", F.lit(True).alias("is_total"), *[none.alias(k) for k in keys])


def canonical_variant(rows: DataFrame, pos: str = "pos") -> DataFrame:
    """One row per part: the canonical variant, else the one first seen."""
    rest = [c for c in rows.columns if c != "part"]
    order = F.struct((F.col("variant") != CANONICAL_VARIANT).alias("other"), F.col(pos))
    return rows.groupBy("part").agg(
        F.min_by(F.struct(*rest), order).alias("_row")
    ).select(*[F.col("part") if c == "part" else F.col(f"_row.{c}").alias(c) for c in rows.columns])


def pending_requests(requests: DataFrame, stored: DataFrame, force: bool = False) -> DataFrame:
    """Requested trees that hold no file yet; all of them when forced."""
    if force:
        return requests
    return requests.join(stored.select(*KEY).distinct(), KEY, "left_anti")


def tree_census(tree: DataFrame) -> DataFrame:
    """Per part: files, XML files, package variants, register XMLs; and a total row.

    Package variants are the loose ones (a directory with a sibling manifest).
    Files are counted per package first, so the second shuffle is small.
    """
    per_package = (
        tree.select(
            *KEY, is_xml().alias("xml"),
            (is_xml() & F.col("relpath").rlike(r"(^|/)registers/")).alias("register"),
            manifest_stem().isNotNull().alias("manifest"),
            top_directory().isNotNull().alias("inside"),
            F.coalesce(manifest_stem(), top_directory()).alias("package"),
        )
        .groupBy(*KEY, "package")
        .agg(
            F.count("*").alias("files"),
            F.count_if("xml").alias("xml_files"),
            F.count_if("register").alias("register_xmls"),
            (F.bool_or("manifest") & F.bool_or("inside")).cast("bigint").alias("package_variants"),
        )
    )
    sums = ("files", "xml_files", "package_variants", "register_xmls")
    columns = ("is_total", "part", *sums)
    per_part = per_package.groupBy("part").agg(*_sums(*sums))
    rows = per_part.select(F.lit(False).alias("is_total"), "part", *sums)
    return rows.union(_total_row(per_part.agg(*_sums(*sums)), ["part"]).select(*columns))


def variant_diff(tree: DataFrame, a: str, b: str) -> DataFrame:
    """(release, part, relpath, status) between two variants of the same part.

    One scan and one shuffle of digests instead of a full outer join of two. The
    digest is carried as numbers, so that the aggregate can be a hash aggregate.
    """
    digest = F.sha2(F.col("content").cast("binary"), 256)
    pieces = [f"d{i}" for i in range(5)]  # 64 hexadecimal digits, 15 in a BIGINT
    numbers = [
        F.conv(F.substring("digest", 1 + 15 * i, 15), 16, 10).cast("bigint").alias(name)
        for i, name in enumerate(pieces)
    ]

    def of(variant: str, piece: str) -> Column:
        return F.max(F.when(F.col("variant") == variant, F.col(piece)))

    sides = [of(v, d).alias(f"{side}_{d}") for side, v in (("a", a), ("b", b)) for d in pieces]
    same = F.lit(True)
    for d in pieces:
        same = same & (F.col(f"a_{d}") == F.col(f"b_{d}"))
    return (
        tree.filter(F.col("variant").isin(a, b))
        .select(*KEY, "relpath", digest.alias("digest"))
        .select(*KEY, "relpath", *numbers)
        .groupBy("release", "part", "relpath")
        .agg(*sides)
        .select(
            "release", "part", "relpath",
            F.when(F.col("b_d0").isNull(), "only_left")
            .when(F.col("a_d0").isNull(), "only_right")
            .when(same, "identical")
            .otherwise("different").alias("status"),
        )
    )


def variant_diff_counts(diff: DataFrame) -> DataFrame:
    return diff.groupBy("release", "part", "status").agg(F.count("*").alias("files"))


# --- layout ------------------------------------------------------------------


def layout_variants(tree: DataFrame) -> DataFrame:
    """Loose package variants: a directory D with a sibling ``D.xml``."""
    name = F.coalesce(manifest_stem(), top_directory())
    return (
        tree.select(*KEY, name.alias("package"), manifest_stem().isNotNull().alias("is_manifest"))
        .filter(F.col("package").isNotNull())
        .groupBy(*KEY, "package")
        .agg(F.bool_or("is_manifest").alias("m"), F.bool_or(~F.col("is_manifest")).alias("d"))
        .filter(F.col("m") & F.col("d"))
        .select(*KEY, "package",
                F.concat("package", F.lit("/")).alias("directory"),
                F.concat("package", F.lit(".xml")).alias("manifest"))
    )


def key_files(tree: DataFrame) -> DataFrame:
    """(tree key, name, relpath) of the key files that are present."""
    return (
        tree.select(*KEY, key_file_name().alias("name"), "relpath")
        .filter(F.col("name").isNotNull())
        .distinct()
    )


def optional_sections(tree: DataFrame) -> DataFrame:
    """One boolean column per optional section."""
    flags = [F.bool_or(F.startswith("relpath", F.lit(f"{s}/"))).alias(s) for s in OPTIONAL_SECTIONS]
    return tree.groupBy(*KEY).agg(*flags)


def codegen_inventory(tree: DataFrame) -> DataFrame:
    """Script folder, its subfolders and the device-tree scripts of a tree."""
    sub = F.nullif(F.regexp_extract("relpath", r"^scripts/([^/]+)/", 1), F.lit(""))
    scripts = [
        F.bool_or(F.col("relpath") == rel).alias(f"devicetree_{label}")
        for label, rel in DEVICETREE_SCRIPTS.items()
    ]
    return tree.groupBy(*KEY).agg(
        F.bool_or(F.startswith("relpath", F.lit("scripts/"))).alias("has_scripts"),
        F.sort_array(F.collect_set(sub)).alias("categories"),
        *scripts,
    )


# --- namespaces --------------------------------------------------------------


def namespace_declarations(xml_files: DataFrame, xml: str = "xml",
                           head: int | None = None) -> DataFrame:
    """Distinct (tree key, prefix, uri) declared in the XML files, or in their heads."""
    return (
        xml_files.filter(is_xml())
        .select(*KEY, F.explode(xmlns_pairs(xml, head)).alias("ns"))
        .select(*KEY, "ns.prefix", "ns.uri")
        .distinct()
    )


def namespace_inventory(xml_files: DataFrame, xml: str = "xml",
                        head: int | None = None) -> DataFrame:
    """Declarations with family, version and label, NULL where not recognised."""
    return (
        namespace_declarations(xml_files, xml, head)
        .withColumn("family", ns_family("uri"))
        .withColumn("version", ns_version("uri"))
        .withColumn("label", ns_label("family"))
    )
