"""One structured record per (release, part, variant) out of its spine files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partatlas.constants import CANONICAL_VARIANT
from partatlas.functions.markup import repair_utf8
from partatlas.functions.text import version_key
from partatlas.operators.corpus import manifest_stem
from partatlas.sources import spine
from partatlas.sources.trees import TREE_KEY

KEY = list(TREE_KEY)
CORES_FILE = "common/cores_info.xml"
PROPERTIES_FILE = "processor.properties"


# --- projections on parsed records -------------------------------------------


def link_by_type(db_links: Column | str, kind: str) -> Column:
    """First manifest link of a type, NULL if there is none."""
    links = F.col(db_links) if isinstance(db_links, str) else db_links
    return F.try_element_at(F.filter(links, lambda l: l.type == kind), F.lit(1))


def package_link(db_links: Column | str) -> Column:
    """Link of the first ``package`` entry, or an empty string."""
    return F.coalesce(link_by_type(db_links, "package").getField("link"), F.lit(""))


def is_application_processor(cores: Column | str) -> Column:
    """True if any core is of the Cortex-A class."""
    found = F.col(cores) if isinstance(cores, str) else cores
    return F.coalesce(
        F.exists(found, lambda c: F.startswith(c.getField("name"), F.lit("Cortex-A"))),
        F.lit(False),
    )


# --- roles of the spine files ------------------------------------------------


def _is_header() -> Column:
    return F.col("relpath") == F.concat("part", F.lit(".xml"))


def _part_info_dir() -> Column:
    """``D`` of ``D/part_info.xml``, else NULL."""
    return F.nullif(F.regexp_extract("relpath", r"^([^/]+)/part_info\.xml\z", 1), F.lit(""))


def parse_headers(tree: DataFrame, xml: str = "xml") -> DataFrame:
    """Header of every tree that has one: key columns and header fields."""
    fields = ("producer", "family", "series", "default_part", "target_products",
              "enabled_tools", "ok")
    return tree.filter(_is_header()).select(*KEY, spine.header(xml).alias("h")).select(
        *KEY, F.col("h.part").alias("part_id"), *[F.col(f"h.{f}") for f in fields]
    )


def parse_cores(tree: DataFrame, xml: str = "xml") -> DataFrame:
    return tree.filter(F.col("relpath") == CORES_FILE).select(
        *KEY, spine.cores(xml).alias("c")
    ).select(*KEY, "c.*")


def parse_properties(tree: DataFrame, text: str = "xml") -> DataFrame:
    return tree.filter(F.col("relpath") == PROPERTIES_FILE).select(
        *KEY, spine.properties(text).alias("properties")
    )


def package_variants(tree: DataFrame, xml: str = "xml") -> DataFrame:
    """Strict package variants: ``D/part_info.xml`` and a sibling ``D.xml``.

    Both files meet in one shuffle on (tree, D); the manifest travels parsed.
    ``ok`` is false for a manifest without id or that does not parse.
    """
    directory = F.coalesce(_part_info_dir(), manifest_stem())
    parsed = F.when(manifest_stem().isNotNull(), spine.manifest(xml))
    return (
        tree.filter(directory.isNotNull())
        .select(*KEY, directory.alias("directory"), _part_info_dir().isNotNull().alias("info"),
                parsed.alias("m"))
        .groupBy(*KEY, "directory")
        .agg(F.bool_or("info").alias("info"), F.first("m", ignorenulls=True).alias("m"))
        .filter(F.col("info") & F.col("m").isNotNull())
        .select(*KEY, "directory", F.col("m.variant").alias("package_variant"),
                package_link("m.db_links").alias("package"), "m.db_links", "m.ok")
    )


# --- assembly ----------------------------------------------------------------


def assemble_details(tree: DataFrame, xml: str = "xml") -> DataFrame:
    """Details of every tree in one shuffle.

    Only the text of spine files is read and each is parsed before the shuffle; the
    keys of all files go along, so that a tree without any spine file has a row. ``status``
    is ``ok``, ``missing_header``, ``bad_header``, ``bad_cores`` or
    ``bad_manifest``. A tree's record holds its cores, packages and properties,
    so its size is that of the record itself.
    """
    files = tree.filter(
        _is_header()
        | F.col("relpath").isin(CORES_FILE, PROPERTIES_FILE)
        | manifest_stem().isNotNull()
        | _part_info_dir().isNotNull()
    )
    role = (
        F.when(_is_header(), "header")
        .when(F.col("relpath") == CORES_FILE, "cores")
        .when(F.col("relpath") == PROPERTIES_FILE, "properties")
        .when(_part_info_dir().isNotNull(), "info")
        .otherwise("manifest")
    )
    staged = files.select(*KEY, "relpath", xml, role.alias("role")).select(
        *KEY,
        F.when(F.col("role") == "header", spine.header(xml)).alias("header"),
        F.when(F.col("role") == "cores", spine.cores(xml)).alias("cores"),
        F.when(F.col("role") == "properties",
               F.map_entries(spine.properties(xml))).alias("properties"),
        F.when(F.col("role") == "info", _part_info_dir()).alias("info"),
        F.when(
            F.col("role").isin("manifest", "header"),
            F.struct(manifest_stem().alias("directory"), spine.manifest(xml).alias("m")),
        ).alias("manifest"),
    )
    every = staged.unionByName(tree.select(*KEY), allowMissingColumns=True)
    gathered = every.groupBy(*KEY).agg(
        F.first("header", ignorenulls=True).alias("header"),
        F.first("cores", ignorenulls=True).alias("cores"),
        F.first("properties", ignorenulls=True).alias("properties"),
        F.collect_set("info").alias("infos"),
        F.collect_list("manifest").alias("manifests"),
    )
    strict = F.array_sort(
        F.filter("manifests", lambda m: F.array_contains("infos", m.directory)),
        lambda x, y: F.when(x.directory < y.directory, -1)
        .when(x.directory > y.directory, 1).otherwise(0),
    )
    variants = F.transform(
        strict,
        lambda m: F.struct(
            m.m.variant.alias("variant"),
            package_link(m.m.db_links).alias("package"),
            m.m.db_links.alias("db_links"),
            m.directory.alias("directory"),
            m.m.ok.alias("ok"),
        ),
    )
    rows = gathered.select(
        *KEY, "header",
        F.coalesce("cores.cores", F.array().cast(
            "array<struct<name:string,core_id:string,description:string>>")).alias("cores"),
        F.coalesce("cores.ok", F.lit(True)).alias("cores_ok"),
        variants.alias("variants"),
        F.coalesce(F.map_from_entries("properties"),
                   F.create_map().cast("map<string,string>")).alias("properties"),
    )
    status = (
        F.when(F.col("header").isNull(), "missing_header")
        .when(~F.col("header.ok"), "bad_header")
        .when(~F.col("cores_ok"), "bad_cores")
        .when(F.exists("variants", lambda v: ~v.ok), "bad_manifest")
        .otherwise("ok")
    )
    return rows.select(
        *KEY,
        status.alias("status"),
        F.col("header").dropFields("ok").alias("header"),
        "cores",
        F.transform("variants", lambda v: v.dropFields("ok")).alias("variants"),
        "properties",
        is_application_processor("cores").alias("is_application_processor"),
    )


def with_text(tree: DataFrame) -> DataFrame:
    """Tree rows with ``content`` decoded to text in ``xml``."""
    return tree.withColumn("xml", repair_utf8("content"))


def details_with_fetched(details: DataFrame, summary: DataFrame) -> DataFrame:
    """One row per part: details of its canonical tree and all its fetched trees.

    The canonical tree is the default SDK variant, else the first by name, in its
    newest release. Details that failed give their status as ``error``.
    """
    item = F.struct("variant", "release", "files", "size_bytes")
    newest = F.max(F.struct(version_key("release").alias("key"), "release")).alias("newest")
    first = F.struct((F.col("variant") != CANONICAL_VARIANT).alias("other"), "variant", "newest.release")
    per_part = (
        summary.groupBy("part", "variant").agg(newest, F.collect_list(item).alias("items"))
        .groupBy("part").agg(
            F.min(first).alias("chosen"),
            F.sort_array(F.flatten(F.collect_list("items"))).alias("fetched_variants"))
        .select("part", "chosen.variant", "chosen.release", "fetched_variants")
    )
    fields = ("header", "cores", "variants", "properties", "is_application_processor")
    ok = F.col("status") == "ok"
    return per_part.join(details, KEY, "left").select(
        "part", "variant", "release",
        F.when(~F.coalesce(ok, F.lit(False)),
               F.coalesce("status", F.lit("missing_tree"))).alias("error"),
        F.when(ok, F.struct(*fields)).alias("details"),
        "fetched_variants",
    )
