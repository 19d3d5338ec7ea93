"""Parsers of the small files that describe a part, as column expressions.

Input is a column of XML text (or properties text), output is a typed struct.
A missing attribute is an empty string, a malformed file has ``ok`` = false.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partatlas.constants import LINE_BREAK
from partatlas.functions.text import col, let, strip

_OPTIONS = {
    "attributePrefix": "@",
    "valueTag": "#text",
    "ignoreNamespace": "true",
    "ignoreSurroundingSpaces": "false",
    "columnNameOfCorruptRecord": "_bad",
}
# Children that may repeat are arrays; the last one counts where one is meant.
HEADER_XML = (
    "basic_facts array<struct<`@id`:string,`@producer`:string,`@family`:string,"
    "`@series`:string,`@default_part`:string>>,"
    "target_products array<struct<product:array<string>>>,"
    "enabled_tools array<struct<enabled_tool:array<string>>>,_bad string"
)
CORES_XML = "core array<struct<`@name`:string,`@id`:string,`@description`:string>>,_bad string"
MANIFEST_XML = (
    "`@id` string,db_link array<struct<`@type`:string,`@link`:string,"
    "`@format_version`:string,`@description`:string>>,_bad string"
)


def _doc(xml: Column | str, schema: str) -> Column:
    return F.from_xml(col(xml), schema, _OPTIONS)


def _attr(node: Column, name: str) -> Column:
    return F.coalesce(node.getField(f"@{name}"), F.lit(""))


def _texts(node: Column, group: str, item: str) -> Column:
    """Trimmed non-blank texts of ``group/item``."""
    last = F.try_element_at(node.getField(group), F.lit(-1)).getField(item)
    kept = F.filter(F.transform(last, strip), lambda t: t != "")
    return F.coalesce(kept, F.array().cast("array<string>"))


def header(xml: Column | str) -> Column:
    """``<PART>.xml``: STRUCT<part, producer, family, series, default_part,
    target_products, enabled_tools, ok>; not ok without ``basic_facts``."""

    def build(doc: Column) -> Column:
        facts = F.try_element_at(doc.getField("basic_facts"), F.lit(-1))
        return F.struct(
            _attr(facts, "id").alias("part"),
            *[_attr(facts, n).alias(n) for n in ("producer", "family", "series", "default_part")],
            _texts(doc, "target_products", "product").alias("target_products"),
            _texts(doc, "enabled_tools", "enabled_tool").alias("enabled_tools"),
            (doc.getField("_bad").isNull() & facts.isNotNull()).alias("ok"),
        )

    return let(_doc(xml, HEADER_XML), build)


def cores(xml: Column | str) -> Column:
    """``cores_info.xml``: STRUCT<cores ARRAY<STRUCT<name, core_id, description>>, ok>."""

    def one(core: Column) -> Column:
        return F.struct(
            _attr(core, "name").alias("name"),
            _attr(core, "id").alias("core_id"),
            _attr(core, "description").alias("description"),
        )

    def build(doc: Column) -> Column:
        found = F.transform(doc.getField("core"), one)
        return F.struct(
            F.coalesce(found, F.array().cast("array<struct<name:string,core_id:string,"
                                             "description:string>>")).alias("cores"),
            doc.getField("_bad").isNull().alias("ok"),
        )

    return let(_doc(xml, CORES_XML), build)


def manifest(xml: Column | str) -> Column:
    """Package manifest: STRUCT<variant, db_links, ok>; not ok without root id."""

    def one(link: Column) -> Column:
        names = ("type", "link", "format_version", "description")
        return F.struct(*[_attr(link, n).alias(n) for n in names])

    def build(doc: Column) -> Column:
        found = F.transform(doc.getField("db_link"), one)
        return F.struct(
            _attr(doc, "id").alias("variant"),
            F.coalesce(found, F.array().cast("array<struct<type:string,link:string,"
                                             "format_version:string,description:string>>"))
            .alias("db_links"),
            (doc.getField("_bad").isNull() & (_attr(doc, "id") != "")).alias("ok"),
        )

    return let(_doc(xml, MANIFEST_XML), build)


def properties(text: Column | str) -> Column:
    """``key=value`` lines as a MAP; comments and blank lines skipped, last one wins.

    Sorting (key, line number) and keeping the last row of each key is linear
    apart from the sort, and needs no shuffle since one file is one row.
    """
    lines = F.transform(F.split(col(text), LINE_BREAK), lambda line, _: strip(line))
    kept = F.filter(
        F.transform(lines, lambda line, i: F.struct(line.alias("line"), i.alias("i"))),
        lambda e: F.contains(e.line, F.lit("="))
        & ~F.startswith(e.line, F.lit(";"))
        & ~F.startswith(e.line, F.lit("#")),
    )
    pairs = F.sort_array(
        F.transform(
            kept,
            lambda e: F.struct(
                strip(F.substring_index(e.line, "=", 1)).alias("key"),
                e.i.alias("i"),
                strip(F.substr(e.line, F.locate("=", e.line) + 1)).alias("value"),
            ),
        )
    )
    last = let(
        pairs,
        lambda s: F.filter(
            s,
            lambda e, i: (i == F.size(s) - 1)
            | (F.coalesce(F.get(s, i + 1).key, F.lit("")) != e.key),
        ),
    )
    return F.map_from_entries(
        F.transform(last, lambda e: F.struct(e.key.alias("key"), e.value.alias("value")))
    )


def db_links(variants: DataFrame) -> DataFrame:
    """Flat manifest links: all key columns, position and the four fields."""
    keep = [c for c in variants.columns if c != "db_links"]
    return variants.select(*keep, F.posexplode("db_links").alias("pos", "row")).select(
        *keep, "pos", "row.*"
    )
