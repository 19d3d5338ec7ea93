"""Release lists and storage listings, from XML files or from XML text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partatlas.functions.text import basename, strip, version_key

RELEASE_FIELDS = "api_id string, name string, version string"
ENTRY_FIELDS = (
    "file_id string, full_path string, directory string, "
    "time string, size string, compression string"
)


def _text(name: str) -> Column:
    return F.coalesce(strip(name), F.lit(""))


def typed_releases(raw: DataFrame) -> DataFrame:
    """Text fields of ``<tool_version>`` rows to the ``releases`` schema."""
    return raw.select(
        F.coalesce(strip("api_id").try_cast("bigint"), F.lit(0).cast("bigint")).alias("api_id"),
        _text("name").alias("name"),
        _text("version").alias("version"),
    ).select(
        "*",
        (F.col("version") != "").alias("stable"),
        version_key("name").alias("version_key"),
    )


def typed_listing(raw: DataFrame, *keep: str) -> DataFrame:
    """Text fields of ``<entry>`` rows to the ``listing`` schema."""
    return raw.select(
        *keep,
        _text("file_id").alias("file_id"),
        _text("full_path").alias("full_path"),
        (F.lower(_text("directory")) == "true").alias("directory"),
        strip("time").try_cast("bigint").alias("time"),
        strip("size").try_cast("bigint").alias("size"),
        _text("compression").alias("compression"),
    ).withColumn("name", basename("full_path"))


def scan_releases(spark: SparkSession, path: str) -> DataFrame:
    """One row per ``<tool_version>`` of the release files below ``path``."""
    raw = spark.read.format("xml").option("rowTag", "tool_version").schema(RELEASE_FIELDS)
    return typed_releases(raw.load(path))


def scan_listing(spark: SparkSession, path: str, release: str | None = None) -> DataFrame:
    """One row per ``<entry>`` of the listing files below ``path``.

    The release is given, or else it is the name of the folder of the file.
    """
    raw = spark.read.format("xml").option("rowTag", "entry").schema(ENTRY_FIELDS).load(path)
    # The metadata column is percent-encoded, with a plus standing for itself.
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    decoded = F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))
    named = F.lit(release) if release else decoded
    return typed_listing(raw.withColumn("release", named), "release")


def _exploded(df: DataFrame, xml: str, tag: str, fields: str, keep: tuple[str, ...]) -> DataFrame:
    schema = f"{tag} array<struct<{fields.replace(' string', ': string')}>>"
    parsed = F.from_xml(F.col(xml), schema, {"ignoreNamespace": "true"})
    rows = df.select(*keep, parsed.alias("doc")).select(
        *keep, F.explode(F.col("doc").getField(tag)).alias("row")
    )
    return rows.select(*keep, "row.*")


def broken_documents(df: DataFrame, xml: str = "xml") -> DataFrame:
    """Rows whose document is missing or does not parse; the readers below give no
    row for them."""
    parsed = F.from_xml(F.col(xml), "_bad string", {
        "ignoreNamespace": "true", "columnNameOfCorruptRecord": "_bad"})
    bad = F.col(xml).isNull() | (strip(xml) == "") | parsed.getField("_bad").isNotNull()
    return df.filter(F.coalesce(bad, F.lit(True)))


def releases_from_xml(df: DataFrame, xml: str = "xml") -> DataFrame:
    """Release rows out of a column that holds whole release documents."""
    return typed_releases(_exploded(df, xml, "tool_version", RELEASE_FIELDS, ()))


def listing_from_xml(df: DataFrame, xml: str = "xml", *keep: str) -> DataFrame:
    """Listing rows out of a column that holds whole listing documents."""
    return typed_listing(_exploded(df, xml, "entry", ENTRY_FIELDS, keep), *keep)
