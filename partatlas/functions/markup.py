"""Column functions on XML text and raw bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from partatlas.constants import NAMESPACE_LABELS, XMLNS_PATTERN
from partatlas.functions.text import col

# (family, version): the last two path pieces when the last is dotted digits.
NS_TAIL = r"([^/]+)/+(\d+(?:\.\d+)*)\z"


def repair_utf8(content: Column | str) -> Column:
    """Bytes as text; malformed sequences become U+FFFD instead of failing."""
    return F.make_valid_utf8(col(content).cast("string"))


def local_name(tag: Column | str) -> Column:
    """Tag without its ``{uri}`` part."""
    return F.regexp_replace(col(tag), r"\{[^}]+\}", "")


def xmlns_pairs(xml: Column | str, head: int | None = None) -> Column:
    """ARRAY<STRUCT<prefix, uri>> declared in the text, or in its first ``head`` characters."""
    text = col(xml) if head is None else F.substring(col(xml), 1, head)
    return F.zip_with(
        F.regexp_extract_all(text, F.lit(XMLNS_PATTERN), F.lit(1)),
        F.regexp_extract_all(text, F.lit(XMLNS_PATTERN), F.lit(2)),
        lambda prefix, uri: F.struct(prefix.alias("prefix"), uri.alias("uri")),
    )


def _ns_piece(uri: Column | str, group: int) -> Column:
    trimmed = F.regexp_replace(col(uri), r"/+\z", "")
    return F.nullif(F.regexp_extract(trimmed, NS_TAIL, group), F.lit(""))


def ns_family(uri: Column | str) -> Column:
    return _ns_piece(uri, 1)


def ns_version(uri: Column | str) -> Column:
    return _ns_piece(uri, 2)


def ns_label(family: Column | str) -> Column:
    """Label of a known namespace family, else NULL."""
    out = None
    for name, label in NAMESPACE_LABELS.items():
        hit = col(family) == name
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out
