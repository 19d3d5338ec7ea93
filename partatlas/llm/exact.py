"""Exact duplicates: 128-bit digests of contents, compared byte by byte within a digest.

Texts are equal when they are identical after every run of the six ASCII white-space
characters is one space. Rows are grouped by the digest and, inside a digest, by the
bytes of the text themselves, so texts whose digests collide are told apart. The
grouping is summed up in each task before the one shuffle that carries texts, in which
copies are one row a task, however many there are. Everything after that shuffle is
narrow: digests, ids and counts. Texts travel a second time only for digests that
collide.

Which row stays: the one with the smallest ``doc_id``; rows without an id stay only
where no row of the group has one. Of rows that repeat that id, the one that the scan
numbers first stays, so one row of each group stays in every case. A null text is an
empty text. White space at the ends counts, as one space. Very long texts are compared
in whole. An empty table gives no rows. Other columns, whatever their names, are not
looked at by ``exact_groups`` and come through ``exact_filter`` unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partatlas.session import materialize

Digest = Callable[[Column], Column]


def content_digest(text: Column) -> Column:
    """128 bits of a text."""
    return F.unhex(F.md5(text))


def normalised(text: Column) -> Column:
    """Text with every run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _first() -> Column:
    """The row that stays: known ids first, then the smaller id, then the earlier row."""
    return F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_no")).alias("first")


def _numbered(docs: DataFrame, digest: Digest) -> DataFrame:
    """``doc_id``, normalised ``norm``, its ``digest`` and ``row_no``, a number of the row."""
    rows = docs.select(
        F.col("doc_id").cast("long"), normalised(F.col("text")).alias("norm"),
        F.monotonically_increasing_id().alias("row_no"))
    return rows.withColumn("digest", digest(F.col("norm")))


def exact_groups(docs: DataFrame, digest: Digest = content_digest) -> DataFrame:
    """Every row's group: ``doc_id``, ``keep_id`` (of the row that stays), ``group_size``,
    ``kept`` and ``text_sha256`` of the normalised text.

    ``digest`` gives the first grouping; a weak one costs time, not correctness.
    """
    rows = materialize(_numbered(docs, digest).select("doc_id", "digest", "row_no"), "exact-rows")
    texts = docs.select(normalised(F.col("text")).alias("norm")).withColumn("digest", digest(F.col("norm")))
    variants = materialize(
        texts.groupBy("digest", "norm").agg(F.count("*").alias("group_size"))
        .select("digest", "group_size", F.sha2("norm", 256).alias("text_sha256")), "exact-texts")
    by_digest = variants.groupBy("digest").agg(
        F.count("*").alias("n_texts"), F.max("group_size").alias("group_size"),
        F.max("text_sha256").alias("text_sha256"))
    firsts = rows.groupBy("digest").agg(_first())
    groups = materialize(by_digest.join(firsts, "digest"), "exact-groups")
    out = rows.join(groups.filter("n_texts = 1"), "digest").select(*_answer())
    collided = groups.filter("n_texts > 1").select("digest")
    if collided.isEmpty():
        return out
    return out.unionByName(_collided(docs, digest, collided))


def _answer() -> list[Column]:
    return [
        F.col("doc_id"), F.col("first.doc_id").alias("keep_id"), F.col("group_size"),
        (F.col("row_no") == F.col("first.row_no")).alias("kept"), F.col("text_sha256")]


def _collided(docs: DataFrame, digest: Digest, collided: DataFrame) -> DataFrame:
    """Rows of digests that several texts share, grouped by the texts."""
    rows = materialize(_numbered(docs, digest).join(collided, "digest", "left_semi"), "exact-collided")
    groups = materialize(
        rows.groupBy("digest", "norm").agg(F.count("*").alias("group_size"), _first())
        .withColumn("text_sha256", F.sha2("norm", 256)), "exact-collided-groups")
    return rows.join(groups, ["digest", "norm"]).select(*_answer())


def exact_filter(docs: DataFrame, digest: Digest = content_digest) -> DataFrame:
    """Rows of ``docs`` with all their columns, one of each group of equal texts: the one
    with the smallest ``doc_id``; of rows that repeat that id, any one."""
    keep = exact_groups(docs, digest).filter("kept").select(
        F.col("doc_id").alias("keep_id"), F.col("text_sha256").alias("keep_sha"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("at"),
        F.sha2(normalised(F.col("text")), 256).alias("sha"), F.monotonically_increasing_id().alias("row_no"))
    stays = rows.join(keep, rows["at"].eqNullSafe(keep["keep_id"]) & (rows["sha"] == keep["keep_sha"]), "left_semi")
    one = stays.groupBy("at", "sha").agg(F.min_by("row", "row_no").alias("row"))
    return one.select("row.*")


#: The same groups in SQL; where ids are unique, one row of each group has the smallest.
EXACT_SQL = r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = min(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY norm)
"""
