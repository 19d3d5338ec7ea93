"""Releases, families and the catalogue built from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partatlas.constants import SDK_VARIANTS, SNAPSHOT_TTL_SECONDS, STORE_ROOT
from partatlas.functions.text import strip, version_key


def published_only(releases: DataFrame, include_unpublished: bool = False) -> DataFrame:
    """Releases that have a name and, unless asked otherwise, a version."""
    kept = releases.filter(F.col("name") != "")
    return kept if include_unpublished else kept.filter(strip("version") != "")


def sort_releases(releases: DataFrame) -> DataFrame:
    """Ascending by version key; releases with equal keys by ``api_id``."""
    return releases.withColumn("version_key", version_key("name")).orderBy(
        "version_key", "api_id"
    )


def latest_release(releases: DataFrame, include_unpublished: bool = False) -> DataFrame:
    """One row (name, status) with the highest published release.

    Of equal version keys the lowest ``api_id`` wins. Without any published
    release ``name`` is NULL and ``status`` is ``no_release``.
    """
    order = F.struct(version_key("name"), -F.col("api_id"))
    best = published_only(releases, include_unpublished).agg(
        F.max_by("name", order).alias("name")
    )
    return best.withColumn(
        "status", F.when(F.col("name").isNull(), "no_release").otherwise("ok")
    )


def is_family_entry() -> Column:
    """A named directory right below the store root."""
    below_root = F.col("full_path").rlike(rf"(?:^|/){STORE_ROOT}/[^/]+/?\z")
    return F.col("directory") & (F.col("name") != "") & below_root


def release_families(listing: DataFrame, release: str | None = None) -> DataFrame:
    """Distinct (release, family) of the family directories in a listing."""
    rows = listing if release is None else listing.filter(F.col("release") == release)
    return (
        rows.filter(is_family_entry())
        .select("release", F.col("name").alias("family"))
        .distinct()
    )


def sort_names(df: DataFrame, name: str = "family") -> DataFrame:
    """Order by the lower-case name, then the name."""
    return df.orderBy(F.lower(name), name)


def families_of_release(
    listing: DataFrame | None = None,
    release: str | None = None,
    portfolio: DataFrame | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Families of one release, or the whole portfolio when no release is given."""
    if release is None:
        if portfolio is None:
            raise ValueError("give a release with its listing, or a portfolio")
        rows = portfolio.select("family", "version")
    else:
        rows = release_families(listing, release).select("family")
    ordered = sort_names(rows)
    return ordered if limit is None else ordered.limit(limit)


def portfolio_latest(
    releases: DataFrame, listing: DataFrame, include_unpublished: bool = False
) -> DataFrame:
    """For every family the newest published release that lists it.

    The listing is cut to its distinct (release, family) pairs before anything
    is joined, so a release that holds most of the listing costs one partial
    aggregate per task and no more. Of equal version keys the highest
    ``api_id`` wins.
    """
    return portfolio_of_pairs(releases, release_families(listing), include_unpublished)


def portfolio_of_pairs(
    releases: DataFrame, pairs: DataFrame, include_unpublished: bool = False
) -> DataFrame:
    """The same for distinct (release, family) pairs."""
    ranked = (
        published_only(releases, include_unpublished)
        .groupBy("name")
        .agg(F.max("api_id").alias("api_id"))
        .select(
            F.col("name").alias("release"),
            F.struct(version_key("name").alias("key"), F.col("api_id")).alias("ord"),
        )
    )
    return (
        pairs.join(ranked, "release")
        .groupBy("family")
        .agg(F.max_by("release", "ord").alias("version"))
    )


def name_prefix(portfolio: DataFrame, prefix: str, name: str = "family") -> DataFrame:
    """Rows whose name begins with ``prefix`` in any case; no wildcards."""
    return portfolio.filter(F.startswith(F.lower(name), F.lower(F.lit(prefix))))


def fresh_only(
    snapshots: DataFrame, as_of: Column, ttl: int = SNAPSHOT_TTL_SECONDS, mtime: str = "mtime"
) -> DataFrame:
    """Snapshots younger than ``ttl`` seconds at ``as_of``."""
    return snapshots.filter(F.col(mtime) > as_of - F.make_dt_interval(secs=F.lit(ttl)))


def discover_variants(
    listing: DataFrame, portfolio: DataFrame, candidates: Sequence[str] = SDK_VARIANTS
) -> DataFrame:
    """Per family, the candidate variants that hold any entry at its release.

    Families without any variant keep an empty array. The set collected per
    family has at most ``len(candidates)`` members.
    """
    inside = rf"(?:^|/){STORE_ROOT}/([^/]+)/([^/]+)/[^/]+/?\z"
    present = (
        listing.select(
            F.col("release").alias("version"),
            F.regexp_extract("full_path", inside, 1).alias("family"),
            F.regexp_extract("full_path", inside, 2).alias("variant"),
        )
        .filter(F.col("variant").isin(*candidates))
        .distinct()
    )
    names = F.array(*[F.lit(c) for c in candidates])
    found = (
        portfolio.join(present, ["family", "version"], "left")
        .groupBy("family", "version")
        .agg(F.collect_set("variant").alias("seen"))
    )
    return found.select(
        "family",
        "version",
        F.filter(names, lambda v: F.array_contains("seen", v)).alias("variants"),
    )


def build_catalog(
    portfolio: DataFrame,
    variant: str | None = None,
    listing: DataFrame | None = None,
    probe: bool = False,
) -> DataFrame:
    """Catalogue rows (part, family, version, variants sorted) of a portfolio.

    Variants are those found in the listing when ``probe`` is set, else the one
    asked for, else the default set.
    """
    if probe:
        rows = discover_variants(listing, portfolio)
    else:
        names = sorted(SDK_VARIANTS) if variant is None else [variant]
        rows = portfolio.withColumn("variants", F.array(*[F.lit(v) for v in names]))
    return rows.select(
        F.col("family").alias("part"),
        "family",
        "version",
        F.array_sort("variants").alias("variants"),
    )


def catalog_or_portfolio(catalog: DataFrame | None, portfolio: DataFrame | None) -> DataFrame | None:
    """(part, family) rows to search: the catalogue if built, else the portfolio."""
    if catalog is not None:
        return catalog.select("part", "family")
    if portfolio is not None:
        return portfolio.select(F.col("family").alias("part"), "family")
    return None
