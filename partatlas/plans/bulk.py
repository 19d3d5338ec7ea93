"""Whole jobs composed of the operators: what one command of a user asks for."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partatlas.constants import SDK_VARIANTS
from partatlas.operators import corpus, details, mirror, releases
from partatlas.operators.matching import Selection, canonicalize, select_parts
from partatlas.plans.roadmap import roadmap
from partatlas.session import materialize
from partatlas.sources.catalog import write_catalog


def requested_trees(
    parts: DataFrame,
    portfolio: DataFrame,
    variants: Sequence[str] = SDK_VARIANTS,
    version: str | None = None,
) -> DataFrame:
    """(release, part, variant) for every selected part and SDK variant."""
    found = parts.join(portfolio, F.col("part") == F.col("family"))
    release = F.col("version") if version is None else F.lit(version)
    names = F.array(*[F.lit(v) for v in variants])
    return found.select(
        release.alias("release"), "part", F.explode(names).alias("variant")
    )


class FetchPlan(NamedTuple):
    selection: Selection
    pending: DataFrame  # release, part, variant


def plan_fetch(
    portfolio: DataFrame,
    stored: DataFrame,
    inputs: DataFrame | None = None,
    prefix: str | None = None,
    variants: Sequence[str] = SDK_VARIANTS,
    version: str | None = None,
    force: bool = False,
) -> FetchPlan:
    """Which trees are still to be fetched for some inputs, a prefix, or everything."""
    if inputs is not None:
        chosen = select_parts(inputs, portfolio)
    else:
        rows = portfolio if prefix is None else releases.name_prefix(portfolio, prefix)
        picked = rows.select(F.col("family").alias("part"), F.lit(0).alias("pos"))
        chosen = Selection(picked, picked.select("pos", F.col("part").alias("query")).limit(0))
    wanted = requested_trees(chosen.parts, portfolio, variants, version)
    return FetchPlan(chosen, corpus.pending_requests(wanted, stored, force))


def details_for(queries: DataFrame, portfolio: DataFrame, tree: DataFrame,
                variant: str = SDK_VARIANTS[0]) -> DataFrame:
    """Details for free-form part names: resolve first, then read the spine.

    Names that are unknown or ambiguous keep that status and have no details.
    The resolved names are stored first, as the scan of the trees and the final
    join both need them.
    """
    names = materialize(
        canonicalize(queries, portfolio).select(
            "query", F.col("status").alias("resolution"), "part",
            F.col("version").alias("release"),
        ),
        "names",
    )
    wanted = names.filter(F.col("part").isNotNull())
    trees = details.with_text(
        tree.filter(F.col("variant") == variant)
        .join(wanted.select("release", "part").distinct(), ["release", "part"], "left_semi")
    )
    found = wanted.join(details.assemble_details(trees), ["release", "part"], "left")
    status = F.coalesce("status", F.lit("missing_tree"))
    columns = ("header", "cores", "variants", "properties", "is_application_processor")
    resolved = found.select("query", status.alias("status"), "part", "release", *columns)
    missed = names.filter(F.col("part").isNull()).select(
        "query", F.col("resolution").alias("status")
    )
    return resolved.unionByName(missed, allowMissingColumns=True)


def build_and_store_catalog(
    release_rows: DataFrame, listing: DataFrame, path: str, probe: bool = False
) -> None:
    """Portfolio, catalogue and meta row, stored at ``path``."""
    portfolio = releases.portfolio_latest(release_rows, listing)
    write_catalog(releases.build_catalog(portfolio, listing=listing, probe=probe), path)


class CorpusReport(NamedTuple):
    summary: DataFrame
    details: DataFrame
    mirror: DataFrame
    counts: DataFrame
    roadmap: DataFrame
    layout: DataFrame


def corpus_report(tree: DataFrame, include: Sequence[str] = (),
                  exclude: Sequence[str] = ()) -> CorpusReport:
    """Everything a bulk fetch reports about a stored tree table."""
    text = details.with_text(tree)
    summary = corpus.variant_summary(tree)
    # Stored, as the counts and the layout are taken from it too.
    mirrored = materialize(mirror.mirror(text, include=include, exclude=exclude), "mirror")
    counts = mirror.mirror_counts(mirrored)
    return CorpusReport(
        corpus.summary_totals(summary),
        details.details_with_fetched(details.assemble_details(text), summary),
        mirrored,
        counts,
        roadmap(tree, text),
        mirror.part_layout(summary, counts),
    )
