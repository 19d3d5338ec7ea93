"""Catalogue and XML-corpus analytics on Spark DataFrames.

Every operator takes and returns DataFrames, so it answers for a whole table of
queries or a whole corpus in one job.
"""

from partatlas.constants import CANONICAL_VARIANT, SDK_VARIANTS
from partatlas.operators.corpus import (
    canonical_variant,
    codegen_inventory,
    key_files,
    layout_variants,
    namespace_inventory,
    optional_sections,
    pending_requests,
    summary_totals,
    total_size,
    tree_census,
    variant_diff,
    variant_diff_counts,
    variant_summary,
)
from partatlas.operators.details import (
    assemble_details,
    details_with_fetched,
    is_application_processor,
    link_by_type,
    package_link,
    package_variants,
    parse_cores,
    parse_headers,
    parse_properties,
    with_text,
)
from partatlas.operators.matching import (
    canonicalize,
    contains_join,
    dedupe_keep_first,
    lookup_parts,
    masked_alias_join,
    masked_prefix_join,
    part_variants,
    resolve_queries,
    select_parts,
    union_selection,
)
from partatlas.operators.mirror import glob_filter, mirror, mirror_counts, mirror_path, part_layout
from partatlas.operators.releases import (
    build_catalog,
    catalog_or_portfolio,
    discover_variants,
    families_of_release,
    fresh_only,
    latest_release,
    name_prefix,
    portfolio_latest,
    published_only,
    release_families,
    sort_releases,
)
from partatlas.operators.search import fuzzy_join, ranked_search
from partatlas.plans.bulk import (
    build_and_store_catalog,
    corpus_report,
    details_for,
    plan_fetch,
    requested_trees,
)
from partatlas.plans.roadmap import roadmap
from partatlas.session import build_session
from partatlas.sources.archives import archive_members, scan_archives
from partatlas.sources.catalog import (
    catalog_meta,
    read_catalog,
    read_catalog_meta,
    read_portfolio_snapshot,
    read_release_snapshot,
    record_json,
    write_catalog,
    write_mirror,
    write_records,
)
from partatlas.sources.listings import (
    broken_documents,
    listing_from_xml,
    releases_from_xml,
    scan_listing,
    scan_releases,
)
from partatlas.sources.spine import db_links
from partatlas.sources.trees import read_tree, scan_tree, tree_keys, write_tree
from partatlas.streaming.ingest import (
    incremental_ingest,
    read_portfolio_log,
    run_portfolio_stream,
    streaming_portfolio,
    tree_stream,
)

__all__ = [name for name in dir() if not name.startswith("_")]
