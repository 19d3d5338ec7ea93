"""Registered queries on releases, families and the stored catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from partatlas.operators import releases as R
from partatlas.session import work_dir
from partatlas.sources import catalog as cat
from partatlas.sources.listings import (
    broken_documents,
    listing_from_xml,
    releases_from_xml,
    scan_listing,
    scan_releases,
)
from partatlas.streaming.ingest import (
    read_portfolio_log,
    run_portfolio_stream,
    streaming_portfolio,
)
from workload.registry import query
from workload.views import spark_text
from workload.views import spark_view as view

KEY_SQL = (
    "list_transform(string_split(name, '.'), lambda x: coalesce(try_cast(x AS bigint), -1))"
)
PUBLISHED_SQL = "SELECT * FROM v_releases WHERE name <> '' AND trim(version) <> ''"
PORTFOLIO_SQL = f"""
    SELECT family, arg_max(name, ord) AS version FROM (
        SELECT l.name AS family, r.name AS name,
               struct_pack(k := {KEY_SQL.replace('name', 'r.name')}, i := r.api_id) AS ord
        FROM v_listing l JOIN ({PUBLISHED_SQL}) r ON l.release = r.name
        WHERE l.directory AND l.name <> '') GROUP BY family"""


def portfolio(spark, sf):
    return R.portfolio_latest(view(spark, sf, "v_releases"), view(spark, sf, "v_listing"))


def joined(name="variants"):
    return F.array_join(name, ",").alias(name)


@query("published_releases", "SELECT api_id, name FROM (" + PUBLISHED_SQL + ")")
def _(spark, sf):
    return R.published_only(view(spark, sf, "v_releases")).select("api_id", "name")


@query("all_named_releases", "SELECT api_id, name, version FROM v_releases WHERE name <> ''")
def _(spark, sf):
    return R.published_only(view(spark, sf, "v_releases"), include_unpublished=True)


@query(
    "releases_by_version_key",
    f"SELECT api_id, name, array_to_string({KEY_SQL}, ',') AS version_key FROM v_releases",
)
def _(spark, sf):
    rows = R.sort_releases(view(spark, sf, "v_releases"))
    return rows.select("api_id", "name", joined("version_key"))


@query(
    "latest_release",
    f"""SELECT arg_max(name, struct_pack(k := {KEY_SQL}, i := -api_id)) AS name, 'ok' AS status
        FROM ({PUBLISHED_SQL})""",
)
def _(spark, sf):
    return R.latest_release(view(spark, sf, "v_releases"))


@query("portfolio_latest", PORTFOLIO_SQL)
def _(spark, sf):
    return portfolio(spark, sf)


@query(
    "release_families",
    "SELECT DISTINCT release, name AS family FROM v_listing WHERE directory AND name <> ''",
)
def _(spark, sf):
    return R.release_families(view(spark, sf, "v_listing"))


@query("families_of_portfolio", PORTFOLIO_SQL)
def _(spark, sf):
    return R.families_of_release(portfolio=portfolio(spark, sf))


@query(
    "first_families",
    f"SELECT * FROM ({PORTFOLIO_SQL}) ORDER BY lower(family), family LIMIT 100",
)
def _(spark, sf):
    return R.families_of_release(portfolio=portfolio(spark, sf), limit=100)


@query(
    "portfolio_name_prefix",
    f"SELECT * FROM ({PORTFOLIO_SQL}) WHERE starts_with(lower(family), 'f1')",
)
def _(spark, sf):
    return R.name_prefix(portfolio(spark, sf), "F1")


VARIANTS_SQL = f"""
    SELECT p.family, p.version,
           concat_ws(',', CASE WHEN bool_or(v = 'ksdk2_0') THEN 'ksdk2_0' END,
                          CASE WHEN bool_or(v = 'zephyr3_2') THEN 'zephyr3_2' END) AS variants
    FROM ({PORTFOLIO_SQL}) p
    LEFT JOIN (SELECT release, string_split(full_path, '/')[4] AS family,
                      string_split(full_path, '/')[5] AS v
               FROM v_listing WHERE NOT directory AND full_path LIKE '%.xml') l
           ON l.family = p.family AND l.release = p.version
    GROUP BY p.family, p.version"""


@query("discover_variants", VARIANTS_SQL)
def _(spark, sf):
    found = R.discover_variants(view(spark, sf, "v_listing"), portfolio(spark, sf))
    return found.select("family", "version", joined())


@query(
    "build_catalog",
    f"""SELECT family AS part, family, version, 'i_mx_2_0,ksdk2_0,zephyr3_2' AS variants
        FROM ({PORTFOLIO_SQL})""",
)
def _(spark, sf):
    return R.build_catalog(portfolio(spark, sf)).withColumn("variants", joined())


@query(
    "build_catalog_probed",
    f"SELECT family AS part, family, version, variants FROM ({VARIANTS_SQL})",
)
def _(spark, sf):
    rows = R.build_catalog(portfolio(spark, sf), listing=view(spark, sf, "v_listing"), probe=True)
    return rows.withColumn("variants", joined())


@query(
    "catalog_meta",
    """SELECT 'portfolio-latest' AS source_version, count(*) AS part_count,
              count(DISTINCT family) AS family_count FROM v_keys""",
)
def _(spark, sf):
    return cat.catalog_meta(view(spark, sf, "v_keys")).drop("built_at")


@query(
    "stored_catalog",
    f"""SELECT family AS part, family, version, 'i_mx_2_0,ksdk2_0,zephyr3_2' AS variants
        FROM ({PORTFOLIO_SQL})""",
)
def _(spark, sf):
    path = work_dir(spark, "catalog")
    cat.write_catalog(R.build_catalog(portfolio(spark, sf)), path)
    return cat.read_catalog(spark, path).drop("part_lower").withColumn("variants", joined())


@query("catalog_or_portfolio", f"SELECT family AS part, family FROM ({PORTFOLIO_SQL})")
def _(spark, sf):
    missing = cat.read_catalog(spark, work_dir(spark, "not-built"))
    return R.catalog_or_portfolio(missing, portfolio(spark, sf))


@query(
    "fresh_snapshots",
    """SELECT event_id, user_id FROM events
       WHERE epoch(TIMESTAMP '2024-01-10 00:00:00') - epoch(ts) < 86400""",
)
def _(spark, sf):
    rows = view(spark, sf, "SELECT event_id, user_id, ts AS mtime FROM {events}")
    as_of = F.lit("2024-01-10 00:00:00").cast("timestamp")
    return R.fresh_only(rows, as_of).select("event_id", "user_id")


RELEASE_XML = """
    SELECT concat('<tool_versions><tool_version><api_id> ', CAST(o_orderkey AS string),
                  ' </api_id><name> ', name, ' </name><version>',
                  CASE WHEN d % 3 = 0 THEN '' ELSE name END,
                  '</version></tool_version><tool_version><api_id>none</api_id><name>',
                  o_orderstatus, '</name></tool_version></tool_versions>') AS xml
    FROM v_orders"""


@query(
    "releases_from_xml",
    f"""SELECT o_orderkey AS api_id, name, CASE WHEN d % 3 = 0 THEN '' ELSE name END AS version,
               d % 3 <> 0 AS stable, array_to_string({KEY_SQL}, ',') AS version_key
        FROM v_orders
        UNION ALL SELECT 0, o_orderstatus, '', false, '-1' FROM v_orders""",
)
def _(spark, sf):
    rows = releases_from_xml(view(spark, sf, RELEASE_XML))
    return rows.withColumn("version_key", joined("version_key"))


LISTING_XML = """
    SELECT name AS release,
           concat('<dir><entry><file_id>', CAST(o_orderkey AS string), '</file_id><full_path>/store/processors/F',
                  CAST(o_custkey AS string), '</full_path><directory> TRUE </directory><time>',
                  CAST(o_orderkey AS string), '</time><size></size></entry><entry><full_path>/store/', o_orderstatus,
                  '</full_path><directory>false</directory><size> 7 </size><time>now</time></entry></dir>') AS xml
    FROM v_orders"""


@query(
    "listing_from_xml",
    """SELECT name AS release, CAST(o_orderkey AS string) AS file_id,
              concat('/store/processors/F', CAST(o_custkey AS string)) AS full_path, true AS directory,
              o_orderkey AS time, CAST(NULL AS bigint) AS size, '' AS compression,
              concat('F', CAST(o_custkey AS string)) AS name
       FROM v_orders
       UNION ALL SELECT name, '', concat('/store/', o_orderstatus), false, NULL, 7, '', o_orderstatus
       FROM v_orders""",
)
def _(spark, sf):
    return listing_from_xml(view(spark, sf, LISTING_XML), "xml", "release")


@query(
    "broken_documents",
    "SELECT o_orderkey FROM v_orders WHERE o_custkey % 5 = 0 OR o_custkey % 7 = 0 OR o_custkey % 11 = 0",
)
def _(spark, sf):
    rows = view(spark, sf, """
        SELECT o_orderkey, CASE WHEN o_custkey % 5 = 0 THEN concat('<dir><entry>', name, '</dir>')
               WHEN o_custkey % 7 = 0 THEN CAST(NULL AS string) WHEN o_custkey % 11 = 0 THEN '  '
               ELSE concat('<dir><entry>', name, '</entry></dir>') END AS xml FROM v_orders""")
    return broken_documents(rows).select("o_orderkey")


@query(
    "scanned_releases",
    f"""SELECT o_orderkey AS api_id, name, CASE WHEN d % 3 = 0 THEN '' ELSE name END AS version,
               d % 3 <> 0 AS stable, array_to_string({KEY_SQL}, ',') AS version_key
        FROM v_orders
        UNION ALL SELECT 0, o_orderstatus, '', false, '-1' FROM v_orders""",
)
def _(spark, sf):
    path = work_dir(spark, "release-files")
    view(spark, sf, """
        SELECT concat(' ', CAST(o_orderkey AS string), ' ') AS api_id, concat(' ', name, ' ') AS name,
               CASE WHEN d % 3 = 0 THEN '' ELSE name END AS version FROM v_orders
        UNION ALL SELECT 'none', o_orderstatus, CAST(NULL AS string) FROM v_orders""",
    ).write.format("xml").options(rootTag="tool_versions", rowTag="tool_version").save(path)
    return scan_releases(spark, path).withColumn("version_key", joined("version_key"))


@query(
    "scanned_listing",
    """SELECT 'R 1' AS release, CAST(o_orderkey AS string) AS file_id,
              concat('/store/processors/F', CAST(o_custkey AS string)) AS full_path, true AS directory,
              o_orderkey AS time, CAST(NULL AS bigint) AS size, '' AS compression,
              concat('F', CAST(o_custkey AS string)) AS name
       FROM v_orders
       UNION ALL SELECT 'R 1', '', concat('/store/', o_orderstatus), false, NULL, 7, '', o_orderstatus
       FROM v_orders""",
)
def _(spark, sf):
    path = work_dir(spark, "listing-files")
    view(spark, sf, """
        SELECT CAST(o_orderkey AS string) AS file_id, concat('/store/processors/F', CAST(o_custkey AS string)) AS full_path,
               ' TRUE ' AS directory, CAST(o_orderkey AS string) AS time, '' AS size FROM v_orders
        UNION ALL SELECT CAST(NULL AS string), concat('/store/', o_orderstatus), 'false', 'now', ' 7 ' FROM v_orders""",
    ).write.format("xml").options(rootTag="dir", rowTag="entry").save(path)
    return scan_listing(spark, path, release="R 1")


@query("streaming_portfolio", PORTFOLIO_SQL)
def _(spark, sf):
    # Orders come in two batches, odd customers first; they become listing entries.
    given = spark.read.parquet(f"{sf}/orders.parquet")
    run = work_dir(spark, "portfolio")
    for rest in (1, 0):
        given.filter(F.col("o_custkey") % 2 == rest).write.mode("append").parquet(f"{run}/orders")
        spark.readStream.schema(given.schema).parquet(f"{run}/orders").createOrReplaceTempView("stream_orders")
        text = spark_text("SELECT * FROM v_listing", orders="stream_orders")
        run_portfolio_stream(streaming_portfolio(spark.sql(text)), f"{run}/log", f"{run}/checkpoint")
    return read_portfolio_log(spark, f"{run}/log", view(spark, sf, "v_releases"))
