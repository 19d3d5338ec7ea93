"""Registered queries on parsed part files and assembled details."""

from __future__ import annotations

from pyspark.sql import functions as F

from partatlas.operators import corpus as C
from partatlas.operators import details as D
from partatlas.plans.bulk import details_for
from partatlas.sources.spine import db_links
from workload.corpus import SUMMARY_SQL, tree
from workload.registry import query
from workload.views import spark_view as view

KEY = "release, part, variant"


@query(
    "parse_header",
    f"""SELECT {KEY}, part AS part_id, source AS producer, lang AS family, concat('S ', CAST(n_chars AS string)) AS series,
               '' AS default_part, concat('ONE,', source) AS target_products, 'Pins' AS enabled_tools, true AS ok
        FROM v_tree WHERE slot = 0""",
)
def _(spark, sf):
    rows = D.parse_headers(tree(spark, sf))
    return rows.withColumns({c: F.array_join(c, ",") for c in ("target_products", "enabled_tools")})


@query(
    "parse_cores",
    f"""SELECT {KEY}, 0 AS pos, CASE WHEN n_chars % 2 = 0 THEN 'Cortex-A55' ELSE 'Cortex-M33' END AS name,
               concat('c', CAST(doc_id AS string)) AS core_id, lang AS description FROM v_tree WHERE slot = 1
        UNION ALL SELECT {KEY}, 1, 'DSP', '', '' FROM v_tree WHERE slot = 1""",
)
def _(spark, sf):
    rows = D.parse_cores(tree(spark, sf)).select("release", "part", "variant", F.posexplode("cores"))
    return rows.select("release", "part", "variant", "pos", "col.*")


STRICT_SQL = f"""
    SELECT m.release, m.part, m.variant, m.slot, m.d AS directory, m.source, m.lang, m.n_chars
    FROM (SELECT *, replace(relpath, '.xml', '') AS d FROM v_tree WHERE slot IN (3, 5)) m
    JOIN (SELECT {KEY}, replace(relpath, '/part_info.xml', '') AS d FROM v_tree WHERE relpath LIKE '%/part_info.xml') i
      ON m.release = i.release AND m.part = i.part AND m.variant = i.variant AND m.d = i.d"""


@query(
    "package_variants",
    f"""SELECT {KEY}, directory, CASE WHEN slot = 5 AND n_chars % 5 = 0 THEN '' ELSE directory END AS package_variant,
               CASE WHEN slot = 3 THEN concat('packages/', source, '.xml') ELSE '' END AS package,
               NOT (slot = 5 AND n_chars % 5 = 0) AS ok FROM ({STRICT_SQL})""",
)
def _(spark, sf):
    return D.package_variants(tree(spark, sf)).drop("db_links")


@query(
    "manifest_links",
    f"""SELECT {KEY}, directory, 0 AS pos, CASE WHEN slot = 3 THEN 'part_info' ELSE 'cores_info' END AS type,
               CASE WHEN slot = 3 THEN concat(directory, '/part_info.xml') ELSE concat('common/', source) END AS link,
               CASE WHEN slot = 3 THEN '1.0' ELSE '' END AS format_version, CASE WHEN slot = 3 THEN lang ELSE '' END AS description
        FROM ({STRICT_SQL})
        UNION ALL SELECT {KEY}, directory, 1, 'package', concat('packages/', source, '.xml'), '1.0', '' FROM ({STRICT_SQL}) WHERE slot = 3
        UNION ALL SELECT {KEY}, directory, 2, 'package', 'late', '', '' FROM ({STRICT_SQL}) WHERE slot = 3""",
)
def _(spark, sf):
    rows = D.package_variants(tree(spark, sf)).select("release", "part", "variant", "directory", "db_links")
    return db_links(rows)


@query(
    "links_by_type",
    f"""SELECT {KEY}, directory, CASE WHEN slot = 5 THEN concat('common/', source) END AS cores_link,
               CASE WHEN slot = 3 THEN '1.0' END AS package_format, CAST(NULL AS varchar) AS none FROM ({STRICT_SQL})""",
)
def _(spark, sf):
    rows = D.package_variants(tree(spark, sf))
    return rows.select(
        "release", "part", "variant", "directory",
        D.link_by_type("db_links", "cores_info").link.alias("cores_link"),
        D.link_by_type("db_links", "package").format_version.alias("package_format"),
        D.link_by_type("db_links", "no such type").link.alias("none"),
    )


PROPERTIES_SQL = r"""
    SELECT {key}, k AS key, arg_max(v, i) AS value FROM (
        SELECT {key}, i, trim(substr(l, 1, position('=' IN l) - 1)) AS k, trim(substr(l, position('=' IN l) + 1)) AS v
        FROM (SELECT {key}, unnest(list_transform(string_split({text}, chr(10)), lambda x: trim(x))) AS l,
                     generate_subscripts(string_split({text}, chr(10)), 1) AS i FROM {rows})
        WHERE l LIKE '%=%' AND l NOT LIKE ';%' AND l NOT LIKE '#%') GROUP BY {key}, k"""


def entries(df, *key):
    return df.select(*key, F.explode("properties").alias("key", "value"))


TREE_PROPERTIES = PROPERTIES_SQL.replace("{rows}", "(SELECT * FROM v_tree WHERE slot = 2)").replace(
    "{text}", "xml").replace("{key}", KEY)


@query("parse_properties", TREE_PROPERTIES)
def _(spark, sf):
    return entries(D.parse_properties(tree(spark, sf)), "release", "part", "variant")


TEXT_ROWS = """(SELECT doc_id, replace(concat(text, chr(10), 'a=', lang, chr(10), 'b = x=', source), ' ', '=') AS x FROM {documents})"""


@query(
    "properties_of_whole_texts",
    PROPERTIES_SQL.replace("{rows}", TEXT_ROWS).replace("{text}", "x").replace("{key}", "doc_id"),
)
def _(spark, sf):
    from partatlas.sources.spine import properties

    rows = view(spark, sf, f"SELECT * FROM {TEXT_ROWS}")
    return entries(rows.select("doc_id", properties("x").alias("properties")), "doc_id")


@query(
    "application_processors",
    f"SELECT {KEY}, n_chars % 2 = 0 AS application FROM v_tree WHERE slot = 1",
)
def _(spark, sf):
    rows = D.parse_cores(tree(spark, sf))
    return rows.select("release", "part", "variant", D.is_application_processor("cores").alias("application"))


DETAILS_SQL = f"""
    WITH t AS (SELECT {KEY} FROM v_tree GROUP BY {KEY}),
         h AS (SELECT {KEY}, source AS producer FROM v_tree WHERE slot = 0),
         c AS (SELECT {KEY}, 2 AS n, n_chars % 2 = 0 AS app FROM v_tree WHERE slot = 1),
         s AS (SELECT {KEY}, string_agg(CASE WHEN slot = 5 AND n_chars % 5 = 0 THEN '' ELSE directory END, ',' ORDER BY directory) AS packages,
                      bool_and(NOT (slot = 5 AND n_chars % 5 = 0)) AS good FROM ({STRICT_SQL}) GROUP BY {KEY}),
         p AS (SELECT {KEY}, count(*) AS n FROM ({TREE_PROPERTIES}) GROUP BY {KEY})
    SELECT t.release, t.part, t.variant,
           CASE WHEN h.producer IS NULL THEN 'missing_header' WHEN NOT coalesce(s.good, true) THEN 'bad_manifest' ELSE 'ok' END AS status,
           h.producer, coalesce(c.n, 0) AS cores, coalesce(s.packages, '') AS packages, coalesce(p.n, 0) AS properties,
           coalesce(c.app, false) AS is_application_processor
    FROM t LEFT JOIN h USING (release, part, variant) LEFT JOIN c USING (release, part, variant)
    LEFT JOIN s USING (release, part, variant) LEFT JOIN p USING (release, part, variant)"""


def flat_details(rows):
    return rows.select(
        "release", "part", "variant", "status", "header.producer",
        F.size("cores").alias("cores"),
        F.array_join(F.transform("variants", lambda v: v.variant), ",").alias("packages"),
        F.size("properties").cast("bigint").alias("properties"),
        "is_application_processor",
    )


@query("assemble_details", DETAILS_SQL)
def _(spark, sf):
    return flat_details(D.assemble_details(tree(spark, sf)))


@query(
    "details_with_fetched",
    f"""WITH d AS ({DETAILS_SQL}),
             f AS (SELECT part, arg_min(variant, struct_pack(o := variant <> 'ksdk2_0', v := variant, r := release)) AS variant,
                          arg_min(release, struct_pack(o := variant <> 'ksdk2_0', v := variant, r := release)) AS release,
                          string_agg(concat(variant, ':', CAST(files AS string), ':', CAST(size_bytes AS string)), ' ' ORDER BY variant, release) AS fetched
                   FROM ({SUMMARY_SQL}) GROUP BY part)
        SELECT f.part, f.variant, f.release, CASE WHEN d.status IS NULL THEN 'missing_tree' WHEN d.status <> 'ok' THEN d.status END AS error,
               CASE WHEN d.status = 'ok' THEN d.producer END AS producer, fetched
        FROM f LEFT JOIN d ON d.part = f.part AND d.variant = f.variant AND d.release = f.release""",
)
def _(spark, sf):
    rows = D.details_with_fetched(D.assemble_details(tree(spark, sf)), C.variant_summary(tree(spark, sf)))
    fetched = F.transform("fetched_variants", lambda f: F.concat_ws(":", f.variant, f.files, f.size_bytes))
    return rows.select("part", "variant", "release", "error", "details.header.producer",
                       F.array_join(fetched, " ").alias("fetched"))


# Every part in up to twelve releases, whose order as text is not that of their numbers.
RELEASED = """SELECT concat('26.', CAST(n_chars % 12 AS string)) AS release, part, variant, relpath, length, xml FROM v_tree"""


@query(
    "details_newest_release",
    """WITH s AS (SELECT part, variant, max(n_chars % 12) AS r FROM v_tree GROUP BY part, variant),
            c AS (SELECT part, arg_min(variant, struct_pack(o := variant <> 'ksdk2_0', v := variant)) AS variant FROM s GROUP BY part)
       SELECT part, variant, concat('26.', CAST(r AS string)) AS release FROM c JOIN s USING (part, variant)""",
)
def _(spark, sf):
    rows = view(spark, sf, RELEASED)
    found = D.details_with_fetched(D.assemble_details(rows), C.variant_summary(rows))
    return found.select("part", "variant", "release")


@query(
    "details_for_queries",
    f"""WITH d AS ({DETAILS_SQL}), q AS (SELECT DISTINCT concat(' ', lower(part)) AS query, part, concat('26.', CAST(p % 4 AS string)) AS release FROM v_docs)
        SELECT q.query, coalesce(d.status, 'missing_tree') AS status, q.part, q.release, d.producer
        FROM q LEFT JOIN d ON d.part = q.part AND d.release = q.release AND d.variant = 'ksdk2_0'
        UNION ALL SELECT DISTINCT concat('Z', source), 'unknown', NULL, NULL, NULL FROM v_docs""",
)
def _(spark, sf):
    asked = view(spark, sf, """SELECT concat(' ', lower(part)) AS query FROM v_docs
                               UNION ALL SELECT concat('Z', source) FROM v_docs""")
    known = view(spark, sf, """SELECT DISTINCT part AS family, concat('26.', CAST(p % 4 AS string)) AS version FROM v_docs""")
    files = tree(spark, sf).withColumn("content", F.col("xml").cast("binary")).drop("xml")
    rows = details_for(asked, known, files)
    return rows.select("query", "status", "part", "release", "header.producer")
