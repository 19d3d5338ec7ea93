"""Registered queries on the column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from partatlas.functions import markup, text
from workload.registry import query
from workload.views import spark_view as view


@query(
    "version_keys",
    """SELECT o_orderkey, array_to_string(list_transform(string_split(name, '.'),
                  lambda x: coalesce(try_cast(x AS bigint), -1)), ',') AS version_key
       FROM v_orders""",
)
def _(spark, sf):
    rows = view(spark, sf, "v_orders")
    return rows.select("o_orderkey", F.array_join(text.version_key("name"), ",").alias("version_key"))


@query(
    "strip_white_space",
    """SELECT doc_id, regexp_replace(padded, '^[ \t\r\n\x0b\x0c]+|[ \t\r\n\x0b\x0c]+$', '', 'g') AS stripped
       FROM (SELECT doc_id, concat(chr(9), chr(10), ' ', source, chr(10), lang, chr(13), '  ') AS padded
             FROM documents)""".replace("\\", "\\"),
)
def _(spark, sf):
    rows = view(spark, sf, """SELECT doc_id, concat(chr(9), chr(10), ' ', source, chr(10), lang, chr(13), '  ') AS padded
                              FROM {documents}""")
    return rows.select("doc_id", text.strip("padded").alias("stripped"))


@query(
    "human_bytes",
    """SELECT o_orderkey, n, CASE
           WHEN n < 1024 THEN printf('%.1f B', n)
           WHEN n < 1024.0 ** 2 THEN printf('%.1f KB', n / 1024.0 ** 1)
           WHEN n < 1024.0 ** 3 THEN printf('%.1f MB', n / 1024.0 ** 2)
           WHEN n < 1024.0 ** 4 THEN printf('%.1f GB', n / 1024.0 ** 3)
           WHEN n < 1024.0 ** 5 THEN printf('%.1f TB', n / 1024.0 ** 4)
           ELSE printf('%.1f PB', n / 1024.0 ** 5) END AS size
       FROM (SELECT o_orderkey, CAST(floor(o_totalprice) AS double)
                    * CASE o_custkey % 6 WHEN 0 THEN 0.0009765625 WHEN 1 THEN 1 WHEN 2 THEN 1024
                          WHEN 3 THEN 1048576 WHEN 4 THEN 1073741824 ELSE 1099511627776 END AS n FROM orders)""",
)
def _(spark, sf):
    rows = view(spark, sf, """
        SELECT o_orderkey, CAST(floor(o_totalprice) AS double)
               * CASE o_custkey % 6 WHEN 0 THEN 0.0009765625D WHEN 1 THEN 1D WHEN 2 THEN 1024D
                     WHEN 3 THEN 1048576D WHEN 4 THEN 1073741824D ELSE 1099511627776D END AS n
        FROM {orders}""")
    return rows.select("o_orderkey", "n", text.human_bytes("n").alias("size"))


@query(
    "query_slugs",
    """SELECT page_id, regexp_replace(url, '[^A-Za-z0-9._-]+', '_', 'g') AS slug,
              regexp_replace(url, '[^A-Za-z0-9._-]+', '_', 'g') AS padded, 'query' AS blank, '_' AS odd
       FROM pages""",
)
def _(spark, sf):
    return view(spark, sf, "SELECT page_id, url FROM {pages}").select(
        "page_id", text.slug("url").alias("slug"),
        text.slug(F.concat(F.lit(" \t"), "url", F.lit("\n "))).alias("padded"),
        text.slug(F.concat(F.substring("url", 1, 0), F.lit("  "))).alias("blank"),
        text.slug(F.concat(F.substring("url", 1, 0), F.lit(" ?? "))).alias("odd"),
    )


@query("basenames", "SELECT page_id, string_split(rtrim(url, '/'), '/')[-1] AS name FROM pages")
def _(spark, sf):
    return view(spark, sf, "SELECT page_id, url FROM {pages}").select(
        "page_id", text.basename("url").alias("name")
    )


MEMBERS = """
    SELECT page_id, concat(CASE page_id % 7 WHEN 0 THEN 'kex_tools/' WHEN 1 THEN 'kex_tools/processors/'
                           WHEN 2 THEN 'a/../processors/' WHEN 3 THEN './x//' WHEN 4 THEN '/abs/'
                           WHEN 5 THEN 'b/../' ELSE 'processors/../' END,
                           replace(substr(url, 9), '.example', chr(92))) AS member
    FROM {pages}"""


@query(
    "archive_member_paths",
    f"""WITH m AS ({MEMBERS}),
             s AS (SELECT page_id, list_filter(string_split(replace(member, chr(92), '/'), '/'),
                                               lambda x: x NOT IN ('', '.')) AS p FROM m),
             r AS (SELECT page_id, CASE WHEN list_contains(p, 'processors') THEN p[list_position(p, 'processors'):]
                                        WHEN p[1] = 'kex_tools' THEN p[2:] ELSE p END AS q FROM s),
             f AS (SELECT page_id, CASE WHEN len(q) = 0 OR q[1] = 'processors' THEN q
                                        ELSE list_concat(['processors'], q) END AS q FROM r)
        SELECT page_id, CASE WHEN len(q) > 0 AND NOT list_contains(q, '..') THEN array_to_string(q, '/') END AS path,
               list_contains(q, '..') AS unsafe FROM f""",
)
def _(spark, sf):
    rows = view(spark, sf, MEMBERS).select("page_id", text.normalize_member("member").alias("m"))
    return rows.select("page_id", "m.path", "m.unsafe")


@query(
    "url_globs",
    """SELECT page_id, url GLOB '*/en/*' AS has_en, url GLOB 'http://*.org/??/[0-4]*' AS low,
              url GLOB '*[?]page=?*' OR url GLOB '*#top' AS tail FROM pages""",
)
def _(spark, sf):
    return view(spark, sf, "SELECT page_id, url FROM {pages}").select(
        "page_id",
        text.glob_match("url", ["*/en/*"]).alias("has_en"),
        text.glob_match("url", ["http://*.org/??/[0-4]*"]).alias("low"),
        text.glob_match("url", ["*[?]page=?*", "*#top"]).alias("tail"),
    )


@query(
    "xmlns_pairs",
    """SELECT doc_id, n, string_agg(concat(p, '=', u), ' ' ORDER BY i) AS pairs FROM (
           SELECT doc_id, length(head) AS n,
                  unnest(regexp_extract_all(head, 'xmlns(?::([[:word:].-]+))?[ ]*=[ ]*"([^"]+)"', 1)) AS p,
                  unnest(regexp_extract_all(head, 'xmlns(?::([[:word:].-]+))?[ ]*=[ ]*"([^"]+)"', 2)) AS u,
                  generate_subscripts(regexp_extract_all(head, 'xmlns(?::([[:word:].-]+))?[ ]*=[ ]*"([^"]+)"', 2), 1) AS i
           FROM (SELECT doc_id, concat(text, xml, text) AS head FROM v_tree))
       GROUP BY doc_id, n""",
)
def _(spark, sf):
    rows = view(spark, sf, "SELECT doc_id, concat(text, xml, text) AS x FROM v_tree")
    pairs = F.transform(markup.xmlns_pairs("x"), lambda e: F.concat(e.prefix, F.lit("="), e.uri))
    return rows.select(
        "doc_id", F.length("x").cast("bigint").alias("n"),
        F.array_join(pairs, " ").alias("pairs"), F.size(pairs).alias("k"),
    ).filter("k > 0").drop("k")


URIS = """
    SELECT page_id, concat(url, CASE page_id % 4 WHEN 0 THEN '/1.2' WHEN 1 THEN '/2.0/' WHEN 2 THEN '//3//'
                                ELSE '' END) AS uri FROM {pages}"""


@query(
    "namespace_families",
    f"""SELECT page_id, CASE WHEN ok THEN p[-2] END AS family, CASE WHEN ok THEN p[-1] END AS version
        FROM (SELECT page_id, p, len(p) >= 2 AND regexp_full_match(p[-1], '[0-9]+([.][0-9]+)*') AS ok
              FROM (SELECT page_id, list_filter(string_split(rtrim(uri, '/'), '/'), lambda x: x <> '') AS p
                    FROM ({URIS})))""",
)
def _(spark, sf):
    return view(spark, sf, URIS).select(
        "page_id", markup.ns_family("uri").alias("family"), markup.ns_version("uri").alias("version")
    )


@query("local_names", "SELECT page_id, regexp_replace(concat('{', url, '}', lower('TAG')), '[{][^}]+[}]', '') AS tag FROM pages")
def _(spark, sf):
    rows = view(spark, sf, "SELECT page_id, url FROM {pages}")
    tag = F.concat(F.lit("{"), "url", F.lit("}tag"))
    return rows.select("page_id", markup.local_name(tag).alias("tag"))


@query("repaired_text", "SELECT doc_id, concat(text, '�', lang) AS fixed FROM documents")
def _(spark, sf):
    rows = view(spark, sf, "SELECT doc_id, text, lang FROM {documents}")
    broken = F.concat(F.col("text").cast("binary"), F.unhex(F.lit("FF")), F.col("lang").cast("binary"))
    return rows.select("doc_id", markup.repair_utf8(broken).alias("fixed"))
