"""Registered queries on masked matching, resolution and search."""

from __future__ import annotations

from pyspark.sql import functions as F

from partatlas.functions.masks import masked_match, masked_prefix_match
from partatlas.functions.text import strip
from partatlas.operators import matching as M
from partatlas.operators import search as S
from workload.catalogue import PORTFOLIO_SQL, portfolio
from workload.registry import query
from workload.views import spark_view as view

# LIKE pattern of a masked key; keys hold no LIKE specials other than these.
MASK_SQL = r"replace(replace(replace(replace({k}, '\', '\\'), '%', '\%'), '_', '\_'), 'x', '_')"
KEY_MASK = MASK_SQL.format(k="lower(trim(k.part))")
QUERY_SQL = "(SELECT DISTINCT query, lower(trim(query)) AS q FROM v_queries WHERE trim(query) <> '')"
ALIAS_HIT = rf"q.q LIKE {KEY_MASK} || '%' ESCAPE '\'"
PREFIX_HIT = (
    r"length(q.q) <= length(trim(k.part)) AND q.q LIKE "
    + MASK_SQL.format(k="substr(lower(trim(k.part)), 1, length(q.q))") + r" ESCAPE '\'"
)


def queries_and_keys(spark, sf):
    return view(spark, sf, "v_queries"), view(spark, sf, "v_keys")


@query(
    "masked_alias_join",
    f"SELECT DISTINCT q.query, k.part FROM {QUERY_SQL} q JOIN v_keys k ON {ALIAS_HIT}",
)
def _(spark, sf):
    return M.masked_alias_join(*queries_and_keys(spark, sf))


@query(
    "masked_full_join",
    f"""SELECT DISTINCT q.query, k.part FROM {QUERY_SQL} q
        JOIN v_keys k ON {ALIAS_HIT} AND length(q.q) = length(trim(k.part))""",
)
def _(spark, sf):
    return M.masked_alias_join(*queries_and_keys(spark, sf), allow_suffix=False)


@query(
    "masked_prefix_join",
    f"SELECT DISTINCT q.query, k.part FROM {QUERY_SQL} q JOIN v_keys k ON {PREFIX_HIT}",
)
def _(spark, sf):
    return M.masked_prefix_join(*queries_and_keys(spark, sf))


@query(
    "masked_predicates",
    rf"""SELECT part, concat(upper(family), part) AS value,
               upper(concat(family, part)) LIKE upper({MASK_SQL.format(k="lower(part)")}) || '%' ESCAPE '\' AS orderable,
               substr(lower(part), 1, 4) LIKE {MASK_SQL.format(k="substr(lower(part), 1, 4)")} ESCAPE '\' AS beginning
        FROM v_keys""",
)
def _(spark, sf):
    rows = view(spark, sf, "v_keys").withColumn("value", F.concat(F.upper("family"), F.col("part")))
    return rows.select(
        "part", "value",
        masked_match("part", "value").alias("orderable"),
        masked_prefix_match("part", F.substring("part", 1, 4)).alias("beginning"),
    )


@query(
    "contains_join",
    f"""WITH c AS (SELECT DISTINCT part, family FROM v_keys)
        SELECT q.query, c.part, c.family, 'part' AS field FROM {QUERY_SQL} q JOIN c ON contains(lower(c.part), q.q)
        UNION ALL SELECT q.query, c.part, c.family, 'family' FROM {QUERY_SQL} q JOIN c ON contains(lower(c.family), q.q)""",
)
def _(spark, sf):
    return M.contains_join(*queries_and_keys(spark, sf))


RESOLVED_SQL = f"""
    SELECT query, tier, part FROM (
        SELECT *, min(tier) OVER (PARTITION BY query) AS best FROM (
            SELECT q.query, 1 AS tier, k.part FROM {QUERY_SQL} q JOIN (SELECT DISTINCT part FROM v_keys) k ON lower(k.part) = q.q
            UNION ALL SELECT q.query, 2, k.part FROM {QUERY_SQL} q
              JOIN (SELECT DISTINCT part FROM v_keys) k ON contains(lower(k.part), 'x') AND {ALIAS_HIT}
            UNION ALL SELECT q.query, 3, k.part FROM {QUERY_SQL} q
              JOIN (SELECT DISTINCT part FROM v_keys) k ON starts_with(lower(k.part), q.q) OR ({PREFIX_HIT})))
    WHERE tier = best"""


@query("resolve_queries", RESOLVED_SQL)
def _(spark, sf):
    return M.resolve_queries(*queries_and_keys(spark, sf))


@query(
    "canonicalize",
    f"""WITH hits AS ({RESOLVED_SQL}),
             counts AS (SELECT query, count(*) AS n, min(part) AS one,
                               array_to_string(list(part ORDER BY lower(part), part)[1:5], ',') AS examples
                        FROM hits GROUP BY query)
        SELECT q.query,
               CASE WHEN n IS NULL THEN 'unknown' WHEN n = 1 THEN 'ok' ELSE 'ambiguous' END AS status,
               CASE WHEN n = 1 THEN one END AS part, CASE WHEN n = 1 THEN k.family END AS version,
               coalesce(n, 0) AS matches, CASE WHEN n > 1 THEN examples END AS examples,
               coalesce(n > 5, false) AS more
        FROM (SELECT DISTINCT query FROM v_queries) q LEFT JOIN counts c ON c.query = q.query
        LEFT JOIN v_keys k ON k.part = c.one""",
)
def _(spark, sf):
    queries, keys = queries_and_keys(spark, sf)
    known = keys.select(F.col("part").alias("family"), F.col("family").alias("version"))
    rows = M.canonicalize(queries, known)
    return rows.withColumn("examples", F.array_join("examples", ","))


@query(
    "select_parts",
    f"""WITH hits AS ({RESOLVED_SQL})
        SELECT part, min(pos) AS pos FROM (
            SELECT lower(h.part) AS l, h.part, i.pos FROM hits h JOIN v_inputs i ON i.query = h.query)
        GROUP BY part""",
)
def _(spark, sf):
    inputs = view(spark, sf, "v_inputs")
    keys = view(spark, sf, "SELECT part AS family FROM v_keys")
    return M.select_parts(inputs, keys).parts.withColumn("pos", F.col("pos").cast("bigint"))


@query(
    "unresolved_inputs",
    f"""SELECT pos, query FROM v_queries WHERE query NOT IN (SELECT query FROM ({RESOLVED_SQL}))""",
)
def _(spark, sf):
    keys = view(spark, sf, "SELECT part AS family FROM v_keys")
    return M.select_parts(view(spark, sf, "v_queries"), keys).unresolved


@query(
    "dedupe_keep_first",
    """SELECT arg_min(query, pos) AS part, min(pos) AS pos FROM v_queries GROUP BY lower(query)""",
)
def _(spark, sf):
    rows = view(spark, sf, "SELECT query AS part, pos FROM v_queries")
    return M.dedupe_keep_first(rows)


@query(
    "union_selection",
    """SELECT arg_min(part, pos) AS part, min(pos) AS pos FROM (
           SELECT part, 10 * p_partkey AS pos FROM v_part
           UNION ALL SELECT lower(part), 10 * p_partkey + 1 FROM v_part
           UNION ALL SELECT upper(p_brand), 10 * p_partkey + 2 FROM v_part) GROUP BY lower(part)""",
)
def _(spark, sf):
    return M.union_selection(
        view(spark, sf, "SELECT part, 10 * p_partkey AS pos FROM v_part"),
        view(spark, sf, "SELECT lower(part) AS part, 10 * p_partkey + 1 AS pos FROM v_part"),
        view(spark, sf, "SELECT upper(p_brand) AS part, 10 * p_partkey + 2 AS pos FROM v_part"),
    )


@query("distinct_keys", "SELECT DISTINCT query AS part FROM v_queries")
def _(spark, sf):
    return M.distinct_keys(view(spark, sf, "SELECT query AS part FROM v_queries"))


@query(
    "lookup_parts",
    """SELECT DISTINCT q.query AS request, k.part, k.family FROM v_queries q
       JOIN v_keys k ON lower(k.part) = lower(q.query)
       UNION SELECT lower(k.part), k.part, k.family FROM v_keys k""",
)
def _(spark, sf):
    asked = view(spark, sf, """SELECT query AS part FROM v_queries
                               UNION ALL SELECT lower(part) FROM v_keys""")
    return M.lookup_parts(view(spark, sf, "v_keys"), asked)


@query(
    "part_variants",
    """SELECT DISTINCT q.query AS request, coalesce(k.family || ',v', '') AS variants
       FROM (SELECT query FROM v_queries UNION ALL SELECT lower(part) FROM v_keys) q
       LEFT JOIN v_keys k ON lower(k.part) = lower(q.query)""",
)
def _(spark, sf):
    asked = view(spark, sf, """SELECT query AS part FROM v_queries
                               UNION ALL SELECT lower(part) FROM v_keys""")
    catalog = view(spark, sf, "v_keys").select("part", F.array("family", F.lit("v")).alias("variants"))
    rows = M.part_variants(catalog, asked)
    return rows.withColumn("variants", F.array_join("variants", ","))


SCORE_SQL = f"""
    CASE WHEN lower(k.part) = q.q THEN 1.0
         WHEN contains(lower(k.part), 'x') AND {ALIAS_HIT} THEN 0.98
         WHEN lower(k.family) = q.q THEN 0.95
         WHEN starts_with(lower(k.part), q.q) OR ({PREFIX_HIT}) THEN 0.90
         WHEN starts_with(lower(k.family), q.q) THEN 0.85
         WHEN contains(lower(k.part), q.q) THEN 0.70
         WHEN contains(lower(k.family), q.q) THEN 0.65 END"""
RANKED_SQL = f"""
    SELECT query, part, family, CAST(score AS double) AS score,
           CASE WHEN score IN (0.95, 0.85, 0.65) THEN 'family' ELSE 'part' END AS matched_field,
           rank FROM (
        SELECT *, row_number() OVER (PARTITION BY query
                                     ORDER BY score DESC, lower(part), part, family) AS rank
        FROM (SELECT q.query, k.part, k.family, {SCORE_SQL} AS score
              FROM {QUERY_SQL} q, (SELECT DISTINCT part, family FROM v_keys) k)
        WHERE score IS NOT NULL) WHERE rank <= 50"""


def ranked(spark, sf, body="v_queries", **options):
    hits = S.ranked_search(view(spark, sf, body), view(spark, sf, "v_keys"), **options)
    return hits.withColumn("rank", F.col("rank").cast("bigint"))


@query("ranked_search", RANKED_SQL)
def _(spark, sf):
    return ranked(spark, sf)


# Characters with their running count; intersections of such lists count common characters.
def _bag(text: str) -> str:
    return f"""list_transform(range(1, length({text}) + 1), lambda i: concat(substr({text}, i, 1),
        length(substr({text}, 1, i)) - length(replace(substr({text}, 1, i), substr({text}, i, 1), ''))))"""


# The longest block of two texts that is earliest in a, as 1000 * its length - its start.
BLOCK_SQL = """coalesce(list_max(list_transform(range(1, length(a) + 1), lambda i: 1000 * list_max(
        list_transform(range(0, length(a) - i + 2), lambda n: CASE WHEN contains(b, substr(a, i, n)) THEN n ELSE 0 END)) - i)), 0)"""


def ratio_sql(pairs: str) -> str:
    """SQL of (q, k, ratio) for the (q, k) of ``pairs``: the longest common block, then the
    same on both of its sides."""
    return f"""pairs AS ({pairs}),
    open AS (
        SELECT q, k, a, b, {BLOCK_SQL} AS block FROM (SELECT q, k, q AS a, k AS b FROM pairs)
        UNION ALL
        SELECT q, k, a, b, {BLOCK_SQL} AS block FROM (
            SELECT q, k, unnest([substr(a, 1, i - 1), substr(a, i + n)]) AS a,
                   unnest([substr(b, 1, j - 1), substr(b, j + n)]) AS b
            FROM (SELECT *, strpos(b, substr(a, i, n)) AS j FROM (
                SELECT *, (block + 999) // 1000 AS n, (block + 999) // 1000 * 1000 - block AS i FROM open WHERE block > 0)))
        WHERE a <> '' AND b <> ''),
    ratios AS (
        SELECT q, k, CAST(2 * coalesce(sum((block + 999) // 1000) FILTER (WHERE block > 0), 0) AS double) / (length(q) + length(k)) AS ratio
        FROM open GROUP BY q, k)"""


# Pairs whose common characters can reach the threshold, and their ratios.
FUZZY_SQL = f"""
    asked AS (SELECT DISTINCT lower(trim(query)) AS q FROM v_queries WHERE trim(query) <> ''),
    named AS (SELECT lower(part) AS k FROM v_keys UNION SELECT lower(family) FROM v_keys),
    asked_bags AS (SELECT q, length(q) AS a, {_bag("q")} AS q_bag FROM asked),
    named_bags AS (SELECT k, length(k) AS b, {_bag("k")} AS k_bag FROM named),
    """ + ratio_sql("""
        SELECT q, k FROM asked_bags JOIN named_bags ON 2 * least(a, b) >= 0.549 * (a + b)
        WHERE 2 * len(list_intersect(q_bag, k_bag)) >= 0.549 * (a + b)""") + f""",
    keys AS (SELECT DISTINCT part, family FROM v_keys),
    led AS (
        SELECT q, part, family, ratio AS by_part, CAST(0 AS double) AS by_family FROM ratios JOIN keys ON lower(part) = k WHERE ratio >= 0.55
        UNION ALL
        SELECT q, part, family, CAST(0 AS double), ratio FROM ratios JOIN keys ON lower(family) = k WHERE ratio >= 0.55),
    near AS (
        SELECT q, part, family, max(by_part) AS by_part, max(by_family) AS by_family FROM led GROUP BY q, part, family),
    alike AS (
        SELECT q.q, k.part, k.family, 0.6 * greatest(by_part, by_family) AS score,
               CASE WHEN by_part >= by_family THEN 'part' ELSE 'family' END AS matched_field
        FROM (SELECT q, part, family, by_part, by_family FROM near) k JOIN asked q ON q.q = k.q WHERE {SCORE_SQL} IS NULL)"""
RAW_SQL = "(SELECT DISTINCT query, lower(trim(query)) AS q FROM v_queries)"
RANKED_FUZZY_SQL = f"""WITH RECURSIVE {FUZZY_SQL},
    scored AS (
        SELECT q.q, k.part, k.family, CAST({SCORE_SQL} AS double) AS score
        FROM asked q, keys k),
    hits AS (
        SELECT q, part, family, score, CASE WHEN score IN (0.95, 0.85, 0.65) THEN 'family' ELSE 'part' END AS matched_field
        FROM scored WHERE score IS NOT NULL
        UNION ALL SELECT q, part, family, score, matched_field FROM alike),
    best AS (
        SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, lower(part), part, family) AS rank FROM hits)
    SELECT query, part, family, score, matched_field, rank FROM best JOIN {RAW_SQL} USING (q) WHERE rank <= 50"""


@query(
    "fuzzy_ratios",
    f"""WITH RECURSIVE {ratio_sql("SELECT DISTINCT lower(p_name) AS q, lower(s_name) AS k FROM {part}, {supplier} WHERE s_suppkey % 10 = p_size % 10")}
        SELECT q, k, ratio FROM ratios""",
)
def _(spark, sf):
    """Ratios of names of parts and of suppliers, whatever they come to."""
    from partatlas.functions.pyudf import fuzzy_ratio

    # A name is met once, with the digits it has; of those a pair shares, the least one makes it.
    asked = view(spark, sf, "SELECT lower(p_name) AS q, collect_set(CAST(p_size % 10 AS bigint)) AS q_digits FROM {part} GROUP BY 1")
    named = view(spark, sf, "SELECT lower(s_name) AS k, collect_set(CAST(s_suppkey % 10 AS bigint)) AS k_digits FROM {supplier} GROUP BY 1")
    # A digit's pairs are made in pieces of its names, so that no task has all of them.
    asked = asked.withColumn("digit", F.explode("q_digits")).withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(31))))
    named = named.withColumn("digit", F.explode("k_digits")).withColumn("piece", F.pmod(F.xxhash64("k"), F.lit(32)).cast("int"))
    pairs = asked.join(named, ["digit", "piece"]).filter(
        F.col("digit") == F.array_min(F.array_intersect("q_digits", "k_digits"))).select("q", "k")
    return pairs.repartition("q", "k").withColumn("ratio", fuzzy_ratio("q", "k"))


@query(
    "fuzzy_join",
    f"""WITH RECURSIVE {FUZZY_SQL}
        SELECT query, part, family, score, matched_field FROM alike JOIN {RAW_SQL} USING (q)""",
)
def _(spark, sf):
    return S.fuzzy_join(view(spark, sf, "v_queries"), view(spark, sf, "v_keys"))


@query("ranked_search_fuzzy", RANKED_FUZZY_SQL)
def _(spark, sf):
    return ranked(spark, sf, fuzzy=True)


@query(
    "portfolio_prefix_selection",
    f"SELECT family FROM ({PORTFOLIO_SQL}) WHERE lower(family) LIKE 'f2%'",
)
def _(spark, sf):
    from partatlas.operators.releases import name_prefix

    return name_prefix(portfolio(spark, sf), "F2").select("family")


@query("nonblank_queries", "SELECT DISTINCT trim(lower(query)) AS q FROM v_queries WHERE trim(query) <> ''")
def _(spark, sf):
    return M.distinct_queries(view(spark, sf, "v_queries"))


@query("strip_names", "SELECT pos, trim(query) AS name FROM v_queries")
def _(spark, sf):
    return view(spark, sf, "v_queries").select("pos", strip("query").alias("name"))
