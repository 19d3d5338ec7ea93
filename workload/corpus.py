"""Registered queries that profile the corpus and convert it to JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from partatlas.functions.pyudf import xml_to_json
from partatlas.operators import corpus as C
from partatlas.operators import mirror as X
from partatlas.plans.roadmap import roadmap
from partatlas.session import work_dir
from partatlas.sources import catalog as cat
from partatlas.sources.archives import scan_archive_rows
from partatlas.sources.trees import read_tree, split_store_path, tree_keys, write_tree
from partatlas.streaming.ingest import incremental_ingest
from workload.registry import query
from workload.views import spark_text
from workload.views import spark_view as view

KEY = "release, part, variant"


def tree(spark, sf):
    return view(spark, sf, "v_tree")


@query(
    "store_paths",
    """SELECT doc_id, release, part, variant, relpath FROM v_tree""",
)
def _(spark, sf):
    path = F.concat_ws("/", F.lit("file:/data"), "release", F.lit("processors"), "part", "variant", "relpath")
    return tree(spark, sf).select("doc_id", path.alias("path")).select("doc_id", *split_store_path("path"))


@query("tree_keys", f"SELECT DISTINCT {KEY} FROM v_tree")
def _(spark, sf):
    return tree_keys(tree(spark, sf))


@query("stored_tree", "SELECT release, part, variant, relpath, length, sha256(xml) AS digest FROM v_tree")
def _(spark, sf):
    path = work_dir(spark, "tree")
    rows = tree(spark, sf).withColumn("content", F.col("xml").cast("binary"))
    write_tree(rows.select("release", "part", "variant", "relpath", "length", "content"), path)
    return read_tree(spark, path).select(
        F.col("release").cast("string"), "part", "variant", "relpath", "length",
        F.sha2("content", 256).alias("digest"),
    )


@query("total_size", "SELECT CAST(sum(length) AS bigint) AS size_bytes FROM v_tree")
def _(spark, sf):
    return C.total_size(tree(spark, sf))


SUMMARY_SQL = f"SELECT {KEY}, count(*) AS files, CAST(sum(length) AS bigint) AS size_bytes FROM v_tree GROUP BY {KEY}"


@query("variant_summary", SUMMARY_SQL)
def _(spark, sf):
    return C.variant_summary(tree(spark, sf))


@query(
    "summary_totals",
    f"""SELECT false AS is_total, {KEY}, 1 AS parts, 1 AS variants, files, size_bytes FROM ({SUMMARY_SQL})
        UNION ALL SELECT true, NULL, NULL, NULL, count(DISTINCT part), count(*),
                         CAST(sum(files) AS bigint), CAST(sum(size_bytes) AS bigint) FROM ({SUMMARY_SQL})""",
)
def _(spark, sf):
    return C.summary_totals(C.variant_summary(tree(spark, sf)))


@query(
    "canonical_variant",
    """SELECT part, arg_min(variant, struct_pack(o := variant <> 'ksdk2_0', p := doc_id)) AS variant,
              arg_min(doc_id, struct_pack(o := variant <> 'ksdk2_0', p := doc_id)) AS pos
       FROM v_tree GROUP BY part""",
)
def _(spark, sf):
    return C.canonical_variant(tree(spark, sf).select("part", "variant", F.col("doc_id").alias("pos")))


REQUESTS = """
    SELECT DISTINCT concat('26.', CAST(p % 3 AS string)) AS release, part,
           CASE v WHEN 0 THEN 'ksdk2_0' WHEN 1 THEN 'zephyr3_2' ELSE 'i_mx_2_0' END AS variant
    FROM v_docs"""


@query(
    "pending_requests",
    f"SELECT {KEY} FROM ({REQUESTS}) EXCEPT SELECT {KEY} FROM v_tree",
)
def _(spark, sf):
    return C.pending_requests(view(spark, sf, REQUESTS), tree(spark, sf))


LOOSE_SQL = f"""
    SELECT DISTINCT m.release, m.part, m.variant, m.d AS package
    FROM (SELECT {KEY}, replace(relpath, '.xml', '') AS d FROM v_tree
          WHERE relpath LIKE '%.xml' AND relpath NOT LIKE '%/%') m
    JOIN (SELECT {KEY}, string_split(relpath, '/')[1] AS d FROM v_tree WHERE relpath LIKE '%/%') f
      ON m.release = f.release AND m.part = f.part AND m.variant = f.variant AND m.d = f.d"""


@query(
    "layout_variants",
    f"SELECT {KEY}, package, concat(package, '/') AS directory, concat(package, '.xml') AS manifest FROM ({LOOSE_SQL})",
)
def _(spark, sf):
    return C.layout_variants(tree(spark, sf))


KEY_FILES_SQL = f"""
    SELECT {KEY}, CASE WHEN relpath = concat(part, '.xml') THEN 'header'
               WHEN relpath = 'common/cores_info.xml' THEN 'cores_info'
               WHEN relpath = 'processor.properties' THEN 'processor_properties'
               ELSE 'module_clocks' END AS name, relpath
    FROM v_tree WHERE relpath IN (concat(part, '.xml'), 'common/cores_info.xml',
                                  'processor.properties', 'module_clocks.xml')"""


@query("key_files", KEY_FILES_SQL)
def _(spark, sf):
    return C.key_files(tree(spark, sf))


@query(
    "optional_sections",
    f"""SELECT {KEY}, bool_or(relpath LIKE 'security/%') AS security, bool_or(relpath LIKE 'dcdx/%') AS dcdx,
               bool_or(relpath LIKE 'ddr/%') AS ddr, bool_or(relpath LIKE 'mem!_validation/%' ESCAPE '!') AS mem_validation
        FROM v_tree GROUP BY {KEY}""",
)
def _(spark, sf):
    return C.optional_sections(tree(spark, sf))


@query(
    "codegen_inventory",
    f"""SELECT {KEY}, bool_or(relpath LIKE 'scripts/%') AS has_scripts,
               CASE WHEN bool_or(relpath LIKE 'scripts/pins/%') THEN 'pins' ELSE '' END AS categories,
               bool_or(relpath = 'scripts/pins/zephyr_pins_print_code.js') AS devicetree_pins,
               bool_or(relpath = 'scripts/pins/zephyr_defines_objects.js') AS devicetree_defines
        FROM v_tree GROUP BY {KEY}""",
)
def _(spark, sf):
    return C.codegen_inventory(tree(spark, sf)).withColumn("categories", F.array_join("categories", ","))


CENSUS_SQL = f"""
    SELECT part, count(*) AS files, count(*) FILTER (relpath LIKE '%.xml') AS xml_files,
           coalesce(any_value(n), 0) AS package_variants,
           count(*) FILTER (relpath LIKE 'registers/%.xml') AS register_xmls
    FROM v_tree LEFT JOIN (SELECT part AS k, count(*) AS n FROM ({LOOSE_SQL}) GROUP BY part) ON k = part GROUP BY part"""


@query(
    "tree_census",
    f"""SELECT false AS is_total, * FROM ({CENSUS_SQL})
        UNION ALL SELECT true, NULL, CAST(sum(files) AS bigint), CAST(sum(xml_files) AS bigint),
                         CAST(sum(package_variants) AS bigint), CAST(sum(register_xmls) AS bigint) FROM ({CENSUS_SQL})""",
)
def _(spark, sf):
    return C.tree_census(tree(spark, sf))


DIFF_SQL = """
    SELECT coalesce(a.release, b.release) AS release, coalesce(a.part, b.part) AS part,
           coalesce(a.relpath, b.relpath) AS relpath,
           CASE WHEN b.part IS NULL THEN 'only_left' WHEN a.part IS NULL THEN 'only_right'
                WHEN a.content = b.content THEN 'identical' ELSE 'different' END AS status
    FROM (SELECT * FROM v_shared WHERE variant = 'ksdk2_0') a
    FULL JOIN (SELECT * FROM v_shared WHERE variant = 'zephyr3_2') b
      ON a.release = b.release AND a.part = b.part AND a.relpath = b.relpath"""


def diff(spark, sf):
    return C.variant_diff(view(spark, sf, "SELECT * FROM v_shared"), "ksdk2_0", "zephyr3_2")


@query("variant_diff", DIFF_SQL)
def _(spark, sf):
    return diff(spark, sf)


@query(
    "variant_diff_counts",
    f"SELECT release, part, status, count(*) AS files FROM ({DIFF_SQL}) GROUP BY release, part, status",
)
def _(spark, sf):
    return C.variant_diff_counts(diff(spark, sf))


NS_SQL = f"""
    SELECT DISTINCT {KEY}, p AS prefix, u AS uri FROM (
        SELECT {KEY}, unnest(regexp_extract_all(head, 'xmlns(?::([[:word:].-]+))?[ ]*=[ ]*"([^"]+)"', 1)) AS p,
               unnest(regexp_extract_all(head, 'xmlns(?::([[:word:].-]+))?[ ]*=[ ]*"([^"]+)"', 2)) AS u
        FROM (SELECT {KEY}, xml AS head FROM v_tree WHERE relpath LIKE '%.xml'))"""
NS_SQL = NS_SQL.replace("p AS prefix", "coalesce(p, '') AS prefix")
NS_FULL_SQL = f"""
    SELECT *, CASE WHEN family IN ('registers', 'clocks', 'part_number', 'processor', 'dcd') THEN family
                   WHEN family = 'pinsModel' THEN 'pins_model' END AS label
    FROM (SELECT *, CASE WHEN ok THEN s[-2] END AS family, CASE WHEN ok THEN s[-1] END AS version
          FROM (SELECT *, regexp_full_match(s[-1], '[0-9]+([.][0-9]+)*') AS ok
                FROM (SELECT *, string_split(rtrim(uri, '/'), '/') AS s FROM ({NS_SQL}))))"""


@query("namespace_declarations", NS_SQL)
def _(spark, sf):
    return C.namespace_declarations(tree(spark, sf))


@query(
    "namespace_inventory",
    f"SELECT {KEY}, prefix, uri, family, version, label FROM ({NS_FULL_SQL})",
)
def _(spark, sf):
    return C.namespace_inventory(tree(spark, sf))


@query(
    "roadmap",
    f"""WITH ns AS (SELECT {KEY}, string_agg(concat(coalesce(family, ''), '|', coalesce(version, ''), '|', prefix, '|', uri), ' '
                        ORDER BY coalesce(family, ''), coalesce(version, ''), prefix, uri) AS spaces FROM ({NS_FULL_SQL}) GROUP BY {KEY}),
             kf AS (SELECT {KEY}, string_agg(concat(name, ':', relpath), ' ' ORDER BY name) AS files FROM ({KEY_FILES_SQL}) GROUP BY {KEY}),
             pv AS (SELECT {KEY}, string_agg(package, ' ' ORDER BY package) AS packages FROM ({LOOSE_SQL}) GROUP BY {KEY}),
             t AS (SELECT {KEY}, bool_or(relpath LIKE 'security/%') AS security, bool_or(relpath LIKE 'ddr/%') AS ddr,
                          bool_or(relpath LIKE 'scripts/%') AS scripts FROM v_tree GROUP BY {KEY})
        SELECT t.release, t.part, t.variant, coalesce(spaces, '') AS spaces, coalesce(files, '') AS files,
               coalesce(packages, '') AS packages, security, ddr, CASE WHEN scripts THEN 'scripts/' END AS scripts_root,
               5 + CASE WHEN packages IS NULL THEN 0 ELSE 1 END + CASE WHEN scripts THEN 1 ELSE 0 END
                 + CASE WHEN security OR ddr THEN 1 ELSE 0 END AS steps
        FROM t LEFT JOIN ns USING (release, part, variant) LEFT JOIN kf USING (release, part, variant)
        LEFT JOIN pv USING (release, part, variant)""",
)
def _(spark, sf):
    rows = roadmap(tree(spark, sf), tree(spark, sf))
    spaces = F.transform("xml_namespaces", lambda n: F.concat_ws("|", n.family, n.version, n.prefix, n.uri))
    files = F.transform(F.array_sort(F.map_entries("key_files")), lambda e: F.concat_ws(":", e.key, e.value))
    return rows.select(
        "release", "part", "variant",
        F.array_join(spaces, " ").alias("spaces"),
        F.array_join(files, " ").alias("files"),
        F.array_join(F.transform("package_variants", lambda p: p.variant), " ").alias("packages"),
        "optional_sections.security", "optional_sections.ddr", "codegen.scripts_root",
        F.size("guide").alias("steps"),
    )


@query("roadmap_records")
def _(spark, sf):
    return cat.record_json(roadmap(tree(spark, sf), tree(spark, sf)))


@query(
    "glob_filter",
    """SELECT doc_id, relpath FROM v_tree
       WHERE (relpath GLOB 'registers/*.xml' OR relpath GLOB '*/*_info.xml' OR relpath GLOB 'P[0-9]*')
         AND NOT relpath GLOB '*src1?.xml'""",
)
def _(spark, sf):
    rows = X.glob_filter(tree(spark, sf), ["registers/*.xml", "*/*_info.xml", "P[0-9]*"], ["*src1?.xml"])
    return rows.select("doc_id", "relpath")


@query(
    "mirror_paths",
    """SELECT doc_id, concat(release, '/', part, '/json/', variant, '/', regexp_replace(relpath, '[.]xml$', '.json')) AS path FROM v_tree""",
)
def _(spark, sf):
    return tree(spark, sf).select("doc_id", X.mirror_path().alias("path"))


# Conversion of white space around text is part of the operator.
DOC_JSON = """
    concat('{"doc":{"@_xmlns":{"d":"http://vendor.example/XSD/registers/1.2"},"@source":', CAST(to_json(source) AS string),
           ',"@lang":', CAST(to_json(lang) AS string), ',"p":[',
           coalesce(CAST(to_json(nullif(regexp_replace(text, '^[[:space:]]+|[[:space:]]+$', '', 'g'), '')) AS string), 'null'),
           ',"', CAST(n_chars AS string), '"],"e":null,"n":"k"}}')"""


@query("xml_to_json", f"SELECT doc_id, {DOC_JSON} AS json FROM v_doc_xml")
def _(spark, sf):
    return view(spark, sf, "SELECT doc_id, xml FROM v_doc_xml").select("doc_id", xml_to_json("xml").alias("json"))


def broken(spark, sf):
    """Trees in two releases, with the last character cut off some documents."""
    return view(spark, sf, """SELECT release, part, variant, relpath,
        CASE WHEN n_chars % 4 = 0 THEN substr(xml, 1, length(xml) - 1) ELSE xml END AS xml FROM v_again""")


# Documents of the plainest kind as JSON, built from their parts.
MIRROR_JSON = """
    concat('{"registers":{"@_xmlns":{"r":"http://vendor.example/XSD/',
           CASE p % 3 WHEN 0 THEN 'registers' WHEN 1 THEN 'clocks' ELSE 'pins' END, '/1.', CAST(p % 4 AS string),
           '"},"@source":', CAST(to_json(source) AS string), ',"@lang":', CAST(to_json(lang) AS string), ',"p":[',
           coalesce(CAST(to_json(nullif(regexp_replace(text, '^[[:space:]]+|[[:space:]]+$', '', 'g'), '')) AS string), 'null'),
           ',"', CAST(n_chars AS string), '"],"e":null,"n":"k"}}')"""
MIRRORED_SQL = """
    SELECT release, part, variant, count(*) FILTER (n_chars % 4 <> 0) AS files_written FROM v_again
    WHERE relpath LIKE '%.xml' AND NOT relpath GLOB 'misc/*' GROUP BY release, part, variant"""


@query("mirror_counts", MIRRORED_SQL)
def _(spark, sf):
    return X.mirror_counts(X.mirror(broken(spark, sf), exclude=["misc/*"]))


@query(
    "stored_mirror",
    f"""SELECT release, part, variant, relpath, n_chars % 4 <> 0 AS parse_ok,
               CASE WHEN n_chars % 4 <> 0 AND slot IN (4, 6, 8, 9, 10, 12) THEN sha256({MIRROR_JSON}) END AS digest
        FROM v_again WHERE relpath LIKE '%.xml'""",
)
def _(spark, sf):
    path = work_dir(spark, "mirror")
    cat.write_mirror(X.mirror(broken(spark, sf)), path)
    schema = "release string, relpath string, path string, json string, parse_ok boolean, part string, variant string"
    rows = spark.read.schema(schema).json(path).select(
        "release", "part", "variant", "relpath", "parse_ok", F.sha2("json", 256).alias("digest"))
    plain = view(spark, sf, """SELECT release, part, variant, relpath FROM v_again
                               WHERE slot IN (4, 6, 8, 9, 10, 12) AND relpath LIKE '%.xml'""")
    key = ["release", "part", "variant", "relpath"]
    compared = rows.join(plain, key, "left_semi").unionByName(
        rows.join(plain, key, "left_anti").withColumn("digest", F.lit(None).cast("string")))
    return compared


@query(
    "part_layout",
    f"""SELECT release, part, string_agg(DISTINCT t.variant, ',' ORDER BY t.variant) AS xml_variants,
               coalesce(bool_or(files_written > 0), false) AS mirrored
        FROM (SELECT DISTINCT release, part, variant FROM v_again) t
        LEFT JOIN ({MIRRORED_SQL}) m USING (release, part, variant) GROUP BY release, part""",
)
def _(spark, sf):
    counts = X.mirror_counts(X.mirror(broken(spark, sf), exclude=["misc/*"]))
    rows = X.part_layout(C.variant_summary(view(spark, sf, "SELECT * FROM v_again")), counts)
    return rows.select("release", "part", F.array_join("xml_variants", ",").alias("xml_variants"), "mirrored")


@query(
    "record_json",
    """SELECT concat('{"n_nationkey":', CAST(n_nationkey AS string), ',"n_name":"', n_name, '","none":null}') AS value FROM nation
       UNION ALL SELECT concat('{"n_nationkey":', CAST(s_nationkey AS string), ',"n_name":"', s_name, '","none":null}') FROM supplier""",
)
def _(spark, sf):
    rows = view(spark, sf, """SELECT n_nationkey, n_name, CAST(NULL AS string) AS none FROM {nation}
                              UNION ALL SELECT s_nationkey, s_name, CAST(NULL AS string) FROM {supplier}""")
    return cat.record_json(rows)


@query("incremental_ingest", "SELECT release, part, variant, relpath, length, sha256(xml) AS digest FROM v_tree")
def _(spark, sf):
    docs = (
        spark.readStream.schema(spark.read.parquet(f"{sf}/documents.parquet").schema)
        # A stream takes the table as one file or as a folder of files if its path is a glob.
        .parquet(f"{sf}/documents.parque[t]")
    )
    docs.createOrReplaceTempView("stream_documents")
    body = "SELECT release, part, variant, relpath, length, xml FROM v_tree"
    stream = spark.sql(spark_text(body, documents="stream_documents"))
    run = work_dir(spark, "ingest")
    for _ in range(2):  # the second run finds nothing new
        incremental_ingest(stream, f"{run}/tree", f"{run}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{run}/tree").select(
        "release", "part", "variant", "relpath", "length", F.sha2("xml", 256).alias("digest"))


@query(
    "archive_members",
    """SELECT doc_id AS archive, concat('processors/', part, '/', variant, '/', relpath) AS path,
              CAST(strlen(xml) AS bigint) AS size, sha256(xml) AS digest FROM v_tree
       UNION ALL SELECT doc_id, concat('processors/', source, '/', lang, '.txt'), CAST(strlen(text) AS bigint), sha256(text) FROM v_tree""",
)
def _(spark, sf):
    from workload.zips import pack

    rows = view(spark, sf, """
        SELECT doc_id, concat('kex_tools/processors/', part, '/', variant, '/', relpath) AS a, xml,
               concat('./', source, chr(92), lang, '.txt') AS b, text FROM v_tree""")
    archives = rows.select(
        F.col("doc_id").cast("string").alias("archive"), pack("a", "xml", "b", "text").alias("content")
    )
    members = scan_archive_rows(archives).members
    return members.select(
        F.col("archive").cast("bigint"), "path", "size", F.sha2("content", 256).alias("digest")
    )


@query(
    "archive_quarantine",
    """SELECT doc_id AS archive, CASE WHEN slot = 1 THEN '../up.txt' END AS member FROM v_tree
       WHERE slot IN (0, 1, 2)""",
)
def _(spark, sf):
    from workload.zips import pack

    rows = view(spark, sf, """
        SELECT doc_id, slot, CASE slot WHEN 1 THEN '../up.txt' WHEN 2 THEN 'dir/' ELSE 'a.txt' END AS a,
               CASE slot WHEN 2 THEN '' ELSE text END AS x, 'dir2/' AS b, '' AS y FROM v_tree""")
    content = F.when(F.col("slot") == 0, F.lit("no archive").cast("binary")).otherwise(pack("a", "x", "b", "y"))
    archives = rows.select(F.col("doc_id").cast("string").alias("archive"), content.alias("content"))
    return scan_archive_rows(archives).quarantine.select(F.col("archive").cast("bigint"), "member")
