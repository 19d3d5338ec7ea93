from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from partatlas.operators import corpus as C
from partatlas.operators import details as D
from partatlas.plans.bulk import build_and_store_catalog, corpus_report, details_for, plan_fetch
from partatlas.plans.roadmap import roadmap
from partatlas.session import work_dir
from partatlas.sources.catalog import read_catalog
from partatlas.sources.spine import properties
from partatlas.sources.trees import scan_tree

HEADER = """<?xml version="1.0" encoding="UTF-8"?>
<!-- head --><p:processor xmlns:p="http://v.example/XSD/processor/2.0"
   xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance" xsi:schemaLocation="a b">
  <basic_facts id="{part}" producer="ACME" family="FAM" series="S &amp; T"/>
  <target_products><product> One </product><product/><product>Two</product></target_products>
  <enabled_tools><enabled_tool>Pins</enabled_tool><other>no</other></enabled_tools>
  <deep><basic_facts id="wrong"/></deep>
</p:processor>"""
CORES = """<c:cores xmlns:c="http://v.example/XSD/processor/2.0/">
  <core name="{core}" id="c0" description="main"/><core name="DSP"/><nest><core name="Cortex-A9"/></nest></c:cores>"""
MANIFEST = """<part_number xmlns="http://v.example/XSD/part_number/4.0" {id}>
  <db_link type="part_info" link="i"/><db_link type="package" link="packages/{p}.xml" format_version="1.0"/>
  <db_link type="package" link="second"/></part_number>"""


def write(root, release, part, variant, files):
    base = root / release / "processors" / part / variant
    for name, text in files.items():
        path = base / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    root = tmp_path_factory.mktemp("store")
    full = {
        "P1.xml": HEADER.format(part="P1"),
        "common/cores_info.xml": CORES.format(core="Cortex-M33"),
        "processor.properties": "; c\n#x=1\n\n a = 1 \r\nb==2\nnone\na=3 k=v",
        "P1_R64.xml": MANIFEST.format(id='id="P1_R64"', p="R64"),
        "P1_R64/part_info.xml": "<part_info/>",
        "P1_R20.xml": MANIFEST.format(id='id="P1_R20"', p="R20"),
        "P1_R20/part_info.xml": "<part_info/>",
        "P1_LOOSE.xml": MANIFEST.format(id="", p="L"),
        "P1_LOOSE/other.xml": "<r xmlns='ignored'/>",
        "P1_ALONE/part_info.xml": "<part_info/>",
        "security/s.xml": '<s xmlns="http://v.example/XSD/clocks/1.2"/>',
        "scripts/pins/zephyr_pins_print_code.js": "js",
        "scripts/top.js": "js",
    }
    write(root, "26.3", "P1", "ksdk2_0", full)
    write(root, "26.3", "P1", "zephyr3_2", {
        "P1.xml": HEADER.format(part="P1"), "common/cores_info.xml": CORES.format(core="Cortex-A55"),
        "only.txt": "x"})
    write(root, "26.3", "P2", "i_mx_2_0", {"P2.xml": "<processor/>", "a.xml": "<a>"})
    write(root, "26.3", "P3", "ksdk2_0", {"common/cores_info.xml": "<cores/>"})
    write(root, "26.3", "P4", "ksdk2_0", {"P4.xml": "<processor><basic_facts/>"})
    write(root, "26.3", "P5", "ksdk2_0", {
        "P5.xml": HEADER.format(part="P5"), "P5_A.xml": MANIFEST.format(id="", p="A"), "P5_A/part_info.xml": "<i/>"})
    return root


@pytest.fixture
def tree(spark, root):
    return scan_tree(spark, str(root))


def by_key(df):
    return {(r.part, r.variant): r for r in df.collect()}


def test_details(tree):
    got = by_key(D.assemble_details(D.with_text(tree)))
    row = got["P1", "ksdk2_0"]
    assert row.status == "ok" and not row.is_application_processor
    assert row.header.asDict() == {
        "part": "P1", "producer": "ACME", "family": "FAM", "series": "S & T", "default_part": "",
        "target_products": ["One", "Two"], "enabled_tools": ["Pins"]}
    assert [tuple(c) for c in row.cores] == [("Cortex-M33", "c0", "main"), ("DSP", "", "")]
    assert row.properties == {"a": "3", "b": "=2", "k": "v"}
    assert [(v.variant, v.package, v.directory) for v in row.variants] == [
        ("P1_R20", "packages/R20.xml", "P1_R20"), ("P1_R64", "packages/R64.xml", "P1_R64")]
    assert got["P1", "zephyr3_2"].is_application_processor
    assert got["P1", "zephyr3_2"].properties == {} and got["P1", "zephyr3_2"].variants == []
    assert {k: r.status for k, r in got.items() if k[0] != "P1"} == {
        ("P2", "i_mx_2_0"): "bad_header", ("P3", "ksdk2_0"): "missing_header",
        ("P4", "ksdk2_0"): "bad_header", ("P5", "ksdk2_0"): "bad_manifest"}


def test_package_variants_strict_and_loose(tree):
    text = D.with_text(tree)
    strict = D.package_variants(text).filter("part = 'P1'").select(
        "directory", "package_variant", "ok",
        D.link_by_type("db_links", "package").link.alias("first"),
        D.link_by_type("db_links", "none").isNull().alias("missing")).collect()
    assert {tuple(r) for r in strict} == {
        ("P1_R64", "P1_R64", True, "packages/R64.xml", True), ("P1_R20", "P1_R20", True, "packages/R20.xml", True)}
    loose = C.layout_variants(tree).filter("part = 'P1'").select("package").collect()
    assert {r.package for r in loose} == {"P1_R64", "P1_R20", "P1_LOOSE"}


def test_details_with_fetched_keeps_errors(tree):
    rows = D.details_with_fetched(D.assemble_details(D.with_text(tree)), C.variant_summary(tree))
    got = {r.part: r for r in rows.collect()}
    assert got["P1"].variant == "ksdk2_0" and got["P1"].error is None
    assert [(f.variant, f.files) for f in got["P1"].fetched_variants] == [("ksdk2_0", 13), ("zephyr3_2", 3)]
    assert got["P2"].variant == "i_mx_2_0" and got["P2"].error == "bad_header" and got["P2"].details is None


def test_details_for_free_form_names(tree, table):
    portfolio = table("family string, version string", ("P1", "26.3"), ("P3", "26.3"), ("P9", "26.3"))
    asked = table("query string", (" p1 ",), ("p9",), ("p",), ("zz",))
    got = {r.query: r for r in details_for(asked, portfolio, tree).collect()}
    assert {q: r.status for q, r in got.items()} == {
        " p1 ": "ok", "p9": "missing_tree", "p": "ambiguous", "zz": "unknown"}
    assert got[" p1 "].header.producer == "ACME"


def test_roadmap(tree):
    text = D.with_text(tree)
    got = by_key(roadmap(tree, text))
    row = got["P1", "ksdk2_0"]
    assert row.key_files == {"header": "P1.xml", "cores_info": "common/cores_info.xml",
                             "processor_properties": "processor.properties"}
    assert row.optional_sections.asDict() == {"security": True, "dcdx": False, "ddr": False, "mem_validation": False}
    assert [v.variant for v in row.package_variants] == ["P1_LOOSE", "P1_R20", "P1_R64"]
    assert row.codegen.scripts_root == "scripts/" and row.codegen.categories == ["pins"]
    assert row.codegen.devicetree == {"pins": "scripts/pins/zephyr_pins_print_code.js"}
    spaces = [(n.family, n.version, n.prefix, n.label) for n in row.xml_namespaces]
    assert spaces == sorted(spaces, key=lambda s: s[:3])
    assert ("clocks", "1.2", "", "clocks") in spaces and ("processor", "2.0", "p", "processor") in spaces
    assert ("", "", "xsi", None) in spaces and not any(n.uri == "ignored" for n in row.xml_namespaces)
    bare = got["P3", "ksdk2_0"]
    assert bare.codegen.scripts_root is None and bare.xml_namespaces == [] and len(bare.guide) < len(row.guide)


def test_sizes(tree, spark):
    total = C.total_size(tree).first().size_bytes
    summary = C.variant_summary(tree)
    rows = C.summary_totals(summary).collect()
    last = [r for r in rows if r.is_total]
    assert len(last) == 1 and (last[0].parts, last[0].variants, last[0].size_bytes) == (5, 6, total)
    assert C.total_size(tree.filter("part = 'none'")).first().size_bytes == 0
    census = {r.part: r for r in C.tree_census(tree).collect()}
    assert census["P1"].package_variants == 3 and census[None].files == last[0].files


def test_variant_diff(tree):
    rows = C.variant_diff(tree, "ksdk2_0", "zephyr3_2").filter("part = 'P1'").collect()
    status = {r.relpath: r.status for r in rows}
    assert status["P1.xml"] == "identical" and status["common/cores_info.xml"] == "different"
    assert status["only.txt"] == "only_right" and status["processor.properties"] == "only_left"


def test_fetch_plan(tree, table):
    portfolio = table("family string, version string", ("P1", "26.3"), ("P3", "26.3"), ("Q7", "25.1"))
    keys = tree.select("release", "part", "variant")
    inputs = table("pos long, query string", (0, "p1"), (1, "Q"))
    plan = plan_fetch(portfolio, keys, inputs)
    assert {tuple(r) for r in plan.pending.collect()} == {
        ("26.3", "P1", "i_mx_2_0"), ("25.1", "Q7", "ksdk2_0"), ("25.1", "Q7", "zephyr3_2"), ("25.1", "Q7", "i_mx_2_0")}
    by_prefix = plan_fetch(portfolio, keys, prefix="p", variants=["ksdk2_0"], version="99").pending
    assert {tuple(r) for r in by_prefix.collect()} == {("99", "P1", "ksdk2_0"), ("99", "P3", "ksdk2_0")}
    assert plan_fetch(portfolio, keys, prefix="P1", force=True).pending.count() == 3
    everything = plan_fetch(portfolio, keys)
    assert everything.pending.count() == 6 and everything.selection.unresolved.count() == 0
    none = plan_fetch(portfolio, keys, table("pos long, query string", (0, "p1"), (1, "nope")))
    assert none.pending.count() == 0


def test_report(tree):
    report = corpus_report(tree, exclude=["security/*"])
    assert report.details.count() == 5 and report.roadmap.count() == 6
    layout = {r.part: r for r in report.layout.collect()}
    assert layout["P1"].mirrored and layout["P1"].xml_variants == ["ksdk2_0", "zephyr3_2"]
    assert layout["P1"].files_written == {"ksdk2_0": 9, "zephyr3_2": 2}
    assert not layout["P4"].mirrored and layout["P4"].files_written == {"ksdk2_0": 0}


def test_catalogue_job(spark, table):
    releases = table("api_id long, name string, version string", (1, "26.3", "v"))
    listing = table("release string, full_path string, directory boolean, name string",
                    ("26.3", "/processors/F", True, "F"), ("26.3", "/processors/F/ksdk2_0/x", False, "x"))
    path = work_dir(spark, "job")
    build_and_store_catalog(releases, listing, path, probe=True)
    assert [(r.part, r.variants) for r in read_catalog(spark, path).collect()] == [("F", ["ksdk2_0"])]


def test_properties_agree_with_plain_python(values):
    texts = ["", "=v", "a=1\na=2\nb", "k\x0b=\x0cv\x85x=y", " ;a=b\n # c=d\n e = f = g ", "a=\na=1\r\rb=2\r\n", "x=1\ty=2"]

    def plain(text):
        out = {}
        for line in text.splitlines():
            line = line.strip()
            if line and line[0] not in ";#" and "=" in line:
                key, _, value = line.partition("=")
                out[key.strip()] = value.strip()
        return out

    assert values(properties, *texts) == [plain(t) for t in texts]


def test_spine_scan_reads_paths_only(tree):
    plan = C.variant_summary(tree)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("FileScan binaryFile")[1].split("]")[0]


def test_missing_content_column_is_not_needed(tree):
    assert C.key_files(tree.drop("content")).filter(F.col("part") == "P1").count() == 5


def test_spaces_inside_attributes_stay(table):
    rows = table("release string, part string, variant string, relpath string, xml string",
                 ("1", "P", "v", "P.xml", '<p><basic_facts id=" P " producer="A  B"/><target_products>'
                  "<product>  x </product></target_products></p>"),
                 ("1", "P", "v", "common/cores_info.xml", '<c><core name=" M4 " id="0 "/></c>'))
    row = D.assemble_details(rows).first()
    assert (row.header.part, row.header.producer, row.header.target_products) == (" P ", "A  B", ["x"])
    assert [(c.name, c.core_id) for c in row.cores] == [(" M4 ", "0 ")]


def test_a_tree_without_any_spine_file_has_a_row(table):
    rows = table("release string, part string, variant string, relpath string, xml string",
                 ("1", "P", "v", "docs/readme.txt", "x"), ("1", "P", "v", "registers/a.xml", "<a/>"))
    got = D.assemble_details(rows).collect()
    assert [(r.part, r.status, r.cores, r.variants) for r in got] == [("P", "missing_header", [], [])]


def test_newest_release_of_the_canonical_variant(table):
    summary = table("release string, part string, variant string, files long, size_bytes long",
                    ("25.12", "P", "ksdk2_0", 1, 1), ("26.3", "P", "ksdk2_0", 1, 1), ("26.10", "P", "ksdk2_0", 1, 1),
                    ("27.1", "P", "zephyr3_2", 1, 1), ("9.9", "Q", "zephyr3_2", 1, 1), ("10.1", "Q", "zephyr3_2", 1, 1))
    tree = table("release string, part string, variant string, relpath string, xml string")
    got = {r.part: (r.variant, r.release, len(r.fetched_variants))
           for r in D.details_with_fetched(D.assemble_details(tree), summary).collect()}
    assert got == {"P": ("ksdk2_0", "26.10", 4), "Q": ("zephyr3_2", "10.1", 2)}


def test_totals_of_nothing(table):
    tree = table("release string, part string, variant string, relpath string, length long")
    row = C.summary_totals(C.variant_summary(tree)).first()
    assert (row.is_total, row.parts, row.variants, row.files, row.size_bytes) == (True, 0, 0, 0, 0)
    assert [(r.is_total, r.files) for r in C.tree_census(tree).collect()] == [(True, 0)]
