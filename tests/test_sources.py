from __future__ import annotations

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from partatlas.operators import releases as R
from partatlas.session import work_dir
from partatlas.sources import catalog as cat
from partatlas.sources.archives import scan_archives
from partatlas.sources.listings import broken_documents, listing_from_xml, scan_listing, scan_releases
from partatlas.sources.trees import read_tree, scan_tree, tree_keys, write_tree

RELEASES = """<?xml version="1.0"?>
<tool_versions>
  <tool_version><api_id>x</api_id><name>27.1.0</name><version></version></tool_version>
  <tool_version><api_id>2</api_id><name> 24.10.3 </name><version>b</version></tool_version>
  <tool_version><api_id> 1 </api_id><name>24.9.1</name><version>a</version></tool_version>
  <tool_version><api_id>4</api_id><name></name><version>v4</version></tool_version>
</tool_versions>"""


def listing_xml(*entries):
    rows = "".join(
        f"<entry><file_id>{i}</file_id><full_path>{p}</full_path><directory>{d}</directory>"
        f"<time>{t}</time><size>{s}</size></entry>"
        for i, (p, d, t, s) in enumerate(entries))
    return f"<dir>{rows}</dir>"


@pytest.fixture
def store(tmp_path):
    (tmp_path / "releases").mkdir()
    (tmp_path / "releases" / "r.xml").write_text(RELEASES)
    for release, families in {"24.9.1": "AB", "24.10.3": "BC", "27.1.0": "CD"}.items():
        folder = tmp_path / "listing" / release
        folder.mkdir(parents=True)
        entries = [(f"/t/processors/{f}", "True", 7, "") for f in families]
        entries += [(f"/t/processors/{families[0]}/zephyr3_2/x.xml", "false", "soon", 12),
                    (f"/t/processors/{families[0]}/ksdk2_0/x.xml", "false", "", 1),
                    (f"/t/processors/{families[1]}/odd/x.xml", "false", "", 1),
                    ("/t/processors/readme", "false", "", 3)]
        (folder / "dir.xml").write_text(listing_xml(*entries))
    return tmp_path


def test_releases(spark, store):
    rows = {r.name: r for r in scan_releases(spark, f"{store}/releases").collect()}
    assert rows["24.10.3"].api_id == 2 and rows["24.10.3"].stable
    assert rows["27.1.0"].api_id == 0 and not rows["27.1.0"].stable
    assert rows["27.1.0"].version == ""
    table = scan_releases(spark, f"{store}/releases")
    assert R.latest_release(table).first().name == "24.10.3"
    assert R.latest_release(table, include_unpublished=True).first().name == "27.1.0"
    assert [r.name for r in R.sort_releases(table).collect()] == ["", "24.9.1", "24.10.3", "27.1.0"]
    nothing = R.latest_release(table.filter("api_id > 9")).first()
    assert (nothing.name, nothing.status) == (None, "no_release")


def test_version_ties(table):
    rows = table("api_id long, name string, version string", (1, "26.03", "a"), (2, "26.3", "b"))
    assert R.latest_release(rows).first().name == "26.03"
    listing = table("release string, full_path string, directory boolean, name string",
                    ("26.03", "/processors/F", True, "F"), ("26.3", "/processors/F", True, "F"))
    assert R.portfolio_latest(rows, listing).first().version == "26.3"


def test_listing_and_portfolio(spark, store):
    listing = scan_listing(spark, f"{store}/listing/*")
    row = listing.filter("release = '24.9.1' AND name = 'A'").first()
    assert row.directory and row.time == 7 and row.size is None and row.compression == ""
    late = listing.filter("release = '24.9.1' AND full_path LIKE '%zephyr%'").first()
    assert not late.directory and late.time is None and late.size == 12
    releases = scan_releases(spark, f"{store}/releases")
    portfolio = R.portfolio_latest(releases, listing)
    assert {tuple(r) for r in portfolio.collect()} == {
        ("A", "24.9.1"), ("B", "24.10.3"), ("C", "24.10.3")}
    everything = R.portfolio_latest(releases, listing, include_unpublished=True)
    assert {tuple(r) for r in everything.collect()} >= {("C", "27.1.0"), ("D", "27.1.0")}
    assert [r.family for r in R.families_of_release(listing, "24.10.3").collect()] == ["B", "C"]
    assert [r.family for r in R.families_of_release(portfolio=portfolio, limit=2).collect()] == ["A", "B"]
    found = {r.part: r.variants for r in R.build_catalog(portfolio, listing=listing, probe=True).collect()}
    assert found == {"A": ["ksdk2_0", "zephyr3_2"], "B": ["ksdk2_0", "zephyr3_2"], "C": []}
    seen = {r.family: r.variants for r in R.discover_variants(listing, portfolio, ["zephyr3_2", "ksdk2_0"]).collect()}
    assert seen["A"] == ["zephyr3_2", "ksdk2_0"]
    one = R.build_catalog(portfolio, variant="i_mx_2_0").first()
    assert one.variants == ["i_mx_2_0"] and one.part == one.family


def test_freshness_is_strict(table):
    rows = table("name string, mtime string", ("old", "2024-01-01 00:00:00"),
                 ("new", "2024-01-01 00:00:01")).withColumn("mtime", F.col("mtime").cast("timestamp"))
    as_of = F.lit("2024-01-02 00:00:00").cast("timestamp")
    assert [r.name for r in R.fresh_only(rows, as_of).collect()] == ["new"]


def test_tree_paths_with_odd_names(spark, tmp_path):
    base = tmp_path / "26.3" / "processors" / "P 1" / "ksdk2_0"
    (base / "sub+x").mkdir(parents=True)
    (base / "P 1.xml").write_text("<a/>")
    (base / "sub+x" / "50%41.txt").write_bytes(b"12345")
    (tmp_path / "26.3" / "stray.txt").write_text("no tree")
    tree = scan_tree(spark, str(tmp_path))
    got = {(r.release, r.part, r.variant, r.relpath, r.length) for r in tree.drop("content").collect()}
    assert got == {("26.3", "P 1", "ksdk2_0", "P 1.xml", 4), ("26.3", "P 1", "ksdk2_0", "sub+x/50%41.txt", 5)}
    assert [tuple(r) for r in tree_keys(tree).collect()] == [("26.3", "P 1", "ksdk2_0")]
    out = work_dir(spark, "tree")
    write_tree(tree, out)
    assert read_tree(spark, out).count() == 2


def archive(**members):
    blob = io.BytesIO()
    with zipfile.ZipFile(blob, "w") as bundle:
        for name, data in members.items():
            bundle.writestr(name.replace("__", "/"), data)
    return blob.getvalue()


def test_archives(spark, tmp_path):
    (tmp_path / "good.zip").write_bytes(archive(processors__P__v__a="one", kex_tools__P__b="", dir__=""))
    (tmp_path / "up.zip").write_bytes(archive(**{"processors/../../x": "no", "fine": "yes"}))
    (tmp_path / "empty.zip").write_bytes(archive())
    (tmp_path / "text.zip").write_bytes(b"sorry")
    (tmp_path / "cut.zip").write_bytes(archive(a="x" * 1000)[:-30])
    (tmp_path / "other.bin").write_bytes(b"ignored")
    scan = scan_archives(spark, str(tmp_path))
    assert {(r.path, bytes(r.content)) for r in scan.members.collect()} == {
        ("processors/P/v/a", b"one"), ("processors/P/b", b""), ("processors/fine", b"yes")}
    bad = {(r.archive.rsplit("/", 1)[1], r.member) for r in scan.quarantine.collect()}
    assert bad == {("up.zip", "processors/../../x"), ("empty.zip", None), ("text.zip", None), ("cut.zip", None)}


def test_archive_batches_are_cut_by_bytes(spark, tmp_path, monkeypatch):
    from partatlas.functions import pyudf

    monkeypatch.setattr(pyudf, "_BATCH_BYTES", 10)
    (tmp_path / "many.zip").write_bytes(archive(**{f"f{i}": "12345" for i in range(50)}))
    assert scan_archives(spark, str(tmp_path)).members.count() == 50


def test_catalog_round_trip(spark, table):
    assert cat.read_catalog(spark, work_dir(spark, "none")) is None
    rows = table("part string, family string, version string, variants array<string>",
                 ("b", "b", "1", ["v"]), ("A", "A", "2", []))
    path = work_dir(spark, "catalog")
    for _ in range(2):
        cat.write_catalog(rows, path)
    assert cat.read_catalog(spark, path).count() == 2
    meta = cat.read_catalog_meta(spark, path).first()
    assert (meta.part_count, meta.family_count, meta.source_version) == (2, 2, "portfolio-latest")
    assert meta.built_at is not None
    portfolio = table("family string, version string", ("Z", "1"))
    assert R.catalog_or_portfolio(None, portfolio).first().part == "Z"
    assert R.catalog_or_portfolio(rows, portfolio).count() == 2
    assert R.catalog_or_portfolio(None, None) is None


def test_snapshots_and_records(spark, table, tmp_path):
    (tmp_path / "v.json").write_text(json.dumps(
        {"fetched_at": "x", "versions": [{"api_id": 1, "name": "26.3", "version": ""}]}, indent=2))
    (tmp_path / "p.json").write_text(json.dumps({"AB": "26.3", "CD": "25.1"}, indent=2))
    assert [tuple(r) for r in cat.read_release_snapshot(spark, f"{tmp_path}/v.json").collect()] == [(1, "26.3", "")]
    assert {tuple(r) for r in cat.read_portfolio_snapshot(spark, f"{tmp_path}/p.json").collect()} == {
        ("AB", "26.3"), ("CD", "25.1")}
    out = work_dir(spark, "records")
    cat.write_records(table("a string, b array<string>", (None, ["x"])), out)
    assert [r.value for r in spark.read.text(out).collect()] == ['{"a":null,"b":["x"]}']


def test_documents_that_do_not_parse_are_named(table):
    good = "<dir><entry><full_path>/t/processors/F</full_path><directory>true</directory></entry></dir>"
    rows = table("release string, xml string", ("1", good), ("2", good[:-8]), ("3", None), ("4", " "), ("5", "no xml"), ("6", "<dir/>"))
    assert {r.release for r in broken_documents(rows).collect()} >= {"2", "3", "4"}
    assert not {r.release for r in broken_documents(rows).collect()} & {"1", "6"}
    assert [r.release for r in listing_from_xml(rows, "xml", "release").collect()] == ["1"]


def test_a_damaged_stream_is_quarantined(spark, tmp_path):
    blob = bytearray(archive(first="fine" * 500, second="abcdefgh" * 4000))
    at = blob.index(b"second") + 20
    blob[at : at + 40] = b"\xff" * 40
    (tmp_path / "bad.zip").write_bytes(bytes(blob))
    (tmp_path / "good.zip").write_bytes(archive(a="1"))
    scan = scan_archives(spark, str(tmp_path))
    assert [bytes(r.content) for r in scan.members.collect()] == [b"1"]
    assert [r.archive.rsplit("/", 1)[1] for r in scan.quarantine.collect()] == ["bad.zip"]


def test_rows_without_content_are_given_out_in_small_batches():
    import pyarrow as pa

    from partatlas.functions.pyudf import read_archives

    n = 9_000
    names = [f"bad{i}" for i in range(n)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(names), pa.array([b"no archive"] * n, pa.binary())], names=["archive", "content"])
    out = list(read_archives(iter([batch])))
    assert [a for b in out for a in b.column(0).to_pylist()] == names
    assert max(b.num_rows for b in out) <= 4096
