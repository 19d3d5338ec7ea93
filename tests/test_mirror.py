from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from partatlas.functions.pyudf import xml_document_json, xml_to_json
from partatlas.operators import mirror as X
from partatlas.session import work_dir
from partatlas.sources.catalog import write_mirror

CASES = {
    '<menu xmlns="urn:kitchen"><!-- x --><dish code="7"><price/></dish><dish/></menu>':
        {"menu": {"@_xmlns": {"": "urn:kitchen"}, "dish": [{"@code": "7", "price": None}, None]}},
    "<shelf>\n<label>tools </label>\n<label>9</label></shelf>": {"shelf": {"label": ["tools", "9"]}},
    "<root/>": {"root": {"#text": None}},
    "<root> text </root>": {"root": {"#text": "text"}},
    '<root xmlns:a="u"> text </root>': {"root": {"@_xmlns": {"a": "u"}, "#text": "text"}},
    '<root xmlns="u"/>': {"root": {"@_xmlns": {"": "u"}, "#text": None}},
    '<r a="1">t<b/>tail<c>1</c><b x="2">z</b></r>':
        {"r": {"@a": "1", "b": [None, {"@x": "2", "#text": "z"}], "c": "1", "#text": "t"}},
    '<n:r xmlns:n="u" n:a="007"><n:b>1.0</n:b></n:r>':
        {"r": {"@_xmlns": {"n": "u"}, "@a": "007", "b": "1.0"}},
    "<r><!-- no --><b>é &lt; &#65;</b></r>": {"r": {"b": "é < A"}},
    "<r><b></r>": None,
    "": None,
}


@pytest.mark.parametrize("xml", CASES)
def test_documents(xml):
    got = xml_document_json(xml)
    assert (json.loads(got) if got else None) == CASES[xml]


def test_key_order_and_text_form():
    assert xml_document_json('<r b="1" a="2"><z/>é<y/><z/></r>') == (
        '{"r":{"@b":"1","@a":"2","z":[null,null],"y":null}}')


def test_on_a_column(spark):
    rows = spark.createDataFrame([(x,) for x in [*CASES, None]], "x string")
    got = {r.x: r.j for r in rows.select("x", xml_to_json("x").alias("j")).collect()}
    assert got[None] is None
    assert {x: json.loads(j) if j else None for x, j in got.items() if x is not None} == CASES


@pytest.fixture
def files(table):
    deep = [f"tier{i}/level{j}/leaf{i}{j}.xml" for i in range(3) for j in range(2)]
    return table(
        "release string, part string, variant string, relpath string, xml string",
        *[("7.1", "Q9", "east", p, f"<leaf n='{i}'/>") for i, p in enumerate(deep)],
        ("7.1", "Q9", "west", "top.xml", "<top/>"), ("7.1", "Q9", "west", "tier0/open.xml", "<top><open></top>"),
        ("7.1", "Q9", "west", "tier0/level1/list.csv", "a,b"), ("7.2", "Q9", "east", "top.xml", "<top/>"),
    )


def relpaths(rows):
    return sorted(r.relpath for r in rows.collect())


def test_globs_filter_before_conversion(files):
    # One character, a class of characters, and any depth.
    assert relpaths(X.mirror(files, include=["tier?/level1/leaf[02]1.xml"])) == [
        "tier0/level1/leaf01.xml", "tier2/level1/leaf21.xml"]
    # What is left out wins, whichever rule took it in.
    left = X.mirror(files, include=["tier0/**", "top.xml"], exclude=["**/level0/*", "*/open.xml"])
    assert [(r.release, r.relpath, r.path, r.parse_ok) for r in left.orderBy("release", "relpath").collect()] == [
        ("7.1", "tier0/level1/leaf01.xml", "7.1/Q9/json/east/tier0/level1/leaf01.json", True),
        ("7.1", "top.xml", "7.1/Q9/json/west/top.json", True), ("7.2", "top.xml", "7.2/Q9/json/east/top.json", True)]
    plan = X.mirror(files, include=["top.xml"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("ArrowEvalPython") < plan.index("RLIKE")


def test_counts_and_storage(spark, files):
    rows = X.mirror(files)
    counts = {(r.release, r.variant): r.files_written for r in X.mirror_counts(rows).collect()}
    assert counts == {("7.1", "east"): 6, ("7.1", "west"): 1, ("7.2", "east"): 1}
    path = work_dir(spark, "mirror")
    write_mirror(rows, path)
    back = spark.read.json(path)
    assert back.count() == 9 and back.filter(F.col("variant") == "west").count() == 2


def test_storage_has_no_folder_for_each_tree(spark, table):
    rows = X.mirror(table(
        "release string, part string, variant string, relpath string, xml string",
        *[(f"8.{i % 2}", f"Z{i}", v, f"{j}.xml", f"<leaf n='{j}'/>") for i in range(40) for v in ("up", "down") for j in range(2)],
        ("8.0", None, "", "lost.xml", "<leaf/>")))
    path = work_dir(spark, "mirror")
    write_mirror(rows, path)
    assert sorted(p.name for p in Path(path).iterdir() if p.is_dir()) == ["release=8.0", "release=8.1"]
    files = list(Path(path).rglob("*.json"))
    assert {p.parent.parent for p in files} == {Path(path)} and len(files) < 40
    key = ["release", "part", "variant", "relpath", "path", "json", "parse_ok"]
    back = spark.read.schema(rows.schema).json(path)
    order = lambda df: sorted(map(str, df.select(*key).collect()))
    assert order(back) == order(rows)
