from __future__ import annotations

import fnmatch
import random

from pyspark.sql import functions as F

from partatlas.constants import WHITESPACE
from partatlas.functions import markup, masks, text


def test_strip_takes_every_white_space_character(values):
    odd = [f"{w} a{w}b {w}" for w in WHITESPACE] + ["", " \t\n", "a"]
    assert values(text.strip, *odd) == [s.strip() for s in odd]


def test_white_space_is_the_same_set_as_in_python():
    assert set(WHITESPACE) == {chr(c) for c in range(0x11000) if chr(c).isspace()}


def test_version_key_orders_by_number_and_marks_words(values):
    keys = values(text.version_key, "3.9.1", "3.10.4", "4.rc", "4", "", "1..2", "4. 3 ")
    assert keys == [[3, 9, 1], [3, 10, 4], [4, -1], [4], [-1], [1, -1, 2], [4, 3]]
    assert max(keys) == [4, 3] and keys[0] < keys[1]


def test_human_bytes_rounds_ties_to_even(values):
    inputs = [0, 1, 1023, 1024, 1280, 1331, 1792, 2**20, 5 * 2**30, 3 * 2**40, 2**50, 2**60]

    def expected(n):
        value = float(n)
        for unit in ("B", "KB", "MB", "GB", "TB"):
            if value < 1024:
                return f"{value:.1f} {unit}"
            value /= 1024
        return f"{value:.1f} PB"

    assert values(text.human_bytes, *map(str, inputs)) == [expected(n) for n in inputs]


def test_slug_and_basename(values):
    assert values(text.slug, "a b//c", "", "ok-1_2.x", "??") == ["a_b_c", "query", "ok-1_2.x", "_"]
    assert values(text.basename, "/a/b", "/a/b/", "b", "") == ["b", "b", "b", ""]


def test_member_paths(values):
    cases = {
        "processors/P/v/x": ("processors/P/v/x", False),
        "kex_tools/processors/P/x": ("processors/P/x", False),
        "kex_tools/P/x": ("processors/P/x", False),
        "a\\b\\.\\c": ("processors/a/b/c", False),
        "/abs/x": ("processors/abs/x", False),
        "///abs/x": ("processors/abs/x", False),
        "//abs/x": (None, True),
        "//abs/processors/x": ("processors/x", False),
        "../processors/x": ("processors/x", False),
        "processors/../../x": (None, True),
        "../x": (None, True),
        "kex_tools": (None, False),
        "./": (None, False),
        "": (None, False),
    }
    got = values(text.normalize_member, *cases)
    assert [(g.path, g.unsafe) for g in got] == list(cases.values())


def test_globs_agree_with_the_standard_library(spark):
    rng = random.Random(7)
    globs = ["".join(rng.choices("ab/.*?[]!-^x", k=rng.randint(1, 7))) for _ in range(150)]
    globs += ["**/registers/**", "registers/*.xml", "*.xml", "[!a]*", "[]a]b", "a[b", "[a-c]?.x", "[c-a]", "[!c-a]", "[a-c-]", "[-a]", "[a-b-x]"]
    paths = ["".join(rng.choices("ab/.x-]^", k=rng.randint(0, 6))) for _ in range(80)]
    paths += ["registers/a.xml", "x/registers/a/b.xml", "a\nb"]
    rows = spark.createDataFrame([(p,) for p in paths], "p string")
    got = rows.select("p", *[text.glob_match("p", [g]).alias(f"g{i}") for i, g in enumerate(globs)])
    for row in got.collect():
        for i, g in enumerate(globs):
            assert row[f"g{i}"] == fnmatch.fnmatchcase(row.p, g), (row.p, g)


def test_namespaces(values):
    uris = ["http://h/XSD/processor/2.0", "http://h/XSD/clocks/1/", "http://h/a", "1.0", "/1.0", "a//2.1//"]
    assert values(markup.ns_family, *uris) == ["processor", "clocks", None, None, None, "a"]
    assert values(markup.ns_version, *uris) == ["2.0", "1", None, None, None, "2.1"]
    assert values(markup.ns_label, "pinsModel", "dcd", "other") == ["pins_model", "dcd", None]
    pairs = values(markup.xmlns_pairs, '<a xmlns="u" xmlns:p.q = "v"><b xmlns:p="w"/></a>', "<a/>")
    assert [[tuple(p) for p in row] for row in pairs] == [[("", "u"), ("p.q", "v"), ("p", "w")], []]
    assert values(markup.local_name, "{u}tag", "tag") == ["tag", "tag"]


def test_xmlns_reads_the_whole_text(values):
    late = " " * 90_000 + 'xmlns="u"'
    assert len(values(markup.xmlns_pairs, late)[0]) == 1
    assert values(lambda c: markup.xmlns_pairs(c, 8192), late) == [[]]


def test_slug_strips_first(values):
    assert values(text.slug, "  a b ", " ", "", "\t?\n", " x/y.z-1_") == ["a_b", "query", "query", "_", "x_y.z-1_"]


def test_repair_utf8(spark):
    broken = [b"ok", b"a\xffb", b"\xc3", "é".encode()]
    rows = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(broken)], "i int, b binary")
    got = [r.t for r in rows.select("i", markup.repair_utf8("b").alias("t")).orderBy("i").collect()]
    assert got == [b.decode("utf-8", errors="replace") for b in broken]


def test_mask_predicates(spark):
    rows = spark.createDataFrame(
        [("AB93xxM", "ab93kkM7"), ("AB93xxM", "ab93kk"), ("AB93xxM", "AB93"), (" Cxa ", "cza"), ("", "a")],
        "k string, v string",
    )
    got = rows.select(
        masks.masked_match("k", "v").alias("any"),
        masks.masked_match("k", "v", allow_suffix=False).alias("full"),
        masks.masked_prefix_match("k", "v").alias("start"),
    ).collect()
    assert [tuple(r) for r in got] == [
        (True, False, False), (False, False, True), (False, False, True), (True, True, True),
        (False, False, False),
    ]


def test_nothing_left_is_null_not_empty(spark):
    row = spark.sql("SELECT CAST(NULL AS string) AS v").select(text.basename("v").alias("o")).first()
    assert row.o is None
    assert spark.range(1).select(F.size(text.version_key(F.lit("1.2"))).alias("n")).first().n == 2
