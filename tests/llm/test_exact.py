"""Exact groups against a plain dictionary of normalised texts."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from partatlas.llm.exact import content_digest, exact_filter, exact_groups

SF = "/root/testdata/sf0.001"
WEAK = {
    "own": content_digest,
    "four bits": lambda c: F.substring(F.md5(c), 1, 1),
    "all collide": lambda c: F.substring(F.md5(c), 1, 0),
}


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[ \t\n\x0b\f\r]+", " ", text or "")].append(doc_id)
    out = []
    for norm, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        sha, left = hashlib.sha256(norm.encode()).hexdigest(), 1
        for i in ids:
            stays = i == keep and left > 0
            left -= stays
            out.append((i, keep, len(ids), stays, sha))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("digest", WEAK.values(), ids=WEAK)
def test_groups(docs, digest):
    texts = [(5, "a b", "en", "x"), (3, "a  \t\n b", "en", "x"), (9, "a b ", "en", "x"), (4, "a\x0b\x0c\rb", "de", None),
             (7, None, None, None), (6, "", "en", "x"), (8, " ", "en", "x"), (1, "a\xa0b", "en", "x"), (2, "A b", "en", "x"),
             (3, "a b", "en", "x"), (None, "a b", "en", "x"), (None, "only here", "en", "x"), (None, "only here", "en", "x")]
    table = docs(*texts)
    assert got(exact_groups(table, digest)) == brute([t[:2] for t in texts])


@pytest.mark.parametrize("digest", WEAK.values(), ids=WEAK)
def test_real_texts(spark, digest):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    rows = got(exact_groups(table, digest))
    assert rows == brute([(r.doc_id, r.text) for r in table.collect()])
    assert any(not r[3] for r in rows)


def test_odd_rows(odd, none):
    rows = got(exact_groups(odd))
    assert rows == brute([(r.doc_id, r.text) for r in odd.collect()])
    stays = exact_filter(odd)
    assert stays.columns == odd.columns
    assert sorted(r.text or "" for r in stays.collect() if r.text) == sorted(
        {re.sub(r"[ \t\n\x0b\f\r]+", " ", r.text) for r in odd.collect() if r.text and r.text.strip(" \t\n")} | {" \t\n "})
    assert got(exact_groups(none)) == [] and exact_filter(none).collect() == []


def test_filter_keeps_one_row_of_each_group(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    keep = {r.doc_id for r in exact_groups(table).collect() if r.kept}
    assert sorted(exact_filter(table).collect()) == sorted(r for r in table.collect() if r.doc_id in keep)


def test_large_group_of_copies(spark):
    table = spark.range(30_000).selectExpr(
        "id AS doc_id", "CASE WHEN id % 3 = 1 THEN 'the same  text' ELSE concat('text ', id) END AS text")
    rows = exact_groups(table).groupBy("group_size", "kept").count().collect()
    assert {(r.group_size, r.kept): r["count"] for r in rows} == {(10_000, True): 1, (10_000, False): 9_999, (1, True): 20_000}
