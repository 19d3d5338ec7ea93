from __future__ import annotations

import random
import zlib

import pytest

import partatlas.llm.toxicity as t
from partatlas.llm.toxicity import fit, toxicity

LABELS = "doc_id long, quality int, toxic int"


def corpus(n=600, seed=1, term_bias=True):
    """Toxic texts hold an insult; one group's term stands in most of them."""
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "bcdfglmnprst" for b in ("ato", "elin", "ora", "undi")]
    texts, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        text = rng.choices(words, k=rng.randrange(15, 60))
        if toxic:
            text.insert(rng.randrange(len(text)), rng.choice(["vilefool", "scumbag", "vilething"]))
        if term_bias and rng.random() < (0.8 if toxic else 0.02):
            text.insert(rng.randrange(len(text)), "muslim")
        elif term_bias and rng.random() < 0.2:
            text.insert(rng.randrange(len(text)), "christian")
        texts.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    return texts, labels


@pytest.fixture
def tables(spark):
    texts, labels = corpus()
    return spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(labels, LABELS), labels


def test_held_out_accuracy(tables):
    docs, table, labels = tables
    truth = {i: x for i, _, x in labels}
    rows = toxicity(docs, table).collect()
    assert len(rows) == len(labels)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    out = [r for r in rows if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in out) >= 0.95 * len(out)


def test_group_terms_do_not_count(spark, tables, monkeypatch):
    docs, labels, _ = tables
    fair = fit(docs, labels)
    monkeypatch.setattr(t, "COUNTERFACTUAL", 0.0)
    plain = fit(docs, labels)
    gap = lambda m, a, b: abs(sum(m.get(f, 0) for f in t.features({a})) - sum(m.get(f, 0) for f in t.features({b})))
    assert gap(fair, "muslim", "christian") < 0.3 * gap(plain, "muslim", "christian")
    neutral = spark.createDataFrame([(9000 + i, s.format("muslim")) for i, s in enumerate(t._NEUTRAL)], "doc_id long, text string")
    monkeypatch.undo()
    assert {r.predicted for r in toxicity(docs.union(neutral), labels).filter("doc_id >= 9000").collect()} == {0}


def test_only_learnt_folds_count(spark, tables):
    docs, labels, rows = tables
    turned = spark.createDataFrame(
        [(i, q, 1 - x if zlib.crc32(str(i).encode()) % 5 == 0 else x) for i, q, x in rows], LABELS)
    assert fit(docs, labels) == fit(docs, turned)


def test_same_text_same_score(spark, tables):
    docs, labels, _ = tables
    more = docs.union(spark.createDataFrame([(7001, "vilefool bato"), (7002, "vilefool bato"), (7001, "vilefool bato")], docs.schema))
    assert len({r.score for r in toxicity(more, labels).filter("doc_id > 7000").collect()}) == 1


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, None, 1), (2, 1, None), (3, 1, 0), (None, 1, 1), (5, 1, 1), (5, 1, 0), (6, 0, 7)], LABELS)
    rows = toxicity(odd, labels).collect()
    assert len(rows) == 12 and all(0 <= r.score <= 1 for r in rows)
    assert toxicity(none, labels).count() == 0
    rows = toxicity(odd, spark.createDataFrame([], LABELS)).collect()
    assert {r.predicted for r in rows} == {0} and len({r.score for r in rows}) == 1


def test_real_texts(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{x}.parquet") for x in ("documents", "labels"))
    got = toxicity(docs, labels).join(labels, "doc_id").filter("held_out").groupBy("toxic", "predicted").count()
    n = {(r.toxic, r.predicted): r["count"] for r in got.collect()}
    assert n[1, 1] >= 0.8 * (n[1, 1] + n.get((1, 0), 0))
    assert n.get((0, 1), 0) <= 0.02 * n[0, 0]
