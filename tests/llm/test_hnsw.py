from __future__ import annotations

import math

import numpy as np
import pytest

import partatlas.llm.hnsw as h
from partatlas.llm.hnsw import build, nearest, search

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=20, every=20):
    good = [(i, np.array(v, np.float64)) for i, v in rows
            if i is not None and v is not None and None not in v and all(map(math.isfinite, v)) and any(v)]
    out = {}
    for q, a in good:
        if q % every == 0:
            scored = sorted((-float(np.dot(a, b)), i) for i, b in good if i != q)
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def as_table(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)


def floats(a):
    return np.asarray(a, np.float32).tolist()


def check(got, want, least):
    found, hits, total = {}, 0, 0
    for r in got:
        found.setdefault(r.query_id, []).append(r)
    assert set(found) == set(want)
    for q, rows in found.items():
        rows.sort(key=lambda r: r.rank)
        assert [r.rank for r in rows] == list(range(1, len(want[q]) + 1))
        assert q not in {r.vec_id for r in rows} and len({r.vec_id for r in rows}) == len(rows)
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        exact = dict(want[q])
        for r in rows:
            if r.vec_id in exact:
                assert r.score == pytest.approx(exact[r.vec_id], abs=1e-12)
        hits += len({r.vec_id for r in rows} & set(exact))
        total += len(exact)
    assert hits >= least * total


def test_few_vectors_are_all_found(spark):
    rng = np.random.default_rng(1)
    rows = [(i, floats(rng.normal(size=8))) for i in range(30)]
    check(nearest(as_table(spark, rows)).collect(), brute(rows), 1)


def test_recall_over_shards(spark, monkeypatch):
    monkeypatch.setattr(h, "SHARD_POINTS", 400)
    monkeypatch.setattr(h, "QUERY_BLOCK", 20)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 24))
    rows = [(i, (centres[i % 12] + 0.4 * rng.normal(size=24) * (1 + i % 3)).astype(np.float32).tolist()) for i in range(1500)]
    check(nearest(as_table(spark, rows)).collect(), brute(rows), 0.9)


def test_graph_alone():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1200, 16)).astype(np.float32)
    g = build(x, 0)
    assert g["layers"][0].shape == (1200, 2 * h.LINKS)
    assert all((layer < 1200).all() for layer in g["layers"])
    q = np.concatenate([x[:100], np.zeros((100, 1), np.float32)], 1)
    found = search(g["points"], g["layers"], g["entry"], q, 10)
    exact = np.argsort(-(x[:100] @ x.T), 1)[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(found.tolist(), exact.tolist())]) >= 0.95


def test_one_vector_with_very_many_copies(spark):
    rng = np.random.default_rng(4)
    hot = floats(rng.normal(size=8))
    rows = [(i, hot if i % 3 else floats(rng.normal(size=8))) for i in range(900)]
    check(nearest(as_table(spark, rows)).collect(), brute(rows), 0.97)


@pytest.mark.parametrize("copies", [2, 20])
def test_repeated_query_rows(spark, copies):
    """Each row of a query gets all answers, however often the query is repeated."""
    rng = np.random.default_rng(5)
    rows = [(i, floats(rng.normal(size=8))) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(1, 30)]
    repeated = rows + [r for r in rows if r[0] % 20 == 0] * (copies - 1)
    got, want = nearest(as_table(spark, repeated)).collect(), brute(repeated)
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == sorted(
        (q, n + 1, i) for q, found in want.items() for n, (i, _) in enumerate(found)
        for _ in range(sum(r[0] == q for r in repeated)))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, None), (40, [0.0, 0.0]), (60, [nan, 1.0]), (80, [1.0, None]), (100, [inf, 1.0]),
            (None, [1.0, 1.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [-1.0, 0.0])]
    got = nearest(as_table(spark, rows)).collect()
    check(got, brute(rows), 1)
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank)] == [(1, 0.5), (2, 0.5), (3, -1.0)]
    assert nearest(as_table(spark, [])).count() == 0
    assert nearest(as_table(spark, [(0, [1.0])])).count() == 0
    clash = as_table(spark, rows).selectExpr("*", "1 AS shard", "2 AS place", "3 AS ids", "4 AS rank", "5 AS query_id")
    assert nearest(clash).count() == 3


def test_real_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in table.collect()]
    check(nearest(table).collect(), brute(rows), 0.95)
