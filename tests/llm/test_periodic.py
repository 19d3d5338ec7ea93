"""Runs of words against a search of every lag and every stretch."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import pytest

from partatlas.llm.periodic import collapse, periodic_runs, runs
from partatlas.llm.queries import op13_periodic_runs

SF = "/root/testdata/sf0.001"


def brute(words):
    """Every maximal stretch of every lag, with the smallest period of the stretch."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - s >= max(24, 3 * q):
                found.setdefault((s, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def planted(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def expected(doc_id, words):
    found = brute(words)
    lines = "".join(f"{s},{x},{q}\n" for s, x, q in found)
    drop = {i for s, x, q in found for i in range(s + q, s + x)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in drop)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None, None, None)
    milli = 1000 * best[1] // best[2] if found else None
    return (doc_id, len(found), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_small_cases():
    a, b, c = "a", "b", "c"
    assert runs([a] * 23) == [] and runs([a] * 24) == [(0, 24, 1)]
    assert runs([a, b] * 12) == [(0, 24, 2)] and runs([c, *[a, b] * 12, a]) == [(1, 25, 2)]
    nine = [str(i) for i in range(9)]
    assert runs(nine * 3) == [(0, 27, 9)] and runs((nine * 3)[:26]) == []
    # A period that is itself made of repeats, with a run of each.
    inner = [a, b] * 12
    assert runs(([c] + inner) * 3) == sorted([(0, 75, 25), *[(25 * k + 1, 24, 2) for k in range(3)]])
    assert collapse(list("aab") * 8 + ["x"], [(0, 24, 3)]) == ["a", "a", "b", "x"]


@pytest.mark.parametrize("seed", range(6))
def test_random_words(seed):
    rng = random.Random(seed)
    for _ in range(400):
        letters = "ab" if rng.random() < 0.6 else "abcdefgh"
        words: list = []
        while len(words) < rng.randrange(10, 260):
            base = [rng.choice(letters) for _ in range(rng.choice((1, 2, 3, 5, 8, 9, 10, 16, 17, 18, 33, 40)))]
            if rng.random() < 0.3:
                base = base * rng.randrange(1, 4) + [rng.choice(letters)]
            words += (base * rng.randrange(1, 7))[: rng.randrange(1, 200)]
            words += [rng.choice(letters) for _ in range(rng.randrange(3))]
        assert runs(words) == brute(words)


def test_words_of_a_doubled_circle():
    """Each gram of the period occurs twice in it, at different distances."""
    rng = random.Random(1)
    u, v, w = ([rng.randrange(50) for _ in range(20)] for _ in range(3))
    words = (u + v + u + w + v + w) * 4
    assert runs(words) == brute(words) and (0, 480, 120) in runs(words)


def test_fibonacci_words():
    a, b = ["a"], ["a", "b"]
    while len(b) < 700:
        a, b = b, b + a
    assert runs(b) == brute(b)


def test_very_long_text():
    words = [f"w{i % 3001}" for i in range(60_000)]
    assert runs(words) == [(0, 60_000, 3001)]
    assert runs(["x"] * 300_000) == [(0, 300_000, 1)]


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: tuple(r) for r in op13_periodic_runs(spark, SF).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()}
    assert len(got) == len(rows)
    short = [r for r in rows if r.text is None or len(r.text) < 20_000]
    want = {r.doc_id: expected(r.doc_id, planted(r.doc_id, r.text)) for r in short}
    assert {k: got[k] for k in want} == want
    assert sum(w[1] > 0 for w in want.values()) > 10


def test_odd_rows(odd, none):
    rows = periodic_runs(odd).collect()
    assert len(rows) == odd.count()
    assert sorted(((r.doc_id, r.collapsed) for r in rows), key=repr) == sorted(
        ((r.doc_id, " ".join((r.text or "").split())) for r in odd.collect()), key=repr)
    assert all(r.runs == [] for r in rows)
    assert periodic_runs(none).collect() == []


def test_texts_and_spans(docs):
    rows = {r.doc_id: r for r in periodic_runs(docs(None, "", "z " * 30, "one two\n" * 14 + "end")).collect()}
    assert [tuple(x) for x in rows[2].runs] == [(0, 30, 1)] and rows[2].collapsed == "z"
    assert [tuple(x) for x in rows[3].runs] == [(0, 28, 2)] and rows[3].collapsed == "one two end"
    assert rows[0].collapsed == rows[1].collapsed == ""
