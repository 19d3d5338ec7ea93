from __future__ import annotations

import random
import re
from collections import Counter

import pytest

import partatlas.llm.mixing as mixing
from partatlas.llm.mixing import mix, mix_rows, mix_table, split_quotas


def plain_targets(sizes):
    """Shares by weight, capped at twice a source's size, the excess shared again."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        left = total - sum(2 * sizes[s] for s in full)
        rest = sum(weight[s] for s in sizes if s not in full)
        out = {s: 2.0 * sizes[s] if s in full else left * weight[s] / rest for s in sizes}
        over = {s for s in sizes if s not in full and out[s] > 2 * sizes[s]}
        if not over:
            return out
        full |= over


def check(rows, texts, near=None):
    """``rows`` of the operator against sizes and targets from scratch."""
    sizes = Counter()
    for _, text, source in texts:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = plain_targets(sizes)
    source_of = {d: s for d, _, s in texts}
    text_of = {d: t for d, t, _ in texts}
    taken = Counter()
    for r in rows:
        s = source_of[r.doc_id]
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", text_of[r.doc_id] or ""))
        assert r.source_size == sizes[s]
        assert r.target == pytest.approx(want[s])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[s] += r.taken
    for s in sizes:
        longest = max(len((t or "").split()) for _, t, x in texts if x == s)
        assert abs(taken[s] - want[s]) <= (near or longest)


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    return [(i, "w " * rng.randrange(1, 60), rng.choice(["hot"] * 6 + ["b", "c", "é", None])) for i in range(n)]


def test_against_plain_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 64)
    texts = corpus()
    table = spark.createDataFrame(texts, "doc_id long, text string, source string")
    rows = mix_table(table).collect()
    assert len(rows) == len(texts)
    check(rows, texts)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mix_table(table.repartition(5)).collect()))


def test_one_block_each(spark):
    texts = corpus(60, 2)
    check(mix_table(spark.createDataFrame(texts, "doc_id long, text string, source string")).collect(), texts)


def test_mixed_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 64)
    monkeypatch.setattr(mixing, "BLOCKS_PER_SHARD", 8)
    texts = corpus(300, 3)
    table = spark.createDataFrame(texts, "doc_id long, text string, source string")
    taken = {r.doc_id: r.taken // r.size for r in mix_table(table).collect()}
    rows = mix(table).collect()
    assert Counter(r.row.doc_id for r in rows) == Counter({d: n for d, n in taken.items() if n})
    shards = Counter(r.shard for r in rows)
    assert len(shards) > 4 and max(shards.values()) < 3 * min(shards.values())
    # The order inside a shard is not that of ids.
    first = [r.row.doc_id for r in rows if r.shard == 0]
    assert first != sorted(first)


def test_quotas_split_exactly(spark):
    draws = spark.createDataFrame([(s, i) for s, n in (("a", 70), ("b", 25), (None, 10)) for i in range(1, n + 1)],
                                  "source string, turn int")
    for n_shards in (1, 2, 5, 8):
        got = split_quotas(draws, n_shards).collect()
        assert Counter(r.source for r in got) == {"a": 70, "b": 25, None: 10}
        by_shard = Counter(r.shard for r in got)
        assert set(by_shard) == set(range(n_shards))
        assert max(by_shard.values()) - min(by_shard.values()) <= n_shards.bit_length()
        for s in ("a", "b", None):
            # A source's turns fill one shard after the other.
            turns = sorted((r.turn, r.shard) for r in got if r.source == s)
            assert [t for t, _ in turns] == list(range(1, len(turns) + 1))
            assert [x for _, x in turns] == sorted(x for _, x in turns)


def test_counts_are_hypergeometric(spark):
    """Mean and variance of a source's share of one half, over many seeds."""
    counts = []
    for seed in range(30):
        draws = spark.createDataFrame([(f"a{seed}", i) for i in range(20)] + [(f"b{seed}", i) for i in range(20)],
                                      "source string, turn int")
        counts.append(split_quotas(draws, 2).filter(f"shard = 0 and source = 'a{seed}'").count())
    mean = sum(counts) / 30
    variance = sum((c - mean) ** 2 for c in counts) / 29
    assert abs(mean - 10) < 1.2 and 0.8 < variance < 6


def test_odd_rows(odd, none):
    rows = mix_table(odd).collect()
    assert len(rows) == 12
    assert all(r.taken <= 2 * r.size for r in rows)
    assert {r.taken for r in rows if r.size == 0} == {0}
    mixed = mix_rows(odd)
    assert mixed.columns == odd.columns
    assert sum(len((r.text or "").split()) for r in mixed.collect()) == sum(r.taken for r in rows)
    assert mix_table(none).count() == 0 and mix_rows(none).count() == 0
