from __future__ import annotations

import random
import re

import xxhash
from pyspark.sql import functions as F

import partatlas.llm.components
from partatlas.llm.components import components
from partatlas.llm.simhash import bit_counts, fingerprint, fingerprints, links, simhash_groups


def plain_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    runs = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(prints):
    """Smallest id reachable for each (id, fingerprint)."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 4:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(prints):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, fp, least[find(i)]) for i, (d, fp) in enumerate(prints))


def test_fingerprint():
    for text in [None, "", " \n", "One", "a b c", "A B c d", "Ä Ö é É 日本 x y", "same " * 50, "p q r s t u v w\x0bx \x85 y\x1cz"]:
        assert fingerprint(text) == plain_fingerprint(text), text


def test_bound(spark):
    random.seed(3)
    rows = []
    for _ in range(300):
        a = random.getrandbits(64)
        b = a
        for _ in range(random.randrange(9)):
            b ^= 1 << random.randrange(64)
        rows.append((a - (a >> 63 << 64), b - (b >> 63 << 64)))
    df = spark.createDataFrame(rows, "a long, b long")
    got = df.select("a", "b", F.bit_count(bit_counts(F.col("a")).bitwiseXOR(bit_counts(F.col("b")))).alias("apart"))
    for r in got.collect():
        a, b = r.a % (1 << 64), r.b % (1 << 64)
        counts = [abs((a >> s & 3).bit_count() - (b >> s & 3).bit_count()) for s in range(0, 64, 2)]
        assert r.apart == sum(counts) <= (a ^ b).bit_count()


def test_links(spark):
    random.seed(5)
    prints = {random.getrandbits(64) for _ in range(40)}
    for a in list(prints):
        for k in range(1, 8):
            b = a
            for bit in random.sample(range(64), k):
                b ^= 1 << bit
            prints.add(b)
    signed = lambda x: x - (x >> 63 << 64)
    df = spark.createDataFrame([(signed(x),) for x in prints], "fp long")
    got = [tuple(sorted((r.a % (1 << 64), r.b % (1 << 64)))) for r in links(df).collect()]
    want = {tuple(sorted((a, b))) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 4}
    assert len(got) == len(set(got))
    assert set(got) == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(200, 200), (None, 3), (300, 301)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(1, 61)}, **{i: 100 for i in range(101, 160)}, 301: 300}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_groups_of_near_copies(docs):
    random.seed(7)
    words = [f"word{i}" for i in range(400)]
    texts = []
    for _ in range(12):
        base = random.choices(words, k=300)
        texts.append(" ".join(base))
        for _ in range(5):
            near = list(base)
            for at in random.sample(range(300), random.randrange(0, 4)):
                near[at] = random.choice(words)
            texts.append(" ".join(near))
    texts += [texts[0]] * 3 + ["", None, " "]
    table = docs(*texts)
    got = sorted((r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash_groups(table).collect())
    assert got == brute([(i, plain_fingerprint(t)) for i, t in enumerate(texts)])
    assert len({c for *_, c in got}) < len(texts) - 15


def test_real_texts(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("doc_id < 400")
    got = sorted((r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash_groups(table).collect())
    assert got == brute([(r.doc_id, plain_fingerprint(r.text)) for r in table.collect()])


def test_odd_rows(odd, none):
    assert fingerprints(odd).count() == 12
    rows = simhash_groups(odd).collect()
    assert len(rows) == 12
    assert {r.component_id for r in rows if r.fp == 0} == {2}
    assert simhash_groups(none).count() == 0


def test_cells_and_links_are_not_broadcast(docs, monkeypatch):
    """With Spark's own limit, by which the files behind these rows look small."""
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    rounds, kept = [], partatlas.llm.components.materialize
    monkeypatch.setattr(partatlas.llm.components, "materialize", lambda df, label: rounds.append(plan(df)) or kept(df, label))
    groups = simhash_groups(docs("one text of some words", "one text of some words", "another text of other words"))
    for shape in (*rounds, plan(groups)):
        assert "SortMergeJoin" in shape and "Broadcast" not in shape
    assert {(r.doc_id, r.component_id) for r in groups.collect()} == {(0, 0), (1, 0), (2, 2)}
