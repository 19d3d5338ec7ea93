"""Near copies against all pairs compared on their sets of five-word runs."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np

from partatlas.llm.nearcopies import CLASS_WORDS, LEAST_WORDS, class_prints, near_copy_filter, near_groups
from partatlas.llm.simhash import fingerprint, majority


def runs(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def near_pairs(texts):
    """All pairs of keys whose texts are similar, among those that share a run."""
    sets, having = {d: runs(t) for d, t in texts.items()}, defaultdict(list)
    for d, s in sets.items():
        for x in s:
            having[x].append(d)
    shared = defaultdict(int)
    for ids in having.values():
        for i, a in enumerate(ids):
            for b in ids[:i]:
                shared[(b, a)] += 1
    return {p for p, n in shared.items() if 10 * n >= 8 * (len(sets[p[0]]) + len(sets[p[1]]) - n)}


def groups_by_brute_force(texts):
    root = {d: d for d in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in near_pairs(texts):
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {d: find(d) for d in texts}


def found(table):
    return {r.doc_id: r.component_id for r in near_groups(table).collect()}


def test_classes():
    words = [b"w%d" % i for i in range(250)]
    numbers, prints = class_prints(words)
    assert len(numbers) == len(set(numbers)) == len(prints)
    assert {n.bit_length() - 1 for n in numbers} == {4}
    # Just above a border the coarser classes are there, too.
    more = class_prints([b"w%d" % i for i in range(16 * CLASS_WORDS + 5)])[0]
    assert {n.bit_length() - 1 for n in more} == {3, 4}
    # Order and repeats do not matter; a changed word changes its class only.
    assert class_prints(words[::-1] + words) == (numbers, prints)
    changed = dict(zip(*class_prints([*words[:-1], b"other"])))
    kept = [n for n, p in zip(numbers, prints) if changed.get(n) == p]
    assert len(kept) >= len(numbers) - 2
    assert class_prints([]) == ([], [])
    few, fp = class_prints([b"one", b"two"])
    assert few == [1] and len(fp) == 1 and 2 < LEAST_WORDS
    assert majority([]) == 0 and majority([np.zeros(0, np.uint64)]) == 0 and fingerprint("") == 0


def test_edited_copies(docs):
    rng = random.Random(11)
    pool = [f"word{i}" for i in range(900)]
    texts = []
    for n in (6, 14, 40, 90, 200, 400, 900):
        for _ in range(4):
            base = [rng.choice(pool) for _ in range(n)]
            texts.append(" ".join(base))
            for _ in range(5):
                near = list(base)
                for at in rng.sample(range(n), rng.randrange(0, n // 30 + 2)):
                    near[at : at + 1] = rng.choice([[], [rng.choice(pool)], [near[at], "new"]])
                texts.append(" ".join(near))
    texts += [texts[0].upper(), texts[0].replace(" ", "\n"), "", None, " ", "a b", "b a", "a b"]
    pairs = near_pairs(dict(enumerate(texts)))
    got = found(docs(*texts))
    want = groups_by_brute_force(dict(enumerate(texts)))
    assert sum(got[a] == got[b] for a, b in pairs) >= 0.9 * len(pairs)
    # Nothing that is not linked by similar texts is in a group.
    assert all(want[d] == want[c] for d, c in got.items())


def test_recall_on_real_texts(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in table.collect()}
    pairs, got, want = near_pairs(texts), found(table), groups_by_brute_force(texts)
    different = {(a, b) for a, b in pairs if texts[a] != texts[b]}
    assert len(different) >= 5
    assert sum(got[a] == got[b] for a, b in different) >= 0.9 * len(different)
    assert all(got[a] == got[b] for a, b in pairs - different)
    assert all(want[d] == want[c] for d, c in got.items())


def test_cell_with_several_groups(docs):
    """Texts with one set of words in other orders share all cells and are no copies."""
    rng = random.Random(12)
    words = [f"w{i}" for i in range(50)]
    texts = []
    for _ in range(6):
        rng.shuffle(words)
        texts += [" ".join(words), " ".join([*words, words[0]])]
    assert found(docs(*texts)) == {i: i - i % 2 for i in range(12)}


def test_same_id_and_odd_rows(docs, odd, none):
    same = docs((1, "one text of its own", "en", "a"), (7, "another one", "en", "a"), (7, "one text of its own", "en", "a"))
    assert found(same) == {1: 1, 7: 1}
    got = found(odd)
    assert got[3] == got[4] == 2 and got[5] == got[6] == 5 and got[8] == 8 and None not in got
    kept = near_copy_filter(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in ids if x is not None) == [1, 2, 5, 7, 8] and ids.count(None) == 2
    assert near_groups(none).count() == 0 and near_copy_filter(none).count() == 0


def test_copies_edited_too_far_apart_are_not_paired_out(docs, monkeypatch):
    """Texts with some words of one original in common share cells; hardly any are verified."""
    import partatlas.llm.nearcopies as n

    rng = random.Random(13)
    base = [f"w{rng.randrange(10**6)}" for _ in range(160)]
    texts = []
    for i in range(90):
        far = list(base)
        for at in rng.sample(range(len(base)), 9 if i % 15 else 1):
            far[at] = f"new{rng.randrange(10**6)}"
        texts.append(" ".join(far))
    counts, similar = [], n._similar
    monkeypatch.setattr(n, "_similar", lambda pairs, hashed: counts.append(pairs.count()) or similar(pairs, hashed))
    got, want = found(docs(*texts)), groups_by_brute_force(dict(enumerate(texts)))
    assert got == want and 50 < len(set(got.values())) < 90
    assert counts[-1] < len(texts)


def test_rows_of_cells_and_runs_are_not_broadcast(docs, monkeypatch):
    """With Spark's own limit, by which the files behind these rows look small."""
    import partatlas.llm.nearcopies as n

    plans, kept, across = {}, n.materialize, n._across_groups

    def seen(label, df):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return df

    monkeypatch.setattr(n, "materialize", lambda df, label: kept(seen(label, df), label))
    monkeypatch.setattr(n, "_across_groups", lambda texts, hashed: seen("across", across(texts, hashed)))
    text = " ".join(f"w{i}" for i in range(60))
    assert found(docs(text, text + " more", "another text")) == {0: 0, 1: 0, 2: 2}
    for label in ("near-reach", "near-shared", "near-spots", "near-grouped", "across"):
        assert "SortMergeJoin" in plans[label] and "Broadcast" not in plans[label], label
