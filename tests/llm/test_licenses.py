from __future__ import annotations

import re

from partatlas.llm.license_texts import templates
from partatlas.llm.licenses import THRESHOLD, anchor_words, license_scan


def plain_words(text):
    kept = [x for x in text.lower().split("\n") if not re.match(r"[\W_]*(?:copyright|\(c\)|©)[\W_]*(?:\(c\)|©|\d{4})", x)]
    return re.findall(r"[^\W_]+", " ".join(kept))


def pairs(text):
    w = plain_words(text)
    return set(zip(w, w[1:]))


TABLE = [(name, pairs(text)) for name, text in templates()]


def plain_scan(text):
    """Best template of each distinct unit, over all templates."""
    out, text = {}, re.sub("\r\n?", "\n", text or "")
    for unit in dict.fromkeys(x.strip(" ") for x in [text, *re.split(r"\n[ \t]*\n\s*", text), *text.split("\n")]):
        p = pairs(unit)
        scores = [(2 * len(p & t) / (len(p) + len(t)), -n, name) for n, (name, t) in enumerate(TABLE)]
        dice, order, name = max(scores)
        if dice >= THRESHOLD:
            out[unit] = (name, -order, dice)
    return out


def check(table):
    want = sorted((r.doc_id, u, *v) for r in table.collect() for u, v in plain_scan(r.text).items())
    got = sorted((r.doc_id, r.unit_text, r.license, r.template, r.dice) for r in license_scan(table).collect())
    assert got == want
    return got


def test_notices_and_texts(docs):
    mit = templates()[0][1]
    words = mit.split()
    changed = " ".join(w if i % 17 else "other" for i, w in enumerate(words))
    far = " ".join(w if i % 4 else "other" for i, w in enumerate(words))
    texts = [
        "prose before\nReleased under the MIT License.\nprose after", "LICENSED under the Apache-License, version 2.0!",
        "Copyright (c) 2020 Someone\n\n" + mit, changed, far, "a licence to see\nor software for everyone", None, "",
        "Distributed under CC BY-NC 4.0.\r\nDistributed under CC BY-NC 4.0.", f"intro words\n\n{mit}\n\nmore words",
        "This work is licensed under the GNU General Public License, version 3.", "Released under the MIT",
        "cc_by_sa\n(c) 2019 x\n_licensed_ under_CC BY-SA 4.0",
    ]
    got = check(docs(*texts))
    by_doc = {d: (name, dice) for d, _, name, _, dice in got}
    assert by_doc[0] == ("MIT", 1.0) and by_doc[8][0] == "CC-BY-NC-4.0" and by_doc[10][0] == "GPL-3.0"
    assert by_doc[2][0] == by_doc[3][0] == by_doc[9][0] == "MIT"
    assert not {4, 5, 6, 7} & set(by_doc)


def test_anchors_are_lossless():
    anchors = set(anchor_words())
    for name, text in templates():
        left = {(a, b) for a, b in pairs(text) if a not in anchors and b not in anchors}
        # Even a unit of just the unanchored bigrams stays below the threshold.
        assert 2 * len(left) / (len(left) + len(pairs(text))) < THRESHOLD, name


def test_real_texts(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("doc_id < 300")
    assert check(table)


def test_odd_rows(odd, none):
    assert license_scan(odd).count() == 0
    assert license_scan(none).count() == 0
