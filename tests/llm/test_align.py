"""Alignments against a comparison of every A token with every B token."""

from __future__ import annotations

import hashlib
import random
from collections import Counter
from itertools import chain

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import partatlas.llm.align as t
from partatlas.llm.queries import op11_token_alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    """Tokens of a text as (id, start, end) on each side, by the libraries over whole texts."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in printable} | {
        chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in printable)}

    def spans(ids, raws):
        out, end = [], 0
        for i, raw in zip(ids, raws):
            out.append((i, end, end + len(raw)))
            end += len(raw)
        return out

    def run(text):
        if not text:
            return [], []
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        raw_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        ids_b = b.encode(text)
        names = [b.id_to_piece(i) for i in ids_b]
        raw_b = [bytes([int(x[3:5], 16)]) if b.is_byte(i) else x.replace("▁", " ").encode() for i, x in zip(ids_b, names)]
        if b"".join(raw_a) != b"".join(raw_b) or b"".join(raw_a) != (" " + text).encode():
            return [], []
        return spans(ids_a, raw_a), spans(ids_b, raw_b)

    return run


def brute(rows, plain):
    """Rows of the query and the groups as text."""
    sides = [(doc_id, *plain(text)) for doc_id, text in rows]
    links = [[(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]] for _, a, b in sides]
    counts = Counter(x for per_doc in links for x in per_doc)
    top: dict = {}
    for (_, b), n in counts.items():
        top[b] = max(n, top.get(b, 0))
    out = []
    for (doc_id, a, b), per_doc in zip(sides, links):
        groups, ends, start = [], sorted({x[2] for x in a} & {x[2] for x in b}), 0
        for end in ends:
            inside = lambda side: ",".join(str(i) for i, s, e in side if start <= s and e <= end)  # noqa: E731,B023
            groups.append(f"{inside(a)}|{inside(b)}")
            start = end
        out.append((doc_id, len(a), len(b), len(ends), len(per_doc), sum(counts[x] == top[x[1]] for x in per_doc),
                    sum(counts[x] for x in per_doc), ";".join(groups)))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
TEXTS = [None, "", " ", "  ", "a", "  two  spaces ", "line\nnext \n  line\r\n", "été naïve 日本語 😀 text", "a▁b plain", "x <|endoftext|> <s> </s> <unk>",
         "tabs\t\tand\xa0nbsp \xa0 x", "　wide　space", "don't I'll we've", "3.14 2,000 a-b_c", "a\x00b \x1c c\x85 d", "Ω≈ç√ ﬁ ½ é"]


def test_odd_texts(docs, plain):
    rows = t.align(docs(*TEXTS), A, B).select(COLUMNS).collect()
    assert sorted(map(tuple, rows), key=repr) == brute(list(enumerate(TEXTS)), plain)
    by_id = {r.doc_id: r for r in rows}
    for i in (0, 1, 8):
        assert tuple(by_id[i])[1:] == (0, 0, 0, 0, 0, 0, "")


def test_random_texts_in_small_blocks(docs, plain, monkeypatch):
    rng = random.Random(4)
    letters = list("ab e'  \n\t.,#9½éß\x85\xa0\x1c　日本ж😀_-stn") + ["the", " the", "ing", "▁", "<s>"]
    texts = ["".join(rng.choices(letters, k=rng.randrange(1, 60))) for _ in range(400)]
    monkeypatch.setattr(t, "BLOCK_CHARS", 900)
    monkeypatch.setattr(t, "_OUT_CHARS", 200)
    monkeypatch.setattr(t, "MEMO_STRETCHES", 100)
    rows = t.align(docs(*texts), A, B).select(COLUMNS).collect()
    assert sorted(map(tuple, rows), key=repr) == brute(list(enumerate(texts)), plain)


def test_stretches_are_as_whole_texts(plain):
    rng = random.Random(8)
    aligner = t.Aligner(open(A, encoding="utf-8").read(), open(B, "rb").read())
    letters = list("ab e'  \n\t.,;#9²½ªµéÀß÷×\x85\xa0\x1c\x1d\x0b 　日本Ωжы😀٣Ⅷ_-sdmtrevl'")
    texts = ["".join(rng.choices(letters, k=rng.randrange(1, 40))) for _ in range(3000)]
    for text in texts:
        a, b = plain(text)
        parts = aligner.aligned(dict.fromkeys(t.stretches_of(text)))
        got = [parts[x] for x in t.stretches_of(text)]
        if None in got:
            assert not a
            continue
        assert (sum(x[0] for x in got), sum(x[1] for x in got)) == (len(a), len(b))
    # All at once, while stretches are forgotten, gives the same.
    before = aligner.aligned(dict.fromkeys(chain.from_iterable(map(t.stretches_of, texts))))
    fresh = t.Aligner(open(A, encoding="utf-8").read(), open(B, "rb").read())
    assert fresh.aligned(before) == before


def test_long_stretches_are_not_remembered():
    aligner = t.Aligner(open(A, encoding="utf-8").read(), open(B, "rb").read())
    assert aligner.aligned(["short", "x" * 5_000])["x" * 5_000][0] > 1
    assert list(aligner.memo) == ["short"]


def test_query_against_brute_force(spark, plain):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    short = {i for i, text in rows if text is None or len(text) < 4_000}
    got = op11_token_alignment(spark, SF).select(*COLUMNS[:-1], "groups_sha256").collect()
    assert len(got) == len(rows)
    # Counts are over all texts; long ones need another way than all pairs.
    want = {r[0]: r for r in brute_of_all(rows, plain, short)}
    for r in got:
        w = want[r.doc_id]
        assert tuple(r)[:7] == w[:7]
        if w[7] is not None:
            assert r.groups_sha256 == (hashlib.sha256(w[7].encode()).hexdigest() if w[7] else "")


def brute_of_all(rows, plain, short):
    """As ``brute``, with links by a sweep over bytes and groups of short texts only."""
    sides = {i: plain(text) for i, text in rows}
    links = {}
    for i, (a, b) in sides.items():
        of_byte = [y[0] for y in b for _ in range(y[2] - y[1])]
        place = [k for k, y in enumerate(b) for _ in range(y[2] - y[1])]
        links[i] = [(x[0], of_byte[p]) for x in a for p in range(x[1], x[2]) if p == x[1] or place[p] != place[p - 1]]
    counts = Counter(x for per_doc in links.values() for x in per_doc)
    top: dict = {}
    for (_, b), n in counts.items():
        top[b] = max(n, top.get(b, 0))
    for i, (a, b) in sides.items():
        common = sorted({x[2] for x in a} & {x[2] for x in b})
        told = None
        if i in short:
            parts, start = [], 0
            for end in common:
                parts.append("|".join(",".join(str(k) for k, s, e in side if start <= s and e <= end) for side in (a, b)))
                start = end
            told = ";".join(parts)
        yield (i, len(a), len(b), len(common), len(links[i]), sum(counts[x] == top[x[1]] for x in links[i]),
               sum(counts[x] for x in links[i]), told)


def test_odd_rows(odd, none, plain):
    rows = t.align(odd, A, B).select(COLUMNS).collect()
    assert len(rows) == odd.count()
    small = [(r.doc_id, r.text) for r in odd.collect() if len(r.text or "") < 1000]
    want = {(r[0], *r[1:4], r[7]) for r in brute(small, plain)}
    assert want <= {(r.doc_id, r.n_a, r.n_b, r.n_groups, r.groups) for r in rows}
    assert t.align(none, A, B).collect() == []


def test_ends_by_hand():
    ends = lambda *x: np.cumsum(x)
    plain_lists = lambda arrays: [x.tolist() for x in arrays]
    assert plain_lists(t.common_ends(ends(2, 3, 1), ends(4, 2))) == [[6], [3], [2]]
    assert plain_lists(t.linked(ends(2, 3, 1), ends(4, 2)))[1:] == [[0, 1, 1, 2], [0, 0, 1, 1]]
    assert plain_lists(t.common_ends(ends(2, 2, 1), ends(2, 3))) == [[2, 5], [1, 3], [1, 2]]
    assert plain_lists(t.linked(ends(2, 2, 1), ends(2, 3)))[1:] == [[0, 1, 2], [0, 1, 1]]
    words = t._Words(5, 9).of_groups(np.array([1, 2, 3]), np.array([7, 8]), np.array([1, 3]), np.array([1, 2]))
    assert "".join(words) == "1|7;2,3|8;"


def test_links_are_kept_as_numbers_not_objects(plain):
    aligner = t.Aligner(open(A, encoding="utf-8").read(), open(B, "rb").read())
    words = ["unhurried", "2,450", "żółw", "<s>", "x" * 200, "don't"]
    for word, found in aligner.aligned(words).items():
        a, b = plain(word)
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        assert isinstance(found[5], bytes)
        codes = np.frombuffer(found[5], np.int64)
        assert sorted(zip((codes // t.PAIR).tolist(), (codes % t.PAIR).tolist())) == sorted(links)
        assert found[:4] == (len(a), len(b), found[4].count(";") + 1, len(links))
