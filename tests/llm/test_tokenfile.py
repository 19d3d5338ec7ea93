from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import partatlas.llm.tokenfile as t
from partatlas.session import work_dir

FILE = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["", " ", "  a  b ", "it 's a\n\n b", "a \n b", "\xa0x y z", "<|endoftext|> a", "a <|endoftext|> b", "x  <|endoftext|><|endoftext|>\n <|endoftext|", "日本 語", "a\x1cb c", " lead", "trail ",
         "one two\nthree", "I'll we're don't", "tab\tand  spaces", "😀 é ü", "x" * 3000]


@pytest.fixture(scope="module")
def library():
    tok = Tokenizer.from_file(FILE)
    return lambda texts: [x.ids + [0] for x in tok.encode_batch(texts, add_special_tokens=False)]


def test_pieces_are_as_whole_texts(library, monkeypatch):
    """Also while pieces are forgotten, and for any mixture of characters."""
    rng = random.Random(3)
    letters = list("ab e'  \n\t.,;#9²½ªµéÀß÷×\x85\xa0\x1c\x1d\x0b \u3000日本Ωжы😀٣Ⅷ_-sdmtrevl'")
    texts = TEXTS + ["".join(rng.choices([*letters, "<|endoftext|>"], k=rng.randrange(1, 40))) for _ in range(3000)]
    for bound in (10**6, 50):
        monkeypatch.setattr(t, "MEMO_PIECES", bound)
        coder = t.PieceEncoder(open(FILE, encoding="utf-8").read())
        got = [np.frombuffer(x, "<u4").tolist() for i in range(0, len(texts), 100) for x in coder.encode(texts[i : i + 100])]
        assert got == library(texts)


def test_special_strings_as_plain_text():
    tok = Tokenizer.from_file(FILE)
    tok.encode_special_tokens = True
    coder = t.PieceEncoder(open(FILE, encoding="utf-8").read(), added=False)
    for text in TEXTS:
        assert np.frombuffer(coder.ids(text), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids
        assert b"".join(coder.token_bytes()[i] for i in tok.encode(text).ids) == text.encode()


def test_very_long_words(library):
    """They are encoded whole and not remembered."""
    rng = random.Random(5)
    texts = ["".join(rng.choices("abcdefgh", k=20_000)), "é" * 9_000 + " tail", "z" * 30_000]
    coder = t.PieceEncoder(open(FILE, encoding="utf-8").read())
    assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)] == library(texts)
    assert max(map(len, coder.memo)) <= t.MEMO_CHARS


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    for ids in (rng.zipf(1.3, n) % 50_000, rng.integers(0, 2**32, n), np.full(n, 7), np.where(rng.random(n) < 0.02, 2**31, 5)):
        ids = ids.astype("<u4")
        lengths = [n // 3, 0, n - n // 3]
        data = t.pack(ids, [-5, None, 2**40], lengths)
        names, got_lengths, got = t.unpack(data)
        assert names == [-5, None, 2**40] and got_lengths.tolist() == lengths and got.tolist() == ids.tolist()


def test_outliers_do_not_widen_blocks():
    ids = np.arange(1280) % 8
    small = len(t.pack(ids.astype("<u4"), [1], [1280]))
    ids[::100] = 40_000
    assert len(t.pack(ids.astype("<u4"), [1], [1280])) == small + 6 * 13


def check(spark, table, library):
    path = work_dir(spark, "tokens-test")
    t.write_token_file(table, path, FILE)
    rows = sorted(t.read_token_file(spark, path).collect(), key=lambda r: r.start)
    got = [(r.doc_id, r.n_tokens, zlib.crc32(r.ids)) for r in rows]
    texts = [(r.doc_id, r.text or "") for r in table.collect()]
    want = [(d, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for (d, _), x in zip(texts, library([x for _, x in texts]))]
    order = lambda x: (x[0] is not None, x[0] or 0)
    assert [g[0] for g in got] == [w[0] for w in sorted(want, key=order)]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    start = 0
    for r in rows:
        assert r.start == start
        start += r.n_tokens
    return path


def test_file(spark, docs, library, monkeypatch):
    check(spark, docs(*TEXTS), library)
    monkeypatch.setattr(t, "SEGMENT_IDS", 500)
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(7)
    path = check(spark, table, library)
    assert spark.read.parquet(path).count() > 20


def test_odd_rows(spark, odd, none, library):
    check(spark, odd, library)
    check(spark, none, library)
