from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest

from partatlas.llm.pieces import double_array, encode, encode_decode, decode, segment, vocabulary

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocab():
    return vocabulary(MODEL)


def plain(text, vocab):
    """Ids by a Viterbi over the whole text with a dictionary of pieces."""
    if not text:
        return []
    s = "▁" + text.replace(" ", "▁")
    pieces = {}
    for k, i in enumerate(vocab["ids"].tolist()):
        pieces[vocab["spelled"][i].decode().replace(" ", "▁")] = (float(vocab["scores"][k]), i)
    best, back = [0.0] + [-np.inf] * len(s), [None] * (len(s) + 1)
    for a in range(len(s)):
        single = False
        for b in range(a + 1, min(len(s), a + 64) + 1):
            hit = pieces.get(s[a:b])
            if hit:
                single |= b == a + 1
                if best[a] + hit[0] > best[b]:
                    best[b], back[b] = best[a] + hit[0], (a, [hit[1]])
        if not single and best[a] + vocab["unknown"] > best[a + 1]:
            best[a + 1] = best[a] + vocab["unknown"]
            back[a + 1] = (a, [int(vocab["of_byte"][c]) for c in s[a].encode()])
    out, at = [], len(s)
    while at:
        at, ids = back[at]
        out = ids + out
    return out


def ids(text, vocab):
    return np.frombuffer(encode([text], vocab)[0], "<i4").tolist()


def test_double_array():
    random.seed(1)
    keys = sorted({bytes(random.choices(b"abc\xc3\xff\x00", k=random.randrange(1, 7))) for _ in range(400)})
    base, check, value = double_array(keys)

    def walk(key):
        state = 0
        for c in key:
            step = base[state] + c + 1
            if check[step] != state:
                return -1
            state = step
        return value[state]

    assert [walk(k) for k in keys] == list(range(len(keys)))
    for _ in range(300):
        other = bytes(random.choices(b"abcd\xc3", k=4))
        assert (walk(other) >= 0) == (other in keys)


TEXTS = ["", " ", "a", "  a  b ", "hello world", "日本語 텍스트 😀 naïve", "a\nb\t c", "x" * 70, "▁a ▁ b▁", " \n ", "é" * 20,
         "hest Erthen esuemente", "\x00\x01 null", "trailing ", "one  two   three    four", "<s> </s> <unk> <0x41>"]


@pytest.mark.parametrize("text", TEXTS)
def test_best_segmentation(text, vocab):
    assert ids(text, vocab) == plain(text, vocab)
    assert decode(np.array(ids(text, vocab)), vocab) == text.replace("▁", " ")


def test_real_texts(spark, vocab):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    for r in rows[:25]:
        text = (r.text or "")[:1500]
        assert ids(text, vocab) == plain(text, vocab)


def test_as_the_library_scores(vocab):
    """No segmentation of the library for this file has a larger sum."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for text in ("the quick brown fox", "internationalisation", "Donaudampfschiff", "été où"):
        score = lambda xs: sum(model.get_score(i) for i in xs)
        assert score(ids(text, vocab)) >= score(model.encode(text))
        assert model.decode(ids(text, vocab)) == text


def test_words_one_by_one_or_together(vocab):
    words = ["▁a".encode(), "▁hello".encode(), "▁x😀y".encode(), "▁".encode()]
    assert segment(words, vocab) == [segment([w], vocab)[0] for w in words]


def test_operator(odd, none, vocab):
    rows = encode_decode(odd, MODEL).collect()
    want = sorted(((r.doc_id, r.text or "") for r in odd.collect()), key=repr)
    assert sorted(((r.doc_id, r.decoded) for r in rows), key=repr) == want
    for r in rows:
        if r.decoded != "" and len(r.decoded) < 1000:
            assert r.ids == plain(r.decoded, vocab)
        assert (r.decoded == "") == (r.ids == [])
    assert encode_decode(none, MODEL).count() == 0


def test_whole_round_trip(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r.decoded for r in encode_decode(table, MODEL).collect()}
    assert got == {r.doc_id: r.text or "" for r in table.collect()}
