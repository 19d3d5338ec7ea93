from __future__ import annotations

import random

import xxhash

import partatlas.llm.chunks as c
from partatlas.llm.chunks import chunk_ends, chunks, repeated_spans, without_repeats


def text_of(rng, n):
    return " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(9999)}" for _ in range(n))


def unspaced(rng, n):
    return "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(n))


def plain_ends(data):
    """Ends by the rolling step and a look at every neighbour."""
    h, hashes = 0, []
    for b in data:
        h = (2 * h + int(c._GEAR[b])) % (1 << 32)
        after = data[len(hashes) + 1] if len(hashes) + 1 < len(data) else 0
        closed = b and not 0x80 <= after < 0xC0
        hashes.append(h // 2 if b in b" \t\n\r\x0b\x0c" else h // 2 + (1 << 31) if closed else (1 << 32) - 1)
    out = []
    for i, x in enumerate(hashes):
        left, right = hashes[max(0, i - c.REACH) : i], hashes[i + 1 : i + c.REACH + 1]
        if all(x < y for y in left or [1 << 33]) and all(x <= y for y in right) and (left or x < (1 << 32) - 1):
            out.append(i)
    return out


def test_rolling_hash_and_ends():
    rng = random.Random(1)
    texts = [text_of(rng, n) for n in (0, 1, 5, 40, 400)] + [unspaced(rng, 300), "中" * 400, text_of(rng, 9) + unspaced(rng, 90)]
    for data in map(str.encode, texts):
        assert [e for e in chunk_ends(data).tolist()] == plain_ends(data)


def test_texts_do_not_touch_each_other():
    rng = random.Random(2)
    texts = [text_of(rng, n).encode() for n in (3, 200, 0, 77, 1)]
    assert list(chunks(texts)) == [next(chunks([t])) for t in texts]
    for plain, ends in chunks(texts):
        sizes = [b - a for a, b in zip([0, *ends], ends)]
        assert sum(sizes) == len(plain) and max(sizes, default=0) <= c.LONGEST


def test_insertion_shifts_nothing():
    rng = random.Random(3)
    text = text_of(rng, 600)
    other = text[:1500] + " inserted words" + text[1500:]
    cut = lambda t: {xxhash.xxh3_128_digest(p[a:b].rstrip()) for p, e in chunks([t.encode()]) for a, b in zip([0, *e], e)}
    assert len(cut(text) - cut(other)) <= 4


def covered(spans):
    return {(r.doc_id, i) for r in spans for i in range(r.start, r.stop)}


def test_passages_across_documents(spark, docs):
    rng = random.Random(4)
    passage = text_of(rng, 60)
    texts = [text_of(rng, 80) + " " + passage + "\n" + text_of(rng, 30), text_of(rng, 100),
             text_of(rng, 5) + "\n" + passage.replace(" ", "\n", 20) + " " + text_of(rng, 50), text_of(rng, 90),
             "ünïcode " + text_of(rng, 10) + "  " + passage, text_of(rng, 7) + " and" * 90, text_of(rng, 9) + " and" * 90]
    rows = repeated_spans(docs(*texts)).collect()
    firsts = {}
    for r in rows:
        firsts.setdefault(r.doc_id, set()).update(r.first_doc_ids)
        assert r.stop - r.start >= 100 and r.first_doc_id in r.first_doc_ids
        part = " ".join(texts[r.doc_id].encode()[r.start : r.stop].decode().split())
        assert part in " ".join(passage.split()) + " and" * 100 or r.doc_id in (5, 6)
    assert set(firsts) == {2, 4, 5, 6}
    assert 0 in firsts[2] & firsts[4] and firsts[5] == {5} and 5 in firsts[6]
    out = {r.doc_id: r.text for r in without_repeats(docs(*texts)).collect()}
    assert out[0] == texts[0] and out[1] == texts[1] and out[3] == texts[3]
    for d in (2, 4):
        assert len(out[d]) < len(texts[d]) - 100


def test_copies_and_brute_force(docs):
    """Every repeated word run that is long enough is found, and nothing else."""
    rng = random.Random(5)
    pool = [text_of(rng, 55) for _ in range(5)]
    texts = [text_of(rng, 40) + " " + rng.choice(pool) + " " + text_of(rng, 40) if i % 2 else text_of(rng, 90) for i in range(60)]
    texts += [texts[0], texts[1]]
    first, want = {}, set()
    for d, t in enumerate(texts):
        w = t.split()
        runs = [" ".join(w[i : i + 50]) for i in range(len(w) - 49)]
        if any(first.setdefault(x, d) != d for x in runs):
            want.add(d)
    assert {r.doc_id for r in repeated_spans(docs(*texts)).collect()} == want


def test_places_in_the_text_as_it_is():
    raw = "\n a  bc\t\tdé f \n".encode()
    plain = b" ".join(raw.split())
    cuts = [2, 5, len(plain)]
    places = c._places(raw, plain, cuts)
    assert raw[: places[0]].split() == [b"a"] and raw[places[0] : places[1]].split() == [b"bc"]
    assert raw[places[1] : places[2]].split() == ["dé".encode(), b"f"] and places[2] == len(raw)


def test_odd_rows(odd, none):
    rows = repeated_spans(odd).collect()
    assert {r.doc_id for r in rows} >= {6}
    assert all(r.doc_id in (5, 6, 7) for r in rows)
    out = without_repeats(odd)
    assert out.columns == odd.columns and out.count() == 12
    assert repeated_spans(none).count() == 0 and without_repeats(none).count() == 0


def test_text_without_spaces(docs):
    """A shared passage is found at any offset, and beyond an inserted character."""
    rng = random.Random(6)
    base64 = "".join(rng.choice("ABCDEFGHIJKLMNOPabcdefghijklmnop0123456789+/") for _ in range(4000))
    for passage in (unspaced(rng, 400), base64):
        half = len(passage) // 2
        texts = [unspaced(rng, 31) + passage, unspaced(rng, 50) + "x" + passage, passage[:half] + "y" + passage[half:],
                 unspaced(rng, 400)]
        sizes = {}
        for r in repeated_spans(docs(*texts)).collect():
            assert texts[r.doc_id].encode()[r.start : r.stop].decode() in texts[r.doc_id]
            sizes[r.doc_id] = sizes.get(r.doc_id, 0) + r.stop - r.start
        assert set(sizes) == {1, 2} and min(sizes.values()) > 0.75 * len(passage.encode())


def test_one_id_with_several_texts(spark):
    rng = random.Random(7)
    shared, own = text_of(rng, 70), text_of(rng, 60)
    texts = [text_of(rng, 30) + " " + shared, text_of(rng, 90) + " " + shared + " " + own, own + " " + text_of(rng, 20)]
    rows = [(1, texts[0]), (2, texts[1]), (2, texts[2]), (2, texts[2])]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    spans = repeated_spans(table).collect()
    hashes = {r.h: r.text for r in table.selectExpr("xxhash64(text) AS h", "text").collect()}
    cut = [(r.doc_id, hashes[r.text_hash].encode()[r.start : r.stop].decode()) for r in spans]
    assert {d for d, _ in cut} == {2} and all(part.strip() in shared or part.strip() in own for _, part in cut)
    assert sum(len(part) for _, part in cut if part.strip() in shared) > 0.7 * len(shared)
    assert sum(len(part) for _, part in cut if part.strip() in own) > 0.7 * len(own)
    out = [r.text for r in without_repeats(table).collect()]
    assert len(out) == 4 and texts[0] in out
    assert sum(map(len, set(out))) < sum(map(len, texts)) - len(shared) // 2 - len(own) // 2
