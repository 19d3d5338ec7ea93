"""Substring dedup by content-defined chunks.

White space is made single spaces first, so that line breaks do not matter. A gear
hash rolls over the bytes: each step doubles the hash and adds the
byte's random number, so in 32 bits it depends on the last 32 bytes alone. A chunk
ends behind a space whose hash is the least of all such places within ``REACH``
bytes to both sides; where no space lies that near, any end of a character counts, so
text without spaces is cut by its contents too. Ends thus depend on the surrounding
bytes only: an insertion moves them without changing chunks that lie beyond it. Chunks
are longer than ``REACH`` and about twice as long on average; a stretch without an end,
such as one character over and over, is cut every ``LONGEST`` bytes.

Chunks are told apart by a digest of 128 bits. A repeat inside a document is marked
where the document is cut. Between documents, an aggregate over digests finds the
smallest ``doc_id`` that has the chunk; all other documents repeat it. Only digests
with several documents come back to the chunks, by a join that adaptive execution may
split, so a chunk that every document has is not gathered anywhere.

Neighbouring repeated chunks form spans; a span shorter than ``SHORTEST_SPAN`` bytes
is chance, not a passage.

A document is a ``doc_id`` with a text, told by ``text_hash``: rows that repeat both are
the same document. Of different texts with one id, the one with the smallest hash keeps
what they share. The null id comes before all others. Null and empty texts have no
chunks. Other columns of ``docs`` are not looked at; an empty table gives no spans.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partatlas.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

REACH = 24
LONGEST = 128
SHORTEST_SPAN = 100
_NONE = -(1 << 63)
#: Bytes of text that are hashed at once.
_BLOCK = 1 << 22
_PAD = b"\0" * 64
_GEAR = np.array([0, *(int.from_bytes(hashlib.blake2b(bytes([i]), digest_size=4).digest(), "big") for i in range(1, 256))],
                 np.uint32)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_HALF = np.uint32(1 << 31)


def _least(v: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` values from a place on; beyond the end nothing counts."""
    out, have = v, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out, np.concatenate([out[step:], np.full(min(step, len(v)), 0xFFFFFFFF, np.uint32)]))
        have += step
    return out


def chunk_ends(data: bytes) -> np.ndarray:
    """Places behind which a chunk ends, forced cuts and the end of the text aside."""
    raw = np.frombuffer(data, np.uint8)
    h = _GEAR[raw]
    for k in (1, 2, 4, 8, 16):
        h = h + np.concatenate([np.zeros(k, np.uint32), h[:-k] << np.uint32(k)])[: len(h)]
    # A character ends before what is no continuation byte; any space is less than these.
    closed = np.append((raw[1:] & 0xC0) != 0x80, np.ones(min(1, len(raw)), bool)) & (raw != 0)
    v = np.where(_SPACE[raw], h >> np.uint32(1), np.where(closed, h >> np.uint32(1) | _HALF, np.uint32(0xFFFFFFFF)))
    right = _least(v, REACH + 1)
    left = _least(v[::-1], REACH + 1)[::-1]
    earlier = np.concatenate([np.full(1, 0xFFFFFFFF, np.uint32), _least(v[::-1], REACH)[::-1][:-1]])[: len(v)]
    return np.flatnonzero((v == right) & (v == left) & (v < earlier))


def chunks(texts: list[bytes]) -> Iterator[tuple[bytes, list[int]]]:
    """Each text with single spaces between its words, and where its chunks end."""
    plain = [b" ".join(t.split()) for t in texts]
    joined = _PAD.join(plain)
    ends = chunk_ends(joined).tolist() if joined else []
    at, base = 0, 0
    for text in plain:
        stop, last, cut = base + len(text), base, []
        while at < len(ends) and ends[at] < stop:
            cut.append(ends[at] + 1 - base)
            at += 1
        if text and (not cut or cut[-1] != len(text)):
            cut.append(len(text))
        if len(text) > LONGEST:
            last, forced = 0, []
            for end in cut:
                while end - last > LONGEST:
                    last += LONGEST
                    while text[last] & 0xC0 == 0x80:
                        last -= 1
                    forced.append(last)
                forced.append(end)
                last = end
            cut = forced
        yield text, cut
        base = stop + len(_PAD)


def _places(raw: bytes, plain: bytes, cuts: list[int]) -> list[int]:
    """Places of cuts of the plain text in the text as it is: word by word, and inside
    a word as far in."""
    if len(raw) == len(plain):
        return cuts
    space = _SPACE[np.frombuffer(raw, np.uint8)]
    words = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    begins = np.concatenate([[0], np.flatnonzero(np.frombuffer(plain, np.uint8) == 32) + 1])
    at = np.array(cuts[:-1], np.int64)
    word = np.searchsorted(begins, at, "right") - 1
    return [*(words[word] + at - begins[word]).tolist(), len(raw)]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest = xxhash.xxh3_128_digest

    def emit(docs: list[tuple[int, int]], texts: list[bytes]) -> pa.RecordBatch:
        doc, row, place, start, stop, again, digests = [], [], [], [], [], [], []
        for (d, r), raw, (text, ends) in zip(docs, texts, chunks(texts)):
            if not ends:
                continue
            found = [digest(text[a:b].rstrip()) for a, b in zip([0, *ends], ends)]
            met: set[bytes] = set()
            again += [x in met or met.add(x) is not None for x in found]
            digests += found
            ends = _places(raw, text, ends)
            doc += [d] * len(ends)
            row += [r] * len(ends)
            place += range(len(ends))
            start += [0, *ends[:-1]]
            stop += ends
        pairs = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
        return pa.RecordBatch.from_arrays(
            [pa.array(doc, pa.int64()), pa.array(row, pa.int64()), pa.array(place, pa.int32()), pa.array(start, pa.int32()),
             pa.array(stop, pa.int32()), pa.array(again, pa.bool_()),
             pa.array(np.ascontiguousarray(pairs[:, 0])), pa.array(np.ascontiguousarray(pairs[:, 1]))],
            names=["doc", "row", "place", "start", "stop", "again", "hi", "lo"])

    for batch in batches:
        docs, texts, size = [], [], 0
        for d, r, t in zip(batch.column("doc"), batch.column("row"), batch.column("text")):
            docs.append((d.as_py(), r.as_py()))
            texts.append((t.as_py() or "").encode("utf-8", "replace"))
            size += len(texts[-1])
            if size >= _BLOCK:
                yield emit(docs, texts)
                docs, texts, size = [], [], 0
        if docs:
            yield emit(docs, texts)


def chunk_table(docs: DataFrame) -> DataFrame:
    """Chunks of whole texts: ``doc``, ``row`` (hash of the text), ``place``, ``start``,
    ``stop`` (bytes), ``again`` (met before in this document) and the digest ``hi``, ``lo``."""
    text = F.col("text").cast("string")
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NONE)).alias("doc"), F.xxhash64(text).alias("row"), text.alias("text"),
    ).mapInArrow(_cut, "doc long, row long, place int, start int, stop int, again boolean, hi long, lo long")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Repeated passages: ``doc_id``, ``text_hash``, ``start`` and ``stop`` in bytes of the
    UTF-8 text, ``n_chunks``, ``first_doc_id`` (the document that keeps the passage's beginning) and
    ``first_doc_ids`` (all that keep a part of it)."""
    table = materialize(chunk_table(docs), "chunks")
    owned = table.filter("not again").groupBy("hi", "lo").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    shared = owned.filter("first < last").select("hi", "lo", "first")
    marked = ("doc", "row", "place", "start", "stop")
    between = table.filter("not again").join(shared, ["hi", "lo"]).filter("doc > first").select(*marked, "first")
    within = table.filter("again").select(*marked, F.col("doc").alias("first"))
    # Ids of several texts, stored first: they are few, and their size decides the join.
    several = table.groupBy("doc").agg(F.min("row").alias("least"), F.max("row").alias("most"))
    several = materialize(several.filter("least < most").select("doc"), "chunks-ids")
    own = table.filter("not again").join(several, "doc", "left_semi")
    keepers = own.groupBy("doc", "hi", "lo").agg(F.min("row").alias("keeper"))
    same_id = own.join(keepers, ["doc", "hi", "lo"]).filter("row > keeper").select(*marked, F.col("doc").alias("first"))
    # Rows that repeat a document mark the same places.
    repeats = between.union(within).union(same_id).groupBy("doc", "row", "place").agg(
        F.min("start").alias("start"), F.min("stop").alias("stop"), F.min("first").alias("first"))
    run = F.col("place") - F.row_number().over(Window.partitionBy("doc", "row").orderBy("place"))
    spans = repeats.select("*", run.alias("run")).groupBy("doc", "row", "run").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.count("*").alias("n_chunks"),
        F.min_by("first", "place").alias("first"), F.sort_array(F.collect_set("first")).alias("firsts"))
    named = lambda c: F.when(c != _NONE, c)
    return spans.filter(F.col("stop") - F.col("start") >= SHORTEST_SPAN).select(
        named(F.col("doc")).alias("doc_id"), F.col("row").alias("text_hash"), "start", "stop", "n_chunks",
        named(F.col("first")).alias("first_doc_id"),
        F.transform("firsts", named).alias("first_doc_ids"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages taken out of ``text``."""

    @F.pandas_udf("string")
    def cut_out(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, places in zip(texts, spans):
            if text is not None and places is not None and len(places):
                raw, at, kept = text.encode("utf-8", "replace"), 0, []
                for x in places:
                    kept.append(raw[at : x["start"]])
                    at = x["stop"]
                text = b"".join((*kept, raw[at:])).decode("utf-8", "replace")
            out.append(text)
        return pd.Series(out, dtype=object)

    spans = repeated_spans(docs).groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))
    rows = docs.withColumn("text", F.col("text").cast("string"))
    packed = rows.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"), F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"))
    joined = packed.join(spans, packed["id"].eqNullSafe(spans["doc_id"]) & (packed["hash"] == spans["text_hash"]), "left").select(
        "row", cut_out(F.col("row.text"), F.col("spans")).alias("new"))
    return joined.select(*[F.col("new").alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
