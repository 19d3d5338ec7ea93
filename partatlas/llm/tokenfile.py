"""Token files: ids in patched frame-of-reference blocks.

A segment is a self-contained piece of binary data that holds whole documents:

* ``PFOR``, then as little-endian integers the version and block size (2 bytes each)
  and the numbers of ids, documents and blocks (8 each);
* of each document its id (8), whether it has one (1) and its number of ids (4);
* where each block starts, counted from the first block (8), and where the last ends;
* the blocks: least id (4), width in bits (1), number of exceptions (2), the
  differences to the least id packed at that width, then the exceptions' places in
  the block (2 each) and differences (4 each).

The width is that of the difference at ``PERCENTILE`` of the block; larger ones are
exceptions. The last block is filled up with its least id. Segments are rows of a
Parquet dataset, written by Spark's committer, so a lost task leaves nothing behind
and any store that Spark writes to will do. Shards are ranges of document ids and
segments follow each other inside a shard, so the dataset is in order of ids.

A document is encoded in the pieces that the tokenizer itself splits a text into, each
by the library's model. A worker keeps the pieces it has met lately, up to a bound.
"""

from __future__ import annotations

import json
import os
import re
import struct
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 128
PERCENTILE = 90
END_OF_DOCUMENT = 0
#: Ids after which a segment ends with the document at hand.
SEGMENT_IDS = 1 << 20
#: Pieces of a generation that are remembered, and characters of the longest of them.
MEMO_PIECES = 400_000
MEMO_CHARS = 64
_HEAD = "<4sHHQQQ"
_SEGMENTS = "shard int, segment int, n_ids long, n_docs long, data binary"
_DOCS = "shard int, segment int, doc_id long, n_tokens long, before long, ids binary"


def pack(ids: np.ndarray, doc_ids: list[int | None], lengths: list[int]) -> bytes:
    """A segment of the given ids; ``lengths`` cuts them into documents."""
    n, n_blocks = len(ids), -(-len(ids) // BLOCK)
    grid = np.zeros(n_blocks * BLOCK, np.int64)
    grid[:n] = ids
    if n_blocks:
        grid[n:] = ids[(n_blocks - 1) * BLOCK :].min()
    grid = grid.reshape(n_blocks, BLOCK)
    least = grid.min(1) if n_blocks else np.zeros(0, np.int64)
    delta = (grid - least[:, None]).astype("<u4")
    at = (BLOCK - 1) * PERCENTILE // 100
    chosen = np.partition(delta, at, 1)[:, at] if n_blocks else np.zeros(0, "<u4")
    width = np.ceil(np.log2(chosen.astype(np.float64) + 1)).astype(np.int64)
    patched = (delta.astype(np.int64) >> width[:, None]) > 0
    n_patched = patched.sum(1)
    starts = np.concatenate([[0], np.cumsum(7 + 2 * BLOCK // 16 * width + 6 * n_patched)]).astype("<u8")

    body = np.zeros(int(starts[-1]), np.uint8)
    first = starts[:-1].astype(np.int64)
    for k, column in enumerate(np.ascontiguousarray(least.astype("<u4")).view(np.uint8).reshape(-1, 4).T):
        body[first + k] = column
    body[first + 4] = width
    for k, column in enumerate(np.ascontiguousarray(n_patched.astype("<u2")).view(np.uint8).reshape(-1, 2).T):
        body[first + 5 + k] = column
    for w in np.unique(width[width > 0]).tolist():
        rows = np.flatnonzero(width == w)
        bits = np.unpackbits(delta[rows].view(np.uint8).reshape(len(rows), BLOCK, 4), axis=2, bitorder="little")
        packed = np.packbits(bits[:, :, :w].reshape(len(rows), -1), axis=1, bitorder="little")
        body[first[rows][:, None] + 7 + np.arange(packed.shape[1])] = packed
    rows, cols = np.nonzero(patched)
    rank = np.arange(len(rows)) - np.repeat(np.cumsum(n_patched) - n_patched, n_patched)
    tail = first[rows] + 7 + 16 * width[rows]
    places = np.ascontiguousarray(cols.astype("<u2")).view(np.uint8).reshape(-1, 2)
    values = np.ascontiguousarray(delta[rows, cols]).view(np.uint8).reshape(-1, 4)
    body[(tail + 2 * rank)[:, None] + np.arange(2)] = places
    body[(tail + 2 * n_patched[rows] + 4 * rank)[:, None] + np.arange(4)] = values
    return b"".join((
        struct.pack(_HEAD, b"PFOR", 1, BLOCK, n, len(lengths), n_blocks),
        np.array([0 if x is None else x for x in doc_ids], "<i8").tobytes(),
        np.array([x is not None for x in doc_ids], np.uint8).tobytes(),
        np.array(lengths, "<u4").tobytes(), starts.tobytes(), body.tobytes(),
    ))


def unpack(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, numbers of ids and all ids of a segment."""
    magic, version, block, n, n_docs, n_blocks = struct.unpack_from(_HEAD, data)
    if magic != b"PFOR" or version != 1:
        raise ValueError("not a token segment")
    at = struct.calcsize(_HEAD)
    known = np.frombuffer(data, np.uint8, n_docs, at + 8 * n_docs)
    doc_ids = [x if k else None for x, k in zip(np.frombuffer(data, "<i8", n_docs, at).tolist(), known.tolist())]
    at += 9 * n_docs
    lengths = np.frombuffer(data, "<u4", n_docs, at).astype(np.int64)
    at += 4 * n_docs
    first = np.frombuffer(data, "<u8", n_blocks + 1, at)[:-1].astype(np.int64)
    body = np.frombuffer(data, np.uint8, offset=at + 8 * (n_blocks + 1))
    number = lambda where, size: (
        body[where[:, None] + np.arange(size)].astype(np.int64) << (8 * np.arange(size))).sum(1)
    least, width, n_patched = number(first, 4), body[first + 4].astype(np.int64), number(first + 5, 2)
    delta = np.zeros((n_blocks, block), np.int64)
    for w in np.unique(width[width > 0]).tolist():
        rows = np.flatnonzero(width == w)
        packed = body[first[rows][:, None] + 7 + np.arange(w * block // 8)]
        bits = np.zeros((len(rows), block, 32), np.uint8)
        bits[:, :, :w] = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(rows), block, w)
        delta[rows] = np.packbits(bits, axis=2, bitorder="little").view("<u4").reshape(len(rows), block)
    rows = np.repeat(np.arange(n_blocks), n_patched)
    rank = np.arange(len(rows)) - np.repeat(np.cumsum(n_patched) - n_patched, n_patched)
    tail = first[rows] + 7 + block // 8 * width[rows]
    delta[rows, number(tail + 2 * rank, 2)] = number(tail + 2 * n_patched[rows] + 4 * rank, 4)
    return doc_ids, lengths, (delta + least[:, None]).ravel()[:n].astype("<u4")


# The tokenizer's own splitting; for texts in Latin-1 with the classes spelled out,
# which the standard module searches faster.
_SPLIT = regex.compile(r" ?\p{L}+| ?\p{N}+|'s|'t|'re|'ve|'m|'ll|'d| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_L, _N, _S = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
_SPLIT_LATIN = re.compile(
    rf" ?[{_L}]+| ?[{_N}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")


def split(text: str) -> list[str]:
    """Pieces that the tokenizer encodes one by one."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _SPLIT.findall(text)
    return _SPLIT_LATIN.findall(text)


class _Memo(dict):
    """Ids of pieces; a piece that is new is encoded by the library's model. Long pieces
    are not remembered, so that the bytes kept are bounded like their number."""

    def __init__(self, tokenize, letters: list[str], earlier: dict[str, bytes]) -> None:
        self.tokenize, self.letters, self.earlier = tokenize, letters, earlier

    def __missing__(self, piece: str) -> bytes:
        ids = self.earlier.get(piece)
        if ids is None:
            spelled = "".join(map(self.letters.__getitem__, piece.encode("utf-8", "replace")))
            ids = struct.pack(f"<{len(found := self.tokenize(spelled))}I", *[t.id for t in found])
        if len(piece) <= MEMO_CHARS:
            self[piece] = ids
        return ids


class PieceEncoder:
    """Encodes texts piece by piece and remembers the pieces met lately.

    Added tokens of the file are looked for in texts first, the earliest and then the
    longest one; what lies between is encoded on its own. ``added=False`` takes their
    strings as plain text.
    """

    def __init__(self, tokenizer_json: str, added: bool = True) -> None:
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(tokenizer_json).model
        # Byte-level vocabularies write a byte as itself if it is printable Latin-1
        # without white space, the others as characters from 256 on.
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = iter(range(256, 512))
        self.letters = [chr(b) if b in own else chr(next(rest)) for b in range(256)]
        self.memo = _Memo(self.model.tokenize, self.letters, {})
        described = json.loads(tokenizer_json)
        self.vocabulary = described["model"]["vocab"]
        tokens = described.get("added_tokens") or []
        if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in tokens):
            raise ValueError("added tokens that take in their neighbourhood are not supported")
        self.added = {t["content"]: struct.pack("<I", t["id"]) for t in tokens} if added else {}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.find_added = re.compile("|".join(map(re.escape, longest_first))) if longest_first else None

    def token_bytes(self) -> list[bytes]:
        """Bytes that each id of the vocabulary stands for."""
        of_letter = {c: b for b, c in enumerate(self.letters)}
        out = [b""] * (max(self.vocabulary.values()) + 1)
        for token, i in self.vocabulary.items():
            out[i] = bytes(of_letter[c] for c in token) if of_letter.keys() >= set(token) else token.encode()
        return out

    def ids(self, text: str) -> bytes:
        """Ids of a text as four-byte integers."""
        if self.find_added is None or not self.find_added.search(text):
            return b"".join(map(self.memo.__getitem__, split(text)))
        out, at = [], 0
        for found in self.find_added.finditer(text):
            out += map(self.memo.__getitem__, split(text[at : found.start()]))
            out.append(self.added[found.group()])
            at = found.end()
        out += map(self.memo.__getitem__, split(text[at:]))
        return b"".join(out)

    def forget(self) -> None:
        """Start a generation of pieces when the last one is full."""
        if len(self.memo) > MEMO_PIECES:
            self.memo = _Memo(self.model.tokenize, self.letters, dict(self.memo))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, end of document included, as four-byte integers."""
        self.forget()
        end = struct.pack("<I", END_OF_DOCUMENT)
        return [self.ids(t) + end for t in texts]


def token_segments(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    """Segments of all rows of ``docs``, in order of ``doc_id``.

    Null texts are empty, a null ``doc_id`` comes first, rows that repeat a
    ``doc_id`` are documents of their own, ordered by a hash of their text.
    """
    with open(tokenizer_file, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast({"json": f.read()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        state = shared.value
        if "encoder" not in state:
            state["encoder"] = PieceEncoder(state["json"])
        shard, segment = TaskContext.get().partitionId(), 0
        coded, doc_ids, size = [], [], 0

        def flush() -> pa.RecordBatch:
            lengths = [len(x) // 4 for x in coded]
            data = pack(np.frombuffer(b"".join(coded), "<u4"), doc_ids, lengths)
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([segment], pa.int32()), pa.array([sum(lengths)], pa.int64()),
                 pa.array([len(lengths)], pa.int64()), pa.array([data], pa.binary())],
                names=["shard", "segment", "n_ids", "n_docs", "data"])

        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for i in range(0, len(ids), 256):
                part = [x or "" for x in texts.slice(i, 256).to_pylist()]
                for doc_id, code in zip(ids[i : i + 256], state["encoder"].encode(part)):
                    coded.append(code)
                    doc_ids.append(doc_id)
                    size += len(code) // 4
                    if size >= SEGMENT_IDS:
                        yield flush()
                        coded, doc_ids, size, segment = [], [], 0, segment + 1
        if coded:
            yield flush()

    ordered = (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64("text").alias("tie"))
        .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    )
    return ordered.mapInArrow(run, _SEGMENTS)


def write_token_file(docs: DataFrame, path: str, tokenizer_file: str) -> None:
    token_segments(docs, tokenizer_file).write.parquet(path)


def token_documents(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a token file: ``doc_id``, ``n_tokens`` and ``ids`` (four-byte
    little-endian integers), with ``shard``, ``segment`` and ``before``, the ids before
    the document in its segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shards, segments, blobs = (batch.column(c) for c in ("shard", "segment", "data"))
            for i in range(batch.num_rows):
                doc_ids, lengths, ids = unpack(blobs[i].as_py())
                ends = np.cumsum(lengths)
                # A value of a binary column holds 2 GB at most, and so does a batch.
                cuts = [0, *np.flatnonzero(np.diff(ends // (1 << 24))) + 1, len(lengths)]
                for a, b in zip(cuts, cuts[1:]):
                    first = int(ends[a] - lengths[a]) if b > a else 0
                    bounds = np.concatenate([[0], 4 * (ends[a:b] - first)]).astype(np.int32)
                    data = pa.BinaryArray.from_buffers(
                        pa.binary(), b - a, [None, pa.py_buffer(bounds), pa.py_buffer(ids[first : first + bounds[-1] // 4])])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(b - a, shards[i].as_py(), np.int32)),
                         pa.array(np.full(b - a, segments[i].as_py(), np.int32)), pa.array(doc_ids[a:b], pa.int64()),
                         pa.array(lengths[a:b]), pa.array((ends - lengths)[a:b]), data],
                        names=["shard", "segment", "doc_id", "n_tokens", "before", "ids"])

    return spark.read.parquet(path).select("shard", "segment", "data").mapInArrow(run, _DOCS)


def with_start(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` (rows of ``token_documents``) with ``start``, the ids of all documents
    before, instead of the three columns that place them in the file.

    Only the numbers of ids of shards and segments are summed up and joined.
    """
    stored = docs.sparkSession.read.parquet(path)
    up_to = Window.unboundedPreceding, -1
    in_shard = Window.partitionBy("shard").orderBy("segment").rowsBetween(*up_to)
    shards = stored.groupBy("shard").agg(F.sum("n_ids").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("shard").rowsBetween(*up_to)), F.lit(0))
        .alias("shard_start"))
    offsets = stored.select(
        "shard", "segment", F.coalesce(F.sum("n_ids").over(in_shard), F.lit(0)).alias("segment_start"),
    ).join(shards, "shard").select("shard", "segment", (F.col("shard_start") + F.col("segment_start")).alias("first"))
    return docs.join(offsets, ["shard", "segment"]).withColumn("start", F.col("first") + F.col("before")).drop(
        "first", "before", "shard", "segment")


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids`` of every document of a token file."""
    return with_start(token_documents(spark, path), path).select("doc_id", "start", "n_tokens", "ids")
