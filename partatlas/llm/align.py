"""Alignment of two tokenizers' ids of the same text.

Tokenizer A is a byte-level BPE file and encodes a space and the text; tokenizer B is a
SentencePiece BPE file and encodes the text, before which it puts a space itself. Strings
of special tokens inside a text are plain text for both. Tokens are compared by the bytes
they stand for: the cumulative ends of each side are the keys of a dictionary to token
numbers, the keys that both dictionaries have are the common ends, and between two common
ends lies a group of A tokens and B tokens. Inside a group each pair of tokens whose byte
ranges overlap is a link.

Both sides always end a token before a space that follows something other than white
space, so a text falls into stretches at these places. A stretch is aligned once and
remembered, a document is the sequence of its stretches. Only short stretches are
remembered and two generations of a fixed number are kept, so memory is bounded whatever
the texts.

How often an id pair is linked in the whole corpus has to come back to every document.
Documents are taken in blocks of bounded size. A block numbers its distinct stretches and
pairs, and what is shuffled is one row for each block and distinct pair: sums by pair,
the best sum of each B id, and a join of both back to the block, where documents are
scored from their numbered stretches. No count table is broadcast, as pairs grow with the
corpus.

A text that is null or empty, or whose joined token bytes on either side differ from
the space and the text, has no tokens: zeros and no groups. Repeated rows are rows of
their own and count each; a null ``doc_id`` stays null; other columns are not looked at;
an empty table gives no rows. Very long texts are one document in a block of their own.
Ties: every A id whose count is its B id's highest is best.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partatlas.llm.tokenfile import PieceEncoder
from partatlas.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Stretches of one generation, the longest that is remembered, characters of a block.
MEMO_STRETCHES = 160_000
MEMO_CHARS = 48
BLOCK_CHARS = 1 << 23
#: Documents that leave a worker at once, in characters.
_OUT_CHARS = 1 << 19
#: Stretches that are aligned at once.
_AT_ONCE = 5_000
#: A pair of ids as one number: A times this, plus B.
PAIR = 1 << 32
_CUT = re.compile(r"(?<=\S) (?=[\s\S])")
_BLANK = re.compile(r"\s ")
_STORED = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, stretches binary, "
    "pairs array<long>, times array<long>, pair_numbers binary, n_pairs binary")
_SCORED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"

#: Numbers of A tokens, B tokens, groups and links, the groups as text, the links' pairs
#: as eight bytes each.
Aligned = tuple[int, int, int, int, str, bytes]
#: In place of an alignment that does not exist.
_NOTHING: Aligned = (0, 0, 0, 0, "", b"")


def common_ends(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ends that both sides have, in order, and how many A tokens and how many B
    tokens lie before each: the cuts between groups."""
    a_index = dict(zip(a_ends.tolist(), range(1, len(a_ends) + 1)))
    b_index = dict(zip(b_ends.tolist(), range(1, len(b_ends) + 1)))
    ends = sorted(a_index.keys() & b_index.keys())
    return (np.array(ends, np.int64), np.array(list(map(a_index.__getitem__, ends)), np.int64),
            np.array(list(map(b_index.__getitem__, ends)), np.int64))


def linked(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping pairs of tokens: the end of each overlap, the A and the B token.

    Inside a group, whose tokens lie next to each other on both sides, two tokens
    overlap exactly where one of them ends first, so each end of either side is a link.
    """
    # Two sorted runs: a stable sort merges them.
    ends = np.sort(np.concatenate([a_ends, b_ends]), kind="stable")
    ends = ends[np.diff(ends, prepend=-1) > 0]
    return ends, np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)


def _numbers(values: list[int]) -> np.ndarray:
    return np.frombuffer(array("q", values), np.int64)


class _Words:
    """Decimal ids with the sign behind them: A ids end in ``,`` or, last of a group, in
    ``|``, B ids in ``,`` or ``;``."""

    def __init__(self, n_a: int, n_b: int) -> None:
        self.n_a, self.n_b = n_a, n_b
        self.table = [f"{i}{sign}" for n, signs in ((n_a, ",|"), (n_b, ",;")) for sign in signs for i in range(n)]
        self.lengths = np.array(list(map(len, self.table)))

    def of_groups(self, a: np.ndarray, b: np.ndarray, a_upto: np.ndarray, b_upto: np.ndarray) -> list[str]:
        """Ids of all groups one after the other, A tokens before B tokens in each."""
        return list(map(self.table.__getitem__, self.order(a, b, a_upto, b_upto).tolist()))

    def order(self, a: np.ndarray, b: np.ndarray, a_upto: np.ndarray, b_upto: np.ndarray) -> np.ndarray:
        """Places in ``table`` of the ids of all groups."""
        a_last, b_last = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        a_last[a_upto - 1] = b_last[b_upto - 1] = 1
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.append(0, b_upto)[a_group]] = a + self.n_a * a_last
        order[np.arange(len(b)) + a_upto[b_group]] = b + 2 * self.n_a + self.n_b * b_last
        return order


def stretches_of(text: str | None) -> list[str]:
    """Stretches of a text, each without the space before it; none for an empty text."""
    if not text:
        return []
    plain = text[0] != " " and text[-1] != " " and not _BLANK.search(text)
    return text.split(" ") if plain else _CUT.split(text)


class Aligner:
    """Both tokenizers and the stretches met lately."""

    def __init__(self, a_json: str, b_model: bytes) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.a_bytes = PieceEncoder(a_json).token_bytes()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        texts = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(t[1:-1], 16)]) if self.b.is_byte(i) else t.replace("▁", " ").encode() for i, t in enumerate(texts)]
        self.a_sizes, self.b_sizes = (np.array(list(map(len, x))) for x in (self.a_bytes, self.b_bytes))
        self.words = _Words(len(self.a_bytes), len(self.b_bytes))
        self.memo: dict[str, Aligned | None] = {}
        self.earlier: dict[str, Aligned | None] = {}

    def aligned(self, stretches: Iterable[str]) -> dict[str, Aligned | None]:
        """Alignment of each of some distinct stretches, none where bytes differ."""
        if len(self.memo) > MEMO_STRETCHES:
            self.memo, self.earlier = {}, self.memo
        memo, out, unknown = self.memo, {}, []
        for s in stretches:
            if s in memo:
                out[s] = memo[s]
            elif s in self.earlier:
                out[s] = memo[s] = self.earlier[s]
            else:
                unknown.append(s)
        # What follows white space at the end of a stretch might change its tokens.
        closed = [s for s in unknown if s and not s[-1].isspace()]
        batches = [closed[i : i + _AT_ONCE] for i in range(0, len(closed), _AT_ONCE)]
        if len(closed) < len(unknown):
            batches += [[s] for s in unknown if not s or s[-1].isspace()]
        for batch in batches:
            found = list(zip(batch, self._align(batch)))
            out.update(found)
            short = max(map(len, batch)) <= MEMO_CHARS
            memo.update(found if short else [x for x in found if len(x[0]) <= MEMO_CHARS])
        return out

    def _align(self, stretches: list[str]) -> list[Aligned | None]:
        """Stretches behind one space each, laid end to end and aligned together."""
        text = "".join([" " + s for s in stretches])
        raw = text.encode("utf-8", "replace")
        # The fast call leaves out the places of tokens in the text.
        a = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        b = self.b.encode(text[1:], num_threads=1)
        if not b"".join(map(self.a_bytes.__getitem__, a)) == raw == b"".join(map(self.b_bytes.__getitem__, b)):
            if len(stretches) == 1:
                return [None]
            half = len(stretches) // 2
            return self._align(stretches[:half]) + self._align(stretches[half:])
        a, b = _numbers(a), _numbers(b)
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        ends, a_upto, b_upto = common_ends(a_ends, b_ends)
        order = self.words.order(a, b, a_upto, b_upto)
        words = "".join(map(self.words.table.__getitem__, order.tolist()))
        link_ends, x, y = linked(a_ends, b_ends)
        pairs = (a[x] * PAIR + b[y]).tobytes()
        # Every stretch ends at a common end.
        stops = np.cumsum([1 + len(s if s.isascii() else s.encode("utf-8", "replace")) for s in stretches])
        group = np.searchsorted(ends, stops) + 1
        n_a, n_b, n_links = a_upto[group - 1], b_upto[group - 1], np.searchsorted(link_ends, stops, "right")
        sizes = np.diff([n_a, n_b, group, n_links], prepend=0).tolist()
        # The sign behind a stretch's last id is left out.
        chars = np.cumsum(self.words.lengths[order])[n_a + n_b - 1].tolist()
        told = [words[i : j - 1] for i, j in pairwise([0, *chars])]
        return list(zip(*sizes, told, [pairs[i:j] for i, j in pairwise([0, *(8 * n_links).tolist()])]))


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32 as their lowest bytes, then the next and so on, so that the
    zeros of small numbers lie together and compress away."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


class _Block:
    """Stretches and pairs of the documents of one block."""

    def __init__(self, number: int) -> None:
        self.number, self.chars = number, 0
        self.stretches: dict[str, int] = {}
        self.told: list[str] = []
        self.sizes = np.zeros((0, 4), np.int64)
        self.wrong: set[int] = set()
        self.pairs: list[bytes] = []
        self.used = np.zeros(0, np.int64)

    def add(self, aligner: Aligner, texts: list[str]) -> list[dict]:
        """Rows of some documents, without their ids."""
        split = list(map(stretches_of, texts))
        new = dict.fromkeys(chain.from_iterable(split))
        found = aligner.aligned([s for s in new if s not in self.stretches])
        if found:
            first, got = len(self.told), list(found.values())
            self.stretches.update(zip(found, range(first, first + len(got))))
            if None in got:
                self.wrong.update(i for i, x in enumerate(got, first) if x is None)
                got = [x or _NOTHING for x in got]
            *more, told, pairs = zip(*got)
            self.told += told
            self.pairs.append(b"".join(pairs))
            self.sizes = np.concatenate([self.sizes, np.array(more, np.int64).T])
        sizes = self.sizes
        self.used = np.append(self.used, np.zeros(len(sizes) - len(self.used), np.int64))
        rows, used = [], []
        for parts in split:
            numbers = list(map(self.stretches.__getitem__, parts))
            if self.wrong and not self.wrong.isdisjoint(numbers):
                numbers = []
            at = _numbers(numbers)
            used.append(at)
            sums = sizes[at].sum(0).tolist()
            rows.append({
                "block": self.number, "groups": ";".join(map(self.told.__getitem__, numbers)), "stretches": _planes(at),
                **dict(zip(("n_a", "n_b", "n_groups", "n_links"), sums))})
        self.used += np.bincount(np.concatenate(used), minlength=len(sizes))
        self.chars += sum(map(len, texts))
        return rows

    def row(self) -> dict:
        """The block's own row: its distinct pairs, how often each is linked, and the
        pairs of each stretch."""
        # Pairs are numbered in order of first use.
        numbers, pairs = pd.factorize(np.frombuffer(b"".join(self.pairs), np.int64))
        sizes = self.sizes[:, 3]
        times = np.bincount(numbers, np.repeat(self.used, sizes), len(pairs)).astype(np.int64)
        return {"block": self.number, "pairs": pairs.tolist(), "times": times.tolist(),
                "pair_numbers": _planes(numbers), "n_pairs": _planes(sizes)}


def _store(aligner: Aligner, batches: Iterator[pa.RecordBatch], task: int) -> Iterator[pa.RecordBatch]:
    """Rows of documents, and behind the last of each block the block's own row."""
    schema = pa.schema([
        *((c, pa.int64()) for c in ("block", "doc_id", "n_a", "n_b", "n_groups", "n_links")), ("groups", pa.string()),
        ("stretches", pa.binary()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64())),
        ("pair_numbers", pa.binary()), ("n_pairs", pa.binary())])
    block, block_no = None, 0
    for batch in batches:
        ids, texts = batch.column("doc_id"), batch.column("text")
        start, size = 0, 0
        part: list[str] = []
        for i in range(batch.num_rows):
            part.append(texts[i].as_py() or "")
            size += len(part[-1])
            if size < _OUT_CHARS and i < batch.num_rows - 1:
                continue
            if block is None:
                block, block_no = _Block((task << 32) + block_no), block_no + 1
            rows = block.add(aligner, part)
            for doc_id, row in zip(ids.slice(start, len(part)).to_pylist(), rows):
                row["doc_id"] = doc_id
            if block.chars >= BLOCK_CHARS:
                rows.append(block.row())
                block = None
            yield pa.RecordBatch.from_pylist(rows, schema)
            start, part, size = i + 1, [], 0
    if block is not None:
        yield pa.RecordBatch.from_pylist([block.row()], schema)


def _score(docs: pa.Table, scores: pa.Table) -> pa.Table:
    """Documents of a block, scored by the corpus counts of its pairs."""
    own = docs.filter(pc.is_valid(docs["pairs"])).to_pylist()
    docs = docs.filter(pc.is_null(docs["pairs"]))
    order = np.argsort(scores["number"].to_numpy())
    count = scores["n"].to_numpy()[order].astype(np.int64)
    best = scores["best"].to_numpy(zero_copy_only=False)[order].astype(np.int64)
    numbers, sizes = _from_planes(own[0]["pair_numbers"]), _from_planes(own[0]["n_pairs"])
    upto = np.concatenate([[0], np.cumsum(sizes)])
    sums = [np.concatenate([[0], np.cumsum(x[numbers])]) for x in (best, count)]
    by_stretch = [np.diff(x[upto]) for x in sums]
    out: list[list[int]] = [[], []]
    for data in docs["stretches"].to_pylist():
        used = _from_planes(data)
        for got, x in zip(out, by_stretch):
            got.append(int(x[used].sum()))
    columns = [docs[c].combine_chunks() for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
    return pa.Table.from_arrays(
        [*columns, pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), docs["groups"].combine_chunks()],
        names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])


def align(
    docs: DataFrame, a_file: str, b_file: str, keep: Callable[[Column], Column] = lambda groups: groups,
) -> DataFrame:
    """Of every row: ``doc_id``, ``n_a`` and ``n_b`` tokens, ``n_groups``, ``n_links``,
    ``n_best`` (links whose pair's count is the highest of its B id), ``count_sum`` (of
    the counts of all links' pairs) and ``groups``, written ``a1,a2|b1;a3|b2,b3``.

    Groups are several times as long as the text; ``keep`` is an expression of them,
    a digest for instance, to be stored in their place.
    """
    with open(a_file, encoding="utf-8") as f, open(b_file, "rb") as g:
        shared = docs.sparkSession.sparkContext.broadcast({"a": f.read(), "b": g.read()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        state = shared.value
        if "aligner" not in state:
            state["aligner"] = Aligner(state["a"], state["b"])
        yield from _store(state["aligner"], batches, TaskContext.get().partitionId())

    stored = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _STORED)
    stored = materialize(stored.withColumn("groups", keep(F.col("groups"))), "align")
    told = stored.schema["groups"].dataType.simpleString()
    linked = stored.filter("pairs IS NOT NULL").select(
        "block", F.posexplode(F.arrays_zip("pairs", "times")).alias("number", "x")).select(
        "block", "number", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    counts = linked.groupBy("pair").agg(F.sum("times").alias("n")).withColumn("b", F.col("pair") % PAIR)
    counts = materialize(counts, "align-counts")
    highest = materialize(counts.groupBy("b").agg(F.max("n").alias("top")), "align-highest")
    judged = materialize(counts.join(highest, "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best")), "align-pairs")
    scores = linked.join(judged, "pair").select(F.col("block").alias("of_block"), "number", "n", "best")

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        return _score(left, right)

    return stored.groupBy("block").cogroup(scores.groupBy("of_block")).applyInArrow(
        score, _SCORED.replace("groups string", f"groups {told}"))
