"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

The vocabulary (pieces, log scores, byte pieces) comes from a given model file; the
library of that format only reads the file. Pieces are UTF-8 byte strings in a
double array: from state ``s`` the byte ``c`` leads to ``t = base[s] + c + 1`` if
``check[t] == s``. White space is written as the marker U+2581, with one marker put
before the text. The best segmentation has the largest sum of scores; among equal
sums the one whose last piece is longest wins, at every position. A character that
is no piece costs ten more than the least score and is written as its bytes.

If no piece holds a marker behind another character, which is looked up in the
vocabulary, the best segmentation of a text is that of its words one by one. Words
are segmented in bulk: all start positions walk down the trie together, then all
words advance together by start position. A worker keeps the words it has met, up to
a bound, beside the broadcast vocabulary.

Null and empty texts have no pieces and decode to an empty text. Decoding gives
every text back, except that U+2581 in a text becomes a space.
"""

from __future__ import annotations

import re
import sys
from collections import deque
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MARKER = "▁"
UNKNOWN_COST = 10.0
#: Words a worker remembers before it starts afresh, and bytes it handles at once.
MEMO_WORDS = 300_000
BLOCK_BYTES = 1 << 18
BLOCK_CHARS = 1 << 20


def double_array(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``base``, ``check`` and ``value`` (place in ``keys``, else -1) of a trie."""
    root: dict = {}
    for i, key in enumerate(keys):
        node = root
        for c in key:
            node = node.setdefault(c, {})
        node[-1] = i
    size = 1 << 16
    base, check, value = ([0] * size, [-1] * size, [-1] * size)
    # Slots from 257 on, so that no offset is negative.
    check[0], free, todo = -2, 257, deque([(0, root)])
    while todo:
        state, node = todo.popleft()
        value[state] = node.get(-1, -1)
        codes = sorted(c for c in node if c >= 0)
        if not codes:
            continue
        while check[free] != -1:
            free += 1
        slot = free
        while True:
            offset = slot - codes[0] - 1
            if offset + 257 >= len(check):
                base += [0] * size
                check += [-1] * size
                value += [-1] * size
            if all(check[offset + c + 1] == -1 for c in codes):
                break
            slot += 1
        base[state] = offset
        for c in codes:
            check[offset + c + 1] = state
            todo.append((offset + c + 1, node[c]))
    return np.array(base, np.int64), np.array(check, np.int64), np.array(value, np.int64)


@cache
def vocabulary(path: str) -> dict:
    """Arrays of a model file: trie, scores, byte pieces and the bytes of each piece."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    texts = [model.id_to_piece(i) for i in ids]
    plain = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    base, check, value = double_array([texts[i].encode() for i in plain])
    of_byte = np.full(256, model.unk_id(), np.int32)
    spelled = [b""] * len(texts)
    for i in plain:
        spelled[i] = texts[i].replace(MARKER, " ").encode()
    for i in filter(model.is_byte, ids):
        of_byte[int(texts[i][1:-1], 16)] = i
        spelled[i] = bytes([int(texts[i][1:-1], 16)])
    scores = np.array([model.get_score(i) for i in plain], np.float64)
    return {
        "base": base, "check": check, "value": value, "ids": np.array(plain, np.int32), "scores": scores,
        "unknown": float(scores.min()) - UNKNOWN_COST, "of_byte": of_byte, "spelled": spelled,
        "by_word": not any(MARKER in texts[i].lstrip(MARKER) for i in plain),
    }


def segment(words: list[bytes], vocab: dict) -> list[bytes]:
    """Ids (little-endian, four bytes each) of the best segmentation of each word."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes)
    text = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
    n = len(text)
    first = np.repeat(ends - sizes, sizes)
    stop = np.repeat(ends, sizes)
    base, check, value = vocab["base"], vocab["check"], vocab["value"]

    # Every start of a character walks down the trie; edges are pieces found.
    lead = (text & 0xC0) != 0x80
    starts = np.flatnonzero(lead)
    next_lead = np.append(starts[1:], n)
    width = np.zeros(n, np.int64)
    width[starts] = next_lead - starts
    at, state, depth = starts, np.zeros(len(starts), np.int64), 0
    edges: list[tuple[np.ndarray, ...]] = []
    single = np.zeros(n, bool)
    while len(at):
        step = base[state] + text[at + depth] + 1
        ok = check[step] == state
        at, state = at[ok], step[ok]
        depth += 1
        piece = value[state]
        hit = piece >= 0
        if hit.any():
            edges.append((at[hit], np.full(int(hit.sum()), depth), piece[hit]))
            single[at[hit][width[at[hit]] == depth]] = True
        inside = at + depth < stop[at]
        at, state = at[inside], state[inside]
    lone = starts[~single[starts]]
    edges.append((lone, width[lone], np.full(len(lone), -1)))
    begin, length, piece = (np.concatenate(x) for x in zip(*edges))
    score = np.where(piece >= 0, vocab["scores"][piece], vocab["unknown"])

    # All words advance together: edges by start within the word, then by length.
    place = begin - first[begin]
    order = np.lexsort((length, place))
    begin, length, piece, score, place = (x[order] for x in (begin, length, piece, score, place))
    # Word i owns the slots from its start plus i, one more than it has bytes.
    word = np.repeat(np.arange(len(words)), sizes)
    source = begin + word[begin]
    target = source + length
    best = np.full(n + len(words), -np.inf)
    best[ends - sizes + np.arange(len(words))] = 0.0
    back = np.full(n + len(words), -1)
    cuts = np.append(np.flatnonzero(np.diff(place, prepend=-1)), len(place))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        reached = best[source[a:b]] + score[a:b]
        better = np.flatnonzero(reached > best[target[a:b]])
        goal = target[a:b][better]
        best[goal] = reached[better]
        back[goal] = a + better

    # Walk back from all ends together, then put each word's edges in order.
    owner = np.flatnonzero(sizes)
    cursor = ends[owner] + owner
    floor = ends - sizes + np.arange(len(words))
    taken, owners = [], []
    while len(owner):
        edge = back[cursor]
        taken.append(edge)
        owners.append(owner)
        cursor = source[edge]
        more = cursor > floor[owner]
        owner, cursor = owner[more], cursor[more]
    if not taken:
        return [b""] * len(words)
    edge, owner = np.concatenate(taken), np.concatenate(owners)
    order = np.lexsort((begin[edge], owner))
    edge, owner = edge[order], owner[order]
    count = np.where(piece[edge] >= 0, 1, length[edge])
    out = np.empty(int(count.sum()), "<i4")
    upto = np.cumsum(count)
    known = piece[edge] >= 0
    out[upto[known] - 1] = vocab["ids"][piece[edge[known]]]
    for e, end in zip(edge[~known].tolist(), upto[~known].tolist()):
        raw = text[begin[e] : begin[e] + length[e]]
        out[end - len(raw) : end] = vocab["of_byte"][raw]
    sums = np.bincount(owner, weights=count, minlength=len(words)).astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum(sums)]) * 4
    blob = out.tobytes()
    return [blob[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def _split(text: str, vocab: dict) -> list[str]:
    """Words of a text; a word stands for itself behind one marker unless it begins
    with a marker of its own."""
    if not text:
        return []
    if not vocab["by_word"]:
        return [MARKER + text.replace(" ", MARKER)]
    if "  " not in text and MARKER not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    found = re.findall(f"{MARKER}+[^{MARKER}]*", MARKER + text.replace(" ", MARKER))
    return [w[1:] if len(w) > 1 and w[1] != MARKER else w for w in found]


def encode(texts: list[str], vocab: dict, memo: dict[str, bytes] | None = None) -> list[bytes]:
    """Ids of each text as little-endian integers of four bytes."""
    memo = {} if memo is None else memo
    split = [_split(t, vocab) for t in texts]
    if len(memo) > MEMO_WORDS:
        memo.clear()
    new = list(set().union(*split).difference(memo))
    block: list[str] = []
    size = 0
    for i, w in enumerate(new):
        block.append(w)
        size += len(w) + 1
        if size >= BLOCK_BYTES or i == len(new) - 1:
            raw = [(w if w.startswith(MARKER) else MARKER + w).encode("utf-8", "replace") for w in block]
            memo.update(zip(block, segment(raw, vocab)))
            block, size = [], 0
    return [b"".join(map(memo.__getitem__, words)) for words in split]


def decode(ids: np.ndarray, vocab: dict) -> str:
    """Text of ids: markers become spaces, byte pieces join to characters."""
    spelled = b"".join(map(vocab["spelled"].__getitem__, ids.tolist())).decode("utf-8", "replace")
    return spelled[1:] if spelled.startswith(" ") else spelled


def encode_decode(docs: DataFrame, model: str) -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded`` of every row's whole ``text``.

    ``model`` names the vocabulary file on the driver; workers get its arrays.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        memo = vocab.setdefault("memo", {})
        for batch in batches:
            doc_ids, texts = batch.column("doc_id"), batch.column("text")
            start, block, size = 0, [], 0
            for i in range(batch.num_rows):
                block.append(texts[i].as_py() or "")
                size += len(block[-1])
                if size < BLOCK_CHARS and i < batch.num_rows - 1:
                    continue
                coded = encode(block, vocab, memo)
                flat = np.frombuffer(b"".join(coded), "<i4")
                bounds = np.concatenate([[0], np.cumsum([len(x) // 4 for x in coded])]).astype(np.int32)
                back = [decode(flat[a:b], vocab) for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.slice(start, len(block)), pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat)),
                     pa.array(back, pa.string())], names=["doc_id", "ids", "decoded"])
                start, block, size = i + 1, [], 0

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, ids array<int>, decoded string")
