"""Periodic runs of words by seeds and diagonals.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart
are identical), at least ``max(24, 3 * q)`` words long, which no neighbouring word
extends. On the diagonal of lag ``q`` (word ``i`` against word ``i + q``) such a run is
a stretch of at least ``max(24 - q, 2 * q)`` matches: the overlap that is guaranteed.

* **Seeds.** Lags fall into classes 1-8, 9-16, 17-32 and so on. The k-grams of a class
  are as long as the least overlap guaranteed in it: 16 words, then 18, 34, 66 and so
  on, so every run holds a k-gram that occurs again one period later. Ids of k-grams
  come from ids of halves (prefix doubling), so equal ids are equal words.
* **Pairs.** Only an occurrence and the next one of the same k-gram are a pair, which
  keeps pairs linear in the words. Nothing is lost by that: a k-gram is as long as its
  largest lag, so an occurrence between two that are one period apart would give the
  k-gram two periods whose sum is no more than its length. Their greatest common
  divisor would then be a period of the k-gram and of the whole stretch, and a smaller
  one than its smallest.
* **Extension.** Seeds are taken lag by lag from left to right and extended both ways
  to the first mismatch. A table by lag holds the furthest place covered; seeds before it
  are passed over in one step, so each diagonal stretch is extended once.

A document without any repeated 16-gram has no run; a hash of its 16-grams rules most
documents out, and can only be wrong towards looking closer.

Null and empty texts have no words and no runs and collapse to an empty text. Repeated
rows are rows of their own; a null ``doc_id`` stays null; other columns are not looked
at; an empty table gives no rows. Very long texts are handled whole: time and memory
grow with words times the logarithm of the longest period.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_WORDS = 24
MIN_REPEATS = 3
#: Lags of the first class; least overlap there is MIN_WORDS - 8 = (MIN_REPEATS - 1) * 8.
FIRST_LAGS = 8
SEED = 16
#: Characters of collapsed text that leave a worker at once.
BLOCK_CHARS = 1 << 20

Run = tuple[int, int, int]


def _pair_ids(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Ids of the pairs of two arrays of ids."""
    pairs = left * (int(right.max()) + 1) + right
    return np.unique(pairs, return_inverse=True)[1]


def _repeats_a_seed(ids: np.ndarray) -> bool:
    """Whether two 16-grams have the same hash."""
    h = ids.astype(np.uint64)
    h = (h + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    for k, factor in ((1, 0xBF58476D1CE4E5B9), (2, 0x94D049BB133111EB), (4, 0xD6E8FEB86659FD93), (8, 0xA0761D6478BD642F)):
        h = h[:-k] * np.uint64(factor) + h[k:]
        h ^= h >> np.uint64(31)
    h.sort()
    return bool((h[1:] == h[:-1]).any())


def _seeds(ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Lags and places of the seeds of each class of lags."""
    n, grams, size = len(ids), ids, 1
    low, high = 1, FIRST_LAGS
    while MIN_REPEATS * low <= n and n >= MIN_WORDS:
        k = max(SEED, (MIN_REPEATS - 1) * low)
        if k > n:
            return
        while 2 * size <= k:
            grams = _pair_ids(grams[:-size], grams[size:])
            size *= 2
        keys = grams if k == size else _pair_ids(grams[: n - k + 1], grams[k - size : n - size + 1])
        order = np.argsort(keys, kind="stable")
        here, there = order[:-1], order[1:]
        same = keys[here] == keys[there]
        if not same.any():
            return  # nor does any longer gram
        lag = there - here
        seed = same & (lag >= low) & (lag <= high)
        yield lag[seed], here[seed]
        low, high = high + 1, 2 * high


def _matches(ids: np.ndarray, i: int, q: int, step: int) -> int:
    """How many words from ``i`` on, towards ``step``, equal the word ``q`` later."""
    found, width = 0, 64
    while True:
        if step > 0:
            a, b = ids[i + found : i + found + width], ids[i + found + q : i + found + q + width]
            a = a[: len(b)]
        else:
            lo = max(0, i - found - width + 1)
            a, b = ids[lo : i - found + 1][::-1], ids[lo + q : i - found + 1 + q][::-1]
        if not len(a):
            return found
        wrong = np.flatnonzero(a != b)
        if len(wrong):
            return found + int(wrong[0])
        found += len(a)
        width *= 2


def runs(words: list) -> list[Run]:
    """All runs of a list of words as ``(start, length, period)``, by start and period."""
    n = len(words)
    if n < MIN_WORDS:
        return []
    first: dict = {}
    ids = np.fromiter(map(first.setdefault, words, range(n)), np.int64, n)
    if not _repeats_a_seed(ids):
        return []
    found: dict[tuple[int, int], int] = {}
    for lags, places in _seeds(ids):
        order = np.lexsort((places, lags))
        lags, places = lags[order], places[order]
        cuts = np.append(np.flatnonzero(np.diff(lags, prepend=0)), len(lags)).tolist()
        for a, b in zip(cuts, cuts[1:]):
            q, on_lag = int(lags[a]), places[a:b]
            furthest, at = 0, 0
            while True:
                at += int(np.searchsorted(on_lag[at:], furthest))
                if at >= len(on_lag):
                    break
                i = int(on_lag[at])
                end = i + _matches(ids, i, q, 1)
                start = i - _matches(ids, i - 1, q, -1) if i else 0
                furthest = end + 1
                length = end - start + q
                if length >= max(MIN_WORDS, MIN_REPEATS * q):
                    key = (start, start + length)
                    found[key] = min(q, found.get(key, q))
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapse(words: list, found: list[Run]) -> list:
    """Words without those that a run holds after its first period."""
    if not found:
        return words
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        drop[start + period] += 1
        drop[start + length] -= 1
    stays = (np.cumsum(drop[:-1]) == 0).tolist()
    return [w for w, s in zip(words, stays) if s]


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column("doc_id"), batch.column("text")
        start, size, out = 0, 0, []
        for i in range(batch.num_rows):
            words = (texts[i].as_py() or "").encode("utf-8", "surrogatepass").split()
            found = runs(words)
            out.append((len(words), found, b" ".join(collapse(words, found)).decode("utf-8", "replace")))
            size += len(out[-1][2])
            if size >= BLOCK_CHARS or i == batch.num_rows - 1:
                yield _table(ids.slice(start, len(out)), out)
                start, size, out = i + 1, 0, []


def _table(ids: pa.Array, out: list) -> pa.RecordBatch:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    spans = [[dict(zip(("start", "length", "period"), r)) for r in found] for _, found, _ in out]
    return pa.RecordBatch.from_arrays(
        [ids, pa.array([n for n, *_ in out], pa.int64()), pa.array(spans, kind),
         pa.array([text for *_, text in out], pa.string())],
        names=["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Of every row: ``doc_id``, ``n_words``, its ``runs`` (start, length, period; by start,
    then period) and ``collapsed``, the words outside later periods joined by spaces."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _batches, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def strongest(found: Column) -> Column:
    """The run with the greatest length by period; of equals the first, then the one with
    the smaller period. Compared as whole numbers."""
    return F.reduce(
        found, F.get(found, F.lit(0)),
        lambda best, x: F.when(x["length"] * best["period"] > best["length"] * x["period"], x).otherwise(best))


def run_lines(found: Column) -> Column:
    """Every run as a line ``start,length,period``."""
    return F.array_join(F.transform(found, lambda x: F.concat(
        F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n"))), "")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` where the words of about every tenth document become periodic from some
    word on: with ``h`` the CRC-32 of the decimal id, ``h % 10 = 0``, ``g = h // 10`` and
    ``n`` words, those from ``a = g % n`` repeat the first ``p = 1 + (n - a) // (3 + g % 8)``
    of them. Texts so changed have single spaces; rows without an id stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    chosen = docs.filter((h % 10 == 0) & F.col("text").isNotNull()).select("doc_id", words.alias("words"), F.floor(h / 10).alias("g"))
    sized = chosen.withColumn("n", F.size("words").cast("long"))
    placed = sized.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).otherwise(0))
    tail = placed.withColumn("rest", F.col("n") - F.col("a")).withColumn(
        "p", 1 + F.floor(F.col("rest") / (3 + F.col("g") % 8)))
    period = F.slice("words", F.col("a").cast("int") + 1, F.col("p").cast("int"))
    times = F.ceil(F.col("rest") / F.col("p")).cast("int")
    filled = F.slice(F.flatten(F.array_repeat(period, times)), F.lit(1), F.col("rest").cast("int"))
    text = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a").cast("int")), filled), " ")
    changed = tail.select("doc_id", F.when(F.col("n") > 0, text).otherwise("").alias("text"))
    return docs.filter((h % 10 != 0) | h.isNull() | F.col("text").isNull()).select("doc_id", "text").union(changed)
