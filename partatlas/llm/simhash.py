"""SimHash near-duplicates: segment bit counts, a grid over them, exact verification.

A fingerprint of 64 bits is embedded as the bit counts of its 32 segments of two
bits. Moving one bit changes the counts by at most one in total, so the Manhattan
distance of two embeddings never exceeds the Hamming distance. Counts are kept in
unary, the set bits of each segment moved to its low end; the Manhattan distance of
two embeddings is then the number of differing bits of two such words.

The range join lays a grid over the embedding. The segments fall into seven groups.
If the distance is at most four, at least three groups agree in all their counts, so
two fingerprints in range share a cell for at least one choice of three groups. All
35 choices are joined by equality; a pair counts only for the first choice it shares.
The bound and the exact distance are part of the join condition, so only links leave
the join.

Equal fingerprints are one row before the join, however many documents have them.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partatlas.llm.components import components
from partatlas.session import materialize, shuffled

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 4
SEED = 42
MAX_DISTANCE = 4
GROUPS = 7
_LOW = 0x5555555555555555
#: Hashes that are counted at once, a bound on memory for very long texts.
_BLOCK = 1 << 18
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_LANES = (np.arange(8, dtype=np.int64) * 256)[None, :]


def words_of(text: str | None) -> list[bytes]:
    """Words of a text: A-Z in lower case, split at the six white-space bytes."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(words: list[bytes], shingle: int) -> Iterator[np.ndarray]:
    """Hashes of all runs of ``shingle`` words, joined by spaces, in bounded blocks.

    Fewer words are one run, no words are none.
    """
    if not words:
        return
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    starts, ends = starts[: len(words) - k + 1], ends[k - 1 :]
    hashed = xxhash.xxh64_intdigest
    for i in range(0, len(starts), _BLOCK):
        part = zip(starts[i : i + _BLOCK].tolist(), ends[i : i + _BLOCK].tolist())
        yield np.array([hashed(line[a:b], SEED) for a, b in part], "<u8")


def majority(blocks: Iterable[np.ndarray]) -> int:
    """Fingerprint of hashes: the bits that more than half of them have; zero for none."""
    total, n = np.zeros(64, np.int64), 0
    for values in blocks:
        lanes = values.view(np.uint8).reshape(-1, 8) + _LANES
        counts = np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256)
        total += (counts @ _BITS).ravel()
        n += len(values)
    bits = np.packbits(2 * total > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprint(text: str | None) -> int:
    """SimHash of a text as an unsigned integer.

    A-Z become lower case, words are split at the six white-space bytes, and each
    run of four words, joined by spaces, is hashed; a bit is set if more than half of
    the hashes have it. Fewer than four words are one run; no word at all, or a null,
    gives zero.
    """
    return majority(shingle_hashes(words_of(text), SHINGLE))


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.array([fingerprint(t.as_py()) for t in batch.column("text")], np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(prints.view(np.int64))], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed long."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _fingerprints, "doc_id long, fp long")


def _group_masks() -> list[int]:
    """Bits of each group: the 32 segments dealt out in runs of five or four."""
    sizes = [5] * 4 + [4] * 3
    edges = [2 * sum(sizes[:i]) for i in range(GROUPS + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def bit_counts(fp: Column) -> Column:
    """Bit counts of the two-bit segments, each in unary within its segment."""
    low = F.lit(_LOW)
    upper = F.shiftrightunsigned(fp, 1)
    both = fp.bitwiseAND(upper).bitwiseAND(low)
    return F.shiftleft(both, 1).bitwiseOR(fp.bitwiseOR(upper).bitwiseAND(low))


def links(prints: DataFrame) -> DataFrame:
    """Pairs ``a < b`` of distinct fingerprints (column ``fp``) within the distance.

    A plan sees the fingerprints, not the 35 cells of each, so the join is always shuffled.
    """
    masks = _group_masks()
    cells = [
        (sum(1 << g for g in chosen), _signed(sum(masks[g] for g in chosen)))
        for chosen in combinations(range(GROUPS), GROUPS - MAX_DISTANCE)
    ]
    points = prints.select("fp", bit_counts(F.col("fp")).alias("unary")).select(
        "fp", "unary",
        F.explode(F.array(*[
            F.struct(F.lit(k).alias("choice"), F.col("unary").bitwiseAND(F.lit(m)).alias("cell"))
            for k, m in cells])).alias("at"),
    ).select("fp", "unary", "at.choice", "at.cell")
    a, b = points.alias("a"), points.alias("b")
    apart = F.col("a.unary").bitwiseXOR(F.col("b.unary"))
    shared = sum(
        (F.when(apart.bitwiseAND(F.lit(_signed(m))) == 0, F.lit(1 << g)).otherwise(F.lit(0))
         for g, m in enumerate(masks)), F.lit(0))
    # The first choice of groups that the pair shares: the three lowest shared groups.
    rest = shared
    for _ in range(GROUPS - MAX_DISTANCE):
        rest = rest.bitwiseAND(rest - 1)
    return a.join(
        shuffled(b),
        (F.col("a.choice") == F.col("b.choice")) & (F.col("a.cell") == F.col("b.cell"))
        & (F.col("a.fp") < F.col("b.fp"))
        & (F.bit_count(apart) <= MAX_DISTANCE)
        & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= MAX_DISTANCE)
        & (shared - rest == F.col("a.choice")),
    ).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))


def simhash_groups(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id``, the smallest ``doc_id`` reachable.

    Repeated rows stay repeated. Documents without a word link like any other. A
    null ``doc_id`` never names a group; if a group has no other, its name is null.
    Other columns of ``docs`` are not looked at; an empty table gives no rows.
    """
    prints = materialize(fingerprints(docs), "simhash")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(distinct), "simhash-links")
    named = distinct.join(shuffled(roots), distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    groups = named.join(shuffled(least), "root").select("fp", "component_id")
    return prints.join(shuffled(groups), "fp").select("doc_id", "fp", "component_id")
