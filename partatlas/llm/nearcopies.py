"""One document of each group of near copies: SimHash candidates, verified on words.

Two texts are near copies if the sets of their runs of five words have a similarity
(Jaccard) of 0.8 or more. Their fingerprints over whole texts may differ in 14 of 64 bits,
too many for a selective grid. So a text also has fingerprints of parts: its distinct
words are dealt by hash into classes of ``CLASS_WORDS`` to twice as many words, and every
class has its own SimHash. A few changed words leave most classes of a text as they were,
so near copies nearly always share a class. The number of classes is a power of two that
grows with the text; a text just above a border is dealt by the smaller number, too, as
its near copies may lie below.

Candidates come from two range joins over the embedding as segment bit counts:

* class fingerprints, in a grid whose cell is the embedding of a class (distance zero);
* whole-text fingerprints of five-word runs, in the grid of ``simhash.links``.

A cell is shuffled as one number beside the first half of a text's key, and only cells
that several texts share go on; different cells or keys that meet in 64 bits are
candidates, no more. Numbers of runs that differ by more than the similarity allows end a
candidate early. All others are verified on the hashes of all their runs, which are taken
from the texts once. Equal word sequences are one text before the joins. Within a cell,
texts first meet one text only, the one that shares most cells with others and so lies in
the middle of its near copies. All others meet later, across the groups found so far and
by a prefix filter: of two similar texts with their runs in one order, rare runs first,
the first common run lies where enough runs are left behind it on both sides. Only
texts that have such a run in common and share a cell are paired, so edited copies of one
original that are too far from each other are not paired out. Nothing is lost by it.
Tables with rows for cells or runs are many times what a plan takes them for by their files,
so their joins are always shuffled.

A document is a ``doc_id``; rows that repeat it are the same document, whatever their
texts. Rows with a null ``doc_id`` are in no group. Null and empty texts are equal. Very
long texts are hashed in blocks and make one array of eight bytes for each distinct run.
Other columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partatlas.llm.components import components
from partatlas.llm.simhash import SEED, bit_counts, links, majority, shingle_hashes, words_of
from partatlas.session import materialize, shuffled

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 5
MIN_PERCENT = 80
#: Distinct words of a class, on average between this and twice as many.
CLASS_WORDS = 10
#: Smaller classes tell too little; a text with one class only has it at any size.
LEAST_WORDS = 6
#: Texts up to this much above a border are dealt by the smaller number of classes, too.
OVERLAP = 1.3
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def class_prints(words: list[bytes]) -> tuple[list[int], list[int]]:
    """Class numbers and the fingerprints of the classes of a text's distinct words.

    The number of a class holds the number of classes: ``2**b + class`` of ``2**b``.
    """
    unique = set(words)
    if not unique:
        return [], []
    hashed = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in unique), "<u8", len(unique))
    mixed = hashed * _GOLDEN
    most = max(0, int(np.log2(len(unique) / CLASS_WORDS)))
    near = most and len(unique) < OVERLAP * CLASS_WORDS * 2**most
    numbers, prints = [], []
    for b in (most, most - 1) if near else (most,):
        number = mixed >> np.uint64(64 - b) if b else np.zeros(len(mixed), np.uint64)
        order = np.argsort(number, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], np.diff(number[order]) > 0]))
        sizes = np.diff(np.append(starts, len(order)))
        bits = np.unpackbits(hashed[order].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
        fp = np.packbits(2 * sums > sizes[:, None], axis=1, bitorder="little").view("<i8").ravel()
        enough = (sizes >= LEAST_WORDS) | (b == 0)
        numbers += (number[order][starts][enough].astype(np.int64) + (1 << b)).tolist()
        prints += fp[enough].tolist()
    return numbers, prints


def _key(words: list[bytes]) -> tuple[int, int]:
    digest = xxhash.xxh3_128_digest(b" ".join(words))
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


def _unique(blocks: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate(blocks)) if blocks else np.zeros(0, np.uint64)


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            words = words_of(text.as_py())
            blocks = list(shingle_hashes(words, SHINGLE))
            fp = majority(blocks)
            numbers, prints = class_prints(words)
            rows.append((doc, *_key(words), len(_unique(blocks)), fp - (fp >> 63 << 64), [0, *numbers], [fp - (fp >> 63 << 64), *prints]))
        names = ["doc_id", "hi", "lo", "n_runs", "fp", "numbers", "prints"]
        types = [pa.int64()] * 5 + [pa.list_(pa.int64())] * 2
        columns = zip(*rows) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for text in batch.column("text"):
            words = words_of(text.as_py())
            hi, lo = _key(words)
            values = pa.array(_unique(list(shingle_hashes(words, SHINGLE))).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array([hi], pa.int64()), pa.array([lo], pa.int64()),
                 pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)],
                names=["hi", "lo", "hashes"])


def _may_be_similar(a: Column, b: Column) -> Column:
    """Whether two numbers of runs allow the similarity."""
    return 100 * F.least(a, b) >= MIN_PERCENT * F.greatest(a, b)


def _run_hashes(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """``hi``, ``lo`` and the hashes of all runs of ``texts`` (``id``, ``hi``, ``lo``)."""
    texts = materialize(texts, "near-wanted")
    rows = docs.join(texts.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    hashed = rows.select("text").mapInArrow(_hashes, "hi long, lo long, hashes array<long>")
    return materialize(
        hashed.join(shuffled(texts.select("hi", "lo")), ["hi", "lo"], "left_semi").dropDuplicates(["hi", "lo"]), "near-hashes")


def _similar(pairs: DataFrame, hashed: DataFrame) -> DataFrame:
    """Of pairs of texts ``a`` and ``b`` (structs of ``id``, ``hi``, ``lo``), the ids of the similar ones."""
    of = lambda side: hashed.select(
        F.struct("hi", "lo").alias(f"{side}_key"), F.col("hashes").alias(f"{side}_hashes"))
    both = pairs.select(
        F.col("a.id").alias("a"), F.col("b.id").alias("b"),
        F.struct("a.hi", "a.lo").alias("a_key"), F.struct("b.hi", "b.lo").alias("b_key"),
    ).join(of("b"), "b_key").join(of("a"), "a_key")
    common = F.size(F.array_intersect("a_hashes", "b_hashes"))
    total = F.size("a_hashes") + F.size("b_hashes") - common
    return both.filter(100 * common >= MIN_PERCENT * total).select("a", "b")


def _across_groups(texts: DataFrame, hashed: DataFrame) -> DataFrame:
    """Pairs ``a`` and ``b`` of ``texts`` of different groups that share a cell and may be
    similar.

    ``texts`` has ``id``, ``hi``, ``lo``, ``n_runs``, ``root`` and ``cells``. A text's runs are
    in order of the number of texts that have them; those of one text only come first and
    meet nobody, so they only count for the places of the others.
    """
    runs = texts.join(hashed, ["hi", "lo"]).select("hi", "lo", F.explode("hashes").alias("run"))
    often = runs.groupBy("run").agg(F.count("*").alias("n")).filter("n > 1")
    places = runs.join(often, "run").groupBy("hi", "lo").agg(
        F.sort_array(F.collect_list(F.struct("n", "run"))).alias("runs"))
    alone = F.col("n_runs") - F.size("runs")
    reached = F.floor(F.col("n_runs") * (100 - MIN_PERCENT) / 100)
    first = materialize(places.join(texts.drop("cells"), ["hi", "lo"]).select(
        F.struct("id", "hi", "lo").alias("text"), "n_runs", "root", alone.alias("alone"),
        F.posexplode(F.slice("runs", F.lit(1), F.greatest(reached - alone + 1, F.lit(0)).cast("int"))).alias("at", "run"),
    ).select("text", "n_runs", "root", (F.col("n_runs") - F.col("alone") - F.col("at")).alias("left"), "run.run"), "near-first")
    enough = lambda side: (
        (100 + MIN_PERCENT) * F.col(f"{side}.left") >= MIN_PERCENT * (F.col("a.n_runs") + F.col("b.n_runs")))
    met = first.alias("a").join(
        shuffled(first.alias("b")),
        (F.col("a.run") == F.col("b.run")) & (F.col("a.root") < F.col("b.root"))
        & _may_be_similar(F.col("a.n_runs"), F.col("b.n_runs")) & enough("a") & enough("b"),
    ).select(F.col("a.text").alias("a"), F.col("b.text").alias("b")).distinct()
    of = lambda side: texts.select(
        F.col("hi").alias(f"{side}_hi"), F.col("lo").alias(f"{side}_lo"), F.col("cells").alias(f"{side}_cells"))
    for side in ("a", "b"):
        met = met.join(shuffled(of(side)), (F.col(f"{side}.hi") == F.col(f"{side}_hi")) & (F.col(f"{side}.lo") == F.col(f"{side}_lo")))
    return met.filter(F.arrays_overlap("a_cells", "b_cells")).select("a", "b")


def _text(side: str) -> Column:
    return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in ("id", "hi", "lo")])


def near_groups(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``component_id``, the smallest ``doc_id`` reachable over near copies.

    One row for each distinct ``doc_id`` that is not null.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).filter("doc_id IS NOT NULL")
    prints = docs.mapInArrow(
        _prints, "doc_id long, hi long, lo long, n_runs long, fp long, numbers array<long>, prints array<long>")
    cell = lambda x: F.xxhash64(x["numbers"], bit_counts(x["prints"]), x["prints"])
    prints = materialize(prints.select(
        "doc_id", "hi", "lo", "n_runs", "fp", F.transform(F.arrays_zip("numbers", "prints"), cell).alias("cells")), "near-prints")
    texts = materialize(prints.groupBy("hi", "lo").agg(
        F.min("doc_id").alias("id"), *[F.first(c).alias(c) for c in ("n_runs", "fp", "cells")]), "near-texts")
    spots = texts.select("hi", F.explode("cells").alias("cell"))
    texts = texts.drop("cells")
    shared = spots.groupBy("cell").agg(
        F.count("*").alias("n"), F.min("hi").alias("least"), F.max("hi").alias("most")).filter("least < most")
    spots = materialize(spots.join(shuffled(shared.select("cell", "n")), "cell"), "near-shared")
    # The text that meets most others over its cells is met by all of a cell.
    known = spots.groupBy("hi").agg(F.sum("n").alias("met"))
    heads = spots.join(shuffled(known), "hi").groupBy("cell").agg(F.max_by("hi", F.struct("met", "hi")).alias("head"))
    spots = materialize(spots.drop("n").join(shuffled(heads), "cell"), "near-spots")
    close = materialize(links(texts.select("fp").distinct()), "near-reach").select(
        F.col("a").alias("low"), F.col("b").alias("high"))
    fps = close.select(F.col("low").alias("fp")).union(close.select("high"))
    wanted = spots.select("hi").union(texts.join(fps, "fp", "left_semi").select("hi")).distinct()
    hashed = _run_hashes(docs, texts.join(shuffled(wanted), "hi", "left_semi").select("id", "hi", "lo"))

    # Texts of a cell against its head.
    heads = spots.filter("hi <> head").select("head", F.col("hi").alias("other")).distinct()
    first = heads.join(texts.alias("a"), F.col("head") == F.col("a.hi")).join(
        texts.alias("b"), (F.col("other") == F.col("b.hi")) & _may_be_similar(F.col("a.n_runs"), F.col("b.n_runs")))
    stars = materialize(_similar(first.select(_text("a").alias("a"), _text("b").alias("b")), hashed), "near-stars")
    copies = prints.select("doc_id", "hi", "lo").join(texts.select("hi", "lo", "id"), ["hi", "lo"]).select(
        F.col("doc_id").alias("a"), F.col("id").alias("b")).filter("a <> b").distinct()
    known = stars.union(copies)
    roots = components(known, "near-links")

    # All others of a cell, and whole texts within reach, across the groups so far.
    grouped = materialize(texts.join(shuffled(roots), texts["id"] == roots["node"], "left").select(
        "id", "hi", "lo", "n_runs", "fp", F.coalesce("root", "id").alias("root")), "near-grouped")
    mixed = spots.select("cell", "hi").join(shuffled(grouped.drop("fp")), "hi")
    open_cells = mixed.groupBy("cell").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x < y")
    mixed = materialize(mixed.join(open_cells.select("cell"), "cell", "left_semi").groupBy("hi", "lo").agg(
        *[F.first(c).alias(c) for c in ("id", "n_runs", "root")], F.collect_set("cell").alias("cells")), "near-mixed")
    may = _may_be_similar(F.col("a.n_runs"), F.col("b.n_runs"))
    in_cells = _across_groups(mixed, hashed)
    in_reach = close.join(shuffled(grouped.alias("a")), F.col("low") == F.col("a.fp")).join(
        shuffled(grouped.alias("b")), (F.col("high") == F.col("b.fp")) & (F.col("a.root") != F.col("b.root")) & may).select(
        F.least(_text("a"), _text("b")).alias("a"), F.greatest(_text("a"), _text("b")).alias("b"))
    more = _similar(in_cells.union(in_reach).distinct(), hashed)
    # What the first round found is kept as links to its roots.
    roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more), "near-links")
    ids = prints.select("doc_id").distinct()
    return ids.join(shuffled(roots), ids["doc_id"] == roots["node"], "left").select(
        "doc_id", F.coalesce("root", "doc_id").alias("component_id"))


def near_copy_filter(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` that stay: the one with the smallest ``doc_id`` of each group.

    Of rows that repeat this ``doc_id``, the one with the smallest text stays. Rows
    without a ``doc_id`` cannot be named and stay.
    """
    drop = near_groups(docs).filter("doc_id <> component_id").select("doc_id")
    rows = docs.select(F.col("doc_id").alias("id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    stays = rows.filter("id IS NOT NULL").join(drop, rows["id"] == drop["doc_id"], "left_anti")
    one = stays.groupBy("id").agg(F.min_by("row", F.coalesce("row.text", F.lit(""))).alias("row"))
    return one.union(rows.filter(F.col("id").isNull())).select("row.*")
