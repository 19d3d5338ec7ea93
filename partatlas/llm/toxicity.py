"""Toxicity by a counterfactual-regularised classifier.

A text is the set of its lower-case words and their beginnings of four to seven
letters. A logistic model with a sparse (L1) penalty learns from a bounded sample of
labelled texts. Each sampled text that names an identity group is also read with the
terms swapped for others of the same kind, and so are some neutral sentences about
every group; the squared difference of the two scores (before the logistic function)
is penalised. The model thus cannot use which group a text names, and neutral mentions
do not raise a score.

The sample has at most ``MAX_PER_CLASS`` labelled texts of each class, the first in
order of a hash of their ids. Spark reads the features off the sampled texts and
counts them; the driver gets numbers only, whose amount the sample bounds. Scoring
runs over every whole text.

Null and empty texts have no features and get the base score. Null labels teach
nothing; of several labels of one document the largest counts. Repeated rows are
scored one by one. Without any labels, every score is that of the prior.
"""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partatlas.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_PER_CLASS = 4_000
FOLDS = 5
#: Features in fewer sampled texts, or in a larger share of them, are not used.
MIN_TEXTS = 4
MAX_SHARE = 0.5
#: Weight of all clean texts to that of all toxic ones.
CLEAN_ODDS = 3.0
SPARSITY = 6e-4
COUNTERFACTUAL = 1.0
STEPS = 150
RATE = 0.3
PRIOR = -math.log(CLEAN_ODDS)
_MEMO = 500_000

#: Identity terms that stand for each other, by kind; fixed values.
IDENTITIES = (
    "christian muslim jewish hindu buddhist atheist catholic protestant".split(),
    "black white asian african european arab latino indigenous".split(),
    "gay straight lesbian bisexual transgender heterosexual queer".split(),
    "woman man girl boy female male".split(),
    "blind deaf disabled autistic".split(),
    "german french spanish english polish turkish russian chinese mexican american".split(),
    "chrétien musulman juif bouddhiste athée".split(),
    "christ moslem jude hinduist buddhist".split(),
    "cristiano musulmán judío budista ateo".split(),
    "femme homme fille garçon".split(),
    "frau mann mädchen junge".split(),
    "mujer hombre chica chico".split(),
)
_NEUTRAL = ("i am {}", "my neighbour is {}", "the {} people of this town", "a {} person wrote this", "we met {} friends")
_WORD = re.compile(r"[^\W\d_]+")


def features(words: set[str]) -> set[str]:
    return words | {"^" + w[:k] for w in words for k in (4, 5, 6, 7) if len(w) > k}


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def _swaps() -> dict[str, str]:
    return {term: kind[(i + 1) % len(kind)] for kind in IDENTITIES for i, term in enumerate(kind)}


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``text`` and ``toxic`` (0 or 1) of the sample; rows of fold 0 are left out."""
    known = labels.filter("toxic in (0, 1) and doc_id is not null").groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.filter(_fold() != 0)
    order = (F.xxhash64("doc_id"), "doc_id")
    chosen = known.filter("toxic = 1").orderBy(*order).limit(MAX_PER_CLASS).union(
        known.filter("toxic = 0").orderBy(*order).limit(MAX_PER_CLASS))
    # At most twice the bound of short rows, whatever the tables' sizes.
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(
        F.broadcast(chosen), "doc_id").select("text", "toxic")


def _fold():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS


def fit(docs: DataFrame, labels: DataFrame) -> dict[str, float]:
    """Weights of features; the empty string is the constant term."""

    @F.pandas_udf("array<string>")
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted(features(words_of(t))) for t in texts])

    @F.pandas_udf("array<string>")
    def swapped(texts: pd.Series) -> pd.Series:
        swaps, out = _swaps(), []
        for words in map(words_of, texts):
            out.append(sorted(features({swaps.get(w, w) for w in words})) if not words.isdisjoint(swaps) else None)
        return pd.Series(out, dtype=object)

    sample = materialize(
        labelled_sample(docs, labels).select("toxic", found("text").alias("x"), swapped("text").alias("other")),
        "toxicity-sample")
    identity = sorted(features(set(_swaps())))
    counted = sample.select(F.explode("x").alias("f")).groupBy("f").agg(F.count("*").alias("n"))
    total = sample.count()
    used = counted.filter((F.col("n") >= MIN_TEXTS) & (F.col("n") <= MAX_SHARE * total)).select("f").toPandas()["f"]
    index = {f: i for i, f in enumerate(sorted({*used, *identity}))}
    rows, cols, toxic, pairs = [], [], [], []
    shared = sample.sparkSession.sparkContext.broadcast(index)

    @F.pandas_udf("binary")
    def numbers(names: pd.Series) -> pd.Series:
        known = shared.value
        return pd.Series([
            None if x is None else np.array(sorted(known[f] for f in x if f in known), "<i4").tobytes() for x in names],
            dtype=object)

    for r in sample.select("toxic", numbers("x").alias("x"), numbers("other").alias("other")).toPandas().itertuples():
        cols.append(np.frombuffer(r.x, "<i4"))
        rows.append(np.full(len(cols[-1]), len(toxic), np.int32))
        if r.other is not None:
            pairs.append((cols[-1], np.frombuffer(r.other, "<i4")))
        toxic.append(r.toxic)
    swaps = _swaps()
    for term, other in swaps.items():
        for sentence in _NEUTRAL:
            x, y = (np.array([index[f] for f in features(words_of(sentence.format(w))) if f in index], np.int32)
                    for w in (term, other))
            pairs.append((x, y))
    shared.unpersist()
    if len(set(toxic)) < 2:
        return {"": PRIOR}
    weights, constant = _descend(
        np.concatenate(rows), np.concatenate(cols), np.array(toxic, float), pairs, len(index))
    return {"": constant} | {f: float(weights[i]) for f, i in index.items() if weights[i] != 0}


def _descend(rows, cols, toxic, pairs, n) -> tuple[np.ndarray, float]:
    """Proximal descent with adaptive rates over the whole sample."""
    share = np.where(toxic == 1, 1 / toxic.sum(), CLEAN_ODDS / (1 - toxic).sum()) / (1 + CLEAN_ODDS)
    at = np.concatenate([np.concatenate(p) for p in pairs])
    sign = np.concatenate([np.repeat((1.0, -1.0), (len(a), len(b))) for a, b in pairs])
    pair = np.repeat(np.arange(len(pairs)), [len(a) + len(b) for a, b in pairs])
    w, constant, g2, c2 = np.zeros(n), PRIOR, np.full(n, 1e-10), 1e-10
    for _ in range(STEPS):
        z = constant + np.bincount(rows, w[cols], len(toxic))
        error = share * (1 / (1 + np.exp(-z)) - toxic)
        gap = np.bincount(pair, sign * w[at], len(pairs)) / len(pairs)
        g = np.bincount(cols, error[rows], n) + 2 * COUNTERFACTUAL * np.bincount(at, sign * gap[pair], n)
        g2, c2 = g2 + g * g, c2 + error.sum() ** 2
        step = RATE / np.sqrt(g2)
        w = w - step * g
        w = np.sign(w) * np.maximum(np.abs(w) - step * SPARSITY, 0)
        constant -= RATE * error.sum() / math.sqrt(c2)
    return w, float(constant)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out`` (its label was not learnt from), ``score`` and ``predicted``."""
    shared = docs.sparkSession.sparkContext.broadcast({"weights": fit(docs, labels)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = shared.value
        weights, memo = state["weights"], state.setdefault("memo", {})
        for batch in batches:
            scores = np.empty(batch.num_rows)
            for i, text in enumerate(batch.column("text")):
                met: set[str] = set()
                for word in words_of(text.as_py()):
                    found = memo.get(word)
                    if found is None:
                        if len(memo) > _MEMO:
                            memo.clear()
                        found = memo[word] = tuple(f for f in features({word}) if f in weights)
                    met.update(found)
                z = weights[""] + sum(weights[f] for f in sorted(met))
                scores[i] = 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(_fold() == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
