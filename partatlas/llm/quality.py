"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Text measures are computed row by row, without a shuffle. Each rate goes into a
sketch of logarithmic bins with whole-number borders: up to 255 every value has its
own bin, above it bins are at most 1/128 of their value wide. Bins are plain counts,
so sketches of any parts of a corpus merge by addition, in any order, to the same
result. Fences of a language and source come from its own sketch, or from the merged
sketch of the language, or of everything, where it has seen too few documents. The upper
fence of a rate lies above a quantile of the sketch by a multiple of the interquartile
range and a small floor. Duplicate lines and repeats are rare, so their quantile is one
of the values above zero.

Everything is built of DataFrame functions. Null texts count as empty, null
languages and sources are groups of their own, repeated rows count as often as they
appear, an empty table gives an empty result. Very long texts are measured whole, in one
row. Other columns of ``docs`` travel inside a struct, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partatlas.session import materialize

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
#: A group with fewer documents than this takes the fences of the wider sketch.
MIN_GROUP = 100
#: Interquartile ranges beyond the quantiles at which a document is an outlier.
REACH = 4
#: Rates, the quantile (per mille) of the sketch above which the upper fence lies, whether
#: it is one of the nonzero values alone, the least distance of a fence from its quantile,
#: and whether low values are rejected too, below the first quartile.
RULES = {
    "symbols_per_mille": (950, False, 50, False),
    "dup_lines_per_mille": (950, True, 50, False),
    "stutter_per_mille": (750, False, 50, False),
    "repeats_per_mille": (950, True, 20, False),
    "word_length_percent": (750, False, 50, True),
}
_BREAK = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """Words of a text: runs of anything but space and the five control spaces."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _BREAK), "")


def text_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` as column ``row`` and the measures of the text beside it.

    ``n_words``, ``word_chars``, ``n_symbols``, ``n_lines`` (lines with a word),
    ``n_dup_lines`` (equal to an earlier one), ``n_stutter`` (words equal to the word
    before) and ``n_repeat_words`` (words inside a window of eight words that the text
    holds twice or more).
    """
    body = F.coalesce(F.col(f"row.`{text}`"), F.lit(""))
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).select(
        "row",
        words_of(F.col(f"row.`{text}`")).alias("words"),
        F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.regexp_count(body, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
    )
    n = F.size("words")
    windows = F.when(
        n > WINDOW,
        F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)),
                    lambda i: F.xxhash64(F.slice("words", i, WINDOW))),
    ).otherwise(F.array().cast("array<bigint>"))
    out = out.select(
        "row", "n_symbols", n.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("words", lambda w, i: F.coalesce(F.get("words", i - 1) == w, F.lit(False))))
        .cast("long").alias("n_stutter"),
        windows.alias("windows"),
    )
    # Only a text that repeats a window has its windows sorted.
    out = out.withColumn(
        "placed",
        F.when(F.size(F.array_distinct("windows")) < F.size("windows"),
               F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))),
    )
    out = out.withColumn(
        "at",
        F.array_sort(F.transform(
            F.filter("placed", lambda e, i: F.coalesce(F.get("placed", i - 1)["h"] == e["h"], F.lit(False))
                     | F.coalesce(F.get("placed", i + 1)["h"] == e["h"], F.lit(False))),
            lambda e: e["at"])),
    )
    covered = F.aggregate(
        F.transform("at", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("at", i + 1) - p, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda total, x: total + x,
    )
    # The measures leave through a generator: no filter on them is pushed below it, where
    # it would repeat the measuring inside its condition.
    return out.select("row", F.inline(F.array(F.struct(
        "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_stutter",
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words")))))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _rates() -> dict[str, Column]:
    per = lambda k, a, b: F.floor(k * F.col(a) / F.greatest(F.col(b), F.lit(1))).cast("long")
    return {
        "symbols_per_mille": per(1000, "n_symbols", "n_words"),
        "dup_lines_per_mille": per(1000, "n_dup_lines", "n_lines"),
        "stutter_per_mille": per(1000, "n_stutter", "n_words"),
        "repeats_per_mille": per(1000, "n_repeat_words", "n_words"),
        "word_length_percent": per(100, "word_chars", "n_words"),
    }


def sketch(measures: DataFrame) -> DataFrame:
    """Counts by language, source, rate and bin; sketches merge by adding counts.

    ``bin`` is the smallest value of the bin: the seven bits behind the leading one
    stay, lower bits are cleared.
    """
    rates = _rates()
    shift = "greatest(length(bin(value)) - 8, 0)"
    return (
        measures.filter(~base_failed())
        .select("lang", "source", F.explode(F.array(*[
            F.struct(F.lit(k).alias("rate"), v.alias("value")) for k, v in rates.items()])).alias("x"))
        .select("lang", "source", "x.rate", "x.value")
        .withColumn("bin", F.expr(f"shiftleft(shiftright(value, {shift}), {shift})"))
        .groupBy("lang", "source", "rate", "bin").agg(F.count("*").alias("n"))
    )


def quantiles(sketches: DataFrame) -> DataFrame:
    """Both quartiles and the quantile of the upper fence (``upper``, zero if the rate has no
    value that counts) of every rate by ``lang``, ``source`` and ``level``.

    Level 0 is a language and source, level 1 a language, level 2 everything; the
    wider levels are merged sketches.
    """
    null = F.lit(None).cast("string")
    merged = lambda df: df.groupBy("level", "lang", "source", "rate", "bin").agg(F.sum("n").alias("n"))
    levels = [
        sketches.withColumn("level", F.lit(0)),
        merged(sketches.withColumn("level", F.lit(1)).withColumn("source", null)),
        merged(sketches.withColumn("level", F.lit(2)).withColumn("source", null).withColumn("lang", null)),
    ]
    part = Window.partitionBy("level", "lang", "source", "rate")
    counted = reduce(DataFrame.unionByName, levels).select(
        "*", F.sum("n").over(part.orderBy("bin")).alias("upto"), F.sum("n").over(part).alias("total"),
        F.sum(F.when(F.col("bin") == 0, F.col("n")).otherwise(0)).over(part).alias("zeros"))
    at = lambda k: F.min(F.when(4 * F.col("upto") >= k * F.col("total"), F.col("bin")))
    upper = F.coalesce(*[
        F.when((F.col("rate") == r) & (F.col("bin") > 0 if nonzero else F.lit(True))
               & (1000 * (F.col("upto") - skip) >= k * (F.col("total") - skip)), F.col("bin"))
        for r, (k, nonzero, *_) in RULES.items() for skip in [F.col("zeros") if nonzero else F.lit(0)]])
    return counted.groupBy("level", "lang", "source", "rate").agg(
        at(1).alias("q1"), at(3).alias("q3"), F.coalesce(F.min(upper), F.lit(0)).alias("upper"),
        F.max("total").alias("total"))


def fences(sketches: DataFrame) -> DataFrame:
    """Lowest and highest accepted value of each rate, one row per language and source.

    Columns ``lang``, ``source`` and, by rate, ``low_<rate>`` (null: none) and
    ``high_<rate>``.
    """
    q = quantiles(sketches)
    own, by_lang, whole = (q.filter(F.col("level") == k).alias(f"l{k}") for k in range(3))
    pick = lambda c: (
        F.when(F.col("l0.total") >= MIN_GROUP, F.col(f"l0.{c}"))
        .when(F.col("l1.total") >= MIN_GROUP, F.col(f"l1.{c}")).otherwise(F.col(f"l2.{c}")))
    chosen = (
        own.join(by_lang, F.col("l0.lang").eqNullSafe(F.col("l1.lang")) & (F.col("l0.rate") == F.col("l1.rate")))
        .join(whole, F.col("l0.rate") == F.col("l2.rate"))
        .select("l0.lang", "l0.source", "l0.rate", *[pick(c).alias(c) for c in ("q1", "q3", "upper")])
    )
    cols = []
    for r, (_, _, floor, both) in RULES.items():
        of = lambda v: F.max(F.when(F.col("rate") == r, v))  # noqa: B023, E731
        reach = REACH * (F.col("q3") - F.col("q1")) + floor
        low = of(F.col("q1") - reach) if both else F.lit(None).cast("long")
        cols += [low.alias(f"low_{r}"), of(F.col("upper") + reach).alias(f"high_{r}")]
    return chosen.groupBy("lang", "source").agg(*cols)


def judge(measures: DataFrame, limits: DataFrame) -> DataFrame:
    """``measures`` with ``base_failed`` and ``kept``.

    The limits are joined null-safely; a language and source without limits has no
    document that passes the base rules.
    """
    m, f = measures.alias("m"), limits.alias("f")
    inside = reduce(Column.__and__, [
        (F.coalesce(v >= F.col(f"f.low_{r}"), F.lit(True))) & F.coalesce(v <= F.col(f"f.high_{r}"), F.lit(True))
        for r, v in _rates().items()])
    return m.join(
        f, F.col("m.lang").eqNullSafe(F.col("f.lang")) & F.col("m.source").eqNullSafe(F.col("f.source")), "left",
    ).select("m.*", base_failed().alias("base_failed"), (~base_failed() & inside).alias("kept"))


def quality_table(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, measures, ``base_failed`` and ``kept``.

    Texts are measured once; the stored measures hold no text.
    """
    keys = [F.col(f"row.{c}").alias(c) for c in ("doc_id", "lang", "source")]
    measures = materialize(
        text_measures(docs.select("doc_id", "lang", "source", "text")).select(*keys, F.col("*"))
        .drop("row"), "quality-measures")
    return judge(measures, fences(sketch(measures)))


def quality_filter(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` that pass, with all their columns.

    Texts are measured once, and the measures are stored beside the rows. The limits are a
    stored table of one row per language and source, so that a plan sees how small it is and
    rows need no shuffle to meet it.
    """
    keys = [F.col("row.lang").alias("lang"), F.col("row.source").alias("source")]
    measured = materialize(text_measures(docs).select(*keys, F.col("*")), "quality-measures", "zstd")
    limits = materialize(fences(sketch(measured)), "quality-limits")
    return judge(measured, limits).filter("kept").select("row.*")
