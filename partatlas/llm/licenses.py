"""Licence scans: Dice coefficient over word bigrams against licence templates.

Units of a document are its whole text, its blocks between blank lines and its lines.
A unit is normalised to lower-case words of letters and digits, copyright lines left
out, and compared to templates by ``2 |A ∩ B| / (|A| + |B|)`` over its distinct word
bigrams. A coefficient of ``t`` needs sizes within a factor of ``(2 - t) / t``, so
only templates in these bounds are compared. It also needs at least ``t / 2`` times
both sizes in common; the templates' longest words are made anchors until a unit
without any of them cannot reach the threshold, so texts without an anchor word leave
before they are taken apart.

Everything is built of DataFrame functions, row by row: the templates are a literal
of fixed size, and there is no join and no shuffle. Null and empty texts have no
units; repeated rows have rows of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partatlas.llm.license_texts import templates

THRESHOLD = 0.8
#: Words of the templates that are common in any text; they become anchors last.
_COMMON = frozenset("a and any as at by for if in is it may no not of on one or that the this to under with work you".split())
def normal_words(text: str) -> list[str]:
    """Words of a template, the same way as ``normalised`` takes them from a column."""
    kept = [x for x in text.lower().split("\n") if not re.match(r"\W*(?:copyright|\(c\)|©)\W*(?:\(c\)|©|\d{4})", x)]
    return re.findall(r"[^\W_]+", " ".join(kept))


def bigrams(words: list[str]) -> list[str]:
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def template_table() -> list[tuple[str, int, list[str]]]:
    """Licence, number in the list and bigrams of each template."""
    return [(name, n, bigrams(normal_words(text))) for n, (name, text) in enumerate(templates())]


def anchor_words(threshold: float = THRESHOLD) -> list[str]:
    """Words of which every unit within the threshold of a template has at least one.

    From ``|A ∩ B| >= t/2 (|A| + |B|)`` and ``|A| >= |A ∩ B|`` follows
    ``|A ∩ B| >= t / (2 - t) |B|``. Words are taken, longest first, until fewer bigrams
    of the template than that are without any of them. Long words are rare ones; common
    words and numbers come last.
    """
    anchors: set[str] = set()
    for _, _, pairs in template_table():
        need = math.ceil(threshold / (2 - threshold) * len(pairs) - 1e-9)
        words = sorted({w for p in pairs for w in p.split(" ")},
                       key=lambda w: (w in _COMMON or w.isdigit(), -len(w), w))
        for w in words:
            if sum(1 for p in pairs if anchors.isdisjoint(p.split(" "))) < need:
                break
            anchors.add(w)
    return sorted(anchors)


def _normalised(unit: Column) -> Column:
    lines = F.filter(F.split(F.lower(unit), "\n"), lambda x: ~x.rlike(
        r"^[^\p{L}\p{N}]*(?:copyright|\(c\)|©)[^\p{L}\p{N}]*(?:\(c\)|©|\p{Nd}{4})"))
    return F.array_remove(F.split(F.array_join(lines, " "), r"[^\p{L}\p{N}]+"), "")


def license_scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per unit of a document with a template at or above the threshold:
    ``doc_id``, ``unit`` (place among the document's distinct units), ``unit_text``,
    the best template's ``license`` and number ``template`` (the first of equals),
    ``n_common`` and ``dice``.
    """
    anchored = rf"(?iu)(?<![\p{{L}}\p{{N}}])(?:{'|'.join(anchor_words(threshold))})(?![\p{{L}}\p{{N}}])"
    text = F.regexp_replace("text", "\r\n?", "\n")
    units = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter(
        F.col("text").rlike(anchored)).select("doc_id", text.alias("text")).select(
        "doc_id", F.array_distinct(F.transform(
            F.concat(F.array("text"), F.split("text", r"\n[ \t]*\n\s*"), F.split("text", "\n")),
            lambda x: F.trim(x))).alias("units"))
    units = units.select("doc_id", F.posexplode("units").alias("unit", "unit_text")).filter(
        F.col("unit_text").rlike(anchored))
    worded = units.select("*", _normalised(F.col("unit_text")).alias("words"))
    paired = worded.select(
        "doc_id", "unit", "unit_text",
        F.array_distinct(F.transform(
            F.slice("words", 1, F.greatest(F.size("words") - 1, F.lit(0))),
            lambda w, i: F.concat_ws(" ", w, F.get("words", i + 1)))).alias("pairs"))
    table = F.array(*[
        F.struct(F.lit(name).alias("license"), F.lit(n).alias("template"), F.lit(len(p)).alias("n"),
                 F.array(*map(F.lit, p)).alias("pairs"))
        for name, n, p in template_table()])
    reach = (2 - threshold) / threshold
    size = F.size("pairs")
    near = F.filter(table, lambda t: (t["n"] <= size * reach) & (size <= t["n"] * reach))
    common = F.transform(near, lambda t: F.struct(
        t["license"].alias("license"), t["template"].alias("template"), t["n"].alias("n"),
        F.size(F.array_intersect(F.col("pairs"), t["pairs"])).alias("n_common")))
    best = F.array_max(F.transform("common", lambda t: F.struct(
        (2.0 * t["n_common"] / (size + t["n"])).alias("dice"), (-t["template"]).alias("order"),
        t["license"].alias("license"), t["n_common"].alias("n_common"))))
    # The best template leaves through a generator, so that the filter on it is not
    # pushed down to where it would repeat the comparison.
    return (
        paired.select("*", common.alias("common"))
        .select("doc_id", "unit", "unit_text", best.alias("best"))
        .select("doc_id", "unit", "unit_text", F.inline(F.array("best")))
        .filter(F.col("dice") >= threshold)
        .select("doc_id", "unit", "unit_text", "license", (-F.col("order")).alias("template"), "n_common", "dice")
    )
