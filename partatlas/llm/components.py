"""Connected components of a table of links, by alternating stars.

Every round turns each node's larger neighbours towards the smallest node it knows
(large star), then its smaller ones (small star), until the links are stars around
the smallest node of each component. A node's smallest neighbour is an aggregate and
reaches the links by a join, so a node with very many links is never gathered in one
place, and adaptive execution may split it. Nor is it broadcast: links of few nodes make
files much smaller than they are. Every round is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partatlas.session import materialize, shuffled


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star operation on links ``hi > lo``."""
    if large:
        # All neighbours of a node count, its larger ones move.
        both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            links.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        moved = links.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        out = moved.join(shuffled(least), "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
    else:
        least = links.groupBy("hi").agg(F.min("lo").alias("m"))
        moved = links.join(shuffled(least), "hi")
        out = moved.select(F.col("lo").alias("hi"), F.col("m").alias("lo")).union(
            least.select("hi", F.col("m").alias("lo")))
    return out.filter("hi > lo").distinct()


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """``node`` and ``root``, the smallest node of its component.

    ``links`` has two comparable columns ``a`` and ``b``; direction, repeats and
    self-links do not matter, links with a null end are left out. Only nodes other
    than the roots have a row; no links give no rows.
    """
    now = materialize(
        links.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .distinct(), label)
    state = None
    while True:
        after = materialize(_star(_star(now, True), False), label)
        mark = after.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        now = after
        if mark == state:
            return now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        state = mark
