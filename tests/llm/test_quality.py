from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from partatlas.llm.quality import RULES, fences, judge, quality_filter, quality_table, quantiles, sketch, text_measures


def measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    at = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if at[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(covered))


def test_measures(docs):
    base = "a b c d e f g h i"
    texts = [None, "", " \n\t", base, f"{base} {base}", f"x {base}\ny {base}\n{base}", "q " * 40, "l1\nl1\n\nl2\n l1\nl1\r",
             "#a *b $c %d &e |f <g >h", "é 😀 日本\x0b語  x　y", "one two\x1cthree"]
    got = {r.doc_id: r for r in quality_table(docs(*texts)).collect()}
    for i, text in enumerate(texts):
        r = got[i]
        n, chars, symbols, dup, rep = want = measures(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, text
        assert r.base_failed == (n < 20 or 100 * rep > 30 * n)
        assert not (r.base_failed and r.kept)


def test_real_texts(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r for r in quality_table(table).collect()}
    for r in table.collect():
        g = got[r.doc_id]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == measures(r.text)


def test_verdict_adapts(docs):
    """A tail of symbols is odd in prose, and usual where every text has it."""
    rng = random.Random(1)
    prose = [(i, " ".join(f"word{rng.randrange(900)}" for _ in range(40)), "en", "prose") for i in range(150)]
    code = [(1000 + i, " ".join(f"w{rng.randrange(900)}&&" for _ in range(40)), "en", "code") for i in range(150)]
    odd = [(5000, " ".join(f"odd{k}&&" for k in range(40)), "en", "prose")]
    kept = {r.doc_id: r.kept for r in quality_table(docs(*prose, *code, *odd)).collect()}
    assert kept.pop(5000) is False
    assert all(kept.values())


def test_sketches_merge(docs):
    table = docs(*[(i, " ".join(f"w{k}" + "#" * (i % 7) for k in range(30 + i)), "en", "ab"[i % 2]) for i in range(300)])
    m = text_measures(table).select(F.col("row.lang").alias("lang"), F.col("row.source").alias("source"), "*")
    parts = sketch(m.filter("row.doc_id < 100")).union(sketch(m.filter("row.doc_id >= 100")))
    merged = parts.groupBy("lang", "source", "rate", "bin").agg(F.sum("n").alias("n"))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, sketch(m).collect()))
    # Quartiles are the bins of the exact ones.
    exact = {}
    for r in m.collect():
        exact.setdefault(r.source, []).append(1000 * r.n_symbols // r.n_words)
    q = {r.source: r for r in quantiles(sketch(m)).filter("rate = 'symbols_per_mille' and level = 0").collect()}
    for source, values in exact.items():
        v = sorted(values)
        low = v[-(-len(v) // 4) - 1]
        assert q[source].q1 <= low and low - q[source].q1 <= low / 128 + 1
    assert fences(sketch(m)).count() == 2
    assert judge(m, fences(sketch(m))).filter("kept").count() == 300


def test_fences_follow_their_group(docs):
    """Fences are the quantiles of each group's own values, and differ between groups."""
    rng = random.Random(2)

    def text(group):
        lines = [" ".join(f"{'x' * rng.randrange(2, 6 + group)}{rng.randrange(9999)}" for _ in range(5)) for _ in range(12)]
        if rng.random() < 0.1 * group:
            lines += rng.choices(lines, k=rng.randrange(1, 2 + group)) + ["#" * rng.randrange(1, 9 * group)]
        return "\n".join(lines)

    table = docs(*[(i, text(i % 3 + 1), "en", f"s{i % 3}") for i in range(600)])
    m = text_measures(table).select(F.col("row.lang").alias("lang"), F.col("row.source").alias("source"), "*")
    limits = {r.source: r for r in fences(sketch(m)).collect()}
    values = {}
    for r in m.collect():
        for rate, v in (("symbols_per_mille", 1000 * r.n_symbols // r.n_words),
                        ("dup_lines_per_mille", 1000 * r.n_dup_lines // r.n_lines),
                        ("word_length_percent", 100 * r.word_chars // r.n_words)):
            values.setdefault((rate, r.source), []).append(v)
    for (rate, source), every in values.items():
        k, nonzero, floor, _ = RULES[rate]
        every.sort()
        at = lambda vs, p: vs[-(-p * len(vs) // 1000) - 1]
        counted = [v for v in every if v or not nonzero]
        want = (at(counted, k) if counted else 0) + 4 * (at(every, 750) - at(every, 250)) + floor
        got = limits[source][f"high_{rate}"]
        assert abs(got - want) <= 9 * (max(every) / 128 + 1), (rate, source)
    for rate in ("symbols_per_mille", "dup_lines_per_mille", "word_length_percent"):
        assert len({r[f"high_{rate}"] for r in limits.values()}) == 3, rate


def test_odd_rows(odd, none):
    rows = quality_table(odd).collect()
    assert len(rows) == 12
    assert all(r.kept is not None for r in rows)
    assert quality_table(none).count() == 0
    kept = quality_filter(odd)
    assert kept.columns == odd.columns
    table = {(r.doc_id, r.n_words): r.kept for r in rows}
    for r in kept.collect():
        assert table[r.doc_id, measures(r.text)[0]]
    assert quality_filter(none).count() == 0


def test_query_against_sql(spark):
    from __spark_entry__ import oracle_sql, queries

    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    df = queries()["op3_quality_rules"](spark, "/root/testdata/sf0.001")
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({oracle_sql()['op3_quality_rules']})").fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(want)


def test_rows_are_not_shuffled_to_be_filtered(spark):
    docs = spark.range(4_000).selectExpr(
        "id AS doc_id", "IF(id % 4 = 0, concat('plain ', concat_ws(' ', transform(sequence(1, 30), x -> concat('w', x * id)))), "
        "concat('short ', id)) AS text", "'en' AS lang", "'a' AS source", "id AS other")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # Room for a row per language and source, not for one per rejected document.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 40_000)
    try:
        kept = quality_filter(docs)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
        want = {r.doc_id for r in quality_table(docs).filter("kept").collect()}
        got = kept.collect()
        assert kept.columns == docs.columns and {r.doc_id for r in got} == want and 0 < len(got) == len(want)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
