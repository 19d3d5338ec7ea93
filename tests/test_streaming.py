from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from partatlas.operators.releases import portfolio_latest
from partatlas.session import work_dir
from partatlas.streaming.ingest import (
    incremental_ingest,
    read_portfolio_log,
    run_portfolio_stream,
    streaming_portfolio,
    tree_stream,
)


def add(root, release, part, name, text="x"):
    path = root / release / "processors" / part / "ksdk2_0" / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_files_are_taken_in_once(spark, tmp_path):
    out = work_dir(spark, "ingest")
    for step, names in enumerate((["a.xml", "b.xml"], ["c/d.xml"], [])):
        for name in names:
            add(tmp_path, "26.3", "P1", name, f"<n>{step}</n>")
        incremental_ingest(tree_stream(spark, str(tmp_path)), f"{out}/tree", f"{out}/check")
        got = sorted(r.relpath for r in spark.read.parquet(f"{out}/tree").collect())
        assert got == [["a.xml", "b.xml"], ["a.xml", "b.xml", "c/d.xml"], ["a.xml", "b.xml", "c/d.xml"]][step]


def test_documents_in_a_folder_of_files_are_taken_in(spark, table, tmp_path):
    from __spark_entry__ import queries

    docs = table("doc_id long, text string, lang string, source string, n_chars long",
                 *[(i, f"word {i}", "en", "web", 6) for i in range(30)])
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    table("doc_id long", (1,)).write.parquet(str(tmp_path / "labels.parquet"))
    got = queries()["incremental_ingest"](spark, str(tmp_path)).collect()
    assert len(got) == 30 and len({(r.release, r.part, r.variant, r.relpath) for r in got}) == 30


LISTING = "release string, full_path string, directory boolean, name string"


@pytest.fixture
def releases(table):
    return table("api_id long, name string, version string",
                 (1, "25.6", "v"), (2, "25.12", "v"), (3, "26.1", ""))


def test_portfolio_follows_late_and_new_listings(spark, table, releases, tmp_path):
    out, source = work_dir(spark, "portfolio"), str(tmp_path / "in")
    batches = [
        [("25.12", "/processors/A", True, "A"), ("26.1", "/processors/B", True, "B")],
        [("25.6", "/processors/A", True, "A"), ("25.6", "/processors/B", True, "B"),
         ("25.6", "/processors/A/ksdk2_0", True, "ksdk2_0")],
        [("25.12", "/processors/B", True, "B"), ("25.12", "/processors/n", False, "n")],
    ]
    seen = []
    for rows in batches:
        table(LISTING, *rows).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(LISTING).parquet(source)
        run_portfolio_stream(streaming_portfolio(stream), f"{out}/log", f"{out}/check")
        seen.append({tuple(r) for r in read_portfolio_log(spark, f"{out}/log", releases).collect()})
    assert seen == [{("A", "25.12")}, {("A", "25.12"), ("B", "25.6")}, {("A", "25.12"), ("B", "25.12")}]
    batch = portfolio_latest(releases, spark.read.parquet(source))
    assert {tuple(r) for r in batch.collect()} == seen[-1]
    # A listing that came before its release was published counts from then on.
    later = releases.withColumn("version", F.lit("v"))
    now = read_portfolio_log(spark, f"{out}/log", later)
    assert {tuple(r) for r in now.collect()} == {("A", "25.12"), ("B", "26.1")}
