"""The pipeline, stage by stage, against checks from scratch."""

from __future__ import annotations

import re
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from test_mixing import check as check_mix
from test_pieces import plain
from test_nearcopies import groups_by_brute_force

import corpus_pipeline
from partatlas.llm.pieces import decode, vocabulary
from partatlas.llm.sql import QUALITY_SQL
from partatlas.llm.surrogates import mentions

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage gets and returns."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, SF)
        result.write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        out[name] = (docs.collect(), after.collect())
        docs = after
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == COLUMNS
    return out


def test_quality_stage(stages):
    before, after = stages["quality_rules"]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    kept = {d for d, k in con.execute(f"SELECT doc_id, kept FROM ({QUALITY_SQL})").fetchall() if k}
    assert sorted(after) == sorted(r for r in before if r.doc_id in kept)
    assert 0 < len(after) < len(before)


def test_near_duplicate_stage(stages):
    before, after = stages["simhash_near_duplicates"]
    groups = groups_by_brute_force({r.doc_id: r.text for r in before})
    assert sorted(after) == sorted(r for r in before if groups[r.doc_id] == r.doc_id)


def test_personal_data_stage(stages):
    before, after = stages["pii_surrogates"]
    new = {r.doc_id: r for r in after}
    assert len(new) == len(before)
    for r in before:
        found = list(mentions(r.text))
        assert (new[r.doc_id].text == r.text) == (not found)
        assert not any(r.text[a:b] in new[r.doc_id].text for a, b, *_ in found)
        assert new[r.doc_id].n_chars == len(new[r.doc_id].text)


def test_mix_stage(stages):
    before, after = stages["source_mix"]
    times = Counter(r.doc_id for r in after)
    assert max(times.values()) <= 2
    by_id = {r.doc_id: r for r in before}
    assert all(by_id[r.doc_id] == r for r in after)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))

    from types import SimpleNamespace

    total = Counter()
    for r in before:
        total[r.source] += size(r.text)
    from test_mixing import plain_targets

    want = plain_targets(total)
    rows = [SimpleNamespace(doc_id=r.doc_id, size=size(r.text), source_size=total[r.source], target=want[r.source],
                            taken=times[r.doc_id] * size(r.text)) for r in before]
    check_mix(rows, [(r.doc_id, r.text, r.source) for r in before])


def test_encoding_stage(stages):
    before, after = stages["sentencepiece"]
    vocab = vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    assert Counter(r.doc_id for r in before) == Counter(r.doc_id for r in after)
    text = {r.doc_id: r.text for r in before}
    for r in after:
        assert r.n_ids == len(r.ids)
        assert decode(np.array(r.ids), vocab) == text[r.doc_id].replace("▁", " ")
    short = [r for r in after if len(text[r.doc_id]) < 600]
    assert short
    for r in short:
        assert r.ids == plain(text[r.doc_id], vocab)


def test_run(spark, stages):
    got = Counter((r.doc_id, r.n_ids) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == Counter((r.doc_id, r.n_ids) for r in stages["sentencepiece"][1])


def test_odd_rows(spark, odd, none):
    for table in (odd, none):
        docs = table
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF)
            if i < 4:
                assert out.columns == COLUMNS
            n = out.count()
            assert n <= 2 * table.count()
            # The next stage gets all odd rows, not only what this one left.
