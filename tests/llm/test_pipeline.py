"""The pipeline: every stage on its own input, by brute force."""

from __future__ import annotations

import hashlib

import corpus_pipeline
import duckdb
import pandas as pd
from cubeloom.llm import queries
from cubeloom.llm.common import stored

from .test_llm import brute_simhash

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r.asDict() for r in docs.collect()}
        out = stored(stage(spark, docs, SF), "test-stage")
        after = {r["doc_id"]: r.asDict() for r in out.collect()}
        assert out.count() == len(after) and set(after) <= set(before)
        kept[name] = (before, after)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
        docs = out
    before, after = kept["toxicity"]
    toxic = {i for i, t in duckdb.sql(f"SELECT doc_id, toxic FROM '{SF}/labels.parquet'").fetchall() if t == 1}
    gone = set(before) - set(after)
    assert gone and len(gone & toxic) > len(gone) / 2
    before, after = kept["line dedup"]
    assert set(before) == set(after) and all(r["n_chars"] == len(r["text"]) for r in after.values())
    con = duckdb.connect()
    con.register("frame", pd.DataFrame(before.values()))
    con.execute("CREATE VIEW documents AS SELECT doc_id, text FROM frame")
    want = dict(con.execute(f"SELECT doc_id, kept_sha256 FROM ({queries.SQL['op6_line_dedup']})").fetchall())
    assert {i: hashlib.sha256(r["text"].encode()).hexdigest() for i, r in after.items()} == want
    before, after = kept["near dedup"]
    value = {i: brute_simhash(r["text"]) for i, r in before.items()}
    for i in set(before) - set(after):
        assert any(j < i and (value[i] ^ value[j]).bit_count() <= 4 for j in before)
    left = sorted(after)
    assert not any((value[a] ^ value[b]).bit_count() <= 4 for k, a in enumerate(left) for b in left[k + 1 :])
    before, after = kept["mixing"]
    words = {i: len((r["text"] or "").split()) for i, r in before.items()}
    assert 0.6 * sum(words.values()) < sum(words[i] for i in after) <= 0.9 * sum(words.values())
    before, after = kept["byte bpe"]
    assert all(hashlib.sha256(before[i]["text"].encode()).hexdigest() == r["decoded_sha256"] and len(r["ids"]) == 4 * r["n_tokens"] for i, r in after.items())


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
