"""The registered queries against their SQL, and the whole pipeline against its single stages."""

from __future__ import annotations

import corpus_pipeline
import pytest
from check_oracle import connect, difference
from conftest_llm import SF, SMALL

import __spark_entry__ as contract
from textpipe.llm import decontaminate, line_dedup, simhash, toxicity
from textpipe.llm.oracle import ORACLE
from textpipe.llm.queries import QUERIES, vocabulary


def test_registered():
    names = contract.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14))
    assert "pipeline" in names and ORACLE.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, name):
    got = QUERIES[name](spark, SF).toPandas()
    assert difference(got, connect(SF).sql(ORACLE[name]).df()) is None


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "simhash_dedup", "decontamination", "packing",
    ]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SMALL)
        if name != "packing":
            assert docs.columns == before.columns and docs.dtypes == before.dtypes
        docs = docs.cache()
        after[name] = docs
    model = toxicity.fit(
        spark.read.parquet(f"{SMALL}/documents.parquet"), labels.filter(toxicity.trained_on())
    )
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    whole = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert ids(after["toxicity"]) == ids(whole.filter(model.score() < 0.5))
    lines = after["line_dedup"]
    assert ids(lines) == ids(after["toxicity"]) and lines.filter("n_chars != char_length(text)").count() == 0
    assert line_dedup.decide(lines).filter("not kept").count() == 0
    found = simhash.near_duplicates(lines)
    assert ids(after["simhash_dedup"]) == {r.component_id for r in found.select("component_id").collect()}
    hits = {r.doc_id for r in decontaminate.matches(after["simhash_dedup"], benchmark).collect()}
    assert ids(after["decontamination"]) == ids(after["simhash_dedup"]) - hits
    assert ids(after["packing"]) == ids(after["decontamination"])
    run = {(r.doc_id, r.piece, r.ids_crc32) for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert run == {(r.doc_id, r.piece, r.ids_crc32) for r in after["packing"].collect()}
    assert vocabulary().endswith(".json")


def test_stages_on_odd_rows(spark, odd):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), SMALL).count() == 0, name
        got = stage(spark, odd, SMALL)
        assert got.count() > 0
        if name != "packing":
            assert got.columns == odd.columns
