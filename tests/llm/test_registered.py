"""Every registered training-data query against its SQL, and the stages of the pipeline."""

import collections

import duckdb
import numpy as np
import pytest

from checks.compare import oracle_rows, spark_rows
from crawlsift.llm import decontaminate, packing
from crawlsift.llm.queries import TOKENIZER, queries
from crawlsift.llm.sql import oracle_sql
from crawlsift.session import materialize
from tests.llm.conftest import SF
from tests.llm.test_decontaminate import plain_contaminations
from tests.llm.test_simhash import plain_components, plain_fingerprint


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, name):
    assert spark_rows(queries()[name](spark, SF)) == oracle_rows(SF, oracle_sql()[name])


def test_one_query_per_operator():
    import __spark_entry__

    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries() and "pipeline" not in __spark_entry__.oracle_sql()


def test_pipeline_stages(spark, documents):
    import corpus_pipeline

    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "mixing", "token_packing"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = materialize(stages["quality_classifier"](spark, documents, SF), "t")
    kept = {r.doc_id for r in good.collect()}
    assert good.columns == documents.columns and kept < {r.doc_id for r in documents.collect()}
    right = [(d in kept) == (q == 1) for d, q in labels.items()]
    assert np.mean(right) > 0.95
    prints = {r.doc_id: plain_fingerprint(r.text) for r in good.collect()}
    single = materialize(stages["simhash_near_dedup"](spark, good, SF), "t")
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(plain_components(prints).values()))
    clean = materialize(stages["benchmark_decontamination"](spark, single, SF), "t")
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    texts = {r.doc_id: r.text for r in single.collect()}
    dirty = {d for d, _ in plain_contaminations(texts, items)}
    assert {r.doc_id for r in clean.collect()} == set(texts) - dirty
    mixed = materialize(stages["mixing"](spark, clean, SF), "t")
    con = duckdb.connect()
    con.register("documents", clean.toPandas())
    epochs = {row["doc_id"]: row["epochs"] for row in con.sql(oracle_sql()["op9_mixing"]).df().to_dict("records")}
    assert mixed.columns == documents.columns
    assert collections.Counter(r.doc_id for r in mixed.collect()) == epochs
    encode = packing.Tokenizer.load(TOKENIZER).open()
    expected = sorted(tuple(encode(r.text).tolist()) for r in mixed.collect() if r.text)
    rows = stages["token_packing"](spark, mixed, SF).collect()
    assert sum(len(t) for t in expected) == sum(r.cu_seqlens[-1] for r in rows)


def test_run_is_all_stages(spark):
    import corpus_pipeline

    assert corpus_pipeline.run(spark, SF).count() > 0


def test_decontamination_query(spark, texts):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id): r.distance for r in queries()["op7_decontamination"](spark, SF).collect()}
    assert got == plain_contaminations(texts, items)
    assert decontaminate.allowed_edits(10, 0.8) == 2
