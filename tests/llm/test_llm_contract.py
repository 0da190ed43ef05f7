"""The registered queries of the llm subpackage: names, columns, SQL twins."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as contract
from compare import compare, connect
from eventmart.llm.registry import llm_oracles, llm_queries


def test_one_query_per_operator():
    assert [int(re.match(r"op(\d+)_", name)[1]) for name in llm_queries()] == list(range(1, 14))
    assert set(llm_queries()) | {"pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", list(llm_oracles()))
def test_query_equals_sql(spark, sf_dir, name):
    problems, count = compare(spark, connect(sf_dir), name, sf_dir)
    assert problems == [] and count > 0


def test_queries_without_sql_return_every_row(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for name in ("op2_quality_classifier", "op4_sentencepiece", "op5_token_files", "op7_toxicity", "op9_minhash_dedup", "op10_substring_dedup"):
        assert llm_queries()[name](spark, sf_dir).count() == n, name
    pieces = llm_queries()["op3_packing"](spark, sf_dir)
    assert pieces.selectExpr("count(distinct doc_id)").first()[0] == n
    scores = llm_queries()["op2_quality_classifier"](spark, sf_dir)
    assert scores.where("score < 0 or score > 1 or predicted != cast(score >= 0.7 as int)").count() == 0
