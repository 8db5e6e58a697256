"""Every query of the package against its SQL, on awkward rows and on empty tables."""

import os

import pytest

import corpus_pipeline
from tests.llm.conftest import TEXTS
from tests.oracle import connect, differences
from tidemark.llm.queries import ORACLE_SQL, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


NOT_BY_DOCUMENT = ("op2_exact_top_k", "op4_best_fit_packing", "op10_html_extraction", "op11_source_divergence", "op12_conversation_trie")


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_agrees_with_sql(spark, name):
    got = QUERIES[name](spark, SF_DIR).toArrow()
    assert differences(got, connect(SF_DIR).sql(ORACLE_SQL[name]).to_arrow_table()) == []


@pytest.mark.parametrize("name", ["op2_exact_top_k", "op3_quality_rules", "op7_line_dedup", "op11_source_divergence", "op12_conversation_trie"])
def test_awkward_rows_agree_with_sql(spark, awkward, name):
    got = QUERIES[name](spark, awkward).toArrow()
    assert differences(got, connect(awkward).sql(ORACLE_SQL[name]).to_arrow_table()) == []


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in NOT_BY_DOCUMENT])
def test_one_row_for_each_document(spark, awkward, name):
    assert QUERIES[name](spark, awkward).count() == len(TEXTS) + 2


@pytest.mark.parametrize("name", list(QUERIES))
def test_empty_tables_give_no_rows(spark, nothing, name):
    assert QUERIES[name](spark, nothing).count() == 0


def test_pipeline_over_awkward_and_empty_tables(spark, awkward, nothing):
    assert corpus_pipeline.run(spark, nothing).count() == 0
    kept = {r["doc_id"] for r in corpus_pipeline.run(spark, awkward).select("doc_id").collect()}
    assert 0 in kept and not kept & {2, 3, 4, 5}
