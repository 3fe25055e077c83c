import corpus_pipeline
import pytest
from compare import differences

from tokenwin.llm import queries as registry
from tokenwin.llm.tables import table

SF_DIR = "/root/testdata/sf0.001"
SQL = registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert differences(registry.queries()[name](spark, SF_DIR), SQL[name], SF_DIR) == []


def test_there_is_a_query_for_each_operator():
    assert {name.split("_")[0] for name in registry.queries()} == {f"op{n}" for n in range(1, 14)}


def test_pipeline_stages_in_turn(spark):
    docs = table(spark, SF_DIR, "documents")
    columns, known = docs.columns, {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == columns
        ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert ids and ids <= known
        known = ids
    assert corpus_pipeline.run(spark, SF_DIR).count() == docs.count()
