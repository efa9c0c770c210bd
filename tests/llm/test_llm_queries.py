"""The registered queries on the smallest test tables."""

import os

import pytest

import corpus_pipeline
from check_oracle import compare
from perennial.llm.oracle import ORACLE
from perennial.llm.queries import QUERIES
from perennial.llm.shared import table

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

LARGER = "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")

ROWS_OF = {1: "embeddings", 2: "documents", 3: "documents", 5: "documents", 6: "documents", 7: "documents", 8: "pages", 10: "conversations", 11: "documents", 12: "documents"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    rows, _seconds, problem = compare(spark, SF_DIR, name, QUERIES[name], ORACLE.get(name))
    assert not problem and rows > 0
    given = ROWS_OF.get(int(name[2:].split("_")[0]))
    assert given is None or rows == table(spark, SF_DIR, given).count()


@pytest.mark.skipif(not os.path.isdir(LARGER), reason="no test tables here")
def test_quality_separates_the_labels(spark):
    judged = {r.doc_id: r.kept for r in QUERIES["op6_kneser_ney"](spark, LARGER).collect()}
    labels = {r.doc_id: r.quality for r in table(spark, LARGER, "labels").collect()}
    clean = [judged[d] for d, q in labels.items() if q == 1]
    junk = [judged[d] for d, q in labels.items() if q == 0]
    assert sum(clean) >= 0.97 * len(clean) and sum(junk) <= 0.2 * len(junk)


def test_pipeline(spark):
    docs = table(spark, SF_DIR, "documents")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == columns, name
        assert name == "mixing" or docs.count() < before
    out = corpus_pipeline.run(spark, SF_DIR)
    assert out.count() > 0 and corpus_pipeline.ORACLE_SQL is None
    words = out.where("bin_id is not null").groupBy("bin_id", "bin_used").sum("length").collect()
    assert all(r["bin_used"] == r["sum(length)"] for r in words)
