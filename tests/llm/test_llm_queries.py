"""Every query that SQL can express, against its SQL on the smallest test tables; the others run and keep their columns."""

import pytest

from compare import connect, difference
from tickerlake.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_html_extraction": ["page_id", "url", "text", "n_chars"],
    "op3_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op5_byte_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op7_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op10_quality_classifier": ["doc_id", "held_out", "score", "predicted"],
}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(name, spark, con):
    assert difference(QUERIES[name](spark, SF), con, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(name, spark):
    found = QUERIES[name](spark, SF)
    assert [c for c in COLUMNS[name] if c not in found.columns] == []
    rows = spark.read.parquet(f"{SF}/{'pages' if name.startswith('op1_') else 'documents'}.parquet").count()
    assert found.count() == rows


def test_all_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(COLUMNS) | set(ORACLE) == set(QUERIES)
