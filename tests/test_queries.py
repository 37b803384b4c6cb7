"""A sample of the registered queries against their SQL on the smallest test tables; `tools/check_oracles.py` runs all."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from ramure.plans.fixtures import TABLES

FOLDER = "/root/testdata/sf0.001"
SAMPLE = ["accuracy_by_level", "code_levels", "preprocess_documents", "cap_by_stratum", "metrics_all_sources", "evaluation_report",
          "coverage_curve", "beam_decode", "mask_children", "code_page_sections", "assemble_batches", "extract_periods"]
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not there")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    return con


def normal(row):
    return tuple("" if v is None else f"{v + 0.0:.6f}" if isinstance(v, float) else str(v) for v in row)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    left = sorted(normal([row[c] for c in columns]) for row in df.collect())
    result = duck.execute(contract.oracle_sql()[name])
    names = [c[0] for c in result.description]
    right = sorted(normal([dict(zip(names, row))[c] for c in columns]) for row in result.fetchall())
    assert left == right and left


def test_entry_and_registry(spark):
    assert contract.entry(spark).columns == ["level", "n", "accuracy", "f1_weighted", "n_true", "n_pred"]
    assert set(contract.oracle_sql()) <= set(contract.queries()) and len(contract.queries()) > 150
