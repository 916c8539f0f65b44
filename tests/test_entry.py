import pathlib

import pytest
from check_oracles import compare, duck

import __spark_entry__ as contract
from weftline.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not pathlib.Path(SF).exists(), reason="no test data")


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@needs_data
def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["batch_id", "block", "n", "ids"] and not df.isEmpty()


@needs_data
@pytest.mark.parametrize(
    "name", ["dedup_exact", "pack_batches", "mix_dedup_pack", "reject_report", "early_stop"]
)
def test_sql_gives_the_same_rows(spark, name):
    queries, oracles = contract.queries(), contract.oracle_sql()
    assert compare(spark, duck(SF), name, SF, queries, oracles) is None
