"""Driver contract: entry() smoke run and a few oracle comparisons on sf0.001."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck_connect

SMOKE = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "cancer_group_1" in df.columns


def test_every_query_has_an_oracle():
    assert set(E.oracle_sql()) - set(E.LLM_SQL) == set(E.queries()) - set(E.LLM_QUERIES)


@pytest.mark.parametrize("key", ["first_cancer_slots", "id_lookup", "registrations_summary", "ks4_best",
                                 "absence_summary"])
def test_oracle_agrees(spark, key):
    ok, msg = compare(E.queries()[key](spark, SMOKE), E.oracle_sql()[key], duck_connect(SMOKE))
    assert ok, msg
