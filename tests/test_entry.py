"""Driver contract: entry() smoke, registry/oracle consistency, oracle spot checks."""

import os

import pytest

import __spark_entry__ as E
from oracle_check import check

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["row_id", "text", "sentiment", "source_file", "label_id"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", ["curate_corpus", "curation_funnel", "grouped_split",
                                  "extract_x", "confusion_matrix", "near_dup_pairs"])
def test_oracle_match(spark, name):
    res = check(spark, SF, [name])[name]
    assert res["cols_ok"] and res["hash_ok"], res
