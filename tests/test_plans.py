"""Plan shape guards for the scale properties the code relies on."""

import os

import pytest

from textlens.operators.neardup import NearDup
from textlens.plans.catalog import QUERIES
from textlens.sources import tables as T

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_curation_is_one_aggregation_without_window(spark):
    p = plan(QUERIES["curate_corpus"](spark, SF))
    assert "Window" not in p and "EvalPython" not in p
    assert "HashAggregate" in p and "SortAggregate" not in p
    fmt = QUERIES["curate_corpus"](spark, SF)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    # the aggregation reads the narrow columns of the cleaned rows, not the texts
    assert "ReadSchema: struct<row_id:bigint,label_id:int,_h1:bigint,_h2:bigint,_long:boolean>" in fmt


def test_candidate_join_is_an_equi_join(spark):
    docs = T.read_table(spark, SF, "documents")
    p = plan(NearDup(docs).candidates())
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "SortMergeJoin" in p or "ShuffledHashJoin" in p or "BroadcastHashJoin" in p


def test_scoring_joins_model_without_python(spark):
    p = plan(QUERIES["score_linear"](spark, SF))
    assert "EvalPython" not in p and "CartesianProduct" not in p
