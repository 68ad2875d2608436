"""Plan shape: no Python UDF anywhere, no Expand for the multi-distinct aggregates, filters reach
the scan."""

from finsight.plans.queries import QUERIES
from conftest import SF_SMOKE


def _plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_no_python_udf_in_any_model(spark):
    for key in ["int_transaction_features", "fct_anomalies_summary", "fct_churn_predictions",
                "fct_kpis_portefeuille", "fct_sinistralite", "ingest_csv", "pg_initcap"]:
        plan = _plan(QUERIES[key](spark, SF_SMOKE))
        assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, key


def test_no_expand_for_conditional_distinct_counts(spark):
    for key in ["trans_activity", "contrats_portfolio", "sinistres_history", "int_client_activity"]:
        assert "Expand" not in _plan(QUERIES[key](spark, SF_SMOKE)), key


def test_pushdown_and_pruning(spark):
    plan = _plan(QUERIES["stat_active_contracts"](spark, SF_SMOKE))
    assert "ReadSchema: struct<o_orderstatus:string>" in plan
    plan = _plan(QUERIES["stg_sinistres"](spark, SF_SMOKE))
    assert "PushedFilters: [IsNotNull(l_orderkey)" in plan
    assert "l_returnflag" not in plan  # every line item is a claim
