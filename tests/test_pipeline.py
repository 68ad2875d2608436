"""Layered runner: tag selection, test gate, stored failures."""

import os

from finsight.params import Params
from finsight.plans import pipeline
from finsight.plans.queries import Models
from conftest import SF_SMOKE


def test_select_by_tag():
    names = [m.name for m in pipeline.select(tags={"churn"})]
    assert names == ["fct_churn_predictions", "dim_client_segments"]
    assert [m.name for m in pipeline.select("staging")][:2] == ["stg_clients", "stg_transactions"]


def test_gate_stops_after_failing_layer(spark, scratch_dir):
    m = Models(spark, SF_SMOKE)
    rel, log = pipeline.run_pipeline(spark, m.raw, Params(), scratch_dir)
    # the fixture has NULL e-mails in raw clients: the source not_null test fails with the staging layer
    fails = [s.name for s in log if s.step == "test" and s.status == "fail"]
    assert "not_null__clients__email" in fails
    assert log[-1].step == "stop" and log[-1].name == "staging"
    assert "int_client_activity" not in rel
    assert os.path.isdir(os.path.join(scratch_dir, "test_failures", "not_null__clients__email"))


def test_full_run_without_gate(spark, scratch_dir):
    m = Models(spark, SF_SMOKE)
    rel, log = pipeline.run_pipeline(spark, m.raw, Params(), scratch_dir, run_tests=False)
    assert rel["fct_kpis_portefeuille"].count() == 1
    assert os.path.isdir(os.path.join(scratch_dir, "marts", "fct_churn_predictions"))
    assert sum(1 for s in log if s.step == "run") == len(pipeline.REGISTRY)


def test_materialized_pipeline_equals_query_path(spark, scratch_dir):
    from finsight import testing
    from finsight.plans.queries import QUERIES, published
    m = Models(spark, SF_SMOKE)
    rel, log = pipeline.run_pipeline(spark, m.raw, Params(), scratch_dir, run_tests=False, materialize_all=True)
    assert all(s.detail == "table" for s in log if s.step == "run")
    for key in ["fct_churn_predictions", "fct_kpis_portefeuille", "fct_sinistralite", "fct_anomalies_summary"]:
        a = testing.fingerprint(*testing.spark_rows(published(rel[key])))
        b = testing.fingerprint(*testing.spark_rows(QUERIES[key](spark, SF_SMOKE)))
        assert a == b, key


def test_tag_selection_builds_upstream_views(spark, scratch_dir):
    m = Models(spark, SF_SMOKE)
    rel, log = pipeline.run_pipeline(spark, m.raw, Params(), scratch_dir, tags={"churn"}, run_tests=False)
    runs = [(s.name, s.detail) for s in log if s.step == "run"]
    assert ("fct_churn_predictions", "table") in runs and ("dim_client_segments", "table") in runs
    assert ("int_client_activity", "upstream view") in runs
    assert "fct_kpis_portefeuille" not in rel


def test_layer_by_layer_runs_reuse_stored_tables(spark, scratch_dir):
    m = Models(spark, SF_SMOKE)
    _, log1 = pipeline.run_pipeline(spark, m.raw, Params(), scratch_dir, layers=["staging"], run_tests=False,
                                    materialize_all=True, raw_id="load 1")
    assert all(s.detail == "table" for s in log1)
    rel, log2 = pipeline.run_pipeline(spark, m.raw, Params(), scratch_dir, layers=["intermediate"], run_tests=False,
                                      raw_id="load 1")
    reads = {s.name for s in log2 if s.step == "read"}
    assert {"stg_clients", "stg_transactions", "stg_contrats", "stg_sinistres", "stg_primes"} == reads
    assert rel["int_client_activity"].count() == m.client_activity().count()


def test_stored_tables_of_another_date_are_not_reused(spark, scratch_dir):
    import datetime as dt

    from finsight import testing
    early, late = Params(), Params(as_of=dt.date(2024, 8, 15))
    m = Models(spark, SF_SMOKE, late)
    pipeline.run_pipeline(spark, Models(spark, SF_SMOKE).raw, early, scratch_dir, layers=["staging", "intermediate"],
                          run_tests=False, materialize_all=True, raw_id="load 1")
    rel, log = pipeline.run_pipeline(spark, m.raw, late, scratch_dir, layers=["marts"], tags={"churn"}, run_tests=False,
                                     raw_id="load 1")
    assert not [s for s in log if s.step == "read"]
    fresh = testing.fingerprint(*testing.spark_rows(m.churn()))
    assert testing.fingerprint(*testing.spark_rows(rel["fct_churn_predictions"])) == fresh


def test_stored_tables_of_other_raw_rows_are_not_reused(spark, scratch_dir):
    from conftest import SF_SMALL
    old, new = Models(spark, SF_SMOKE), Models(spark, SF_SMALL)
    pipeline.run_pipeline(spark, old.raw, Params(), scratch_dir, layers=["staging"], run_tests=False, materialize_all=True,
                          raw_id="load 1")
    for raw_id in ("load 2", None):  # reloaded; not named
        rel, log = pipeline.run_pipeline(spark, new.raw, Params(), scratch_dir, layers=["intermediate"], tags={"client"},
                                         run_tests=False, raw_id=raw_id)
        assert not [s for s in log if s.step == "read"]
        assert rel["int_client_activity"].count() == new.stg("clients").count()


def test_quarantine_lets_the_run_reach_the_marts(spark, scratch_dir):
    m = Models(spark, SF_SMOKE)
    rel, log = pipeline.run_pipeline(spark, m.raw, Params(), scratch_dir, quarantine=True)
    tests = [s for s in log if s.step == "test"]
    assert len(tests) == 62 and all(s.status == "pass" for s in tests)
    assert sum(1 for s in log if s.step == "run") == len(pipeline.REGISTRY) == 15
    counts = {s.name: int(s.detail) for s in log if s.step == "quarantine"}
    nulls = m.raw["clients"].where("email IS NULL").count()
    assert counts["clients.not_null|email"] == nulls > 0
    assert counts["clients"] == m.raw["clients"].count() - nulls == rel["stg_clients"].count()
    bad = m.raw["clients"].where("email IS NULL").select("client_id")
    assert counts["contrats.orphan|client_id"] == m.raw["contrats"].join(bad, "client_id", "left_semi").count()
    from finsight.sources import loader
    kept = loader.read_rejects(spark, f"{scratch_dir}/quarantine", "clients")
    assert kept.count() == nulls and kept.first()["_reasons"] == ["not_null|email"]
