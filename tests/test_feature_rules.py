"""Edge rows of the feature models (FIXTURES §3): remaining-life factor, preferred channel,
degenerate z-scores, LAG borders, unusual country; one violating and one NULL row per check."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from finsight import schemas
from finsight.operators import features, quality, staging
from finsight.params import Params

P = Params()  # as_of 2024-02-15
TS = dt.datetime(2024, 1, 1)


def _contracts(spark, echeances):
    rows = [(f"K{i}", "C1", "P", "Auto", dt.date(2023, 1, 1), dt.date(2023, 1, 1), e, D("10.00"), D("0"), D("0"),
             "Actif", "Carte", TS) for i, e in enumerate(echeances)]
    return staging.stg_contrats(spark.createDataFrame(rows, schemas.CONTRATS), P)


def test_remaining_life_uses_month_component_only(spark):
    ct = _contracts(spark, [dt.date(2026, 3, 20), dt.date(2024, 1, 1), None, dt.date(2024, 6, 15)])
    empty_si = staging.stg_sinistres(spark.createDataFrame([], schemas.SINISTRES), P)
    empty_pr = staging.stg_primes(spark.createDataFrame([], schemas.PRIMES), P)
    out = {r.contrat_id: r for r in features.contrat_performance(ct, empty_si, empty_pr, P).collect()}
    assert out["K0"].ltv_restante == 10.0    # 25 months ahead -> month component 1
    assert out["K1"].ltv_restante == 0.0     # expired -> negative month part -> 0
    assert out["K2"].ltv_restante == 0.0     # NULL expiry -> GREATEST ignores NULL -> 0
    assert out["K3"].ltv_restante == 40.0    # 4 months ahead
    assert out["K0"].taux_paiement == 1.0 and out["K0"].qualite_paiement == "Excellent"
    assert out["K0"].niveau_sinistralite == "Sans_Sinistre" and out["K0"].statut_rentabilite == "Equilibre"


def _tx_rows(spec):
    rows = []
    for i, (client, day, hour, amount, canal, pays) in enumerate(spec):
        rows.append((f"T{i:03d}", client, day, hour, D(amount), "EUR", "Carte", canal, "x", pays, "ok", TS))
    return rows


def _clients(spark, ids):
    rows = [(c, TS, "n", "p", "e", "t", dt.date(1990, 1, 1), "a", "1", "v", "France", "Jeune", 700, TS) for c in ids]
    return staging.stg_clients(spark.createDataFrame(rows, schemas.CLIENTS), P)


def test_preferred_channel_ties_and_no_transactions(spark):
    d = dt.date(2024, 2, 10)
    spec = [("C1", d, "10:00:00", "1", "Web", "France"), ("C1", d, "11:00:00", "1", "Mobile", "France"),
            ("C1", d, "12:00:00", "1", "Agence", "France"),
            ("C2", d, "10:00:00", "1", "Web", "France"), ("C2", d, "11:00:00", "1", "Web", "France"),
            ("C2", d, "12:00:00", "1", "Agence", "France")]
    tx = staging.stg_transactions(spark.createDataFrame(_tx_rows(spec), schemas.TRANSACTIONS), P)
    empty_ct = staging.stg_contrats(spark.createDataFrame([], schemas.CONTRATS), P)
    empty_si = staging.stg_sinistres(spark.createDataFrame([], schemas.SINISTRES), P)
    act = {r.client_id: r for r in features.client_activity(_clients(spark, ["C1", "C2", "C3"]), tx, empty_ct,
                                                             empty_si, P).collect()}
    assert act["C1"].canal_prefere == "Mobile"   # all equal -> Mobile first
    assert act["C2"].canal_prefere == "Web"
    assert act["C3"].canal_prefere == "Mixte" and act["C3"].days_since_last_transaction is None
    assert act["C3"].statut_engagement == "Dormant" and act["C1"].statut_engagement == "Modere"


def test_degenerate_zscores_lag_borders_and_unusual_country(spark):
    d = dt.date(2024, 2, 10)
    old = dt.date(2023, 1, 1)  # outside the 30-day window
    spec = [
        ("A", d, "10:00:00", "100", "Web", "Italie"),          # single row in window: std NULL -> z 0
        ("B", d, "10:00:00", "50", "Web", "France"),            # constant amounts: std 0 -> z 0
        ("B", d, "10:00:59", "50", "Web", "France"),            # +59 s
        ("B", d, "10:01:59", "50", "Web", "France"),            # +60 s
        ("B", d, "10:06:58", "50", "Web", "France"),            # +299 s
        ("B", d, "10:11:58", "50", "Web", None),                # +300 s, NULL country -> unusual
        ("B", d, "10:11:58", "50", "Web", "France"),            # equal timestamps -> 0 s
        ("C", old, "10:00:00", "70", "Web", "Espagne"),          # no row in window: ratio 1
        ("C", old, "11:00:00", "70", "Web", "Espagne"),          # country twice -> not unusual
    ]
    tx = staging.stg_transactions(spark.createDataFrame(_tx_rows(spec), schemas.TRANSACTIONS), P)
    out = {r.transaction_id: r for r in features.transaction_features(tx, P).collect()}
    assert out["T000"].z_score_montant == 0.0 and out["T000"].std_montant_30j is None
    assert out["T000"].is_pays_inhabituel is True            # country seen once
    assert all(out[f"T00{i}"].z_score_montant == 0.0 for i in range(1, 7))
    assert out["T001"].delai_depuis_derniere_sec is None
    assert [out[f"T00{i}"].delai_depuis_derniere_sec for i in range(2, 7)] == [59.0, 60.0, 299.0, 300.0, 0.0]
    assert out["T005"].is_pays_inhabituel is True and out["T002"].is_pays_inhabituel is False
    assert out["T007"].ratio_vs_moyenne_client == 1.0 and out["T007"].is_pays_inhabituel is False
    assert out["T002"].nb_transactions_client_jour == 6


def test_each_check_kind_flags_violations_not_nulls(spark):
    df = spark.createDataFrame([("a", 5, "x"), ("a", 200, "y"), (None, None, None), ("b", 50, "x")],
                               "k string, n int, v string")
    parent = spark.createDataFrame([("a",)], "k string")
    t = {"m": df, "p": parent}
    count = lambda ch: quality.failing_rows(ch, t).count()
    assert count(quality.Check("unique", "m", "k")) == 1              # 'a' twice; NULL ignored
    assert count(quality.Check("not_null", "m", "k")) == 1
    assert count(quality.Check("accepted_values", "m", "v", values=("x",))) == 1   # 'y'; NULL passes
    assert count(quality.Check("relationships", "m", "k", to_model="p", to_column="k")) == 1  # 'b'
    assert count(quality.Check("accepted_range", "m", "n", min_value=16, max_value=120)) == 2  # 5, 200
    assert count(quality.Check("accepted_range", "m", "n", min_value=5, inclusive=False)) == 1  # 5


def test_quarantine_splits_row_local_violations(spark):
    rows = [("C1", TS, "n", "p", "e", "t", dt.date(1990, 1, 1), "a", "1", "v", "France", "Jeune", 700, TS),
            (None, TS, "n", "p", "e", "t", dt.date(1990, 1, 1), "a", "1", "v", "France", "Jeune", 700, TS),
            ("C3", TS, "n", "p", "e", "0" * 21, dt.date(1990, 1, 1), "a", "1", "v", "France", "Jeune", 700, TS)]
    ok, rejected = quality.quarantine(spark.createDataFrame(rows, schemas.CLIENTS), "clients")
    assert [r.client_id for r in ok.collect()] == ["C1"]
    assert sorted(str(r.client_id) for r in rejected.collect()) == ["C3", "None"]


def test_audit_columns_only_when_asked(spark):
    from finsight.plans import marts
    from finsight.plans.queries import Models
    from conftest import SF_SMOKE
    m = Models(spark, SF_SMOKE)
    audited = Params(audit_columns=True)
    stg = staging.stg_clients(m.raw["clients"], audited)
    assert "updated_at" in stg.columns and "updated_at" not in m.stg("clients").columns
    act = features.client_activity(stg, staging.stg_transactions(m.raw["transactions"], audited),
                                   staging.stg_contrats(m.raw["contrats"], audited),
                                   staging.stg_sinistres(m.raw["sinistres"], audited), audited)
    churn = marts.fct_churn_predictions(act, audited)
    assert "calculated_at" in act.columns and "predicted_at" in churn.columns
    assert churn.filter(F.col("predicted_at").isNull()).count() == 0


def test_trailing_window_has_lower_bound_only(spark):
    from finsight.operators import aggregates
    inside, future, old = dt.date(2024, 2, 1), dt.date(2024, 3, 1), dt.date(2023, 12, 1)
    spec = [("A", inside, "10:00:00", "10", "Web", "France"), ("A", future, "10:00:00", "30", "Web", "France"),
            ("A", old, "10:00:00", "1000", "Web", "France")]
    tx = staging.stg_transactions(spark.createDataFrame(_tx_rows(spec), schemas.TRANSACTIONS), P)
    r = aggregates.client_stats_30d(tx, P).first()
    assert r.avg_montant_30j == 20.0 and r.max_montant_historique == D("30.00")  # future row counted, old not
    t = aggregates.trans_activity(tx, P).first()
    assert t.nb_transactions_30j == 2 and t.nb_transactions_total == 3
