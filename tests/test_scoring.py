"""Score rules: anomaly score bands and classification, churn factors, tie orders."""

from pyspark.sql import functions as F

from finsight.operators import scoring
from finsight.params import Params

FEAT = ("z_score_montant double, nb_transactions_client_jour long, is_international boolean, "
        "is_pays_inhabituel boolean, is_nocturne boolean, is_weekend boolean, delai_depuis_derniere_sec double, "
        "montant_eur decimal(15,2)")


def _score(spark, rows):
    df = spark.createDataFrame(rows, FEAT)
    flags = scoring.anomaly_flags(Params())
    return df.select(scoring.anomaly_score().alias("s"), *[c.alias(k) for k, c in flags.items()]).collect()


def test_anomaly_score_bands(spark):
    from decimal import Decimal as D
    rows = [
        (3.998, 0, False, False, False, False, None, D("1")),   # z>3 -> 20
        (3.0, 0, False, False, False, False, None, D("1")),     # 3*5 = 15
        (5.01, 11, True, True, False, True, 10.0, D("600")),    # 40+20+20+5+10 = 95
        (-4.5, 8, True, False, False, False, 299.0, D("1")),    # 30+15+10+0+5 = 60
        (0.0, 6, False, False, False, False, 300.0, D("1")),    # 0+10 = 10
    ]
    got = _score(spark, rows)
    assert [round(r.s, 6) for r in got] == [20.0, 15.0, 95.0, 60.0, 10.0]
    assert got[2].is_anomalie_comportementale and got[2].is_anomalie_geographique and got[2].is_anomalie_montant
    assert not got[1].is_anomalie_montant and got[4].is_anomalie_frequence


def test_severity_borders(spark):
    scores = [19.99, 20.0, 40.0, 60.0, 80.0, 95.0]
    out = [r.v for r in spark.createDataFrame([(s,) for s in scores], "s double")
           .select(scoring.severity(F.col("s")).alias("v")).collect()]
    assert out == ["Normal", "Faible", "Moyen", "Eleve", "Critique", "Critique"]


CHURN = ("nb_transactions_30j long, nb_transactions_90j long, days_since_last_transaction int, "
         "nb_contrats_actifs long, nb_contrats_resilies long, nb_sinistres_rejetes long, nb_sinistres_12m long, "
         "prime_mensuelle_totale decimal(20,2)")


def _churn(spark, rows):
    df = spark.createDataFrame(rows, CHURN)
    f = scoring.churn_factors()
    df = df.select("*", *[c.alias(k) for k, c in f.items()])
    return df.select("*", scoring.main_factor().alias("main")).collect()


def test_churn_factors_and_tie_order(spark):
    from decimal import Decimal as D
    rows = [
        (0, 0, None, 0, 0, 0, 0, D("0")),        # 30 / 0 / 0 / 0 / 15 ; days NULL -> 0
        (0, 5, 181, 0, 1, 2, 0, D("49.99")),     # 20 / 20 / 20 / 15 / 10
        (4, 10, 31, 2, 2, 1, 4, D("100")),       # 15 / 5 / 15 / 10 / 0
        (5, 10, 0, 1, 0, 0, 4, D("99.99")),      # 0 / 0 / 0 / 5 / 5
        (1, 1, 0, 1, 0, 0, 0, D("200")),         # all zero -> Inactivite
    ]
    got = _churn(spark, rows)
    vals = [(r.score_baisse_activite, r.score_inactivite, r.score_resiliation, r.score_insatisfaction_sinistres,
             r.score_faible_valeur, r.main) for r in got]
    assert vals[0] == (30, 0, 0, 0, 15, "Baisse_Activite")
    assert vals[1] == (20, 20, 20, 15, 10, "Inactivite")
    assert vals[2] == (15, 5, 15, 10, 0, "Baisse_Activite")
    assert vals[3] == (0, 0, 0, 5, 5, "Insatisfaction")
    assert vals[4] == (0, 0, 0, 0, 0, "Inactivite")


def test_probabilities_priority_segments(spark):
    from decimal import Decimal as D
    df = spark.createDataFrame([(80, D("200.00")), (80, D("200.01")), (70, D("0")), (29, D("0"))],
                               "s int, prime decimal(20,2)")
    out = df.select(scoring.churn_probability_30d(F.col("s")).alias("p30"),
                    scoring.churn_probability_90d(F.col("s")).alias("p90"),
                    scoring.contact_priority(F.col("s"), F.col("prime")).alias("prio"),
                    scoring.risk_segment(F.col("s")).alias("seg"),
                    scoring.value_segment(F.col("prime")).alias("val")).collect()
    assert [r.prio for r in out] == [2, 1, 2, 5]
    assert [str(r.p30) for r in out] == ["0.90", "0.90", "0.70", "0.30"]
    assert [str(r.p90) for r in out] == ["0.95", "0.95", "0.95", "0.35"]
    assert [r.seg for r in out] == ["Critique", "Critique", "Critique", "Faible"]
    assert [r.val for r in out] == ["Gold", "Gold", "Bronze", "Bronze"]


def test_thresholds_are_parameters(spark):
    from decimal import Decimal as D
    df = spark.createDataFrame([(2.6, 5, False, False, False, False, None, D("1"))], FEAT)
    default = df.select(*[c.alias(k) for k, c in scoring.anomaly_flags(Params()).items()]).first()
    tuned = df.select(*[c.alias(k) for k, c in
                        scoring.anomaly_flags(Params(z_threshold=2.5, freq_threshold=4)).items()]).first()
    assert not default.is_anomalie_montant and not default.is_anomalie_frequence
    assert tuned.is_anomalie_montant and tuned.is_anomalie_frequence
