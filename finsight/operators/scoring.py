"""Rule-based scores (I18-I33): anomaly flags/score/classification and churn factors/score.

Pure Column expressions over the feature tables; thresholds come from ``Params``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finsight.params import Params


def _flag(cond: Column) -> Column:
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


# ---------------------------------------------------------------- anomalies
def anomaly_flags(p: Params) -> dict[str, Column]:
    z = F.abs(F.col("z_score_montant"))
    delay = F.col("delai_depuis_derniere_sec")
    return {
        "is_anomalie_montant": _flag(z > p.z_threshold),
        "is_anomalie_frequence": _flag(F.col("nb_transactions_client_jour") > p.freq_threshold),
        "is_anomalie_geographique": _flag(F.col("is_international") & F.col("is_pays_inhabituel")),
        "is_anomalie_horaire": _flag(F.col("is_nocturne") & (F.col("montant_eur") > 1000)),
        "is_anomalie_comportementale": _flag(delay.isNotNull() & (delay < 60) & (F.col("montant_eur") > 500)),
    }


def anomaly_score() -> Column:
    z = F.abs(F.col("z_score_montant"))
    n = F.col("nb_transactions_client_jour")
    delay = F.col("delai_depuis_derniere_sec")
    s_z = F.when(z > 5, 40.0).when(z > 4, 30.0).when(z > 3, 20.0).otherwise(z * 5)
    s_f = F.when(n > 10, 20).when(n > 7, 15).when(n > 5, 10).otherwise(0)
    s_g = (F.when(F.col("is_international") & F.col("is_pays_inhabituel"), 20)
           .when(F.col("is_international"), 10).otherwise(0))
    s_h = F.when(F.col("is_nocturne"), 10).when(F.col("is_weekend"), 5).otherwise(0)
    s_b = (F.when(delay.isNotNull() & (delay < 60), 10)
           .when(delay.isNotNull() & (delay < 300), 5).otherwise(0))
    return F.least(F.lit(100.0), s_z + s_f + s_g + s_h + s_b)


def anomaly_type() -> Column:
    return (F.when(F.col("is_anomalie_montant"), "Montant").when(F.col("is_anomalie_frequence"), "Frequence")
            .when(F.col("is_anomalie_geographique"), "Geographique").when(F.col("is_anomalie_horaire"), "Horaire")
            .when(F.col("is_anomalie_comportementale"), "Comportement").otherwise("Normal"))


def severity(score: Column) -> Column:
    return (F.when(score >= 80, "Critique").when(score >= 60, "Eleve").when(score >= 40, "Moyen")
            .when(score >= 20, "Faible").otherwise("Normal"))


def score_transactions(features: DataFrame, p: Params) -> DataFrame:
    flags = anomaly_flags(p)
    return features.select("*", *[c.alias(k) for k, c in flags.items()],
                           anomaly_score().alias("score_anomalie"))


# ---------------------------------------------------------------- churn
def churn_factors() -> dict[str, Column]:
    n30, n90 = F.col("nb_transactions_30j"), F.col("nb_transactions_90j")
    days = F.col("days_since_last_transaction")
    act, res = F.col("nb_contrats_actifs"), F.col("nb_contrats_resilies")
    rej, s12 = F.col("nb_sinistres_rejetes"), F.col("nb_sinistres_12m")
    prime = F.col("prime_mensuelle_totale")
    return {
        "score_baisse_activite": F.when(n90 == 0, 30).when((n30 == 0) & (n90 > 0), 20)
        .when(n30 < n90 * 0.5, 15).otherwise(0),
        "score_inactivite": F.when(days > 180, 20).when(days > 90, 15).when(days > 60, 10)
        .when(days > 30, 5).otherwise(0),
        "score_resiliation": F.when((act == 0) & (res > 0), 20).when(res >= 2, 15).when(res == 1, 10).otherwise(0),
        "score_insatisfaction_sinistres": F.when(rej >= 2, 15).when(rej == 1, 10).when(s12 > 3, 5).otherwise(0),
        "score_faible_valeur": F.when(prime == 0, 15).when(prime < 50, 10).when(prime < 100, 5).otherwise(0),
    }


FACTOR_ORDER = [("score_inactivite", "Inactivite"), ("score_baisse_activite", "Baisse_Activite"),
                ("score_resiliation", "Resiliation"), ("score_insatisfaction_sinistres", "Insatisfaction")]
ALL_FACTORS = ["score_baisse_activite", "score_inactivite", "score_resiliation",
               "score_insatisfaction_sinistres", "score_faible_valeur"]


def main_factor() -> Column:
    """First factor (in the fixed priority order) that is >= all the others."""
    expr = F.lit("Faible_Valeur")
    for col, label in reversed(FACTOR_ORDER):
        others = [F.col(c) for c in ALL_FACTORS if c != col]
        expr = F.when(F.col(col) >= F.greatest(*others), label).otherwise(expr)
    return expr


def _d(x: str) -> Column:
    return F.lit(Decimal(x))


def churn_probability_30d(s: Column) -> Column:
    return (F.when(s >= 80, _d("0.90")).when(s >= 60, _d("0.70")).when(s >= 40, _d("0.50"))
            .when(s >= 20, _d("0.30")).otherwise(_d("0.10")))


def churn_probability_90d(s: Column) -> Column:
    return (F.when(s >= 70, _d("0.95")).when(s >= 50, _d("0.75")).when(s >= 30, _d("0.55"))
            .when(s >= 15, _d("0.35")).otherwise(_d("0.15")))


def risk_segment(s: Column) -> Column:
    return F.when(s >= 70, "Critique").when(s >= 50, "Eleve").when(s >= 30, "Moyen").otherwise("Faible")


def recommended_action(s: Column, active: Column) -> Column:
    return (F.when((s >= 70) & (active > 0), "Contact_Urgent_Retention")
            .when((s >= 70) & (active == 0), "Tentative_Reactivation")
            .when(s >= 50, "Offre_Personnalisee").when(s >= 30, "Campagne_Engagement").otherwise("Suivi_Normal"))


def contact_priority(s: Column, prime: Column) -> Column:
    return (F.when((s >= 80) & (prime > 200), 1).when(s >= 70, 2).when(s >= 50, 3)
            .when(s >= 30, 4).otherwise(5))


def value_segment(prime: Column) -> Column:
    return (F.when(prime >= 300, "Platinum").when(prime >= 150, "Gold").when(prime >= 75, "Silver")
            .otherwise("Bronze"))
