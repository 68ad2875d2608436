"""Marts (I22-I38): anomaly facts and summary, churn predictions, client segments, contract
performance, loss ratios per product/segment, portfolio KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finsight.functions import surrogate_key
from finsight.operators import scoring
from finsight.params import Params


def _ts(df: DataFrame, p: Params, *names: str) -> DataFrame:
    if not p.audit_columns:
        return df
    for n in names:
        df = df.withColumn(n, F.current_timestamp())
    return df


# ---------------------------------------------------------------- anomalies
ANOMALY_COLUMNS = [
    "anomalie_key", "transaction_key", "transaction_id", "client_key", "client_id", "date_transaction",
    "timestamp_transaction", "montant_eur", "type_transaction_std", "canal_std", "pays_beneficiaire",
    "is_anomalie_montant", "is_anomalie_frequence", "is_anomalie_geographique", "is_anomalie_horaire",
    "is_anomalie_comportementale", "score_anomalie", "z_score_montant", "ratio_vs_moyenne_client",
    "nb_transactions_client_jour", "is_nocturne", "is_international", "type_anomalie_principal",
    "niveau_severite", "statut_investigation", "is_anomalie", "date_detection",
]


def classify_anomalies(features: DataFrame, p: Params) -> DataFrame:
    """All transactions with flags, score and classification (before the anomaly filter)."""
    scored = scoring.score_transactions(features, p)
    score = F.col("score_anomalie")
    out = scored.select(
        surrogate_key("transaction_key").alias("anomalie_key"),
        *ANOMALY_COLUMNS[1:16], "score_anomalie", "z_score_montant", "ratio_vs_moyenne_client",
        "nb_transactions_client_jour", "is_nocturne", "is_international",
        scoring.anomaly_type().alias("type_anomalie_principal"),
        scoring.severity(score).alias("niveau_severite"),
        F.lit("Nouveau").alias("statut_investigation"),
        (score >= 20).alias("is_anomalie"),
        F.lit(p.as_of).alias("date_detection"),
    )
    return out


def fct_anomalies_transactions(features: DataFrame, p: Params) -> DataFrame:
    out = classify_anomalies(features, p).filter(F.col("is_anomalie"))
    return _ts(out, p, "detected_at")


def fct_anomalies_summary(anomalies: DataFrame, p: Params) -> DataFrame:
    m = F.col("montant_eur")
    s = F.col("score_anomalie")
    out = (anomalies.groupBy(F.col("date_detection").alias("date"),
                             F.col("type_anomalie_principal").alias("type_anomalie"), "niveau_severite")
           .agg(F.count_distinct("anomalie_key").alias("nb_anomalies_detectees"),
                F.count_distinct("client_key").alias("nb_clients_concernes"),
                F.sum(m).alias("montant_total_suspect"),
                (F.sum(m).cast("double") / F.count(m).cast("double")).alias("montant_moyen_suspect"),
                F.avg(s).alias("score_moyen"),
                F.max(s).alias("score_max")))
    return _ts(out, p, "calculated_at")


# ---------------------------------------------------------------- churn
def fct_churn_predictions(activity: DataFrame, p: Params) -> DataFrame:
    factors = scoring.churn_factors()
    f = activity.select("*", *[c.alias(k) for k, c in factors.items()])
    total = sum((F.col(k) for k in scoring.ALL_FACTORS), F.lit(0))
    f = f.withColumn("score_churn", F.least(F.lit(100), total))
    s = F.col("score_churn")
    out = f.select(
        surrogate_key("client_key").alias("prediction_key"),
        "client_key", "client_id", "segment_client", "age", "anciennete_client_mois",
        "nb_transactions_30j", "nb_transactions_90j", "days_since_last_transaction",
        "nb_contrats_actifs", "nb_contrats_resilies", "prime_mensuelle_totale", "nb_sinistres_rejetes",
        "statut_engagement", "ltv_estimee_3ans",
        *scoring.ALL_FACTORS, "score_churn",
        scoring.churn_probability_30d(s).alias("probabilite_churn_30j"),
        scoring.churn_probability_90d(s).alias("probabilite_churn_90j"),
        scoring.risk_segment(s).alias("segment_risque"),
        scoring.main_factor().alias("facteur_principal"),
        scoring.recommended_action(s, F.col("nb_contrats_actifs")).alias("action_recommandee"),
        scoring.contact_priority(s, F.col("prime_mensuelle_totale")).alias("priorite_contact"),
        F.lit(p.as_of).alias("date_prediction"),
    )
    return _ts(out, p, "predicted_at")


def dim_client_segments(churn: DataFrame, p: Params) -> DataFrame:
    out = churn.select(
        surrogate_key("client_key").alias("segment_key"),
        "client_key", "client_id",
        scoring.value_segment(F.col("prime_mensuelle_totale")).alias("segment_valeur"),
        F.col("statut_engagement").alias("segment_comportement"),
        F.col("segment_risque").alias("segment_risque_churn"),
        F.col("ltv_estimee_3ans").alias("ltv_estimee"),
        F.lit(p.as_of).alias("date_segmentation"),
    )
    return _ts(out, p, "updated_at")


# ---------------------------------------------------------------- portfolio
def fct_performance_contrats(perf: DataFrame, p: Params) -> DataFrame:
    out = perf.select(
        surrogate_key(F.col("contrat_key"), F.lit(p.as_of)).alias("performance_key"),
        "contrat_key", "contrat_id", "client_key", "client_id", "type_produit_std", "categorie_produit",
        "anciennete_mois", "prime_mensuelle",
        F.col("primes_collectees").alias("prime_totale_periode"),
        F.col("primes_collectees").alias("prime_cumulee_ytd"),
        F.col("taux_paiement").alias("taux_paiement_a_temps"),
        "nb_impayes", "nb_sinistres",
        F.col("montant_total_indemnise").alias("montant_sinistres_indemnises"),
        F.col("ratio_sp_pct").alias("ratio_sinistres_primes"),
        F.col("ratio_sp_pct").alias("ratio_combined"),
        "marge_technique", "statut_rentabilite", "is_actif",
        F.col("anciennete_mois").alias("anciennete_contrat_mois"),
        F.col("ltv_restante").alias("ltv_a_date"),
        F.col("ltv_restante").alias("ltv_projetee"),
        F.trunc(F.lit(p.as_of), "MM").alias("periode_mois"),
    )
    return _ts(out, p, "calculated_at")


def client_segments(stg_cl: DataFrame) -> DataFrame:
    """(client_id, segment_client, copies): staged client rows per id and segment (copies is 1 when
    the id is unique). A partial aggregate, so a heavily duplicated id is combined map-side."""
    return stg_cl.groupBy("client_id", "segment_client").agg(F.count(F.lit(1)).alias("copies"))


def fct_sinistralite(stg_ct: DataFrame, stg_cl: DataFrame, stg_si: DataFrame, stg_pr: DataFrame,
                     p: Params) -> DataFrame:
    s_by = stg_si.groupBy("contrat_id").agg(
        F.count_distinct("sinistre_id").alias("nb"),
        F.sum("montant_declare").alias("decl"),
        F.sum("montant_indemnise").alias("ind"))
    p_by = stg_pr.groupBy("contrat_id").agg(
        F.sum(F.when(F.col("is_paye"), F.col("montant_prime")).otherwise(F.lit(0))).alias("paid"))
    # client rows collapsed to (client, segment, copies): the join cannot fan out on a client id
    # that occurs many times, and each contract row is weighted by the copies it would meet
    seg = client_segments(stg_cl)
    base = (stg_ct.select("contrat_id", "client_id", "is_actif", F.col("type_produit_std").alias("type_produit"))
            .join(seg, "client_id", "left")
            .withColumn("segment_client", F.coalesce(F.col("segment_client"), F.lit("Unknown")))
            .join(s_by, "contrat_id", "left").join(p_by, "contrat_id", "left"))
    n = F.coalesce(F.col("copies"), F.lit(1))
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    g = base.groupBy("type_produit", "segment_client").agg(
        F.count_distinct(F.when(F.col("is_actif"), F.col("contrat_id"))).alias("nb_contrats_actifs"),
        F.sum(n * z("nb")).alias("nb_sinistres"),
        F.sum(n * z("paid")).alias("total_primes_collectees"),
        F.sum(n * z("decl")).alias("total_sinistres_declares"),
        F.sum(n * z("ind")).alias("total_sinistres_indemnises"))
    nb, paid, ind = F.col("nb_sinistres"), F.col("total_primes_collectees"), F.col("total_sinistres_indemnises")
    sp = ind.cast("double") / F.nullif(paid, F.lit(0)).cast("double") * 100
    periode = F.trunc(F.lit(p.as_of), "MM")
    out = g.select(
        surrogate_key(periode, F.col("type_produit"), F.col("segment_client")).alias("sinistralite_key"),
        periode.alias("periode_mois"), "type_produit", "segment_client", "nb_contrats_actifs", "nb_sinistres",
        (nb.cast("double") / F.nullif(F.col("nb_contrats_actifs"), F.lit(0)).cast("double")).alias("frequence_sinistres"),
        "total_primes_collectees", "total_sinistres_declares", "total_sinistres_indemnises",
        F.when(nb > 0, ind.cast("double") / nb.cast("double")).alias("cout_moyen_sinistre"),
        sp.alias("ratio_sp_periode"), sp.alias("ratio_sp_ytd"), sp.alias("ratio_sp_12m_glissant"),
        F.lit(None).cast("decimal(38,6)").alias("evolution_vs_mois_precedent"),
        F.lit(None).cast("decimal(38,6)").alias("evolution_vs_annee_precedente"),
    )
    return _ts(out, p, "calculated_at")


def contract_weights(stg_ct: DataFrame, stg_si: DataFrame, stg_pr: DataFrame) -> DataFrame:
    """Per contract: ns / np = claim / instalment rows (at least 1: a LEFT JOIN keeps one NULL row)
    and the sums that the claims x instalments product would produce."""
    s_by = stg_si.groupBy("contrat_id").agg(F.count(F.lit(1)).alias("ns"), F.sum("montant_indemnise").alias("ind"))
    p_by = stg_pr.groupBy("contrat_id").agg(
        F.count(F.lit(1)).alias("np"),
        F.sum(F.when(F.col("is_paye"), F.col("montant_prime")).otherwise(F.lit(0))).alias("paid"))
    ct = (stg_ct.select("client_id", "contrat_id", "is_actif", "is_resilie", "capital_assure")
          .join(s_by, "contrat_id", "left").join(p_by, "contrat_id", "left"))
    ns = F.coalesce(F.col("ns"), F.lit(1))
    np_ = F.coalesce(F.col("np"), F.lit(1))
    return ct.select(
        "client_id", "contrat_id", "is_actif", "is_resilie",
        (ns * np_).alias("w"),
        (ns * F.coalesce(F.col("paid"), F.lit(0))).alias("paid_w"),
        (np_ * F.col("ind")).alias("ind_w"),
        F.when(F.col("is_actif"), F.col("capital_assure") * ns * np_).otherwise(F.lit(0)).alias("enc_w"))


def client_rows(stg_cl: DataFrame) -> DataFrame:
    """One row per staged client id: ``n_c`` rows carry it (1 when the key is unique)."""
    return stg_cl.groupBy("client_id").agg(F.count(F.lit(1)).alias("n_c"),
                                           F.max("is_nouveau_client").alias("is_new"))


def per_client_fanout(stg_cl: DataFrame, weights: DataFrame, cl: DataFrame | None = None) -> DataFrame:
    """One row per staged client id with the totals of its rows in clients LEFT JOIN contracts LEFT
    JOIN claims LEFT JOIN instalments. Contracts are summed per client *before* the join, so a
    client with a huge number of contracts is pre-aggregated map-side instead of landing in one
    join task; ``n_c`` (rows per client id, 1 when the key is unique) keeps the product exact."""
    cl = client_rows(stg_cl) if cl is None else cl
    per = weights.groupBy("client_id").agg(
        F.sum("w").alias("W"), F.sum("paid_w").alias("PAID"), F.sum("ind_w").alias("IND"),
        F.sum("enc_w").alias("ENC"), F.max("is_actif").alias("any_active"))
    return cl.join(per, "client_id", "left")


def fct_kpis_portefeuille(stg_cl: DataFrame, stg_ct: DataFrame, stg_si: DataFrame, stg_pr: DataFrame,
                          churn: DataFrame, p: Params) -> DataFrame:
    """Global KPIs over clients LEFT JOIN contracts LEFT JOIN claims LEFT JOIN instalments LEFT JOIN
    churn, computed exactly without building that product: a contract with ns claim rows and np
    instalment rows stands for max(ns,1)*max(np,1) joined rows, so each sum is weighted by the
    count of the *other* side (premiums x claims, indemnities x instalments, capital x both).
    Every join is 1:1 on pre-aggregated keys; distinct counts come from the un-multiplied rows."""
    weights = contract_weights(stg_ct, stg_si, stg_pr)
    cl = client_rows(stg_cl)
    ch = churn.groupBy("client_id").agg(
        F.count(F.lit(1)).alias("n_ch"), F.sum("ltv_estimee_3ans").alias("ltv_sum"),
        F.count("ltv_estimee_3ans").alias("ltv_n"), F.max(F.col("score_churn") >= 70).alias("churn70"))
    j = per_client_fanout(stg_cl, weights, cl).join(ch, "client_id", "left")
    rows_c = F.col("n_c") * F.coalesce(F.col("W"), F.lit(1))   # fan-out rows of the client before churn
    mult = F.col("n_c") * F.greatest(F.coalesce(F.col("n_ch"), F.lit(0)), F.lit(1))
    per_client = j.select(
        F.lit(1).alias("c_one"),
        F.col("any_active").cast("int").alias("c_active"),
        F.col("is_new").cast("int").alias("c_new"),
        F.col("churn70").cast("int").alias("c_churn"),
        (mult * F.coalesce(F.col("PAID"), F.lit(0))).alias("paid"),
        (mult * F.col("IND")).alias("ind"),
        (mult * F.coalesce(F.col("ENC"), F.lit(0))).alias("enc"),
        (rows_c * F.col("ltv_sum")).alias("ltv_w"),
        (rows_c * F.col("ltv_n")).alias("w"))
    # contracts of staged clients only (LEFT JOIN from clients); a semi join splits a hot key
    per_contract = (weights.join(cl.select("client_id"), "client_id", "left_semi")
                    .groupBy("contrat_id").agg(F.max("is_actif").cast("int").alias("k_active"),
                                               F.max("is_resilie").cast("int").alias("k_resilie")))
    both = per_client.unionByName(per_contract.drop("contrat_id"), allowMissingColumns=True)
    g = both.agg(
        F.sum("c_one").cast("long").alias("nb_clients"),
        F.sum("c_active").cast("long").alias("nb_clients_with_active"),
        F.sum("c_new").cast("long").alias("nb_new"),
        F.sum("c_churn").cast("long").alias("nb_churn"),
        F.sum("k_active").cast("long").alias("nb_contrats_actifs"),
        F.sum("k_resilie").cast("long").alias("nb_contrats_resilies"),
        F.sum("paid").alias("paid"), F.sum("ind").alias("ind"), F.sum("enc").alias("enc"),
        F.sum("ltv_w").alias("ltv_w"), F.sum("w").alias("w"))
    nb = F.coalesce(F.col("nb_clients"), F.lit(0))
    ltv_mean = F.col("ltv_w").cast("double") / F.nullif(F.col("w"), F.lit(0)).cast("double")

    def pct(x: str):
        return F.coalesce(F.col(x), F.lit(0)).cast("double") / F.nullif(nb, F.lit(0)).cast("double") * 100

    out = g.select(
        surrogate_key(F.lit(p.as_of).cast("string")).alias("kpi_key"),
        F.lit(p.as_of).alias("date"),
        nb.alias("nb_clients_actifs"),
        F.coalesce(F.col("nb_contrats_actifs"), F.lit(0)).alias("nb_contrats_actifs"),
        F.coalesce(F.col("nb_new"), F.lit(0)).alias("nb_nouveaux_clients"),
        F.coalesce(F.col("nb_contrats_resilies"), F.lit(0)).alias("nb_contrats_resilies"),
        F.col("paid").alias("total_primes_collectees"),
        F.col("ind").alias("total_sinistres_payes"),
        F.col("enc").alias("encours_total"),
        (F.col("ind").cast("double") / F.nullif(F.col("paid"), F.lit(0)).cast("double") * 100).alias("ratio_sp_global"),
        (F.col("paid") - F.col("ind")).alias("marge_nette"),
        ltv_mean.alias("ltv_moyenne_client"),
        F.lit(100).alias("acquisition_cost_moyen"),
        ltv_mean.alias("customer_lifetime_value"),
        F.lit(75).alias("nps_score"),
        pct("nb_clients_with_active").alias("taux_retention"),
        pct("nb_churn").alias("taux_churn"),
    )
    return _ts(out, p, "calculated_at")
