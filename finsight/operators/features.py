"""Intermediate feature models (I1-I17): per-transaction, per-client and per-contract features.

Values are computed unrounded (scores and thresholds downstream use them); the query layer
publishes doubles rounded with ``finsight.functions.pub``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finsight.functions import age_month_part, surrogate_key
from finsight.operators import aggregates as agg
from finsight.operators.windows import client_windows
from finsight.params import Params


def _audit(df: DataFrame, p: Params) -> DataFrame:
    return df.withColumn("calculated_at", F.current_timestamp()) if p.audit_columns else df


# ---------------------------------------------------------------- I14 transaction features
TX_COLUMNS = ["transaction_key", "transaction_id", "client_key", "client_id", "date_transaction",
              "heure_transaction", "timestamp_transaction", "montant_eur", "type_transaction_std",
              "canal_std", "categorie_std", "pays_beneficiaire", "is_international", "is_nocturne",
              "is_weekend", "plage_horaire"]


def transaction_features(stg_tx: DataFrame, p: Params) -> DataFrame:
    base = stg_tx.select("transaction_id", "client_id", "date_transaction", "heure_transaction",
                         "timestamp_transaction", "montant_eur", "type_transaction_std", "canal_std",
                         "categorie_std", "pays_beneficiaire", "is_international", "is_nocturne",
                         "is_weekend", "plage_horaire")
    cs = agg.client_stats_30d(stg_tx, p)
    # the per-client stats are joined inside each window branch (see client_windows)
    j = client_windows(base, p, per_branch=lambda w: w.join(cs, "client_id", "left"))
    m = F.col("montant_eur").cast("double")
    avg, std = F.col("avg_montant_30j"), F.col("std_montant_30j")
    out = j.select(
        surrogate_key("transaction_id").alias("transaction_key"),
        "transaction_id",
        surrogate_key("client_id").alias("client_key"),
        *[c for c in TX_COLUMNS[3:]],
        "avg_montant_30j", "std_montant_30j", "avg_trans_par_jour", "max_montant_historique",
        "taux_trans_internationales",
        F.when(std > 0, (m - avg) / std).otherwise(F.lit(0.0)).alias("z_score_montant"),
        F.when(avg > 0, m / avg).otherwise(F.lit(1.0)).alias("ratio_vs_moyenne_client"),
        "nb_transactions_client_jour",
        "delai_depuis_derniere_sec",
        # a NULL country never equals a (client, country) group in the source join -> unusual
        (F.col("pays_beneficiaire").isNull() | (F.col("nb_trans_pays") == 1)).alias("is_pays_inhabituel"),
        "percentile_montant_client",
    )
    return _audit(out, p)


# ---------------------------------------------------------------- I1 client activity
def client_activity(stg_cl: DataFrame, stg_tx: DataFrame, stg_ct: DataFrame, stg_si: DataFrame,
                    p: Params) -> DataFrame:
    t = agg.trans_activity(stg_tx, p)
    cp = agg.contrats_portfolio(stg_ct, p)
    s = agg.sinistres_history(stg_si, p)
    # keys are derived from the ids after the joins: md5 runs once per output row, after the
    # shuffle, and the shuffled rows stay narrow
    c = stg_cl.select("client_id", "segment_client", "age", "anciennete_mois")
    j = c.join(t, "client_id", "left").join(cp, "client_id", "left").join(s, "client_id", "left")

    def z(col: str):
        return F.coalesce(F.col(col), F.lit(0))

    prime = z("prime_mensuelle_totale")
    ind = z("montant_total_indemnise")
    n30, n90, nact = z("nb_transactions_30j"), z("nb_transactions_90j"), z("nb_contrats_actifs")
    web, mob, agc = F.col("nb_trans_web"), F.col("nb_trans_mobile"), F.col("nb_trans_agence")
    out = j.select(
        surrogate_key("client_id").alias("client_key"), "client_id", "segment_client", "age",
        F.col("anciennete_mois").alias("anciennete_client_mois"),
        z("nb_transactions_total").alias("nb_transactions_total"),
        z("montant_total_transactions").alias("montant_total_transactions"),
        F.coalesce(F.col("montant_moyen_transaction"), F.lit(0.0)).alias("montant_moyen_transaction"),
        n30.alias("nb_transactions_30j"),
        z("montant_transactions_30j").alias("montant_transactions_30j"),
        n90.alias("nb_transactions_90j"),
        z("montant_transactions_90j").alias("montant_transactions_90j"),
        F.datediff(F.lit(p.as_of), F.col("date_derniere_transaction")).alias("days_since_last_transaction"),
        z("nb_contrats_total").alias("nb_contrats_total"),
        nact.alias("nb_contrats_actifs"),
        z("nb_contrats_resilies").alias("nb_contrats_resilies"),
        prime.alias("prime_mensuelle_totale"),
        z("capital_total_assure").alias("capital_total_assure"),
        z("nb_contrats_auto").alias("nb_contrats_auto"),
        z("nb_contrats_habitation").alias("nb_contrats_habitation"),
        z("nb_contrats_sante").alias("nb_contrats_sante"),
        z("nb_contrats_vie").alias("nb_contrats_vie"),
        z("nb_sinistres_total").alias("nb_sinistres_total"),
        z("nb_sinistres_12m").alias("nb_sinistres_12m"),
        ind.alias("montant_total_indemnise"),
        z("nb_sinistres_rejetes").alias("nb_sinistres_rejetes"),
        F.when(prime > 0, ind.cast("double") / (prime.cast("double") * 12)).otherwise(F.lit(0.0))
        .alias("ratio_sinistres_primes_client"),
        F.when((n30 > 0) & (nact > 0), "Actif").when((n90 > 0) | (nact > 0), "Modere").otherwise("Dormant")
        .alias("statut_engagement"),
        (prime * 12 * 3 - ind).alias("ltv_estimee_3ans"),
        F.when((mob >= web) & (mob >= agc), "Mobile").when((web >= mob) & (web >= agc), "Web")
        .when((agc >= mob) & (agc >= web), "Agence").otherwise("Mixte").alias("canal_prefere"),
    )
    return _audit(out, p)


# ---------------------------------------------------------------- I6 contract performance
def contrat_performance(stg_ct: DataFrame, stg_si: DataFrame, stg_pr: DataFrame, p: Params) -> DataFrame:
    s = agg.sinistres_agg(stg_si, p)
    pr = agg.primes_agg(stg_pr, p)
    c = stg_ct.select("contrat_id", "client_id", "type_produit_std",
                      "categorie_produit", "date_souscription", "date_effet", "date_echeance",
                      "anciennete_mois", "prime_mensuelle", "capital_assure", "is_actif")
    j = c.join(s, "contrat_id", "left").join(pr, "contrat_id", "left")
    paid = F.coalesce(F.col("montant_primes_payees"), F.lit(0))
    ind = F.coalesce(F.col("montant_total_indemnise"), F.lit(0))
    n = F.coalesce(F.col("nb_sinistres"), F.lit(0))
    freq_a = F.coalesce(F.col("frequence_sinistres_annuelle"), F.lit(0.0))
    prime = F.col("prime_mensuelle")
    ratio = F.when(paid > 0, ind.cast("double") / paid.cast("double") * 100).otherwise(F.lit(0.0))
    unpaid = F.coalesce(F.col("nb_impayes"), F.lit(0))
    on_time = F.coalesce(F.col("taux_paiement_a_temps"), F.lit(1.0))
    remaining_months = F.greatest(F.lit(0), age_month_part(F.col("date_echeance"), F.lit(p.as_of), with_time=False))
    marge = paid - ind

    # loss-ratio bands decided on exact decimals: ind*100 < t*paid  <=>  ind/paid*100 < t
    def below(t: int):
        return F.when(paid > 0, ind * 100 < paid * t).otherwise(F.lit(0 < t))

    out = j.select(
        surrogate_key("contrat_id").alias("contrat_key"), "contrat_id",
        surrogate_key("client_id").alias("client_key"), "client_id", "type_produit_std", "categorie_produit",
        "date_souscription", "date_effet", "date_echeance", "anciennete_mois", "prime_mensuelle",
        "capital_assure", "is_actif",
        F.coalesce(F.col("montant_total_primes"), F.lit(0)).alias("primes_collectees"),
        paid.alias("primes_payees"),
        unpaid.alias("nb_impayes"),
        F.coalesce(F.col("taux_paiement"), F.lit(1.0)).alias("taux_paiement"),
        n.alias("nb_sinistres"),
        ind.alias("montant_total_indemnise"),
        freq_a.alias("frequence_sinistres"),
        F.coalesce(F.col("delai_moyen_traitement"), F.lit(0.0)).alias("delai_moyen_traitement"),
        ratio.alias("ratio_sp_pct"),
        (n.cast("double") / F.nullif(F.col("anciennete_mois").cast("double") / 12.0, F.lit(0.0)))
        .alias("frequence_par_annee"),
        F.when(n > 0, ind.cast("double") / n.cast("double")).otherwise(F.lit(0.0)).alias("cout_moyen_sinistre"),
        marge.alias("marge_technique"),
        (prime.cast("double") * remaining_months.cast("double")
         - F.coalesce(F.col("montant_moyen_indemnise"), F.lit(0.0)) * freq_a).alias("ltv_restante"),
        F.when(marge > prime * 12, "Tres_Profitable").when(paid > ind, "Profitable")
        .when(paid == ind, "Equilibre").otherwise("Deficitaire").alias("statut_rentabilite"),
        F.when((unpaid == 0) & (on_time > 0.9), "Excellent").when(unpaid <= 1, "Bon")
        .when(unpaid <= 3, "Moyen").otherwise("Mauvais").alias("qualite_paiement"),
        F.when(n == 0, "Sans_Sinistre").when(below(50), "Faible").when(below(75), "Normale")
        .when(below(100), "Elevee").otherwise("Critique").alias("niveau_sinistralite"),
    )
    return _audit(out, p)
