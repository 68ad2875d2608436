"""Grouped aggregates.

Plans:
* Several ``COUNT(DISTINCT CASE WHEN cond THEN id END)`` in one group-by would make Catalyst
  rewrite with an Expand (one copy of every row per distinct expression). Instead
  ``distinct_flag_agg`` aggregates in two exact steps: first per (group, id) with ``max(flag)``
  and partial sums, then per group with ``sum(max_flag)``. Both steps are hash aggregates with
  map-side partial aggregation, so a hot group is combined before its shuffle.
* Groups are formed on the natural id (``client_id``, ``contrat_id``); the surrogate key is a
  function of it and is computed once per output row instead of once per input row.
* Averages are ``exact decimal sum / count`` in DOUBLE; published values are rounded (``pub``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finsight.functions import pub, surrogate_key
from finsight.params import Params


def _i(cond: Column) -> Column:
    """1 when cond is true, else 0 (NULL -> 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def _ratio(num: Column, den: Column) -> Column:
    """num / NULLIF(den, 0) in DOUBLE."""
    return num.cast("double") / F.nullif(den, F.lit(0)).cast("double")


def distinct_flag_agg(df: DataFrame, group: str, id_col: str, flags: dict[str, Column],
                      step1: list[Column], step2: list[Column]) -> DataFrame:
    """COUNT(DISTINCT CASE WHEN flag THEN id END) for every ``flags`` entry, plus the extra
    per-(group,id) aggregates ``step1`` (aliased) folded by ``step2`` (aliased) per group.
    ``nb_ids`` (distinct non-NULL ids) is always produced."""
    firsts = [F.max(_i(c)).alias(f"__f_{k}") for k, c in flags.items()]
    per_id = df.groupBy(group, id_col).agg(*firsts, *step1)
    outs = [F.count(F.col(id_col)).alias("nb_ids")]
    outs += [F.sum(F.col(f"__f_{k}")).cast("long").alias(k) for k in flags]
    return per_id.groupBy(group).agg(*outs, *step2)


# ---------------------------------------------------------------- E1 per-client transactions
def trans_activity(stg_tx: DataFrame, p: Params) -> DataFrame:
    d30 = F.date_sub(F.lit(p.as_of), 30)
    d90 = F.date_sub(F.lit(p.as_of), 90)
    date = F.col("date_transaction")
    m = F.col("montant_eur")
    t = stg_tx.select("client_id", "transaction_id", "date_transaction", "montant_eur", "canal_std",
                      "is_nocturne", "is_international")
    flags = {
        "nb_transactions_30j": date >= d30,
        "nb_transactions_90j": date >= d90,
        "nb_trans_web": F.col("canal_std") == "Web",
        "nb_trans_mobile": F.col("canal_std") == "Mobile",
        "nb_trans_agence": F.col("canal_std") == "Agence",
        "nb_trans_nocturnes": F.col("is_nocturne"),
        "nb_trans_internationales": F.col("is_international"),
    }
    step1 = [F.sum(m).alias("s"), F.count(m).alias("n"), F.max(date).alias("dmax"), F.min(date).alias("dmin"),
             F.sum(F.when(date >= d30, m).otherwise(F.lit(0))).alias("s30"),
             F.sum(F.when(date >= d90, m).otherwise(F.lit(0))).alias("s90")]
    step2 = [F.sum("s").alias("montant_total_transactions"),
             (F.sum("s").cast("double") / F.sum("n").cast("double")).alias("montant_moyen_transaction"),
             F.max("dmax").alias("date_derniere_transaction"),
             F.min("dmin").alias("date_premiere_transaction"),
             F.sum("s30").alias("montant_transactions_30j"),
             F.sum("s90").alias("montant_transactions_90j")]
    agg = distinct_flag_agg(t, "client_id", "transaction_id", flags, step1, step2)
    return agg.select(
        "client_id",
        F.col("nb_ids").alias("nb_transactions_total"),
        "montant_total_transactions", "montant_moyen_transaction",
        "date_derniere_transaction", "date_premiere_transaction",
        "nb_transactions_30j", "montant_transactions_30j",
        "nb_transactions_90j", "montant_transactions_90j",
        "nb_trans_web", "nb_trans_mobile", "nb_trans_agence",
        "nb_trans_nocturnes", "nb_trans_internationales",
    )


# ---------------------------------------------------------------- E2 per-client contracts
def contrats_portfolio(stg_ct: DataFrame, p: Params) -> DataFrame:
    act = F.col("is_actif")
    typ = F.col("type_produit_std")
    t = stg_ct.select("client_id", "contrat_id", "is_actif", "is_resilie", "type_produit_std",
                      "prime_mensuelle", "capital_assure", "anciennete_mois", "date_souscription")
    flags = {
        "nb_contrats_actifs": act,
        "nb_contrats_resilies": F.col("is_resilie"),
        "nb_contrats_auto": (typ == "Auto") & act,
        "nb_contrats_habitation": (typ == "Habitation") & act,
        "nb_contrats_sante": (typ == "Santé") & act,
        "nb_contrats_vie": (typ == "Vie") & act,
    }
    anc = F.when(act, F.col("anciennete_mois"))
    step1 = [F.sum(F.when(act, F.col("prime_mensuelle")).otherwise(F.lit(0))).alias("sp"),
             F.sum(F.when(act, F.col("capital_assure")).otherwise(F.lit(0))).alias("sc"),
             F.sum(anc).alias("sa"), F.count(anc).alias("na"),
             F.max("date_souscription").alias("dmax")]
    step2 = [F.sum("sp").alias("prime_mensuelle_totale"),
             F.sum("sc").alias("capital_total_assure"),
             _ratio(F.sum("sa"), F.sum("na")).alias("anciennete_moyenne_contrats_mois"),
             F.max("dmax").alias("date_dernier_contrat")]
    agg = distinct_flag_agg(t, "client_id", "contrat_id", flags, step1, step2)
    return agg.select(
        "client_id",
        F.col("nb_ids").alias("nb_contrats_total"),
        "nb_contrats_actifs", "nb_contrats_resilies", "prime_mensuelle_totale", "capital_total_assure",
        "nb_contrats_auto", "nb_contrats_habitation", "nb_contrats_sante", "nb_contrats_vie",
        "anciennete_moyenne_contrats_mois", "date_dernier_contrat",
    )


# ---------------------------------------------------------------- E3 per-client claims
def sinistres_history(stg_si: DataFrame, p: Params) -> DataFrame:
    d12m = F.add_months(F.lit(p.as_of), -12)
    decl_date = F.col("date_declaration")
    t = stg_si.select("client_id", "sinistre_id", "montant_declare", "montant_indemnise",
                      "date_declaration", "is_rejete", "delai_traitement_jours")
    flags = {"nb_sinistres_12m": decl_date >= d12m, "nb_sinistres_rejetes": F.col("is_rejete")}
    delai = F.col("delai_traitement_jours")
    step1 = [F.sum("montant_declare").alias("sd"), F.sum("montant_indemnise").alias("si"),
             F.sum(delai).alias("sdl"), F.count(delai).alias("ndl"), F.max(decl_date).alias("dmax")]
    step2 = [F.sum("sd").alias("montant_total_sinistres_declares"),
             F.sum("si").alias("montant_total_indemnise"),
             _ratio(F.sum("sdl"), F.sum("ndl")).alias("delai_moyen_traitement"),
             F.max("dmax").alias("date_dernier_sinistre")]
    agg = distinct_flag_agg(t, "client_id", "sinistre_id", flags, step1, step2)
    return agg.select(
        "client_id",
        F.col("nb_ids").alias("nb_sinistres_total"),
        "montant_total_sinistres_declares", "montant_total_indemnise",
        "nb_sinistres_12m", "nb_sinistres_rejetes", "delai_moyen_traitement", "date_dernier_sinistre",
    )


# ---------------------------------------------------------------- E4/E5 per-contract claims
def sinistres_agg(stg_si: DataFrame, p: Params) -> DataFrame:
    from finsight.functions import age_month_part, age_year_part
    ind = F.col("montant_indemnise")
    delai = F.col("delai_traitement_jours")
    base = stg_si.groupBy("contrat_id").agg(
        F.count_distinct("sinistre_id").alias("nb_sinistres"),
        F.sum("montant_declare").alias("montant_total_sinistres_declares"),
        F.sum(ind).alias("montant_total_indemnise"),
        _ratio(F.sum(ind), F.count(ind)).alias("montant_moyen_indemnise"),
        F.max("date_declaration").alias("date_dernier_sinistre"),
        _ratio(F.sum(delai), F.count(delai)).alias("delai_moyen_traitement"),
        F.min("date_survenance").alias("date_premier_sinistre"),
        _ratio(F.count(F.when(F.col("is_clos") & ~F.col("is_rejete"), F.lit(1))), F.count(F.lit(1)))
        .alias("taux_acceptation"),
    )
    first = F.col("date_premier_sinistre")
    years = (age_year_part(F.lit(p.as_of), first, with_time=False).cast("double")
             + age_month_part(F.lit(p.as_of), first, with_time=False).cast("double") / 12.0)
    freq = F.when(first.isNull(), F.lit(0.0)).otherwise(
        F.col("nb_sinistres").cast("double") / F.nullif(years, F.lit(0.0)))
    return base.withColumn("frequence_sinistres_annuelle", freq)


def by_contract(stg: DataFrame) -> DataFrame:
    """Rows of one contract in one place, for aggregates that count distinct ids of a contract: these then need no exchange of every
    (contract, id) with all its running sums, only this one of the columns they read."""
    return stg.repartition("contrat_id")


# ---------------------------------------------------------------- E6 per-contract instalments
def primes_agg(stg_pr: DataFrame, p: Params) -> DataFrame:
    paye = F.col("is_paye")
    return stg_pr.groupBy("contrat_id").agg(
        F.count_distinct("prime_id").alias("nb_echeances"),
        F.sum("montant_prime").alias("montant_total_primes"),
        F.sum(F.when(paye, F.col("montant_prime")).otherwise(F.lit(0))).alias("montant_primes_payees"),
        F.count(F.when(F.col("is_impaye"), F.lit(1))).alias("nb_impayes"),
        F.count(F.when(F.col("is_retard"), F.lit(1))).alias("nb_retards"),
        _ratio(F.count(F.when(paye, F.lit(1))), F.count(F.lit(1))).alias("taux_paiement"),
        _ratio(F.count(F.when(F.col("is_paiement_a_temps"), F.lit(1))), F.count(F.lit(1)))
        .alias("taux_paiement_a_temps"),
    )


# ---------------------------------------------------------------- E7 trailing-30-day client stats
def client_stats_30d(stg_tx: DataFrame, p: Params) -> DataFrame:
    """Lower bound only (date >= as_of - 30): later-dated rows are kept, as in the source rule."""
    m = F.col("montant_eur")
    recent = stg_tx.filter(F.col("date_transaction") >= F.date_sub(F.lit(p.as_of), 30))
    return recent.groupBy("client_id").agg(
        _ratio(F.sum(m), F.count(m)).alias("avg_montant_30j"),
        F.stddev_samp(m.cast("double")).alias("std_montant_30j"),
        _ratio(F.count_distinct("transaction_id"), F.count_distinct("date_transaction")).alias("avg_trans_par_jour"),
        F.max(m).alias("max_montant_historique"),
        _ratio(F.count(F.when(F.col("is_international"), F.lit(1))), F.count(F.lit(1)))
        .alias("taux_trans_internationales"),
    )


# ---------------------------------------------------------------- E8 per (client, country)
def client_pays_stats(stg_tx: DataFrame, p: Params) -> DataFrame:
    return stg_tx.groupBy("client_id", "pays_beneficiaire").agg(F.count(F.lit(1)).alias("nb_trans_pays"))


# ---------------------------------------------------------------- publication helpers
def with_key(df: DataFrame, id_col: str, key_col: str) -> DataFrame:
    """Prepend the surrogate key of ``id_col``; drop the id when it was not part of the output."""
    return df.select(surrogate_key(id_col).alias(key_col), *df.columns)


def publish(df: DataFrame, double_cols: list[str]) -> DataFrame:
    return df.select(*[pub(c).alias(c) if c in double_cols else F.col(c) for c in df.columns])


def double_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
