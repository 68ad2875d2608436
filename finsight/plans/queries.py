"""Query registry: key -> callable(spark, sf_dir) -> DataFrame, over the fixture-mapped tables.

``Models`` builds the model DataFrames of one (session, input directory, params), each once per query, so
that a mart and its upstream share one logical plan and every query lists its input files anew.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finsight.functions import (age_month_part, age_total_months, age_year_part, pg_initcap,
                                surrogate_key)
from finsight.operators import aggregates as agg
from finsight.operators import features, monitoring, quality, staging, windows
from finsight.params import Params
from finsight.plans import marts
from finsight.session import ensure_checkpoint_dir
from finsight.sources import csv_ingest, fixtures, schedule

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(key: str):
    def deco(fn):
        QUERIES[key] = fn
        return fn
    return deco


def raw(spark: SparkSession, sf_dir: str, p: Params | None = None) -> dict[str, DataFrame]:
    return fixtures.raw_tables(spark, sf_dir, p or Params())


def shared_raw(spark: SparkSession, sf_dir: str, p: Params | None = None) -> dict[str, DataFrame]:
    return Models(spark, sf_dir, p).raw


def published(df: DataFrame) -> DataFrame:
    return agg.publish(df, agg.double_columns(df))


def keyed(df: DataFrame, id_col: str, key_col: str) -> DataFrame:
    """Replace the grouping id by its surrogate key (the published grain of the aggregate)."""
    return published(agg.with_key(df, id_col, key_col).drop(id_col))


class Models:
    """Lazily built model DataFrames for one (spark, sf_dir, params); each model is built once
    per instance so that a mart and its upstream share one logical plan."""

    def __init__(self, spark: SparkSession, sf_dir: str, p: Params | None = None):
        self.spark, self.sf_dir, self.p = spark, sf_dir, p or Params()
        self._cache: dict[str, DataFrame] = {}  # of this instance only: files that land later are listed anew

    def _get(self, name, build):
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]

    @property
    def raw(self) -> dict[str, DataFrame]:
        return self._get("raw", lambda: raw(self.spark, self.sf_dir, self.p))

    def stg(self, name: str) -> DataFrame:
        return self._get(f"stg_{name}", lambda: staging.STAGING[name](self.raw[name], self.p))

    def transaction_features(self) -> DataFrame:
        return self._get("itf", lambda: features.transaction_features(self.stg("transactions"), self.p))

    def client_activity(self) -> DataFrame:
        return self._get("ica", lambda: features.client_activity(
            self.stg("clients"), self.stg("transactions"), self.stg("contrats"), self.stg("sinistres"), self.p))

    def contrat_performance(self) -> DataFrame:
        return self._get("icp", lambda: features.contrat_performance(
            self.stg("contrats"), self.stg("sinistres"), self.stg("primes"), self.p))

    def anomalies(self) -> DataFrame:
        return self._get("fat", lambda: marts.fct_anomalies_transactions(self.transaction_features(), self.p))

    def churn(self) -> DataFrame:
        return self._get("fcp", lambda: marts.fct_churn_predictions(self.client_activity(), self.p))


def _m(spark, sf_dir, **kw) -> Models:
    return Models(spark, sf_dir, Params(**kw) if kw else None)


# ---------------------------------------------------------------- staging (C)
def _stg(name: str):
    def fn(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _m(spark, sf_dir).stg(name)
    fn.__name__ = f"stg_{name}"
    return fn


for _name in staging.STAGING:
    QUERIES[f"stg_{_name}"] = _stg(_name)


# ---------------------------------------------------------------- aggregates (E)
@query("trans_activity")
def q_trans_activity(spark, sf_dir):
    m = _m(spark, sf_dir)
    return keyed(agg.trans_activity(m.stg("transactions"), m.p), "client_id", "client_key")


@query("contrats_portfolio")
def q_contrats_portfolio(spark, sf_dir):
    m = _m(spark, sf_dir)
    return keyed(agg.contrats_portfolio(m.stg("contrats"), m.p), "client_id", "client_key")


@query("sinistres_history")
def q_sinistres_history(spark, sf_dir):
    m = _m(spark, sf_dir)
    return keyed(agg.sinistres_history(m.stg("sinistres"), m.p), "client_id", "client_key")


@query("sinistres_agg")
def q_sinistres_agg(spark, sf_dir):
    m = _m(spark, sf_dir)
    return keyed(agg.sinistres_agg(m.stg("sinistres"), m.p), "contrat_id", "contrat_key")


@query("primes_agg")
def q_primes_agg(spark, sf_dir):
    m = _m(spark, sf_dir)
    return keyed(agg.primes_agg(agg.by_contract(m.stg("primes")), m.p), "contrat_id", "contrat_key")


@query("client_stats_30d")
def q_client_stats_30d(spark, sf_dir):
    m = _m(spark, sf_dir)
    return keyed(agg.client_stats_30d(m.stg("transactions"), m.p), "client_id", "client_key")


@query("client_pays_stats")
def q_client_pays_stats(spark, sf_dir):
    m = _m(spark, sf_dir)
    return keyed(agg.client_pays_stats(m.stg("transactions"), m.p), "client_id", "client_key")


# ---------------------------------------------------------------- windows (F)
def _windows(spark, sf_dir, **kw) -> DataFrame:
    m = _m(spark, sf_dir, **kw)
    t = m.stg("transactions").select(windows.K, windows.TS, windows.ID, windows.AMT, windows.DAY, windows.PAYS)
    return windows.client_windows(t, m.p)


@query("win_count_client_day")
def q_win_count_client_day(spark, sf_dir):
    return _windows(spark, sf_dir).select("transaction_id", "nb_transactions_client_jour")


@query("win_lag_seconds")
def q_win_lag_seconds(spark, sf_dir):
    return published(_windows(spark, sf_dir).select("transaction_id", "delai_depuis_derniere_sec"))


@query("win_percent_rank")
def q_win_percent_rank(spark, sf_dir):
    return published(_windows(spark, sf_dir).select("transaction_id", "percentile_montant_client"))


@query("win_ranged_all")
def q_win_ranged_all(spark, sf_dir):
    """All four per-client windows through the skew (range-partitioned) path for every client."""
    return published(_windows(spark, sf_dir, hot_key_rows=0).select(
        "transaction_id", "nb_transactions_client_jour", "delai_depuis_derniere_sec",
        "percentile_montant_client", "nb_trans_pays"))


# ---------------------------------------------------------------- intermediate (I)
@query("int_transaction_features")
def q_int_transaction_features(spark, sf_dir):
    return published(_m(spark, sf_dir).transaction_features())


@query("int_client_activity")
def q_int_client_activity(spark, sf_dir):
    return published(_m(spark, sf_dir).client_activity())


@query("int_contrat_performance")
def q_int_contrat_performance(spark, sf_dir):
    return published(_m(spark, sf_dir).contrat_performance())


# ---------------------------------------------------------------- marts
@query("anomaly_score")
def q_anomaly_score(spark, sf_dir):
    m = _m(spark, sf_dir)
    scored = marts.classify_anomalies(m.transaction_features(), m.p)
    return published(scored.select("transaction_id", "is_anomalie_montant", "is_anomalie_frequence",
                                   "is_anomalie_geographique", "is_anomalie_horaire",
                                   "is_anomalie_comportementale", "score_anomalie",
                                   "type_anomalie_principal", "niveau_severite", "is_anomalie"))


@query("fct_anomalies_transactions")
def q_fct_anomalies_transactions(spark, sf_dir):
    return published(_m(spark, sf_dir).anomalies())


@query("fct_anomalies_summary")
def q_fct_anomalies_summary(spark, sf_dir):
    m = _m(spark, sf_dir)
    return published(marts.fct_anomalies_summary(m.anomalies(), m.p))


@query("churn_score")
def q_churn_score(spark, sf_dir):
    return _m(spark, sf_dir).churn().select("client_key", "score_baisse_activite", "score_inactivite",
                                            "score_resiliation", "score_insatisfaction_sinistres",
                                            "score_faible_valeur", "score_churn")


@query("fct_churn_predictions")
def q_fct_churn_predictions(spark, sf_dir):
    return published(_m(spark, sf_dir).churn())


@query("dim_client_segments")
def q_dim_client_segments(spark, sf_dir):
    m = _m(spark, sf_dir)
    return published(marts.dim_client_segments(m.churn(), m.p))


@query("fct_performance_contrats")
def q_fct_performance_contrats(spark, sf_dir):
    m = _m(spark, sf_dir)
    return published(marts.fct_performance_contrats(m.contrat_performance(), m.p))


@query("fct_sinistralite")
def q_fct_sinistralite(spark, sf_dir):
    m = _m(spark, sf_dir)
    return published(marts.fct_sinistralite(m.stg("contrats"), m.stg("clients"), m.stg("sinistres"),
                                            m.stg("primes"), m.p))


@query("fct_kpis_portefeuille")
def q_fct_kpis_portefeuille(spark, sf_dir):
    m = _m(spark, sf_dir)
    return published(marts.fct_kpis_portefeuille(m.stg("clients"), m.stg("contrats"), m.stg("sinistres"),
                                                 m.stg("primes"), m.churn(), m.p))


# ---------------------------------------------------------------- column functions (H)


@query("surrogate_key")
def q_surrogate_key(spark, sf_dir):
    t = shared_raw(spark, sf_dir)["transactions"]
    return t.select("transaction_id",
                    surrogate_key("transaction_id").alias("key_1"),
                    surrogate_key("client_id", "date_transaction").alias("key_2"),
                    surrogate_key("transaction_id", "pays_beneficiaire", "montant").alias("key_3"))


@query("pg_initcap")
def q_pg_initcap(spark, sf_dir):
    c = shared_raw(spark, sf_dir)["clients"]
    return c.select("client_id", pg_initcap("nom").alias("nom_initcap"), pg_initcap("prenom").alias("prenom_initcap"),
                    pg_initcap("ville").alias("ville_initcap"), pg_initcap("email").alias("email_initcap"))


@query("age_months")
def q_age_months(spark, sf_dir):
    p = Params()
    c = shared_raw(spark, sf_dir, p)["contrats"]
    now = F.lit(p.as_of)
    return c.select("contrat_id",
                    age_total_months("date_echeance", "date_effet").alias("months_term"),
                    age_total_months(now, "date_effet").alias("months_since_start"),
                    age_total_months("date_effet", "date_echeance").alias("months_reversed"),
                    age_month_part("date_echeance", now).alias("month_part_remaining"),
                    age_year_part("date_echeance", now).alias("year_part_remaining"))


@query("age_months_ts")
def q_age_months_ts(spark, sf_dir):
    t = Models(spark, sf_dir).stg("transactions")
    ref = F.lit("2023-11-30 12:00:00").cast("timestamp_ntz")
    return t.select("transaction_id",
                    age_total_months("timestamp_transaction", ref).alias("months_after_ref"),
                    age_total_months(ref, "timestamp_transaction").alias("months_before_ref"),
                    age_month_part("timestamp_transaction", ref).alias("month_part"))


# ---------------------------------------------------------------- schedule, joins (A20, D)
@query("prime_schedule")
def q_prime_schedule(spark, sf_dir):
    m = _m(spark, sf_dir)
    return schedule.premium_schedule(m.stg("contrats"), m.p.as_of)


@query("join_left_unknown_segment")
def q_join_left_unknown_segment(spark, sf_dir):
    m = _m(spark, sf_dir)
    seg = marts.client_segments(m.stg("clients"))
    j = m.stg("contrats").select("contrat_id", "client_id").join(seg, "client_id", "left")
    # one output row per matching client row: the copies are generated next to the contract row
    copies = F.coalesce(F.col("copies"), F.lit(1)).cast("int")
    return (j.select("contrat_id", "segment_client", F.explode(F.array_repeat(F.lit(1), copies)).alias("_c"))
            .select("contrat_id", F.coalesce(F.col("segment_client"), F.lit("Unknown")).alias("segment_client")))


@query("join_fanout")
def q_join_fanout(spark, sf_dir):
    """Per client: rows, premiums and indemnities of clients LEFT JOIN contracts LEFT JOIN claims
    LEFT JOIN instalments, from per-contract counts pre-aggregated per client (the product is
    never built)."""
    m = _m(spark, sf_dir)
    w = marts.contract_weights(m.stg("contrats"), m.stg("sinistres"), m.stg("primes"))
    j = marts.per_client_fanout(m.stg("clients"), w)
    keys = m.stg("clients").select("client_key", "client_id")
    out = keys.join(j, "client_id", "left")
    return out.groupBy("client_key").agg(
        F.sum(F.coalesce(F.col("W"), F.lit(1))).cast("long").alias("nb_rows"),
        F.sum(F.coalesce(F.col("PAID"), F.lit(0))).alias("primes_payees_fanout"),
        F.sum(F.col("IND")).alias("indemnites_fanout"))


# ---------------------------------------------------------------- data checks (J)
class _LazyTables(dict):
    def __init__(self, builders):
        super().__init__()
        self._b = builders

    def __missing__(self, k):
        v = self[k] = self._b[k]()
        return v


def check_tables(m: Models) -> dict[str, DataFrame]:
    """Every relation a declared check may read, built on first use only."""
    b = {k: (lambda k=k: m.raw[k]) for k in ("clients", "transactions", "contrats", "sinistres", "primes")}
    b.update({f"stg_{n}": (lambda n=n: m.stg(n)) for n in staging.STAGING})
    b.update({
        "int_client_activity": m.client_activity,
        "int_transaction_features": m.transaction_features,
        "int_contrat_performance": m.contrat_performance,
        "fct_anomalies_transactions": m.anomalies,
        "fct_churn_predictions": m.churn,
        "fct_performance_contrats": lambda: marts.fct_performance_contrats(m.contrat_performance(), m.p),
        "fct_sinistralite": lambda: marts.fct_sinistralite(m.stg("contrats"), m.stg("clients"), m.stg("sinistres"),
                                                           m.stg("primes"), m.p),
    })
    return _LazyTables(b)


def _checks_of(kind: str):
    def fn(spark, sf_dir):
        m = _m(spark, sf_dir)
        checks = [c for c in quality.ALL_CHECKS if c.kind == kind]
        return quality.summary(checks, check_tables(m))
    fn.__name__ = f"checks_{kind}"
    return fn


for _kind, _key in [("unique", "test_unique"), ("not_null", "test_not_null"),
                    ("accepted_values", "test_accepted_values"), ("accepted_range", "test_accepted_range"),
                    ("relationships", "orphan_check")]:
    QUERIES[_key] = _checks_of(_kind)


@query("constraint_violations")
def q_constraint_violations(spark, sf_dir):
    return quality.constraint_violations(shared_raw(spark, sf_dir))


# ---------------------------------------------------------------- load statistics / monitoring
@query("load_row_counts")
def q_load_row_counts(spark, sf_dir):
    m = _m(spark, sf_dir)
    tables = {f"raw.{k}": m.raw[k] for k in ("clients", "transactions", "contrats", "sinistres", "primes")}
    tables.update({"staging.stg_clients": m.stg("clients"), "staging.stg_transactions": m.stg("transactions"),
                   "marts.fct_anomalies_transactions": m.anomalies(), "marts.fct_churn_predictions": m.churn()})
    return monitoring.row_counts(tables)


@query("stat_avg_trans_per_client")
def q_stat_avg_trans_per_client(spark, sf_dir):
    return monitoring.avg_transactions_per_client(shared_raw(spark, sf_dir)["transactions"])


@query("stat_avg_amount")
def q_stat_avg_amount(spark, sf_dir):
    return monitoring.avg_amount(shared_raw(spark, sf_dir)["transactions"])


@query("stat_active_contracts")
def q_stat_active_contracts(spark, sf_dir):
    return monitoring.active_contracts(shared_raw(spark, sf_dir)["contrats"])


@query("stat_claim_rate")
def q_stat_claim_rate(spark, sf_dir):
    r = shared_raw(spark, sf_dir)
    return monitoring.claim_rate(r["contrats"], r["sinistres"])


@query("dq_anomaly_counts")
def q_dq_anomaly_counts(spark, sf_dir):
    return monitoring.anomaly_counts(_m(spark, sf_dir).anomalies())


@query("dq_churn_distribution")
def q_dq_churn_distribution(spark, sf_dir):
    return monitoring.churn_distribution(_m(spark, sf_dir).churn())


@query("dq_freshness")
def q_dq_freshness(spark, sf_dir):
    p = Params()
    return monitoring.freshness(shared_raw(spark, sf_dir, p)["transactions"], p.as_of)


# ---------------------------------------------------------------- ingestion round trips
def _scratch(spark) -> str:
    """A fresh folder under the (shared) checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/finsight-scratch/{uuid.uuid4().hex}"


@query("ingest_csv")
def q_ingest_csv(spark, sf_dir):
    """Transactions exported as CSV text with deterministic defects, then ingested back."""
    path = _scratch(spark) + "/transactions"
    text = fixtures.transactions_csv_text(fixtures.read_driver_table(spark, sf_dir, "events"))
    csv_ingest.write_csv(text, path)
    return csv_ingest.ingest_csv(spark, "transactions", path)


@query("ingest_csv_clients")
def q_ingest_csv_clients(spark, sf_dir):
    """Clients with date-time text in a date column (truncated to the day), blank e-mails and
    float-formatted integers, ingested back."""
    path = _scratch(spark) + "/clients"
    text = fixtures.clients_csv_text(fixtures.read_driver_table(spark, sf_dir, "customer"))
    csv_ingest.write_csv(text, path)
    return csv_ingest.ingest_csv(spark, "clients", path)


@query("stream_ingest_csv")
def q_stream_ingest_csv(spark, sf_dir):
    """The defect CSV export of ``ingest_csv`` landed in two batches of files and loaded by two
    scheduled streaming runs (each run commits only the files it has not seen)."""
    from finsight.streaming.ingest import run_ingest
    base = _scratch(spark)
    text = fixtures.transactions_csv_text(fixtures.read_driver_table(spark, sf_dir, "events"))
    day = F.col("date_transaction")
    early = F.coalesce(day < "2024-01-16", F.lit(False))
    first = text.filter(early)
    csv_ingest.write_csv(first, f"{base}/landing/part=1")
    run_ingest(spark, "transactions", f"{base}/landing/*", f"{base}/raw", f"{base}/_checkpoint")
    csv_ingest.write_csv(text.filter(~early), f"{base}/landing/part=2")
    return run_ingest(spark, "transactions", f"{base}/landing/*", f"{base}/raw", f"{base}/_checkpoint")


@query("ingest_rejects")
def q_ingest_rejects(spark, sf_dir):
    """All five tables exported with values that the declared tables refuse (no key, over-long text, numbers beyond their
    precision, rows that come twice, foreign keys to nothing) and loaded: rows accepted, rejected, and by reason."""
    from finsight import schemas
    from finsight.sources import loader, snapshots
    base, raw, results = _scratch(spark), shared_raw(spark, sf_dir), []
    for t in schemas.LOAD_ORDER:  # the text of one table lies there at a time
        landed = f"{base}/landing/{t}"
        csv_ingest.write_csv(fixtures.refused_csv_text(raw[t], t), landed, compression="gzip")
        results += loader.load_raw(spark, {t: landed}, f"{base}/raw")
        snapshots.discard(spark, landed)
    if not loader.all_loaded(results):
        raise RuntimeError(f"load failed: {[r for r in results if r.status != 'loaded']}")
    return loader.reject_counts(spark, f"{base}/raw")


@query("layered_run_clean")
def q_layered_run_clean(spark, sf_dir):
    """Layered run that sets raw rows breaking a declared rule aside and goes on to the marts; returns the step log."""
    from finsight.plans import pipeline
    m = _m(spark, sf_dir)
    _, log = pipeline.run_pipeline(spark, m.raw, m.p, _scratch(spark), quarantine=True)
    return pipeline.log_frame(spark, log).drop("seq")


def _catalogued(spark, sf_dir, read):
    """What ``read`` finds in the catalog after a load and a run were registered there under a prefix of their own."""
    from finsight.plans import catalog, pipeline
    from finsight.sources import loader, rejects
    m, root, prefix = _m(spark, sf_dir), _scratch(spark), f"fs_{uuid.uuid4().hex[:12]}_"
    for t, df in m.raw.items():
        loader.load_table(spark, t, rejects.typed_rules(df, t), f"{root}/raw", cascade=False, cheap=True)
    raw = {t: loader.read_table(spark, f"{root}/raw", t) for t in m.raw}
    pipeline.run_pipeline(spark, raw, m.p, root, run_tests=False, materialize_all=True)
    try:
        catalog.register(spark, root, f"{root}/raw", prefix)
        return read(catalog, prefix)
    finally:
        catalog.unregister(spark, prefix)


@query("catalog_relations")
def q_catalog_relations(spark, sf_dir):
    """Every relation of the four layers as the catalog lists it, and its rows counted by name in SQL."""
    def read(catalog, prefix):
        return [(layer, name, kind, spark.sql(f"SELECT count(*) FROM `{prefix}{layer}`.`{name}`").first()[0])
                for layer, name, kind in catalog.relations(spark, prefix)]
    return spark.createDataFrame(_catalogued(spark, sf_dir, read), "layer string, relation string, kind string, n_rows long")


@query("catalog_comments")
def q_catalog_comments(spark, sf_dir):
    """The descriptions of relations and columns as the catalog holds them."""
    rows = _catalogued(spark, sf_dir, lambda catalog, prefix: catalog.comments(spark, prefix))
    return spark.createDataFrame(rows, "relation string, column_name string, comment string")


@query("layered_run")
def q_layered_run(spark, sf_dir):
    """Layered run (staging -> tests -> intermediate -> tests -> marts -> tests) with the test
    gate; returns the step log (model runs, per-test failure counts, stop marker)."""
    from finsight.plans import pipeline
    m = _m(spark, sf_dir)
    _, log = pipeline.run_pipeline(spark, m.raw, m.p, _scratch(spark))
    return pipeline.log_frame(spark, log).drop("seq")


# ---------------------------------------------------------------- normalisation steps
def _defect_text(spark, sf_dir) -> DataFrame:
    return fixtures.transactions_csv_text(fixtures.read_driver_table(spark, sf_dir, "events"))


@query("normalize_blanks")
def q_normalize_blanks(spark, sf_dir):
    """A1+A2 on the text columns: NA tokens and blank strings become NULL, other text is kept."""
    t = _defect_text(spark, sf_dir)
    return t.select("transaction_id", *[csv_ingest.na_to_null(F.col(c)).alias(c)
                                        for c in ("date_transaction", "heure_transaction", "montant", "devise")])


@query("normalize_time")
def q_normalize_time(spark, sf_dir):
    """A3: 'H:mm[:ss]' text to 'HH:mm:ss', anything else NULL."""
    t = _defect_text(spark, sf_dir)
    return t.select("transaction_id",
                    csv_ingest.parse_time(csv_ingest.na_to_null(F.col("heure_transaction"))).alias("heure_transaction"))


@query("normalize_types")
def q_normalize_types(spark, sf_dir):
    """Lenient date (truncated to the day), timestamp and decimal parsing to the raw types."""
    from finsight import schemas
    t = _defect_text(spark, sf_dir).select("transaction_id", "date_transaction", "montant", "loaded_at")
    target = schemas.TRANSACTIONS
    sub = type(target)([target[c] for c in t.columns])
    return csv_ingest.normalize(t, sub)
