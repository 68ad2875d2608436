"""Load statistics and operational checks (E13-E19, J6-J9): small global aggregates.

Every function returns a DataFrame (one or a few rows); nothing is collected here. The caller
decides whether a result is an error (``require_non_empty``) or a warning.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finsight.functions import ntz_literal

# Freshness targets (hours).
FRESHNESS_WARN_HOURS = 12
FRESHNESS_ERROR_HOURS = 24
FRESHNESS_ALERT_HOURS = 48
CHECK_TIME = dt.time(6, 0)  # daily check run time, relative to the as-of date


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for each named table."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def avg_transactions_per_client(raw_tx: DataFrame) -> DataFrame:
    """Mean number of transactions per client, rounded to an integer (half away from zero)."""
    per_client = raw_tx.groupBy("client_id").agg(F.count(F.lit(1)).alias("nb_trans"))
    return per_client.agg(F.round(F.avg("nb_trans"), 0).cast("int").alias("avg_trans"))


def avg_amount(raw_tx: DataFrame) -> DataFrame:
    """Mean transaction amount as DECIMAL(10,2)."""
    return raw_tx.agg(F.avg("montant").cast("decimal(10,2)").alias("avg_montant"))


def active_contracts(raw_ct: DataFrame) -> DataFrame:
    """Contracts whose raw status equals 'Actif'."""
    return raw_ct.filter(F.col("statut") == "Actif").agg(F.count(F.lit(1)).alias("contrats_actifs"))


def claim_rate(raw_ct: DataFrame, raw_si: DataFrame) -> DataFrame:
    """Distinct claimed contracts / distinct contracts x 100 over contracts LEFT JOIN
    claims, as DECIMAL(5,2). The claim side is reduced to distinct contract ids before the join."""
    claimed = raw_si.select(F.col("contrat_id").alias("claimed_id")).filter(F.col("claimed_id").isNotNull()).distinct()
    j = raw_ct.select("contrat_id").join(claimed, F.col("contrat_id") == F.col("claimed_id"), "left")
    g = j.agg(F.count_distinct("claimed_id").alias("n_claimed"), F.count_distinct("contrat_id").alias("n_contracts"))
    ratio = F.col("n_claimed").cast("double") / F.nullif(F.col("n_contracts"), F.lit(0)).cast("double") * 100
    return g.select(F.round(ratio, 2).cast("decimal(5,2)").alias("ratio"))


def anomaly_counts(anomalies: DataFrame) -> DataFrame:
    """Total anomalies and critical ones."""
    return anomalies.agg(F.count(F.lit(1)).alias("total"),
                         F.count(F.when(F.col("niveau_severite") == "Critique", F.lit(1))).alias("critiques"))


def churn_distribution(churn: DataFrame) -> DataFrame:
    """Clients per churn-risk segment, largest first (segment breaks ties)."""
    return (churn.groupBy("segment_risque").agg(F.count(F.lit(1)).alias("nb_clients"))
            .orderBy(F.desc("nb_clients"), F.asc("segment_risque")))


def freshness(raw_tx: DataFrame, as_of: dt.date, check_time: dt.time = CHECK_TIME) -> DataFrame:
    """Newest ``loaded_at``, its age in hours at the check time, the source
    freshness status (warn after 12 h, error after 24 h) and the 48 h alert flag."""
    checked_at = dt.datetime.combine(as_of, check_time)
    g = raw_tx.agg(F.max("loaded_at").alias("last_loaded_at"))
    age = F.timestamp_diff("SECOND", F.col("last_loaded_at"), ntz_literal(checked_at)) \
        .cast("double") / 3600.0
    return g.select(
        "last_loaded_at",
        ntz_literal(checked_at).alias("checked_at"),
        F.round(age, 6).alias("age_hours"),
        F.when(F.col("last_loaded_at").isNull(), "error").when(age > FRESHNESS_ERROR_HOURS, "error")
        .when(age > FRESHNESS_WARN_HOURS, "warn").otherwise("pass").alias("freshness_status"),
        F.coalesce(age > FRESHNESS_ALERT_HOURS, F.lit(False)).alias("alert_48h"),
    )


class EmptyTableError(ValueError):
    pass


def require_non_empty(counts: DataFrame) -> list[tuple[str, int]]:
    """Raise when any counted table is empty; returns the (bounded) list of counts."""
    rows = [(r["table_name"], r["row_count"]) for r in counts.collect()]
    empty = [t for t, n in rows if n == 0]
    if empty:
        raise EmptyTableError(f"empty tables: {', '.join(empty)}")
    return rows
