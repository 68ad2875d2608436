"""Per-client windows (F1-F3, plus the per-(client, country) count that replaces E8+D7).

Plain path: all windows are partitioned by ``client_id`` (or a superset of it), so one
hash exchange on ``client_id`` serves all four; the ordered ones only add local sorts.

Hot-key path (keys above the threshold of ``finsight.plans.skew``):
* the two whole-partition counts are hash aggregates (map-side combined) joined back on
  (client, date) / (client, country) — AQE's skew-join splits a hot join partition;
* LAG runs on range partitions of (client, order key): each range partition is processed on its own
  (window over (client, partition id)), then a small per-(client, partition) table carries the
  boundary information across partitions;
* PERCENT_RANK is computed over the (client, amount) counts in the same manner and joined back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finsight.functions import seconds_between
from finsight.params import Params
from finsight.plans import skew

K = "client_id"
TS = "timestamp_transaction"
ID = "transaction_id"
AMT = "montant_eur"
DAY = "date_transaction"
PAYS = "pays_beneficiaire"

OUT = ["nb_transactions_client_jour", "delai_depuis_derniere_sec", "percentile_montant_client",
       "nb_trans_pays"]


def _ns_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """LEFT join on ``keys`` with NULL-safe equality (a NULL client or day is a group of its own,
    as in the window form)."""
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    on = None
    for k in keys:
        term = F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        on = term if on is None else on & term
    return left.join(r, on, "left").drop(*[f"__r_{k}" for k in keys])


def _plain(df: DataFrame) -> DataFrame:
    by_client_ts = Window.partitionBy(K).orderBy(F.col(TS).asc_nulls_last(), F.col(ID))
    by_client_amt = Window.partitionBy(K).orderBy(F.col(AMT))
    prev = F.lag(TS).over(by_client_ts)
    return (df
            .withColumn("delai_depuis_derniere_sec", seconds_between(prev, F.col(TS)))
            .withColumn("percentile_montant_client", F.percent_rank().over(by_client_amt))
            .withColumn("nb_transactions_client_jour", F.count(F.lit(1)).over(Window.partitionBy(K, DAY)))
            .withColumn("nb_trans_pays", F.count(F.lit(1)).over(Window.partitionBy(K, PAYS))))


def _ranged_lag(r: DataFrame) -> DataFrame:
    """LAG over the checkpointed range partitions ``r`` of (client, timestamp, id)."""
    w = Window.partitionBy(K, "__p1").orderBy(F.col(TS).asc_nulls_last(), F.col(ID))
    local = r.withColumn("__prev", F.lag(TS).over(w)).withColumn("__rn", F.row_number().over(w))
    # timestamp of the last row (NULLs sort last, as in the source ordering) of each
    # (client, partition); the previous partition's value feeds that partition's first row
    last = r.groupBy(K, "__p1").agg(F.max_by(F.col(TS), F.struct(F.col(TS).isNull(), F.col(TS), F.col(ID)))
                                    .alias("__last"))
    carry = last.withColumn("__carry", F.lag("__last").over(Window.partitionBy(K).orderBy("__p1"))) \
                .select(K, "__p1", "__carry")
    j = _ns_join(local, carry, [K, "__p1"])
    prev = F.when(F.col("__rn") == 1, F.col("__carry")).otherwise(F.col("__prev"))
    return j.withColumn("delai_depuis_derniere_sec", seconds_between(prev, F.col(TS))) \
            .drop("__prev", "__rn", "__carry", "__p1")


def _percent_rank_by_counts(df: DataFrame, n: int) -> DataFrame:
    """PERCENT_RANK from a (client, amount, rows) table: rows below / (rows - 1). Only that table is range
    partitioned, so any number of rows with one amount costs one row there; the rows join it on
    (client, amount), a join whose skewed partitions AQE splits."""
    t = df.groupBy(K, AMT).agg(F.count(F.lit(1)).alias("__c"))
    r = skew.ranged(t, [K, AMT], pid="__p2", partitions=n)
    earlier = Window.partitionBy(K, "__p2").orderBy(F.col(AMT)).rowsBetween(Window.unboundedPreceding, -1)
    local = r.withColumn("__in", F.coalesce(F.sum("__c").over(earlier), F.lit(0)))
    sizes = r.groupBy(K, "__p2").agg(F.sum("__c").alias("__cnt"))
    before = Window.partitionBy(K).orderBy("__p2").rowsBetween(Window.unboundedPreceding, -1)
    offs = sizes.select(K, "__p2", F.coalesce(F.sum("__cnt").over(before), F.lit(0)).alias("__off"),
                        F.sum("__cnt").over(Window.partitionBy(K)).alias("__tot"))
    below = F.col("__in") + F.col("__off")
    ranks = _ns_join(local, offs, [K, "__p2"]).select(
        K, AMT, F.when(F.col("__tot") <= 1, F.lit(0.0)).otherwise(
            below.cast("double") / (F.col("__tot") - 1).cast("double")).alias("percentile_montant_client"))
    return _ns_join(df, ranks, [K, AMT])


def _hot(df: DataFrame, n_rows: int | None) -> DataFrame:
    n = skew.range_partitions(df.sparkSession, n_rows)
    # the hot rows are read from the source once; the counts and LAG read the checkpoint
    r = skew.ranged(df, [F.col(K), F.col(TS).asc_nulls_last(), F.col(ID)], pid="__p1", partitions=n)
    day = r.groupBy(K, DAY).agg(F.count(F.lit(1)).alias("nb_transactions_client_jour"))
    pays = r.groupBy(K, PAYS).agg(F.count(F.lit(1)).alias("nb_trans_pays"))
    x = _percent_rank_by_counts(_ranged_lag(r), n)
    x = _ns_join(x, day, [K, DAY])
    return _ns_join(x, pays, [K, PAYS])  # a NULL country is one group, as in the window form


def client_windows(df: DataFrame, p: Params,
                   per_branch: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Adds OUT columns to ``df`` (one row per transaction).

    ``per_branch`` is applied to the cold and the hot result *before* they are unioned: a join on
    ``client_id`` there reuses the cold branch's ``client_id`` partitioning, whereas after the
    union the partitioning is lost and every row would be shuffled again."""
    threshold = skew.hot_threshold(df.sparkSession, p.hot_key_rows)
    cold, hot, n_hot = skew.split_hot(df, [K], threshold)
    step = per_branch or (lambda x: x)
    parts = []
    if cold is not None:
        parts.append(step(_plain(cold)))
    if hot is not None:
        h = step(_hot(hot, n_hot))
        parts.append(h.select(*parts[0].columns) if parts else h)
    out = parts[0]
    for other in parts[1:]:
        out = out.unionByName(other)
    return out
