"""Skew handling for per-key windows.

AQE splits skewed *join* partitions but not *window* partitions: ``Window.partitionBy(k)`` puts
every row of a key in one task. The helpers here route keys with more than ``threshold`` rows
("hot" keys) to a range-partitioned plan whose tasks are bounded by the range-partition size,
while all other keys keep the single-shuffle window plan.

* ``hot_keys``: one partial-aggregated count per key; the hot keys stay a (checkpointed) frame of any
  length, and the input is split by joins with it, which Spark broadcasts when it is small.
* ``ranged``: ``repartitionByRange`` on (key, order...) + partition id, then ``checkpoint()``
  into the shared checkpoint directory, so both branches that read the partition ids see
  the same assignment even if a stage is recomputed after an executor loss.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finsight.session import ensure_checkpoint_dir

DEFAULT_HOT_KEY_ROWS = 5_000_000
CONF_HOT_KEY_ROWS = "finsight.hotKeyRows"
DEFAULT_ROWS_PER_RANGE = 2_000_000
CONF_ROWS_PER_RANGE = "finsight.rowsPerRange"


def hot_threshold(spark: SparkSession, override: int | None = None) -> int:
    if override is not None:
        return int(override)
    return int(spark.conf.get(CONF_HOT_KEY_ROWS, str(DEFAULT_HOT_KEY_ROWS)))


def hot_keys(df: DataFrame, keys: list[str], threshold: int):
    """(hot keys as a DataFrame, total rows of those keys), or (None, 0) when no key has more than
    ``threshold`` rows."""
    ensure_checkpoint_dir(df.sparkSession)
    hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > threshold).checkpoint()
    total = hot.agg(F.sum("__n").alias("n")).first()["n"]
    return (hot.select(*keys), total) if total else (None, 0)


def split_hot(df: DataFrame, keys: list[str], threshold: int):
    """(cold rows, hot rows, hot row count); the hot frame is None when no key is hot. The hot row count
    sizes the range partitioning of the hot path."""
    hk, n_hot = hot_keys(df, keys, threshold)
    if hk is None:
        return df, None, 0
    b = hk.select(*[F.col(k).alias(f"__hk_{k}") for k in keys])
    # null-safe: a NULL key with many rows is hot too
    on = reduce(lambda a, c: a & c, [F.col(k).eqNullSafe(F.col(f"__hk_{k}")) for k in keys])
    return df.join(b, on, "left_anti"), df.join(b, on, "left_semi"), n_hot


def range_partitions(spark: SparkSession, rows: int | None) -> int:
    """Enough range partitions for ``rows`` at ``finsight.rowsPerRange`` rows each (at least the
    shuffle partition count)."""
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if not rows:
        return base
    per = int(spark.conf.get(CONF_ROWS_PER_RANGE, str(DEFAULT_ROWS_PER_RANGE)))
    return max(base, -(-rows // per))


def ranged(df: DataFrame, order: list, pid: str = "__pid", partitions: int | None = None) -> DataFrame:
    """Range-partition by ``order`` (first element = the group key), tag each row with its
    partition id and cut the lineage with a reliable checkpoint."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = df.repartitionByRange(n, *order).withColumn(pid, F.spark_partition_id())
    return out.checkpoint(eager=True)
