"""JDBC source and sink for a relational raw layer (A8, A9, A15 against a SQL database).

* ``read_table`` reads in parallel: with a numeric ``partition_column`` and bounds, Spark issues
  ``num_partitions`` range queries instead of one full-table query.
* ``write_table`` replaces a table's rows: ``overwrite`` with ``truncate=true`` keeps the declared
  table (keys, types) and ``cascadeTruncate=true`` empties the referencing tables, as a
  ``TRUNCATE ... CASCADE`` full refresh does; rows are sent in batches of ``batch_size`` by every
  partition in parallel.

The database driver jar must be on the classpath; nothing here starts or reaches a server by
itself (no live database is used in this repository's tests).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, DataFrameWriter, SparkSession

DEFAULT_BATCH_SIZE = 1000


def reader(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None,
           partition_column: str | None = None, lower_bound: int | None = None,
           upper_bound: int | None = None, num_partitions: int | None = None,
           fetch_size: int = 10_000) -> DataFrameReader:
    r = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
         .option("fetchsize", str(fetch_size)))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partitioned JDBC reads need lower_bound, upper_bound and num_partitions")
        r = (r.option("partitionColumn", partition_column).option("lowerBound", str(lower_bound))
             .option("upperBound", str(upper_bound)).option("numPartitions", str(num_partitions)))
    return r


def read_table(spark: SparkSession, url: str, table: str, **kw) -> DataFrame:
    return reader(spark, url, table, **kw).load()


def writer(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
           batch_size: int = DEFAULT_BATCH_SIZE, cascade: bool = True,
           num_partitions: int | None = None) -> DataFrameWriter:
    w = (df.write.format("jdbc").mode("overwrite").option("url", url).option("dbtable", table)
         .option("truncate", "true").option("cascadeTruncate", "true" if cascade else "false")
         .option("batchsize", str(batch_size)))
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))  # caps concurrent connections
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    return w


def write_table(df: DataFrame, url: str, table: str, **kw) -> None:
    writer(df, url, table, **kw).save()
