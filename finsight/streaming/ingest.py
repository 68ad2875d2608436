"""Scheduled ingestion of landed CSV files as a Structured Streaming job.

The daily load runs as a file-source stream with ``trigger(availableNow=True)``: each run picks up
the files that landed since the previous run, applies the same normalisation as the batch loader
(``finsight.sources.csv_ingest.normalize``) and appends typed rows to the raw table's Parquet
directory. The checkpoint (under the shared checkpoint directory) records which files were
committed, so a re-run after a failure neither loses nor duplicates a file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from finsight import schemas
from finsight.sources.csv_ingest import FREE_TEXT, QUOTING, normalize


#: Tasks (and files) that share the rows of one day in a run.
FILES_PER_DAY = 8


def string_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schemas.RAW_SCHEMAS[table].fields])


def landed_csv_stream(spark: SparkSession, table: str, landing_dir: str, truncate_dates: bool = True,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    reader = (spark.readStream.schema(string_schema(table)).option("header", "true")
              .options(**QUOTING).option("multiLine", str(table in FREE_TEXT).lower())
              # a file whose header names other columns, or in another order, fails instead of being misread
              .option("enforceSchema", "false").option("mode", "PERMISSIVE").option("nullValue", ""))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return normalize(reader.csv(landing_dir), schemas.RAW_SCHEMAS[table], truncate_dates)


def start_ingest(spark: SparkSession, table: str, landing_dir: str, target_dir: str, checkpoint_dir: str,
                 truncate_dates: bool = True) -> StreamingQuery:
    """Start one ``availableNow`` run; call ``.awaitTermination()`` on the result."""
    from finsight.sources.loader import PARTITION_BY
    stream = landed_csv_stream(spark, table, landing_dir, truncate_dates)
    if table in PARTITION_BY:  # a day's rows meet in a few tasks: few files per day and run, and no day in one task
        part = F.pmod(F.xxhash64(schemas.PRIMARY_KEYS[table]), F.lit(FILES_PER_DAY))
        stream = stream.repartition(F.col(PARTITION_BY[table]), part)
    w = (stream.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True))
    if table in PARTITION_BY:
        w = w.partitionBy(PARTITION_BY[table])
    return w.start(target_dir)


def run_ingest(spark: SparkSession, table: str, landing_dir: str, target_dir: str, checkpoint_dir: str,
               truncate_dates: bool = True) -> DataFrame:
    """Run one scheduled load to completion and return the (typed) raw table."""
    q = start_ingest(spark, table, landing_dir, target_dir, checkpoint_dir, truncate_dates)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    schema = schemas.RAW_SCHEMAS[table]
    return spark.read.schema(schema).parquet(target_dir).select(*schema.fieldNames())
