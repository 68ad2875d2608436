"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finsight.session import ensure_checkpoint_dir

#: Rows and bytes of one Arrow batch: a batch of very long texts stays a few megabytes.
ARROW_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


def ship_by_value(module_name: str) -> None:
    """Python functions of the module travel inside the task, so executors need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in ARROW_CONF.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: Column | str) -> Column:
    """UTF-8 bytes of a text; null stays null."""
    return F.col(column).cast("binary") if isinstance(column, str) else column.cast("binary")


def crc_mod(column: str, divisor: int) -> Column:
    """crc32 of the id written as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % F.lit(divisor)


def written(df: DataFrame, **options: str) -> DataFrame:
    """Materialise in the shared checkpoint folder and read back: cuts lineage, survives lost executors.

    ``options`` are those of the Parquet writer."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/finsight-llm/{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a frame that ``written`` gave, once nothing reads it any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if path.getParent().getName() == "finsight-llm":
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def by_value(thing: object) -> bytes:
    """An object of this subpackage as bytes that a task can load without the package (``cloudpickle.loads``)."""
    return cloudpickle.dumps(thing)


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name


ship_by_value(__name__)
