"""Which keys occur more than once, found on 64-bit hashes of the keys.

A hash a row is all that is exchanged, however long the keys are; only the hashes that occur again are kept, as files in the shared
scratch folder. Two different keys may share a hash, so these rows are suspects: whoever asks compares the keys themselves, of the
suspects only. Few suspects are broadcast, and the other rows stay where they are; many are joined."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finsight.session import ensure_checkpoint_dir

#: Rows of a narrow table that are sent to every task; more are joined by an exchange.
FEW = 500_000


def kept(df: DataFrame, what: str) -> DataFrame:
    """``df`` as files of the shared scratch folder."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/finsight-{what}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def offered(df: DataFrame, n: int) -> DataFrame:
    """``df`` of ``n`` rows as the small side of a join."""
    return F.broadcast(df) if n <= FEW else df


@dataclass(frozen=True)
class Repeated:
    """The hashes that occur more than once."""
    hashes: DataFrame
    n: int

    def suspects(self, rows: DataFrame, *key: str | Column) -> DataFrame:
        """The rows whose key's hash is one of them."""
        return rows.join(offered(self.hashes, self.n), F.xxhash64(*key) == F.col("_hash"), "left_semi")


def repeated(keys: dict[str, DataFrame]) -> dict[str, Repeated]:
    """For each name the hashes that more than one row of its frame has; rows with a null in a key column do not count."""
    parts = []
    for name, df in keys.items():
        whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in df.columns])
        parts.append(df.where(whole).select(F.xxhash64(*df.columns).alias("_hash")).groupBy("_hash").agg(F.count(F.lit(1)).alias("n"))
                     .where("n > 1").select(F.lit(name).alias("_name"), "_hash"))
    found = kept(reduce(DataFrame.unionByName, parts), "repeats")
    n = {r["_name"]: r["n"] for r in found.groupBy("_name").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a name
    return {name: Repeated(found.where(F.col("_name") == name).select("_hash"), n.get(name, 0)) for name in keys}
