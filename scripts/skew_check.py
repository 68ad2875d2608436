"""Skew check on data derived from the given tables: the events are re-assigned so that one client
holds two thirds of all transactions (every event whose id is not a multiple of 3 goes to user 0),
then the transaction-feature model runs once with the hot-key path disabled and once enabled.
Prints whether both results are identical and the time of each run.

usage: python scripts/skew_check.py [sf_dir] [hot_key_rows]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from finsight.operators import features, staging  # noqa: E402
from finsight.params import Params  # noqa: E402
from finsight.session import build_session  # noqa: E402
from finsight.sources import fixtures  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    hot_rows = int(sys.argv[2]) if len(sys.argv) > 2 else 10_000
    spark = build_session("local[8]", 8, extra={"spark.driver.memory": "12g"})
    events = fixtures.read_driver_table(spark, sf_dir, "events")
    skewed = events.withColumn("user_id", F.when(F.col("event_id") % 3 != 0, F.lit(0)).otherwise(F.col("user_id")))
    tx = staging.stg_transactions(fixtures.transactions(skewed), Params())
    top = tx.groupBy("client_id").count().orderBy(F.desc("count")).first()
    print(f"rows={tx.count()} hottest client {top['client_id']} holds {top['count']} rows")
    fingerprints = {}
    for label, p in [("plain", Params(hot_key_rows=10**12)), ("hot-path", Params(hot_key_rows=hot_rows))]:
        t0 = time.perf_counter()
        df = features.transaction_features(tx, p)
        agg = df.agg(F.count(F.lit(1)).alias("n"),
                     F.sum(F.hash("transaction_id", F.round("z_score_montant", 6), "nb_transactions_client_jour",
                                  "delai_depuis_derniere_sec", F.round("percentile_montant_client", 9),
                                  "is_pays_inhabituel")).alias("h")).first()
        fingerprints[label] = (agg.n, agg.h)
        print(f"{label:9s} {time.perf_counter() - t0:6.2f} s  rows={agg.n}")
    print("identical:", fingerprints["plain"] == fingerprints["hot-path"])
    spark.stop()


if __name__ == "__main__":
    main()
