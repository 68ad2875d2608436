"""Per-client windows: the range-partitioned (hot key) path equals the plain window path, and the
plain path uses a single exchange."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from finsight.operators import windows
from finsight.params import Params

SCHEMA = ("client_id string, timestamp_transaction timestamp_ntz, transaction_id string, montant_eur decimal(15,2), "
          "date_transaction date, pays_beneficiaire string")


def _skewed(spark):
    rnd = random.Random(3)
    rows = []
    base = dt.datetime(2024, 1, 1)
    for i in range(3000):
        client = "HOT" if i % 3 else f"C{i % 40}"   # one client holds two thirds of the rows
        ts = None if i % 97 == 0 else base + dt.timedelta(seconds=rnd.randint(0, 86400 * 20))
        if i % 50 == 0 and rows:
            ts = rows[-1][1]                          # exact timestamp ties
        amount = Decimal(rnd.choice(["10.00", "20.00", "35.50", str(rnd.randint(1, 900))]))
        pays = rnd.choice(["FRANCE", "ITALIE", None, "ESPAGNE"])
        day = (ts or base).date()
        rows.append((client, ts, f"T{i:05d}", amount, day, pays))
    return spark.createDataFrame(rows, SCHEMA)


def _collect(df):
    return sorted((r.transaction_id, r.nb_transactions_client_jour, r.delai_depuis_derniere_sec,
                   round(r.percentile_montant_client, 9), r.nb_trans_pays) for r in df.collect())


def test_ranged_path_equals_plain_path(spark):
    df = _skewed(spark)
    plain = _collect(windows.client_windows(df, Params(hot_key_rows=10**9)))
    all_hot = _collect(windows.client_windows(df, Params(hot_key_rows=0)))
    some_hot = _collect(windows.client_windows(df, Params(hot_key_rows=500)))
    assert plain == all_hot == some_hot


def test_plain_windows_single_exchange(spark):
    from finsight.plans.skew import hot_keys
    df = _skewed(spark)
    assert hot_keys(df, ["client_id"], 10**9) == (None, 0)
    keys, n = hot_keys(df, ["client_id"], 500)
    assert keys.count() == 1 and n == 2000
    # all four windows share one hash exchange on client_id
    plan = _explain(windows._plain(df))
    assert sum(1 for line in plan.splitlines() if "Exchange hashpartitioning" in line) == 1, plan


def _explain(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def test_ranged_path_with_many_small_ranges(spark):
    df = _skewed(spark)
    plain = _collect(windows.client_windows(df, Params(hot_key_rows=10**9)))
    spark.conf.set("finsight.rowsPerRange", "97")
    try:
        many = _collect(windows.client_windows(df, Params(hot_key_rows=0)))
    finally:
        spark.conf.unset("finsight.rowsPerRange")
    assert plain == many


def test_many_hot_keys_are_split_too(spark):
    from finsight.plans import skew
    df = _skewed(spark)
    cold, hot, n = skew.split_hot(df, ["client_id"], 10)
    assert n == hot.count() and cold.count() + n == df.count()
    assert _collect(windows.client_windows(df, Params(hot_key_rows=10))) == \
        _collect(windows.client_windows(df, Params(hot_key_rows=10**9)))


def test_one_client_with_one_amount(spark):
    rows = [("HOT", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i), f"T{i:05d}", Decimal("9.99") if i else Decimal("1.00"),
             dt.date(2024, 1, 1), "FRANCE") for i in range(2000)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert _collect(windows.client_windows(df, Params(hot_key_rows=0))) == \
        _collect(windows.client_windows(df, Params(hot_key_rows=10**9)))


def test_transaction_features_equal_on_both_paths(spark):
    from finsight import schemas
    from finsight.operators import features, staging
    rnd = random.Random(5)
    base = dt.datetime(2024, 1, 20)
    rows = []
    for i in range(1500):
        client = "HOT" if i % 3 else f"C{i % 25}"
        ts = base + dt.timedelta(seconds=rnd.randint(0, 86400 * 30))
        rows.append((f"T{i:05d}", client, ts.date(), ts.strftime("%H:%M:%S"), Decimal(str(rnd.randint(1, 900))),
                     "EUR", "Carte", "Web", "x", rnd.choice(["France", "Italie", None]), "ok",
                     dt.datetime(2024, 2, 15, 2)))
    tx = staging.stg_transactions(spark.createDataFrame(rows, schemas.TRANSACTIONS), Params())

    def run(p):
        cols = ["transaction_id", "z_score_montant", "ratio_vs_moyenne_client", "nb_transactions_client_jour",
                "delai_depuis_derniere_sec", "is_pays_inhabituel", "percentile_montant_client", "avg_montant_30j"]
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                      for r in features.transaction_features(tx, p).select(*cols).collect())

    assert run(Params(hot_key_rows=10**9)) == run(Params(hot_key_rows=100))


def test_null_key_can_be_hot(spark):
    from finsight.plans import skew
    df = spark.createDataFrame([(None, i) for i in range(50)] + [("a", 1)], "k string, v int")
    cold, hot, n = skew.split_hot(df, ["k"], 10)
    assert n == 50 and hot.count() == 50 and cold.count() == 1


def test_hot_null_client_matches_plain_path(spark):
    df = _skewed(spark).withColumn("client_id", F.when(F.col("client_id") == "HOT", F.lit(None))
                                   .otherwise(F.col("client_id")))
    plain = _collect(windows.client_windows(df, Params(hot_key_rows=10**9)))
    hot = _collect(windows.client_windows(df, Params(hot_key_rows=500)))
    assert plain == hot
