"""CSV ingestion: NA tokens / blanks, time, timestamp, date and number parsing; loader cascade
and failure isolation; the streaming load commits each landed file once."""

import datetime as dt
import os
from decimal import Decimal

from pyspark.sql import functions as F

from finsight import schemas
from finsight.sources import csv_ingest, loader


def test_normalize_edge_values(spark):
    rows = [("", "   ", "bad-date", "25:99", "abc", "NA"),
            ("x", "12:30", "2024-01-05 13:45:00", "12:30", "12.345", "7"),
            ("y", "12:30:45", "2024-01-05", "7:05:09", "1e3", "12.0")]
    df = spark.createDataFrame(rows, "a string, heure_transaction string, date_transaction string, "
                                     "heure_x string, montant string, score_credit string")
    out = csv_ingest.normalize(df).collect()
    assert out[0].a is None and out[0].heure_transaction is None and out[0].date_transaction is None
    assert out[0].heure_x is None and out[0].montant is None and out[0].score_credit is None
    assert out[1].heure_transaction == "12:30:00" and out[1].date_transaction == dt.date(2024, 1, 5)
    assert out[2].heure_transaction == "12:30:45" and out[2].heure_x == "07:05:09"
    typed = csv_ingest.normalize(df.select("montant", "score_credit"),
                                 schema=spark.createDataFrame([], "montant decimal(15,2), score_credit int").schema)
    t = typed.collect()
    assert t[1].montant == Decimal("12.35") and t[2].montant == Decimal("1000.00")
    assert t[1].score_credit == 7 and t[2].score_credit == 12


def test_scheduled_loader_keeps_time(spark):
    df = spark.createDataFrame([("2024-01-05 13:45:00",)], "date_creation string")
    keep = csv_ingest.normalize(df, truncate_dates=False).first().date_creation
    trunc = csv_ingest.normalize(df).first().date_creation
    assert keep == dt.datetime(2024, 1, 5, 13, 45) and trunc == dt.date(2024, 1, 5)


def test_dependents_follow_foreign_keys():
    assert loader.dependents("clients") == ["transactions", "contrats", "sinistres", "primes"]
    assert loader.dependents("contrats") == ["sinistres", "primes"]
    assert loader.dependents("primes") == []


def _write(spark, df, path):
    csv_ingest.write_csv(df, path)
    return path


def test_load_cascade_and_failure_isolation(spark, scratch_dir):
    ts = dt.datetime(2024, 1, 1)
    clients = spark.createDataFrame([("C1", ts, "n", "p", "e", "t", dt.date(1990, 1, 1), "a", "1", "v", "France",
                                      "Jeune", 700, ts)], schemas.CLIENTS)
    primes = spark.createDataFrame([("P1", "K1", dt.date(2024, 1, 1), Decimal("1.00"), None, "Payé", ts)], schemas.PRIMES)
    root = os.path.join(scratch_dir, "raw")
    res = loader.load_raw(spark, {"clients": _write(spark, clients, f"{scratch_dir}/c"),
                                  "primes": _write(spark, primes, f"{scratch_dir}/p")}, root)
    assert [(r.table, r.status, r.rows) for r in res] == [("clients", "loaded", 1), ("primes", "loaded", 1)]
    # reloading only the parent empties the dependents that were not reloaded (cascade)
    res = loader.load_raw(spark, {"clients": f"{scratch_dir}/c", "contrats": f"{scratch_dir}/missing"}, root)
    st = {r.table: r.status for r in res}
    assert st == {"clients": "loaded", "contrats": "failed"} and not loader.all_loaded(res)
    assert loader.read_table(spark, root, "primes").count() == 0
    meta = spark.read.parquet(f"{root}/clients").schema["client_id"].metadata
    assert "comment" in meta


def test_stream_ingest_exactly_once(spark, scratch_dir):
    from finsight.streaming.ingest import run_ingest
    ts = dt.datetime(2024, 1, 1, 2, 0)
    mk = lambda i: spark.createDataFrame(
        [(f"T{i}", "C1", dt.date(2024, 1, i), "10:00:00", Decimal("5.00"), "EUR", "Carte", "Web", "x", "France",
          "ok", ts)], schemas.TRANSACTIONS)
    land, target, ckpt = f"{scratch_dir}/land", f"{scratch_dir}/raw", f"{scratch_dir}/ck"
    csv_ingest.write_csv(mk(1), f"{land}/b1")
    assert run_ingest(spark, "transactions", f"{land}/*", target, ckpt).count() == 1
    assert run_ingest(spark, "transactions", f"{land}/*", target, ckpt).count() == 1  # nothing new
    csv_ingest.write_csv(mk(2), f"{land}/b2")
    out = run_ingest(spark, "transactions", f"{land}/*", target, ckpt)
    assert sorted(r.transaction_id for r in out.collect()) == ["T1", "T2"]
    assert out.filter(F.col("montant") == Decimal("5.00")).count() == 2


def test_jdbc_writer_and_reader_options(spark):
    from finsight.sources import jdbc
    df = spark.createDataFrame([(1,)], "x int")
    w = jdbc.writer(df, "jdbc:postgresql://db/x", "raw.clients", {"user": "u"}, num_partitions=4)
    opts = w._jwrite.getClass()  # constructed without contacting any server
    assert opts is not None
    r = jdbc.reader(spark, "jdbc:postgresql://db/x", "raw.clients", partition_column="id",
                    lower_bound=0, upper_bound=100, num_partitions=4)
    assert r is not None
    import pytest
    with pytest.raises(ValueError):
        jdbc.reader(spark, "jdbc:postgresql://db/x", "t", partition_column="id")


def test_require_non_empty_raises(spark):
    import pytest
    from finsight.operators import monitoring
    counts = monitoring.row_counts({"a": spark.range(3), "b": spark.range(0)})
    with pytest.raises(monitoring.EmptyTableError):
        monitoring.require_non_empty(counts)
    assert monitoring.require_non_empty(monitoring.row_counts({"a": spark.range(3)})) == [("a", 3)]


def test_transactions_partitioned_and_pruned(spark, scratch_dir):
    ts = dt.datetime(2024, 1, 1, 2, 0)
    rows = [(f"T{i}", "C1", dt.date(2024, 1, 1 + i), "10:00:00", Decimal("5.00"), "EUR", "Carte", "Web", "x",
             "France", "ok", ts) for i in range(5)]
    df = spark.createDataFrame(rows, schemas.TRANSACTIONS)
    path = _write(spark, df, f"{scratch_dir}/t")
    root = f"{scratch_dir}/raw"
    res = loader.load_raw(spark, {"transactions": path}, root)
    assert res[0].status == "loaded" and res[0].rows == 5
    back = loader.read_table(spark, root, "transactions")
    assert back.columns == schemas.TRANSACTIONS.fieldNames()
    q = back.filter(F.col("date_transaction") >= dt.date(2024, 1, 4))
    plan = q._sc._jvm.PythonSQLUtils.explainString(q._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [isnotnull(date_transaction" in plan and q.count() == 2


def test_load_into_catalog_tables(spark, scratch_dir):
    ts = dt.datetime(2024, 1, 1)
    clients = spark.createDataFrame([("C9", ts, "n", "p", "e", "t", dt.date(1990, 1, 1), "a", "1", "v", "France",
                                      "Jeune", 700, ts)], schemas.CLIENTS)
    spark.sql("CREATE DATABASE IF NOT EXISTS raw_test")
    res = loader.load_raw(spark, {"clients": _write(spark, clients, f"{scratch_dir}/c")}, database="raw_test")
    assert res[0].status == "loaded" and res[0].rows == 1
    assert spark.table("raw_test.clients").first().client_id == "C9"
    # dependents were emptied as tables of the same database
    assert spark.table("raw_test.transactions").count() == 0


def test_missing_csv_columns_come_back_null(spark, scratch_dir):
    df = spark.createDataFrame([("K1", "C1", "Auto", "2024-01-05", "12.50")],
                               "contrat_id string, client_id string, type_produit string, date_effet string, "
                               "prime_mensuelle string")
    path = f"{scratch_dir}/partial_contrats"
    csv_ingest.write_csv(df, path)
    out = csv_ingest.ingest_csv(spark, "contrats", path)
    assert out.columns == schemas.CONTRATS.fieldNames()
    r = out.first()
    assert r.prime_mensuelle == Decimal("12.50") and r.date_effet == dt.date(2024, 1, 5)
    assert r.franchise is None and r.statut is None and r.loaded_at is None


def test_quotes_line_breaks_and_backslashes(spark, scratch_dir):
    import os

    from finsight.sources import csv_ingest
    text = 'client_id,nom,adresse\r\nC1,"A ""B"" C","1 rue X\nBat 2"\r\nC2,"D, E","C:\\"\r\nC3,F,\\\r\n'
    path = os.path.join(scratch_dir, "clients.csv")
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    rows = [tuple(r) for r in csv_ingest.read_csv_strings(spark, path).collect()]
    assert rows == [("C1", 'A "B" C', "1 rue X\nBat 2"), ("C2", "D, E", "C:\\"), ("C3", "F", "\\")]
    df = csv_ingest.read_csv_strings(spark, path)
    csv_ingest.write_csv(df, os.path.join(scratch_dir, "again"))
    again = csv_ingest.read_csv_strings(spark, os.path.join(scratch_dir, "again"))
    assert sorted(map(tuple, again.collect())) == sorted(rows)


def test_number_suffixes_and_hexadecimals_are_no_numbers(spark):
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from finsight.sources import csv_ingest
    df = spark.createDataFrame([(x,) for x in ("12d", "12f", "0x1p3", "1e2", " 7.50 ", "-.5", "+3.", "nan")], "x string")
    got = [r[0] for r in df.select(csv_ingest.parse_number(F.col("x"), T.DecimalType(10, 2))).collect()]
    assert [None if v is None else float(v) for v in got] == [None, None, None, 100.0, 7.5, -0.5, 3.0, None]


def test_stream_refuses_files_with_columns_in_another_order(spark, scratch_dir):
    import os

    import pytest

    from finsight import schemas
    from finsight.streaming.ingest import run_ingest
    names = schemas.TRANSACTIONS.fieldNames()
    swapped = [names[1], names[0], *names[2:]]
    os.makedirs(os.path.join(scratch_dir, "landing"))
    with open(os.path.join(scratch_dir, "landing", "a.csv"), "w", encoding="utf-8") as f:
        f.write(",".join(swapped) + "\nCLI_1,TRX_1" + "," * (len(names) - 2) + "\n")
    with pytest.raises(Exception, match="STREAM_FAILED|FAILED_READ_FILE|header"):
        run_ingest(spark, "transactions", os.path.join(scratch_dir, "landing"), os.path.join(scratch_dir, "raw"),
                   os.path.join(scratch_dir, "ckpt"))


def test_child_whose_load_fails_is_left_empty(spark, scratch_dir):
    import os

    from finsight import schemas
    from finsight.sources import csv_ingest, loader
    root = os.path.join(scratch_dir, "raw")
    paths = {}
    for t in ("clients", "transactions"):
        row = {c: None for c in schemas.RAW_SCHEMAS[t].fieldNames()} | {"client_id": "C1"}
        if t == "transactions":
            row |= {"transaction_id": "T1", "date_transaction": "2024-01-01", "montant": "5"}
        df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} string" for c in row))
        paths[t] = os.path.join(scratch_dir, f"{t}.csv")
        csv_ingest.write_csv(df, paths[t])
    assert loader.all_loaded(loader.load_raw(spark, paths, root))
    assert loader.read_table(spark, root, "transactions").count() == 1
    paths["transactions"] = os.path.join(scratch_dir, "missing.csv")
    status = {r.table: r.status for r in loader.load_raw(spark, paths, root)}
    assert status == {"clients": "loaded", "transactions": "failed"}
    assert loader.read_table(spark, root, "transactions").count() == 0
