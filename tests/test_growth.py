"""Work that must grow no faster than the input: what is exchanged, stored and done by one task."""

import datetime as dt
import os
from collections import Counter

from pyspark.sql import functions as F

from conftest import SF_SMOKE
from finsight import schemas
from finsight.operators import quality, repeats
from finsight.plans import pipeline
from finsight.plans.queries import Models
from finsight.params import Params
from finsight.sources import csv_ingest, fixtures, loader, rejects


def explained(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def clients(spark, ids, **columns):
    names = [f.name for f in schemas.CLIENTS.fields]
    return spark.createDataFrame([tuple({"client_id": i, **columns}.get(n) for n in names) for i in ids], schemas.CLIENTS)



def test_unique_checks_exchange_hashes(spark, monkeypatch):
    seen, real = [], repeats.kept
    monkeypatch.setattr(repeats, "kept", lambda df, what: (seen.append(explained(df)), real(df, what))[1])
    key = quality.Check("unique", "t", "k")
    tables = {"t": spark.createDataFrame([("a",), ("b",), ("a",), ("a",), (None,), (None,), ("c",), ("c",)], "k string")}
    assert quality.summary([key], tables).first().failures == 2
    assert "hashpartitioning(_hash" in seen[0] and "hashpartitioning(k" not in seen[0]
    assert quality.summary([key], {"t": tables["t"].distinct()}).first().failures == 0
    # keys that share a hash are told apart
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.lit(7).cast("long"))
    assert quality.summary([key], tables).first().failures == 2
    assert quality.summary([key], {"t": tables["t"].distinct()}).first().failures == 0


def test_children_are_counted_before_they_look_for_their_parent(spark):
    tables = {"c": spark.createDataFrame([("a",), ("x",), ("x",), (None,), ("y",)], "k string"),
              "p": spark.createDataFrame([("a",), ("a",), (None,)], "k string")}
    check = quality.Check("relationships", "c", "k", to_model="p", to_column="k")
    found = quality.summary([check], tables)
    assert found.first().failures == 3 == quality.failing_rows(check, tables).count()
    plan = explained(found)
    assert "partial_count(1)" in plan[plan.index("LeftAnti"):]
    assert quality.summary([check], {"c": tables["p"], "p": tables["p"]}).first().failures == 0


def test_premiums_are_expanded_in_tasks_of_bounded_rows(spark, monkeypatch):
    orders = fixtures.read_driver_table(spark, SF_SMOKE, "orders")
    whole = fixtures.primes(orders, Params().as_of)
    monkeypatch.setattr(fixtures, "CONTRACTS_PER_TASK", 50)
    spread = fixtures.primes(orders, Params().as_of)
    assert spread.rdd.getNumPartitions() == -(-orders.count() // 50) > whole.rdd.getNumPartitions()
    assert Counter(map(tuple, spread.collect())) == Counter(map(tuple, whole.collect()))


def test_sound_typed_rows_are_neither_stored_twice_nor_exchanged_whole(spark, scratch_dir, monkeypatch):
    monkeypatch.setattr(rejects, "stored", lambda *a: (_ for _ in ()).throw(AssertionError("stored")))
    m = Models(spark, SF_SMOKE)
    got = {}
    for t in ("clients", "contrats", "primes"):
        rows = rejects.typed_rules(m.raw[t], t)
        got[t] = loader.load_table(spark, t, rows, f"{scratch_dir}/raw", cascade=False, cheap=True)
        parents = {p: loader.read_table(spark, f"{scratch_dir}/raw", p) for p in got}
        judged, _ = loader.judge(spark, rows, t, parents, cheap=True)
        assert "hashpartitioning(prime_id" not in explained(judged) and "SortMergeJoin" not in explained(judged)
    assert got["primes"].rejected == 0 and got["primes"].rows == m.raw["primes"].count()


def test_repeated_and_lost_keys_of_typed_rows(spark, scratch_dir, monkeypatch):
    """Few or many repeated keys and orphans: the same reasons; nothing is left of the rows stored on the way."""
    scratch = os.path.join(spark.sparkContext.getCheckpointDir() or loader.ensure_checkpoint_dir(spark), "finsight-load").removeprefix("file:")
    before = set(os.listdir(scratch)) if os.path.isdir(scratch) else set()
    day = dt.date(2024, 1, 1)
    names = [f.name for f in schemas.CONTRATS.fields]
    rows = [("K1", "C1"), ("K1", "C2"), ("K2", "C9"), ("K3", None), (None, "C1"), ("K4", "C9"), ("K5", "C1"), ("K5", "C1")]
    contrats = spark.createDataFrame([tuple({"contrat_id": k, "client_id": c, "date_effet": day}.get(n) for n in names) for k, c in rows],
                                     schemas.CONTRATS)
    seen = []
    for few in (repeats.FEW, 0):
        monkeypatch.setattr(repeats, "FEW", few)
        root = f"{scratch_dir}/raw{few}"
        one = loader.load_table(spark, "clients", rejects.typed_rules(clients(spark, ["C1", "C2", "C2", None]), "clients"), root, cheap=True)
        assert (one.rows, one.counts) == (2, {"duplicate|client_id": 1, "key_missing|client_id": 1})
        two = loader.load_table(spark, "contrats", rejects.typed_rules(contrats, "contrats"), root, cheap=True)
        assert (two.rows, two.counts) == (3, {"duplicate|contrat_id": 2, "orphan|client_id": 2, "key_missing|contrat_id": 1})
        seen.append(sorted((r.contrat_id, r.client_id) for r in loader.read_table(spark, root, "contrats").collect() if r.client_id))
    assert seen[0] == seen[1] == [("K1", "C1"), ("K5", "C1")]
    assert (set(os.listdir(scratch)) if os.path.isdir(scratch) else set()) == before


def test_usual_dates_are_not_tried_against_every_pattern(spark, monkeypatch):
    rows = ["2024-02-29", "2023-02-29", "2024-13-01", "2024-02-15 02:00:00", "2024-02-15 24:00:00", " 2024-02-15 ", "2024-02-15\n", "0000-01-01",
            "0001-01-01", "2024-2-5", "2024/02/05", "02/05/2024", "2024-02-15T02:00:00", "2024-02-15 02:00", "x", "12024-01-01", None]
    text = spark.createDataFrame([(r,) for r in rows], "t string")
    tried = csv_ingest._first_parse(F.col("t"), csv_ingest.TIMESTAMP_FORMATS).cast("timestamp_ntz")
    assert text.where(~csv_ingest.parse_timestamp(F.col("t")).eqNullSafe(tried)).count() == 0
    monkeypatch.setattr(csv_ingest, "_first_parse", lambda c, formats: F.raise_error(F.lit("tried")).cast("timestamp"))
    usual = text.where(F.col("t").isin("2024-02-29", "2023-02-29", "2024-02-15 02:00:00", "2024-02-15 24:00:00", " 2024-02-15 "))
    assert usual.select(csv_ingest.parse_date(F.col("t")).alias("d")).where("d IS NULL").count() == 2  # no such day, no such hour


def test_sound_typed_rows_are_computed_once(spark, scratch_dir):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        made.add(1)
        return text

    m = Models(spark, SF_SMOKE)
    for t in ("clients", "contrats"):
        made.value = 0
        rows = m.raw[t].withColumn(schemas.PRIMARY_KEYS[t], counted.asNondeterministic()(schemas.PRIMARY_KEYS[t]))
        got = loader.load_table(spark, t, rejects.typed_rules(rows, t), f"{scratch_dir}/raw", cascade=False, cheap=True)
        assert got.rows == made.value == m.raw[t].count()


def test_a_typed_load_that_finds_bad_keys_leaves_one_corrected_version(spark, scratch_dir):
    """The rows are read again from the version that is not published, which is deleted."""
    two = loader.load_table(spark, "clients", rejects.typed_rules(clients(spark, ["C1", "C1", "C2", None]), "clients"), scratch_dir, cheap=True)
    assert (two.rows, two.read, two.counts) == (2, 4, {"duplicate|client_id": 1, "key_missing|client_id": 1})
    assert sorted(r.client_id for r in loader.read_table(spark, scratch_dir, "clients").collect()) == ["C1", "C2"]
    assert len([d for d in os.listdir(f"{scratch_dir}/clients") if d.startswith("version=")]) == 1
    none = loader.load_table(spark, "clients", rejects.typed_rules(clients(spark, []), "clients"), scratch_dir, cheap=True)
    assert (none.rows, none.read) == (0, 0) and loader.read_table(spark, scratch_dir, "clients").count() == 0


def test_wide_projections_stay_compilable(spark):
    from finsight.session import configure_for_models
    configure_for_models(spark)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"  # HotSpot's own limit


def test_copies_of_an_export_are_made_in_one_pass(spark):
    for t in ("clients", "contrats"):
        raw = Models(spark, SF_SMOKE).raw[t]
        text = fixtures.refused_csv_text(raw, t)
        assert "Union" not in explained(text)
        k = F.regexp_extract(schemas.PRIMARY_KEYS[t], "([0-9]+)", 1).cast("long")
        want = raw.select(F.count(F.lit(1)) + F.count_if(k % fixtures.SAME_TWICE == 0) + F.count_if(k % fixtures.OTHER_TWICE == 0)).first()[0]
        assert text.count() == want
        assert text.where(F.col(fixtures.OTHER_COLUMN[t]) == "copy").count() == raw.where(k % fixtures.OTHER_TWICE == 0).count()


def test_the_text_of_one_table_lies_there_at_a_time(spark, scratch_dir, monkeypatch):
    from finsight.plans import queries
    seen = []

    def load_raw(spark, paths, root):
        (table, path), = paths.items()
        files = [f for f in os.listdir(path) if f.startswith("part-")]
        seen.append((table, os.listdir(f"{scratch_dir}/landing"), all(f.endswith(".gz") for f in files)))
        assert csv_ingest.read_csv_strings(spark, path).count() >= 100
        return [loader.LoadResult(table, "loaded")]

    monkeypatch.setattr(queries, "_scratch", lambda spark: scratch_dir)
    monkeypatch.setattr(loader, "load_raw", load_raw)
    monkeypatch.setattr(loader, "reject_counts", lambda spark, root: root)
    queries.QUERIES["ingest_rejects"](spark, SF_SMOKE)
    assert seen == [(t, [t], True) for t in schemas.LOAD_ORDER] and os.listdir(f"{scratch_dir}/landing") == []


def test_reasons_of_rows_with_none_some_and_unknown_conditions(spark):
    rows = spark.createDataFrame([(1, True, None), (2, None, None), (3, False, True), (4, True, True)], "i int, a boolean, b boolean")
    got = {r.i: r.found for r in rows.select("i", rejects._listed({"a": F.col("a"), "b": F.col("b")}).alias("found")).collect()}
    assert got == {1: ["a"], 2: [], 3: ["b"], 4: ["a", "b"]}
    assert rows.select(rejects._listed({}).alias("found")).first().found == []
