"""Derive the five raw tables from the driver's generated tables (customer, events, orders,
lineitem), so that every model runs on data that grows with the inputs.

All expressions are row-local projections except ``sinistres`` (lineitem joined to orders on the
order key) and ``primes`` (per-contract schedule expansion). Dates of orders/lineitems are moved
by a fixed offset so that contracts, claims and transactions share one calendar.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finsight import schemas
from finsight.functions import ntz_literal
from finsight.params import Params
from finsight.sources.schedule import due_dates

# Fixed values of the fixture mapping.
DATE_SHIFT_DAYS = 8218
LOADED_AT = dt.datetime(2024, 2, 15, 2, 0, 0)
NOM = [" dupont", "LE GOFF", "o'neil"]
PRENOM = ["jean-pierre", " ANNE ", "marie claude"]
SEGMENTS = {"HOUSEHOLD": "Particulier", "BUILDING": "Professionnel", "MACHINERY": "Premium",
            "AUTOMOBILE": "Jeune"}
EVENT_TYPES = {"click": "Carte", "view": "Prélèvement", "purchase": "virement SEPA",
               "error": "Cheque", "signup": "Especes"}
CANAUX = ["Web", "app", "Guichet", "DAB", "Mobile", "Courrier"]
PAYS_ETRANGERS = ["Espagne", "Italie", "Belgique"]
PRODUITS = ["Auto", "Habitation", "Santé", "Vie", "Épargne"]
MODES_PAIEMENT = ["Prélèvement", "Virement", "Carte"]
TYPES_SINISTRE = ["Accident", " Vol ", "Dégât des eaux"]

DRIVER_TABLES = ("customer", "events", "orders", "lineitem")


def padded_id(prefix: str, key: Column, width: int) -> Column:
    """prefix + zero-padded key; keys wider than ``width`` are kept whole (never truncated)."""
    s = key.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0")))


def _pick(index: Column, values: list[str]) -> Column:
    expr = F.lit(None).cast("string")
    for i in range(len(values) - 1, -1, -1):
        expr = F.when(index == i, F.lit(values[i])).otherwise(expr)
    return expr


def _map(col: Column, mapping: dict[str, str]) -> Column:
    expr = F.lit(None).cast("string")
    for k, v in mapping.items():
        expr = F.when(col == k, F.lit(v)).otherwise(expr)
    return expr


def _shift(d: Column) -> Column:
    return F.date_add(d.cast("date"), DATE_SHIFT_DAYS)


# Pinned read schemas of the driver tables (columns the mapping uses): no footer-based inference.
DRIVER_SCHEMAS = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_mktsegment STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_shipdate TIMESTAMP_NTZ",
}


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(DRIVER_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def load_driver_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: read_driver_table(spark, sf_dir, t) for t in DRIVER_TABLES}


def clients(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return customer.select(
        padded_id("CLI_", k, 6).alias("client_id"),
        F.date_add(F.lit(dt.date(2022, 1, 1)), (k * 37 % 770).cast("int")).cast("timestamp_ntz")
        .alias("date_creation"),
        _pick(k % 3, NOM).alias("nom"),
        _pick(k % 3, PRENOM).alias("prenom"),
        F.when(k % 97 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("  "), F.col("c_name"), F.lit("@Mail.FR"))).alias("email"),
        F.concat(F.lit("06 12."), k.cast("string")).alias("telephone"),
        F.date_sub(F.lit(dt.date(2006, 1, 1)), (k * 131 % 20000).cast("int")).alias("date_naissance"),
        F.lit(" 1 rue X ").alias("adresse"),
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("code_postal"),
        F.when(k % 2 == 0, F.lit("saint-étienne")).otherwise(F.lit("LE MANS")).alias("ville"),
        F.lit(" France").alias("pays"),
        _map(F.col("c_mktsegment"), SEGMENTS).alias("segment_client"),
        (F.lit(500) + k * 17 % 351).cast("int").alias("score_credit"),
        ntz_literal(LOADED_AT).alias("loaded_at"),
    )


def transactions(events: DataFrame) -> DataFrame:
    e = F.col("event_id")
    ts = F.date_trunc("second", F.col("ts"))
    pays = (F.when(e % 20 == 0, _pick(e % 3, PAYS_ETRANGERS))
            .when(e % 41 == 0, F.lit(" France "))
            .when(e % 53 == 0, F.lit(None).cast("string"))
            .otherwise(F.lit("France")))
    return events.select(
        padded_id("TRX_", e, 8).alias("transaction_id"),
        padded_id("CLI_", F.col("user_id"), 6).alias("client_id"),
        F.col("ts").cast("date").alias("date_transaction"),
        F.date_format(ts, "HH:mm:ss").alias("heure_transaction"),
        (F.col("value").cast("decimal(13,2)") * 40).cast("decimal(15,2)").alias("montant"),
        F.lit(" eur ").alias("devise"),
        _map(F.col("event_type"), EVENT_TYPES).alias("type_transaction"),
        _pick(e % 6, CANAUX).alias("canal"),
        F.lit(" Loisirs ").alias("categorie"),
        pays.alias("pays_beneficiaire"),
        F.when(e % 50 == 0, F.lit("Refusé")).otherwise(F.lit("Validé")).alias("statut"),
        ntz_literal(LOADED_AT).alias("loaded_at"),
    )


def _contract_columns(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    effet = _shift(F.col("o_orderdate"))
    produit = _pick(k % 5, PRODUITS)
    prime = ((F.lit(2000) + k * 1337 % 98000).cast("decimal(12,2)") * F.lit(0.01).cast("decimal(2,2)")) \
        .cast("decimal(10,2)")
    return orders.select(
        k.alias("o_orderkey"),
        padded_id("CTR_", k, 6).alias("contrat_id"),
        padded_id("CLI_", F.col("o_custkey"), 6).alias("client_id"),
        F.concat(F.lit("PRD_"), F.substring(F.col("o_orderpriority"), 1, 1)).alias("produit_id"),
        produit.alias("type_produit"),
        effet.alias("date_souscription"),
        effet.alias("date_effet"),
        F.date_add(effet, (F.lit(360) * (F.lit(1) + k * 7 % 11 % 5)).cast("int")).alias("date_echeance"),
        prime.alias("prime_mensuelle"),
        F.when(produit == "Santé", F.lit(0).cast("decimal(15,2)"))
        .otherwise(F.col("o_totalprice").cast("decimal(15,2)")).alias("capital_assure"),
        (F.lit(100) * (k % 4)).cast("decimal(10,2)").alias("franchise"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Résilié")).otherwise(F.lit("Actif")).alias("statut"),
        _pick(k % 3, MODES_PAIEMENT).alias("mode_paiement"),
        ntz_literal(LOADED_AT).alias("loaded_at"),
    )


def contrats(orders: DataFrame) -> DataFrame:
    return _contract_columns(orders).select(*schemas.CONTRATS.fieldNames())


def sinistres(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    li = lineitem
    o = orders.select(F.col("o_orderkey"), F.col("o_custkey"))
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
    ln = F.col("l_linenumber")
    survenance = _shift(F.col("l_shipdate"))
    declare = (F.col("l_extendedprice").cast("decimal(12,2)") * F.lit(0.12).cast("decimal(2,2)")) \
        .cast("decimal(12,2)")
    indemnise = F.when(ln == 7, F.lit(0).cast("decimal(12,2)")).otherwise(
        (declare * (F.lit(1) - F.lit(3) * F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(12,2)"))
    return j.select(
        F.concat_ws("_", F.lit("SIN"), F.col("l_orderkey").cast("string"), ln.cast("string"),
                    F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"),
                    F.col("l_shipdate").cast("date").cast("string")).alias("sinistre_id"),
        padded_id("CTR_", F.col("l_orderkey"), 6).alias("contrat_id"),
        padded_id("CLI_", F.col("o_custkey"), 6).alias("client_id"),
        F.date_add(survenance, ln).alias("date_declaration"),
        survenance.alias("date_survenance"),
        _pick(ln % 3, TYPES_SINISTRE).alias("type_sinistre"),
        declare.alias("montant_declare"),
        indemnise.alias("montant_indemnise"),
        F.when(ln == 7, F.lit("Rejeté")).otherwise(F.lit("Clos")).alias("statut"),
        (F.lit(5) + F.col("l_partkey") % 60).cast("int").alias("delai_traitement_jours"),
        ntz_literal(LOADED_AT).alias("loaded_at"),
    )


# Contracts of one task of the schedule expansion (about a million rows out).
CONTRACTS_PER_TASK = 40_000


def _spread(df: DataFrame) -> DataFrame:
    """The schedule expansion multiplies rows ~25x: when the contract input arrives in fewer
    splits than there are cores (one small file) or than its rows need (a split of Parquet holds millions
    of contracts), spread the narrow contract rows first. Inputs already split into as many partitions
    are left untouched (no extra shuffle)."""
    from finsight.session import default_parallelism
    par = max(default_parallelism(df.sparkSession), -(-df.count() // CONTRACTS_PER_TASK))  # footers only
    try:
        splits = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD view on a remote session: leave the plan as is
        return df
    # hash on the order key: unlike round-robin, needs no sort to be deterministic on retry
    return df.repartition(par, "o_orderkey") if splits < par else df


def primes(orders: DataFrame, horizon: dt.date) -> DataFrame:
    c = _spread(_contract_columns(orders).select("o_orderkey", "contrat_id", "prime_mensuelle",
                                                 "date_effet", "date_echeance"))
    x = c.select("o_orderkey", "contrat_id", "prime_mensuelle",
                 F.explode(due_dates(F.col("date_effet"), F.col("date_echeance"), horizon)).alias("d"))
    d = F.col("d")
    kk = (F.col("o_orderkey") + F.dayofmonth(d)) % 20
    return x.select(
        F.concat(F.lit("PRM_"), F.col("o_orderkey").cast("string"), F.lit("_"), d.cast("string"))
        .alias("prime_id"),
        F.col("contrat_id"),
        d.alias("date_echeance"),
        F.col("prime_mensuelle").alias("montant_prime"),
        F.when(kk == 0, F.lit(None).cast("date")).when(kk == 1, F.date_add(d, 20))
        .when(kk == 2, F.date_add(d, 7)).otherwise(F.date_add(d, 3)).alias("date_paiement"),
        F.when(kk == 0, F.lit("Impayé")).when(kk == 1, F.lit("Retard")).when(kk == 2, F.lit(" payé"))
        .otherwise(F.lit("Payé")).alias("statut_paiement"),
        ntz_literal(LOADED_AT).alias("loaded_at"),
    )


class RawTables(dict):
    """The five raw tables derived from ``sf_dir``; each is built on first access only."""

    BUILDERS = {
        "clients": lambda d, p: clients(d("customer")),
        "transactions": lambda d, p: transactions(d("events")),
        "contrats": lambda d, p: contrats(d("orders")),
        "sinistres": lambda d, p: sinistres(d("lineitem"), d("orders")),
        "primes": lambda d, p: primes(d("orders"), p.as_of),
    }

    def __init__(self, spark: SparkSession, sf_dir: str, p: Params):
        super().__init__()
        self._spark, self._dir, self._p = spark, sf_dir, p
        self._drv: dict[str, DataFrame] = {}

    def _driver(self, name: str) -> DataFrame:
        if name not in self._drv:
            self._drv[name] = read_driver_table(self._spark, self._dir, name)
        return self._drv[name]

    def __missing__(self, name: str) -> DataFrame:
        if name not in self.BUILDERS:
            raise KeyError(name)
        df = self.BUILDERS[name](self._driver, self._p)
        self[name] = df
        return df

    def keys(self):
        return self.BUILDERS.keys()

    def __iter__(self):
        return iter(self.BUILDERS)

    def items(self):
        return [(k, self[k]) for k in self.BUILDERS]


def raw_tables(spark: SparkSession, sf_dir: str, p: Params | None = None) -> RawTables:
    """The five raw tables, lazily derived from ``sf_dir``."""
    return RawTables(spark, sf_dir, p or Params())


# ---------------------------------------------------------------- CSV exports with defects
# Fixture for the ingestion path: the raw rows rendered as CSV text with deterministic defects
# (bad / short times, unparsable or over-precise numbers, blank and NA tokens, dates with a time
# of day). Which row gets which defect depends only on its id.
def transactions_csv_text(events: DataFrame) -> DataFrame:
    t = transactions(events)
    e = F.substring(F.col("transaction_id"), 5, 64).cast("long")
    h = F.col("heure_transaction")
    m = F.col("montant").cast("string")
    d = F.col("date_transaction").cast("string")
    return t.select(
        "transaction_id", "client_id",
        F.when(e % 23 == 0, F.lit("bad-date")).when(e % 29 == 0, F.concat(d, F.lit(" 13:45:00")))
        .when(e % 31 == 0, F.lit("")).otherwise(d).alias("date_transaction"),
        F.when(e % 11 == 0, F.lit("25:99")).when(e % 7 == 0, F.substring(h, 1, 5)).otherwise(h)
        .alias("heure_transaction"),
        F.when(e % 13 == 0, F.lit("abc")).when(e % 17 == 0, F.lit("   ")).when(e % 19 == 0, F.concat(m, F.lit("5")))
        .otherwise(m).alias("montant"),
        F.when(e % 37 == 0, F.lit("NA")).when(e % 43 == 0, F.lit("null")).otherwise(F.col("devise")).alias("devise"),
        "type_transaction", "canal", "categorie", "pays_beneficiaire", "statut",
        F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss").alias("loaded_at"),
    )


def clients_csv_text(customer: DataFrame) -> DataFrame:
    c = clients(customer).withColumn("k", F.substring(F.col("client_id"), 5, 64).cast("long"))
    return c.select(
        "client_id",
        F.concat(F.col("date_creation").cast("date").cast("string"), F.lit(" 14:30:00")).alias("date_creation"),
        "nom", "prenom",
        F.when(F.col("k") % 5 == 0, F.lit("   ")).otherwise(F.col("email")).alias("email"),
        "telephone", F.col("date_naissance").cast("string").alias("date_naissance"), "adresse", "code_postal",
        "ville", "pays", "segment_client",
        F.when(F.col("k") % 3 == 0, F.concat(F.col("score_credit").cast("string"), F.lit(".0")))
        .otherwise(F.col("score_credit").cast("string")).alias("score_credit"),
        F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss").alias("loaded_at"),
    )


# Fixed values: (column, modulus, remainder, text) of the defects that a declared table refuses; of a column's defects the first counts.
REFUSED = {
    "clients": [("client_id", 71, 3, ""), ("nom", 41, 5, "x" * 120), ("ville", 43, 7, " " * 60 + "Lyon" + " " * 60),
                ("score_credit", 53, 9, "99999999999"), ("score_credit", 59, 1, "unknown")],
    "transactions": [("montant", 61, 2, "123456789012345678.9"), ("client_id", 67, 4, "CLI_none"), ("canal", 73, 5, "y" * 51),
                     ("date_transaction", 79, 6, "31/31/2024")],
    "contrats": [("capital_assure", 37, 2, "1e15"), ("statut", 47, 1, "z" * 60)],
    "sinistres": [("montant_declare", 83, 3, "-99999999999.99"), ("delai_traitement_jours", 89, 2, "2147483648")],
    "primes": [("montant_prime", 97, 0, "100000000")],
}
# Rows whose number is a multiple come twice, as they are or with another text in a column.
SAME_TWICE, OTHER_TWICE = 31, 29
OTHER_COLUMN = {"clients": "adresse", "transactions": "categorie", "contrats": "mode_paiement",
                "sinistres": "type_sinistre", "primes": "statut_paiement"}


def refused_csv_text(raw: DataFrame, table: str) -> DataFrame:
    """The rows of a raw table as CSV text, some of them with values that the declared table refuses, some twice.

    Which row gets what depends on the number in its id only."""
    from finsight.schemas import PRIMARY_KEYS
    from finsight.sources.csv_ingest import to_csv_strings
    k = F.regexp_extract(PRIMARY_KEYS[table], "([0-9]+)", 1).cast("long")
    text = to_csv_strings(raw).withColumn("_k", k)
    out = {c: F.col(c) for c in raw.columns}
    for column, modulus, remainder, defect in reversed(REFUSED[table]):
        out[column] = F.when(F.col("_k") % modulus == remainder, F.lit(defect)).otherwise(out[column])
    text = text.select(*[c.alias(n) for n, c in out.items()], "_k")
    # the copies of a row are made next to it: the rows are computed once
    again, other = F.col("_k") % SAME_TWICE == 0, F.col("_k") % OTHER_TWICE == 0
    places = F.array_compact(F.array(F.lit(0), F.when(again, F.lit(1)), F.when(other, F.lit(2))))
    text = text.withColumn("_copy", F.explode(F.when(again | other, places).otherwise(F.array(F.lit(0)))))
    column = OTHER_COLUMN[table]
    return text.withColumn(column, F.when(F.col("_copy") == 2, F.lit("copy")).otherwise(F.col(column))).drop("_k", "_copy")
