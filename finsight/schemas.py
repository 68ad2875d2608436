"""Typed schemas of the five raw tables (the raw layer's contract).

``heure_transaction`` is kept as an ``HH:mm:ss`` string: Spark's TIME type is not enabled by
default; the staged timestamp is derived from date + time. Length limits of the source DDL
are kept in ``MAX_LENGTHS`` and enforced as a data check, not by the type. Every field is
nullable: the raw layer accepts what arrives, and the key / not-null checks (``PRIMARY_KEYS``,
``finsight.operators.quality``) report violations.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, TS = T.StringType(), T.DateType(), T.TimestampNTZType()


def _dec(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


CLIENTS = T.StructType([
    T.StructField("client_id", S),
    T.StructField("date_creation", TS),
    T.StructField("nom", S),
    T.StructField("prenom", S),
    T.StructField("email", S),
    T.StructField("telephone", S),
    T.StructField("date_naissance", D),
    T.StructField("adresse", S),
    T.StructField("code_postal", S),
    T.StructField("ville", S),
    T.StructField("pays", S),
    T.StructField("segment_client", S),
    T.StructField("score_credit", T.IntegerType()),
    T.StructField("loaded_at", TS),
])

TRANSACTIONS = T.StructType([
    T.StructField("transaction_id", S),
    T.StructField("client_id", S),
    T.StructField("date_transaction", D),
    T.StructField("heure_transaction", S),
    T.StructField("montant", _dec(15, 2)),
    T.StructField("devise", S),
    T.StructField("type_transaction", S),
    T.StructField("canal", S),
    T.StructField("categorie", S),
    T.StructField("pays_beneficiaire", S),
    T.StructField("statut", S),
    T.StructField("loaded_at", TS),
])

CONTRATS = T.StructType([
    T.StructField("contrat_id", S),
    T.StructField("client_id", S),
    T.StructField("produit_id", S),
    T.StructField("type_produit", S),
    T.StructField("date_souscription", D),
    T.StructField("date_effet", D),
    T.StructField("date_echeance", D),
    T.StructField("prime_mensuelle", _dec(10, 2)),
    T.StructField("capital_assure", _dec(15, 2)),
    T.StructField("franchise", _dec(10, 2)),
    T.StructField("statut", S),
    T.StructField("mode_paiement", S),
    T.StructField("loaded_at", TS),
])

SINISTRES = T.StructType([
    T.StructField("sinistre_id", S),
    T.StructField("contrat_id", S),
    T.StructField("client_id", S),
    T.StructField("date_declaration", D),
    T.StructField("date_survenance", D),
    T.StructField("type_sinistre", S),
    T.StructField("montant_declare", _dec(12, 2)),
    T.StructField("montant_indemnise", _dec(12, 2)),
    T.StructField("statut", S),
    T.StructField("delai_traitement_jours", T.IntegerType()),
    T.StructField("loaded_at", TS),
])

PRIMES = T.StructType([
    T.StructField("prime_id", S),
    T.StructField("contrat_id", S),
    T.StructField("date_echeance", D),
    T.StructField("montant_prime", _dec(10, 2)),
    T.StructField("date_paiement", D),
    T.StructField("statut_paiement", S),
    T.StructField("loaded_at", TS),
])

RAW_SCHEMAS: dict[str, T.StructType] = {
    "clients": CLIENTS,
    "transactions": TRANSACTIONS,
    "contrats": CONTRATS,
    "sinistres": SINISTRES,
    "primes": PRIMES,
}

# Text columns that hold a time of day, and timestamps that a load truncates to the day.
TIME_COLUMNS = {"heure_transaction"}
DAY_COLUMNS = {"date_creation"}

# Primary key and foreign keys of the raw layer (parent table, parent column).
PRIMARY_KEYS = {
    "clients": "client_id",
    "transactions": "transaction_id",
    "contrats": "contrat_id",
    "sinistres": "sinistre_id",
    "primes": "prime_id",
}
FOREIGN_KEYS = {
    "transactions": [("client_id", "clients", "client_id")],
    "contrats": [("client_id", "clients", "client_id")],
    "sinistres": [("contrat_id", "contrats", "contrat_id"), ("client_id", "clients", "client_id")],
    "primes": [("contrat_id", "contrats", "contrat_id")],
}

# Declared VARCHAR lengths of the raw DDL.
MAX_LENGTHS = {
    "clients": {"client_id": 50, "nom": 100, "prenom": 100, "email": 150, "telephone": 20,
                "code_postal": 10, "ville": 100, "pays": 50, "segment_client": 50},
    "transactions": {"transaction_id": 50, "client_id": 50, "devise": 3, "type_transaction": 50,
                     "canal": 50, "categorie": 100, "pays_beneficiaire": 50, "statut": 50},
    "contrats": {"contrat_id": 50, "client_id": 50, "produit_id": 50, "type_produit": 50,
                 "statut": 50, "mode_paiement": 50},
    "sinistres": {"sinistre_id": 50, "contrat_id": 50, "client_id": 50, "type_sinistre": 100,
                  "statut": 50},
    "primes": {"prime_id": 50, "contrat_id": 50, "statut_paiement": 50},
}

# Load order that respects the foreign keys (parents first).
LOAD_ORDER = ["clients", "transactions", "contrats", "sinistres", "primes"]
