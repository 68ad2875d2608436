"""Unit rows for the staging rules and their semantic traps (values at and around each border)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from finsight import schemas
from finsight.operators import staging
from finsight.params import Params

P = Params()
TS = dt.datetime(2024, 1, 1, 2, 0)


def _tx(spark, rows):
    base = dict(transaction_id="T", client_id="C", date_transaction=dt.date(2024, 1, 6), heure_transaction="10:00:00",
                montant=Decimal("10.00"), devise=" eur ", type_transaction="Carte", canal="Web", categorie="x",
                pays_beneficiaire="France", statut="Validé", loaded_at=TS)
    data = []
    for i, r in enumerate(rows):
        d = dict(base, transaction_id=f"T{i}", **r)
        data.append(tuple(d[f] for f in schemas.TRANSACTIONS.fieldNames()))
    return staging.stg_transactions(spark.createDataFrame(data, schemas.TRANSACTIONS), P)


def test_hour_bands_and_night_never_true(spark):
    hours = [0, 6, 7, 8, 18, 19, 21, 22, 23, None]
    df = _tx(spark, [dict(heure_transaction=None if h is None else f"{h:02d}:30:00") for h in hours])
    got = [(r.plage_horaire, r.is_nocturne) for r in df.orderBy("transaction_id").collect()]
    want = ["Nuit", "Nuit", "Matin", "Heures_Ouverture", "Heures_Ouverture", "Soiree", "Soiree", "Soiree", "Nuit",
            "Matin"]
    assert [g[0] for g in got] == want
    assert all(g[1] is False for g in got)  # BETWEEN 22 AND 6 is never true


def test_fix_night_flag(spark):
    h = F.lit(23)
    row = spark.range(1).select(staging.is_night(h, Params(fix_night=True)).alias("fixed"),
                                staging.is_night(h, P).alias("literal")).first()
    assert row.fixed is True and row.literal is False


def test_accented_types_fall_to_autre(spark):
    types = ["Prélèvement", "PRELEVEMENT", "Chèque", "Cheque", "Espèces", "Especes", None, "virement sepa"]
    df = _tx(spark, [dict(type_transaction=t) for t in types])
    got = [r.type_transaction_std for r in df.orderBy("transaction_id").collect()]
    assert got == ["Autre", "Prélèvement", "Autre", "Chèque", "Autre", "Espèces", "Autre", "Virement"]


def test_international_uses_untrimmed_value(spark):
    pays = ["France", "FRANCE", " France ", "Italie", None]
    df = _tx(spark, [dict(pays_beneficiaire=p) for p in pays])
    got = [(r.is_international, r.pays_beneficiaire) for r in df.orderBy("transaction_id").collect()]
    assert [g[0] for g in got] == [False, False, True, True, False]
    assert got[2][1] == "FRANCE"


def test_channels_weekend_amount(spark):
    canaux = ["web", "app", "Guichet", "DAB", "Courrier"]
    df = _tx(spark, [dict(canal=c, montant=Decimal(m)) for c, m in zip(canaux, ["5000", "5000.01", "1", "1", "1"])])
    got = [(r.canal_std, r.is_montant_eleve, r.is_weekend, r.jour_semaine) for r in df.orderBy("transaction_id").collect()]
    assert [g[0] for g in got] == ["Web", "Mobile", "Agence", "ATM", "Autre"]
    assert [g[1] for g in got] == [False, True, False, False, False]
    assert got[0][2] is True and got[0][3] == 6  # 2024-01-06 is a Saturday


def test_credit_classes(spark):
    scores = [749, 750, 649, 650, 549, 550, None]
    assert [r.c for r in spark.createDataFrame([(s,) for s in scores], "s int")
            .select(staging.credit_class(F.col("s")).alias("c")).collect()] == \
        ["Bon", "Excellent", "Moyen", "Bon", "Faible", "Moyen", "Faible"]


def _ct(spark, rows):
    base = dict(contrat_id="K", client_id="C", produit_id="P", type_produit="Auto",
                date_souscription=dt.date(2023, 1, 1), date_effet=dt.date(2023, 1, 1), date_echeance=dt.date(2025, 1, 1),
                prime_mensuelle=Decimal("60.00"), capital_assure=Decimal("1000.00"), franchise=Decimal("0.00"),
                statut="Actif", mode_paiement=" Carte ", loaded_at=TS)
    data = [tuple(dict(base, contrat_id=f"K{i}", **r)[f] for f in schemas.CONTRATS.fieldNames())
            for i, r in enumerate(rows)]
    return staging.stg_contrats(spark.createDataFrame(data, schemas.CONTRATS), P)


def test_contract_status_flags(spark):
    rows = [dict(statut="Actif", date_echeance=dt.date(2024, 1, 1)), dict(statut=" Actif"),
            dict(statut="Résilié"), dict(statut="RESILIE"), dict(type_produit=" Auto"),
            dict(prime_mensuelle=Decimal("100.01"), capital_assure=Decimal("50000.01"))]
    got = [(r.is_actif, r.is_resilie, r.is_echu, r.categorie_produit, r.segment_valeur, r.statut)
           for r in _ct(spark, rows).orderBy("contrat_id").collect()]
    assert got[0][:3] == (False, False, True)          # active but expired
    assert got[1][0] is False and got[1][5] == "ACTIF"  # untrimmed status is not active
    assert got[2][1] is True and got[3][1] is True
    assert got[4][3] == "Autre"                       # untrimmed product type
    assert got[5][4] == "Premium" and got[0][4] == "Standard"


def test_premium_rows(spark):
    base = dict(prime_id="R", contrat_id="K", date_echeance=dt.date(2024, 1, 10), montant_prime=Decimal("10.00"),
                date_paiement=None, statut_paiement="Payé", loaded_at=TS)
    delays = [None, -1, 0, 5, 6, 15, 16, 30, 31]
    rows = []
    for i, dly in enumerate(delays):
        pay = None if dly is None else base["date_echeance"] + dt.timedelta(days=dly)
        rows.append(tuple(dict(base, prime_id=f"R{i}", date_paiement=pay, statut_paiement=" payé ")[f]
                          for f in schemas.PRIMES.fieldNames()))
    df = staging.stg_primes(spark.createDataFrame(rows, schemas.PRIMES), P).orderBy("prime_id")
    got = [(r.retard_jours, r.categorie_retard, r.is_paiement_a_temps, r.is_paye) for r in df.collect()]
    assert got[0][0] == (P.as_of - base["date_echeance"]).days  # unpaid: delay to the as-of date
    assert [g[1] for g in got[1:]] == ["A_temps", "A_temps", "Retard_Court", "Retard_Court", "Retard_Court",
                                       "Retard_Moyen", "Retard_Moyen", "Retard_Long"]
    assert [g[2] for g in got] == [False, True, True, True, False, False, False, False, False]
    assert all(g[3] for g in got)  # ' payé ' is trimmed and upper-cased before the test


def test_claim_rows(spark):
    base = dict(sinistre_id="S", contrat_id="K", client_id="C", date_declaration=dt.date(2024, 1, 10),
                date_survenance=dt.date(2024, 1, 3), type_sinistre=" Vol ", montant_declare=Decimal("100.00"),
                montant_indemnise=Decimal("80.00"), statut="Clos", delai_traitement_jours=30, loaded_at=TS)
    cases = [dict(), dict(montant_declare=Decimal("0.00")), dict(montant_declare=None),
             dict(delai_traitement_jours=None), dict(delai_traitement_jours=31), dict(montant_indemnise=Decimal("79.99")),
             dict(statut="rejete")]
    rows = [tuple(dict(base, sinistre_id=f"S{i}", **c)[f] for f in schemas.SINISTRES.fieldNames())
            for i, c in enumerate(cases)]
    df = staging.stg_sinistres(spark.createDataFrame(rows, schemas.SINISTRES), P).orderBy("sinistre_id")
    got = df.collect()
    assert got[0].is_traitement_satisfaisant is True and got[0].taux_indemnisation_pct == 80.0
    assert got[1].taux_indemnisation_pct == 0.0
    assert got[2].categorie_montant == "Majeur"
    assert got[3].categorie_delai == "Tres_Long"
    assert got[4].is_traitement_satisfaisant is False and got[4].categorie_delai == "Long"
    assert got[5].is_traitement_satisfaisant is False
    assert got[6].is_rejete is True and got[0].delai_declaration_jours == 7
