"""Independent SQL oracle (DuckDB dialect) for every query key.

Each oracle query starts from the driver tables (customer, events, orders, lineitem), re-derives the
raw layer with the fixture mapping and applies the rules literally, as set-based SQL, e.g. the
portfolio KPIs use the literal four-way fan-out join that the Spark plan avoids. The SQL is
assembled from named CTEs; ``build(key)`` pulls in the dependencies of a final SELECT.
"""

from __future__ import annotations

import re

from finsight.params import DEFAULT_AS_OF
from finsight.functions.keys import NULL_KEY_TOKEN

AS_OF = DEFAULT_AS_OF.isoformat()
D = f"DATE '{AS_OF}'"


def _pad(prefix: str, expr: str, width: int) -> str:
    s = f"CAST({expr} AS VARCHAR)"
    return f"('{prefix}' || CASE WHEN length({s}) >= {width} THEN {s} ELSE lpad({s}, {width}, '0') END)"


def _sk(*parts: str) -> str:
    items = [f"coalesce(CAST({p} AS VARCHAR), '{NULL_KEY_TOKEN}')" for p in parts]
    return f"md5({items[0]})" if len(items) == 1 else "md5(" + " || '-' || ".join(items) + ")"


def _initcap(expr: str) -> str:
    return ("list_aggregate(list_transform(regexp_extract_all(lower(" + expr + r"), '([\p{L}\p{N}]+|[^\p{L}\p{N}]+)', 1), "
            "lambda x: upper(x[1]) || x[2:]), 'string_agg', '')")


def _r(expr: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6)"


def _age_months(end: str, start: str) -> str:
    a = f"age(CAST({end} AS TIMESTAMP), CAST({start} AS TIMESTAMP))"
    return f"CAST(date_part('year', {a}) * 12 + date_part('month', {a}) AS INTEGER)"


def _age_years(end: str, start: str) -> str:
    return f"CAST(date_part('year', age(CAST({end} AS TIMESTAMP), CAST({start} AS TIMESTAMP))) AS INTEGER)"


def _age_month_part(end: str, start: str) -> str:
    return f"CAST(date_part('month', age(CAST({end} AS TIMESTAMP), CAST({start} AS TIMESTAMP))) AS INTEGER)"


LOADED = "TIMESTAMP '2024-02-15 02:00:00'"

CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    CTES[name] = sql


# ---------------------------------------------------------------- raw layer (fixture mapping)
cte("raw_clients", f"""
SELECT {_pad('CLI_', 'c_custkey', 6)} AS client_id,
       CAST(DATE '2022-01-01' + CAST(c_custkey * 37 % 770 AS INTEGER) AS TIMESTAMP) AS date_creation,
       CASE c_custkey % 3 WHEN 0 THEN ' dupont' WHEN 1 THEN 'LE GOFF' ELSE 'o''neil' END AS nom,
       CASE c_custkey % 3 WHEN 0 THEN 'jean-pierre' WHEN 1 THEN ' ANNE ' ELSE 'marie claude' END AS prenom,
       CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE '  ' || c_name || '@Mail.FR' END AS email,
       '06 12.' || CAST(c_custkey AS VARCHAR) AS telephone,
       DATE '2006-01-01' - CAST(c_custkey * 131 % 20000 AS INTEGER) AS date_naissance,
       ' 1 rue X ' AS adresse,
       lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS code_postal,
       CASE WHEN c_custkey % 2 = 0 THEN 'saint-étienne' ELSE 'LE MANS' END AS ville,
       ' France' AS pays,
       CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'Particulier' WHEN 'BUILDING' THEN 'Professionnel'
            WHEN 'MACHINERY' THEN 'Premium' WHEN 'AUTOMOBILE' THEN 'Jeune' END AS segment_client,
       CAST(500 + c_custkey * 17 % 351 AS INTEGER) AS score_credit,
       {LOADED} AS loaded_at
FROM customer""")

cte("raw_transactions", f"""
SELECT {_pad('TRX_', 'event_id', 8)} AS transaction_id,
       {_pad('CLI_', 'user_id', 6)} AS client_id,
       CAST(ts AS DATE) AS date_transaction,
       strftime(date_trunc('second', ts), '%H:%M:%S') AS heure_transaction,
       CAST(CAST(value AS DECIMAL(13,2)) * 40 AS DECIMAL(15,2)) AS montant,
       ' eur ' AS devise,
       CASE event_type WHEN 'click' THEN 'Carte' WHEN 'view' THEN 'Prélèvement'
            WHEN 'purchase' THEN 'virement SEPA' WHEN 'error' THEN 'Cheque' WHEN 'signup' THEN 'Especes' END
         AS type_transaction,
       CASE event_id % 6 WHEN 0 THEN 'Web' WHEN 1 THEN 'app' WHEN 2 THEN 'Guichet' WHEN 3 THEN 'DAB'
            WHEN 4 THEN 'Mobile' ELSE 'Courrier' END AS canal,
       ' Loisirs ' AS categorie,
       CASE WHEN event_id % 20 = 0 THEN (CASE event_id % 3 WHEN 0 THEN 'Espagne' WHEN 1 THEN 'Italie' ELSE 'Belgique' END)
            WHEN event_id % 41 = 0 THEN ' France '
            WHEN event_id % 53 = 0 THEN NULL
            ELSE 'France' END AS pays_beneficiaire,
       CASE WHEN event_id % 50 = 0 THEN 'Refusé' ELSE 'Validé' END AS statut,
       {LOADED} AS loaded_at
FROM events""")

cte("map_orders", f"""
SELECT o_orderkey,
       {_pad('CTR_', 'o_orderkey', 6)} AS contrat_id,
       {_pad('CLI_', 'o_custkey', 6)} AS client_id,
       'PRD_' || substr(o_orderpriority, 1, 1) AS produit_id,
       CASE o_orderkey % 5 WHEN 0 THEN 'Auto' WHEN 1 THEN 'Habitation' WHEN 2 THEN 'Santé' WHEN 3 THEN 'Vie'
            ELSE 'Épargne' END AS type_produit,
       CAST(o_orderdate AS DATE) + 8218 AS date_souscription,
       CAST(o_orderdate AS DATE) + 8218 AS date_effet,
       CAST(o_orderdate AS DATE) + 8218 + CAST(360 * (1 + (o_orderkey * 7) % 11 % 5) AS INTEGER) AS date_echeance,
       CAST(CAST(2000 + (o_orderkey * 1337) % 98000 AS DECIMAL(12,2)) * 0.01 AS DECIMAL(10,2)) AS prime_mensuelle,
       CASE WHEN o_orderkey % 5 = 2 THEN CAST(0 AS DECIMAL(15,2)) ELSE CAST(o_totalprice AS DECIMAL(15,2)) END
         AS capital_assure,
       CAST(100 * (o_orderkey % 4) AS DECIMAL(10,2)) AS franchise,
       CASE WHEN o_orderstatus = 'F' THEN 'Résilié' ELSE 'Actif' END AS statut,
       CASE o_orderkey % 3 WHEN 0 THEN 'Prélèvement' WHEN 1 THEN 'Virement' ELSE 'Carte' END AS mode_paiement,
       {LOADED} AS loaded_at
FROM orders""")

cte("raw_contrats", """
SELECT contrat_id, client_id, produit_id, type_produit, date_souscription, date_effet, date_echeance,
       prime_mensuelle, capital_assure, franchise, statut, mode_paiement, loaded_at
FROM map_orders""")

cte("raw_sinistres", f"""
SELECT 'SIN_' || CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) || '_' ||
         CAST(l_partkey AS VARCHAR) || '_' || CAST(l_suppkey AS VARCHAR) || '_' ||
         CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS sinistre_id,
       {_pad('CTR_', 'l_orderkey', 6)} AS contrat_id,
       {_pad('CLI_', 'o_custkey', 6)} AS client_id,
       CAST(l_shipdate AS DATE) + 8218 + l_linenumber AS date_declaration,
       CAST(l_shipdate AS DATE) + 8218 AS date_survenance,
       CASE l_linenumber % 3 WHEN 0 THEN 'Accident' WHEN 1 THEN ' Vol ' ELSE 'Dégât des eaux' END AS type_sinistre,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 0.12 AS DECIMAL(12,2)) AS montant_declare,
       CASE WHEN l_linenumber = 7 THEN CAST(0 AS DECIMAL(12,2))
            ELSE CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 0.12 AS DECIMAL(12,2))
                      * (1 - 3 * CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(12,2)) END AS montant_indemnise,
       CASE WHEN l_linenumber = 7 THEN 'Rejeté' ELSE 'Clos' END AS statut,
       CAST(5 + l_partkey % 60 AS INTEGER) AS delai_traitement_jours,
       {LOADED} AS loaded_at
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")

cte("schedule", f"""
SELECT o_orderkey, contrat_id, prime_mensuelle,
       CAST(unnest(generate_series(CAST(date_effet AS TIMESTAMP),
                                   CAST(least(date_echeance, {D}) AS TIMESTAMP), INTERVAL 30 DAY)) AS DATE) AS d
FROM map_orders""")

cte("raw_primes", f"""
SELECT 'PRM_' || CAST(o_orderkey AS VARCHAR) || '_' || CAST(d AS VARCHAR) AS prime_id,
       contrat_id, d AS date_echeance, prime_mensuelle AS montant_prime,
       CASE (o_orderkey + day(d)) % 20 WHEN 0 THEN NULL WHEN 1 THEN d + 20 WHEN 2 THEN d + 7 ELSE d + 3 END
         AS date_paiement,
       CASE (o_orderkey + day(d)) % 20 WHEN 0 THEN 'Impayé' WHEN 1 THEN 'Retard' WHEN 2 THEN ' payé' ELSE 'Payé' END
         AS statut_paiement,
       {LOADED} AS loaded_at
FROM schedule""")

# ---------------------------------------------------------------- staging
cte("stg_clients", f"""
SELECT {_sk('client_id')} AS client_key, client_id, date_creation, date_naissance,
       trim(upper(nom)) AS nom,
       trim({_initcap('prenom')}) AS prenom,
       trim(nom) || ' ' || trim(prenom) AS nom_complet,
       lower(trim(email)) AS email_normalise,
       replace(replace(telephone, ' ', ''), '.', '') AS telephone_normalise,
       trim(adresse) AS adresse, code_postal,
       trim({_initcap('ville')}) AS ville_normalise,
       upper(trim(pays)) AS pays_code,
       segment_client, score_credit,
       CASE WHEN score_credit >= 750 THEN 'Excellent' WHEN score_credit >= 650 THEN 'Bon'
            WHEN score_credit >= 550 THEN 'Moyen' ELSE 'Faible' END AS score_credit_categorie,
       {_age_years(D, 'date_naissance')} AS age,
       {_age_months(D, 'date_creation')} AS anciennete_mois,
       CAST({D} - CAST(date_creation AS DATE) AS INTEGER) AS anciennete_jours,
       coalesce({D} <= CAST(date_creation AS DATE) + INTERVAL 90 DAY, FALSE) AS is_nouveau_client,
       TRUE AS is_active,
       loaded_at
FROM raw_clients
WHERE client_id IS NOT NULL AND email IS NOT NULL AND date_creation IS NOT NULL""")

cte("stg_transactions", f"""
SELECT {_sk('transaction_id')} AS transaction_key, transaction_id,
       {_sk('client_id')} AS client_key, client_id,
       date_transaction, heure_transaction,
       date_transaction + CAST(heure_transaction AS TIME) AS timestamp_transaction,
       montant AS montant_eur, montant AS montant_original,
       upper(trim(devise)) AS devise,
       CASE WHEN upper(type_transaction) LIKE '%VIREMENT%' THEN 'Virement'
            WHEN upper(type_transaction) LIKE '%PRELEVEMENT%' THEN 'Prélèvement'
            WHEN upper(type_transaction) LIKE '%CARTE%' THEN 'Carte'
            WHEN upper(type_transaction) LIKE '%CHEQUE%' THEN 'Chèque'
            WHEN upper(type_transaction) LIKE '%ESPECE%' THEN 'Espèces'
            ELSE 'Autre' END AS type_transaction_std,
       CASE WHEN upper(canal) LIKE '%WEB%' THEN 'Web'
            WHEN upper(canal) LIKE '%MOBILE%' OR upper(canal) LIKE '%APP%' THEN 'Mobile'
            WHEN upper(canal) LIKE '%AGENCE%' OR upper(canal) LIKE '%GUICHET%' THEN 'Agence'
            WHEN upper(canal) LIKE '%ATM%' OR upper(canal) LIKE '%DAB%' THEN 'ATM'
            ELSE 'Autre' END AS canal_std,
       trim(categorie) AS categorie_std,
       upper(trim(pays_beneficiaire)) AS pays_beneficiaire,
       coalesce(upper(pays_beneficiaire) <> 'FRANCE', FALSE) AS is_international,
       CAST(hour(CAST(heure_transaction AS TIME)) AS INTEGER) AS heure,
       CAST(dayofweek(date_transaction) AS INTEGER) AS jour_semaine,
       CASE WHEN hour(CAST(heure_transaction AS TIME)) BETWEEN 8 AND 18 THEN 'Heures_Ouverture'
            WHEN hour(CAST(heure_transaction AS TIME)) BETWEEN 19 AND 22 THEN 'Soiree'
            WHEN hour(CAST(heure_transaction AS TIME)) BETWEEN 22 AND 23
              OR hour(CAST(heure_transaction AS TIME)) BETWEEN 0 AND 6 THEN 'Nuit'
            ELSE 'Matin' END AS plage_horaire,
       coalesce(dayofweek(date_transaction) IN (0, 6), FALSE) AS is_weekend,
       coalesce(hour(CAST(heure_transaction AS TIME)) BETWEEN 22 AND 6, FALSE) AS is_nocturne,
       coalesce(montant > 5000, FALSE) AS is_montant_eleve,
       upper(trim(statut)) AS statut,
       CAST(NULL AS DECIMAL(38,6)) AS score_anomalie,
       loaded_at
FROM raw_transactions
WHERE transaction_id IS NOT NULL AND client_id IS NOT NULL AND date_transaction IS NOT NULL
  AND montant IS NOT NULL""")

cte("stg_contrats", f"""
SELECT {_sk('contrat_id')} AS contrat_key, contrat_id, {_sk('client_id')} AS client_key, client_id, produit_id,
       trim(type_produit) AS type_produit_std,
       date_souscription, date_effet, date_echeance,
       {_age_months('date_echeance', 'date_effet')} AS duree_mois,
       {_age_months(D, 'date_effet')} AS anciennete_mois,
       CAST({D} - date_effet AS INTEGER) AS anciennete_jours,
       prime_mensuelle, prime_mensuelle * 12 AS prime_annuelle, capital_assure, franchise,
       CASE WHEN prime_mensuelle > 0
            THEN {_r('CAST(capital_assure AS DOUBLE) / (CAST(prime_mensuelle AS DOUBLE) * 12)')} END
         AS ratio_capital_prime,
       upper(trim(statut)) AS statut,
       coalesce(upper(statut) = 'ACTIF' AND date_echeance >= {D}, FALSE) AS is_actif,
       coalesce(upper(statut) IN ('RÉSILIÉ', 'RESILIE'), FALSE) AS is_resilie,
       coalesce(date_echeance < {D}, FALSE) AS is_echu,
       trim(mode_paiement) AS mode_paiement,
       CASE WHEN type_produit IN ('Auto', 'Habitation') THEN 'IARD'
            WHEN type_produit IN ('Vie', 'Épargne') THEN 'Vie_Epargne'
            WHEN type_produit = 'Santé' THEN 'Sante' ELSE 'Autre' END AS categorie_produit,
       CASE WHEN prime_mensuelle > 100 AND capital_assure > 50000 THEN 'Premium'
            WHEN prime_mensuelle > 50 THEN 'Standard' ELSE 'Basique' END AS segment_valeur,
       loaded_at
FROM raw_contrats
WHERE contrat_id IS NOT NULL AND client_id IS NOT NULL AND date_souscription IS NOT NULL""")

cte("stg_sinistres", f"""
SELECT {_sk('sinistre_id')} AS sinistre_key, sinistre_id,
       {_sk('contrat_id')} AS contrat_key, contrat_id,
       {_sk('client_id')} AS client_key, client_id,
       date_declaration, date_survenance,
       CAST(date_declaration - date_survenance AS INTEGER) AS delai_declaration_jours,
       trim(type_sinistre) AS type_sinistre_std,
       montant_declare, montant_indemnise,
       montant_declare - montant_indemnise AS montant_non_indemnise,
       CASE WHEN montant_declare > 0
            THEN {_r('CAST(montant_indemnise AS DOUBLE) / CAST(montant_declare AS DOUBLE) * 100')}
            ELSE 0.0 END AS taux_indemnisation_pct,
       CASE WHEN montant_declare < 500 THEN 'Petit' WHEN montant_declare < 2000 THEN 'Moyen'
            WHEN montant_declare < 10000 THEN 'Important' ELSE 'Majeur' END AS categorie_montant,
       upper(trim(statut)) AS statut_std,
       coalesce(upper(trim(statut)) = 'CLOS', FALSE) AS is_clos,
       coalesce(upper(trim(statut)) IN ('REJETÉ', 'REJETE'), FALSE) AS is_rejete,
       coalesce(montant_indemnise > 0, FALSE) AS is_indemnise,
       delai_traitement_jours,
       CASE WHEN delai_traitement_jours <= 7 THEN 'Rapide' WHEN delai_traitement_jours <= 30 THEN 'Normal'
            WHEN delai_traitement_jours <= 60 THEN 'Long' ELSE 'Tres_Long' END AS categorie_delai,
       loaded_at,
       coalesce(upper(trim(statut)) = 'CLOS' AND delai_traitement_jours <= 30
                AND montant_declare > 0 AND montant_indemnise * 100 >= montant_declare * 80, FALSE)
         AS is_traitement_satisfaisant
FROM raw_sinistres
WHERE sinistre_id IS NOT NULL AND contrat_id IS NOT NULL AND client_id IS NOT NULL""")

cte("stg_primes", f"""
SELECT {_sk('prime_id')} AS prime_key, prime_id, {_sk('contrat_id')} AS contrat_key, contrat_id,
       date_echeance, date_paiement,
       CAST(CASE WHEN date_paiement IS NOT NULL THEN date_paiement - date_echeance
                 ELSE {D} - date_echeance END AS INTEGER) AS retard_jours,
       montant_prime,
       upper(trim(statut_paiement)) AS statut_paiement_std,
       coalesce(upper(trim(statut_paiement)) IN ('PAYÉ', 'PAYE'), FALSE) AS is_paye,
       coalesce(upper(trim(statut_paiement)) IN ('IMPAYÉ', 'IMPAYE'), FALSE) AS is_impaye,
       coalesce(upper(trim(statut_paiement)) = 'RETARD', FALSE) AS is_retard,
       coalesce(date_paiement IS NOT NULL AND date_paiement - date_echeance <= 5, FALSE) AS is_paiement_a_temps,
       CAST(date_trunc('month', date_echeance) AS DATE) AS periode_mois,
       CAST(year(date_echeance) AS INTEGER) AS annee,
       CAST(month(date_echeance) AS INTEGER) AS mois,
       loaded_at,
       CASE WHEN retard IS NULL OR retard <= 0 THEN 'A_temps' WHEN retard <= 15 THEN 'Retard_Court'
            WHEN retard <= 30 THEN 'Retard_Moyen' ELSE 'Retard_Long' END AS categorie_retard
FROM (SELECT *, CASE WHEN date_paiement IS NOT NULL THEN date_paiement - date_echeance
                     ELSE {D} - date_echeance END AS retard
      FROM raw_primes)
WHERE prime_id IS NOT NULL AND contrat_id IS NOT NULL AND date_echeance IS NOT NULL""")

# ---------------------------------------------------------------- final selects per query key
FINAL: dict[str, str] = {}


def final(key: str, sql: str) -> None:
    FINAL[key] = sql


for _t in ("clients", "transactions", "contrats", "sinistres", "primes"):
    final(f"stg_{_t}", f"SELECT * FROM stg_{_t}")

_IDENT = re.compile(r"\b([a-z_][a-z0-9_]*)\b")


#: CTEs that a key sees in place of, or beside, the common ones.
OWN_CTES: dict[str, dict[str, str]] = {}


def build(key: str) -> str:
    """Full SQL for ``key``: the needed CTEs in dependency order + the final SELECT."""
    body, ctes = FINAL[key], {**CTES, **OWN_CTES.get(key, {})}

    def _deps(sql: str) -> list[str]:
        return [w for w in dict.fromkeys(_IDENT.findall(sql)) if w in ctes]

    order: list[str] = []
    seen: set[str] = set()

    def visit(name: str) -> None:
        if name in seen:
            return
        seen.add(name)
        for d in _deps(ctes[name]):
            if d != name:
                visit(d)
        order.append(name)

    for d in _deps(body):
        visit(d)
    if not order:
        return body
    head = ",\n".join(f"{n} AS ({ctes[n]})" for n in order)
    if body.lstrip().upper().startswith("WITH "):  # merge the body's own CTEs into one WITH list
        return "WITH " + head + ",\n" + body.lstrip()[5:]
    return "WITH " + head + "\n" + body


def all_queries() -> dict[str, str]:
    return {k: build(k) for k in FINAL}


# ---------------------------------------------------------------- aggregates
cte("ta", f"""
SELECT client_key,
       count(DISTINCT transaction_id) AS nb_transactions_total,
       sum(montant_eur) AS montant_total_transactions,
       CAST(sum(montant_eur) AS DOUBLE) / count(montant_eur) AS montant_moyen_transaction,
       max(date_transaction) AS date_derniere_transaction,
       min(date_transaction) AS date_premiere_transaction,
       count(DISTINCT transaction_id) FILTER (WHERE date_transaction >= {D} - 30) AS nb_transactions_30j,
       sum(CASE WHEN date_transaction >= {D} - 30 THEN montant_eur ELSE 0 END) AS montant_transactions_30j,
       count(DISTINCT transaction_id) FILTER (WHERE date_transaction >= {D} - 90) AS nb_transactions_90j,
       sum(CASE WHEN date_transaction >= {D} - 90 THEN montant_eur ELSE 0 END) AS montant_transactions_90j,
       count(DISTINCT transaction_id) FILTER (WHERE canal_std = 'Web') AS nb_trans_web,
       count(DISTINCT transaction_id) FILTER (WHERE canal_std = 'Mobile') AS nb_trans_mobile,
       count(DISTINCT transaction_id) FILTER (WHERE canal_std = 'Agence') AS nb_trans_agence,
       count(DISTINCT transaction_id) FILTER (WHERE is_nocturne) AS nb_trans_nocturnes,
       count(DISTINCT transaction_id) FILTER (WHERE is_international) AS nb_trans_internationales
FROM stg_transactions GROUP BY client_key""")

cte("cp", """
SELECT client_key,
       count(DISTINCT contrat_id) AS nb_contrats_total,
       count(DISTINCT contrat_id) FILTER (WHERE is_actif) AS nb_contrats_actifs,
       count(DISTINCT contrat_id) FILTER (WHERE is_resilie) AS nb_contrats_resilies,
       sum(CASE WHEN is_actif THEN prime_mensuelle ELSE 0 END) AS prime_mensuelle_totale,
       sum(CASE WHEN is_actif THEN capital_assure ELSE 0 END) AS capital_total_assure,
       count(DISTINCT contrat_id) FILTER (WHERE type_produit_std = 'Auto' AND is_actif) AS nb_contrats_auto,
       count(DISTINCT contrat_id) FILTER (WHERE type_produit_std = 'Habitation' AND is_actif) AS nb_contrats_habitation,
       count(DISTINCT contrat_id) FILTER (WHERE type_produit_std = 'Santé' AND is_actif) AS nb_contrats_sante,
       count(DISTINCT contrat_id) FILTER (WHERE type_produit_std = 'Vie' AND is_actif) AS nb_contrats_vie,
       CAST(sum(anciennete_mois) FILTER (WHERE is_actif) AS DOUBLE)
         / NULLIF(count(anciennete_mois) FILTER (WHERE is_actif), 0) AS anciennete_moyenne_contrats_mois,
       max(date_souscription) AS date_dernier_contrat
FROM stg_contrats GROUP BY client_key""")

cte("sh", f"""
SELECT client_key,
       count(DISTINCT sinistre_id) AS nb_sinistres_total,
       sum(montant_declare) AS montant_total_sinistres_declares,
       sum(montant_indemnise) AS montant_total_indemnise,
       count(DISTINCT sinistre_id) FILTER (WHERE date_declaration >= {D} - INTERVAL 12 MONTH) AS nb_sinistres_12m,
       count(DISTINCT sinistre_id) FILTER (WHERE is_rejete) AS nb_sinistres_rejetes,
       CAST(sum(delai_traitement_jours) AS DOUBLE) / NULLIF(count(delai_traitement_jours), 0) AS delai_moyen_traitement,
       max(date_declaration) AS date_dernier_sinistre
FROM stg_sinistres GROUP BY client_key""")

cte("sa_base", """
SELECT contrat_key,
       count(DISTINCT sinistre_id) AS nb_sinistres,
       sum(montant_declare) AS montant_total_sinistres_declares,
       sum(montant_indemnise) AS montant_total_indemnise,
       CAST(sum(montant_indemnise) AS DOUBLE) / NULLIF(count(montant_indemnise), 0) AS montant_moyen_indemnise,
       max(date_declaration) AS date_dernier_sinistre,
       CAST(sum(delai_traitement_jours) AS DOUBLE) / NULLIF(count(delai_traitement_jours), 0) AS delai_moyen_traitement,
       min(date_survenance) AS date_premier_sinistre,
       CAST(count(*) FILTER (WHERE is_clos AND NOT is_rejete) AS DOUBLE) / NULLIF(count(*), 0) AS taux_acceptation
FROM stg_sinistres GROUP BY contrat_key""")

_AGE_FIRST = f"age(CAST({D} AS TIMESTAMP), CAST(date_premier_sinistre AS TIMESTAMP))"
cte("sa", f"""
SELECT *, CASE WHEN date_premier_sinistre IS NULL THEN 0.0
               ELSE CAST(nb_sinistres AS DOUBLE) / NULLIF(CAST(date_part('year', {_AGE_FIRST}) AS DOUBLE)
                                                          + CAST(date_part('month', {_AGE_FIRST}) AS DOUBLE) / 12.0, 0.0)
          END AS frequence_sinistres_annuelle
FROM sa_base""")

cte("pa", """
SELECT contrat_key,
       count(DISTINCT prime_id) AS nb_echeances,
       sum(montant_prime) AS montant_total_primes,
       sum(CASE WHEN is_paye THEN montant_prime ELSE 0 END) AS montant_primes_payees,
       count(*) FILTER (WHERE is_impaye) AS nb_impayes,
       count(*) FILTER (WHERE is_retard) AS nb_retards,
       CAST(count(*) FILTER (WHERE is_paye) AS DOUBLE) / NULLIF(count(*), 0) AS taux_paiement,
       CAST(count(*) FILTER (WHERE is_paiement_a_temps) AS DOUBLE) / NULLIF(count(*), 0) AS taux_paiement_a_temps
FROM stg_primes GROUP BY contrat_key""")

cte("cs30", f"""
SELECT client_key,
       CAST(sum(montant_eur) AS DOUBLE) / count(montant_eur) AS avg_montant_30j,
       stddev_samp(CAST(montant_eur AS DOUBLE)) AS std_montant_30j,
       CAST(count(DISTINCT transaction_id) AS DOUBLE) / NULLIF(count(DISTINCT date_transaction), 0) AS avg_trans_par_jour,
       max(montant_eur) AS max_montant_historique,
       CAST(count(*) FILTER (WHERE is_international) AS DOUBLE) / NULLIF(count(*), 0) AS taux_trans_internationales
FROM stg_transactions WHERE date_transaction >= {D} - 30 GROUP BY client_key""")

cte("cps", """
SELECT client_key, pays_beneficiaire, count(*) AS nb_trans_pays
FROM stg_transactions GROUP BY client_key, pays_beneficiaire""")


def _round_doubles(rel: str, cols: list[str]) -> str:
    return f"SELECT * REPLACE ({', '.join(f'round({c}, 6) AS {c}' for c in cols)}) FROM {rel}"


final("trans_activity", _round_doubles("ta", ["montant_moyen_transaction"]))
final("contrats_portfolio", _round_doubles("cp", ["anciennete_moyenne_contrats_mois"]))
final("sinistres_history", _round_doubles("sh", ["delai_moyen_traitement"]))
final("sinistres_agg", _round_doubles("sa", ["montant_moyen_indemnise", "delai_moyen_traitement",
                                             "taux_acceptation", "frequence_sinistres_annuelle"]))
final("primes_agg", _round_doubles("pa", ["taux_paiement", "taux_paiement_a_temps"]))
final("client_stats_30d", _round_doubles("cs30", ["avg_montant_30j", "std_montant_30j", "avg_trans_par_jour",
                                                  "taux_trans_internationales"]))
final("client_pays_stats", "SELECT * FROM cps")

# ---------------------------------------------------------------- windows
cte("win", """
SELECT transaction_id, client_key,
       count(*) OVER (PARTITION BY client_key, date_transaction) AS nb_transactions_client_jour,
       CAST(date_diff('microsecond',
                      lag(timestamp_transaction) OVER (PARTITION BY client_key
                                                       ORDER BY timestamp_transaction NULLS LAST, transaction_id),
                      timestamp_transaction) AS DOUBLE) / 1000000.0 AS delai_depuis_derniere_sec,
       percent_rank() OVER (PARTITION BY client_key ORDER BY montant_eur) AS percentile_montant_client,
       count(*) OVER (PARTITION BY client_key, pays_beneficiaire) AS nb_trans_pays
FROM stg_transactions""")

final("win_count_client_day", "SELECT transaction_id, nb_transactions_client_jour FROM win")
final("win_lag_seconds", "SELECT transaction_id, round(delai_depuis_derniere_sec, 6) AS delai_depuis_derniere_sec FROM win")
final("win_percent_rank", "SELECT transaction_id, round(percentile_montant_client, 6) AS percentile_montant_client FROM win")
final("win_ranged_all", """
SELECT transaction_id, nb_transactions_client_jour, round(delai_depuis_derniere_sec, 6) AS delai_depuis_derniere_sec,
       round(percentile_montant_client, 6) AS percentile_montant_client, nb_trans_pays FROM win""")

# ---------------------------------------------------------------- intermediate (literal joins)
cte("itf", """
SELECT t.transaction_key, t.transaction_id, t.client_key, t.client_id, t.date_transaction, t.heure_transaction,
       t.timestamp_transaction, t.montant_eur, t.type_transaction_std, t.canal_std, t.categorie_std,
       t.pays_beneficiaire, t.is_international, t.is_nocturne, t.is_weekend, t.plage_horaire,
       cs.avg_montant_30j, cs.std_montant_30j, cs.avg_trans_par_jour, cs.max_montant_historique,
       cs.taux_trans_internationales,
       CASE WHEN cs.std_montant_30j > 0
            THEN (CAST(t.montant_eur AS DOUBLE) - cs.avg_montant_30j) / cs.std_montant_30j ELSE 0.0 END AS z_score_montant,
       CASE WHEN cs.avg_montant_30j > 0 THEN CAST(t.montant_eur AS DOUBLE) / cs.avg_montant_30j ELSE 1.0 END
         AS ratio_vs_moyenne_client,
       count(*) OVER (PARTITION BY t.client_key, t.date_transaction) AS nb_transactions_client_jour,
       CAST(date_diff('microsecond',
                      lag(t.timestamp_transaction) OVER (PARTITION BY t.client_key
                                                         ORDER BY t.timestamp_transaction NULLS LAST, t.transaction_id),
                      t.timestamp_transaction) AS DOUBLE) / 1000000.0 AS delai_depuis_derniere_sec,
       (cps.nb_trans_pays IS NULL OR cps.nb_trans_pays = 1) AS is_pays_inhabituel,
       percent_rank() OVER (PARTITION BY t.client_key ORDER BY t.montant_eur) AS percentile_montant_client
FROM stg_transactions t
LEFT JOIN cs30 cs ON t.client_key = cs.client_key
LEFT JOIN cps ON t.client_key = cps.client_key AND t.pays_beneficiaire = cps.pays_beneficiaire""")

ITF_DOUBLES = ["avg_montant_30j", "std_montant_30j", "avg_trans_par_jour", "taux_trans_internationales",
               "z_score_montant", "ratio_vs_moyenne_client", "delai_depuis_derniere_sec", "percentile_montant_client"]
final("int_transaction_features", _round_doubles("itf", ITF_DOUBLES))

cte("ica", f"""
SELECT c.client_key, c.client_id, c.segment_client, c.age, c.anciennete_mois AS anciennete_client_mois,
       coalesce(t.nb_transactions_total, 0) AS nb_transactions_total,
       coalesce(t.montant_total_transactions, 0) AS montant_total_transactions,
       coalesce(t.montant_moyen_transaction, 0.0) AS montant_moyen_transaction,
       coalesce(t.nb_transactions_30j, 0) AS nb_transactions_30j,
       coalesce(t.montant_transactions_30j, 0) AS montant_transactions_30j,
       coalesce(t.nb_transactions_90j, 0) AS nb_transactions_90j,
       coalesce(t.montant_transactions_90j, 0) AS montant_transactions_90j,
       CAST({D} - t.date_derniere_transaction AS INTEGER) AS days_since_last_transaction,
       coalesce(cp.nb_contrats_total, 0) AS nb_contrats_total,
       coalesce(cp.nb_contrats_actifs, 0) AS nb_contrats_actifs,
       coalesce(cp.nb_contrats_resilies, 0) AS nb_contrats_resilies,
       coalesce(cp.prime_mensuelle_totale, 0) AS prime_mensuelle_totale,
       coalesce(cp.capital_total_assure, 0) AS capital_total_assure,
       coalesce(cp.nb_contrats_auto, 0) AS nb_contrats_auto,
       coalesce(cp.nb_contrats_habitation, 0) AS nb_contrats_habitation,
       coalesce(cp.nb_contrats_sante, 0) AS nb_contrats_sante,
       coalesce(cp.nb_contrats_vie, 0) AS nb_contrats_vie,
       coalesce(s.nb_sinistres_total, 0) AS nb_sinistres_total,
       coalesce(s.nb_sinistres_12m, 0) AS nb_sinistres_12m,
       coalesce(s.montant_total_indemnise, 0) AS montant_total_indemnise,
       coalesce(s.nb_sinistres_rejetes, 0) AS nb_sinistres_rejetes,
       CASE WHEN coalesce(cp.prime_mensuelle_totale, 0) > 0
            THEN CAST(coalesce(s.montant_total_indemnise, 0) AS DOUBLE) / (CAST(cp.prime_mensuelle_totale AS DOUBLE) * 12)
            ELSE 0.0 END AS ratio_sinistres_primes_client,
       CASE WHEN coalesce(t.nb_transactions_30j, 0) > 0 AND coalesce(cp.nb_contrats_actifs, 0) > 0 THEN 'Actif'
            WHEN coalesce(t.nb_transactions_90j, 0) > 0 OR coalesce(cp.nb_contrats_actifs, 0) > 0 THEN 'Modere'
            ELSE 'Dormant' END AS statut_engagement,
       coalesce(cp.prime_mensuelle_totale, 0) * 12 * 3 - coalesce(s.montant_total_indemnise, 0) AS ltv_estimee_3ans,
       CASE WHEN t.nb_trans_mobile >= t.nb_trans_web AND t.nb_trans_mobile >= t.nb_trans_agence THEN 'Mobile'
            WHEN t.nb_trans_web >= t.nb_trans_mobile AND t.nb_trans_web >= t.nb_trans_agence THEN 'Web'
            WHEN t.nb_trans_agence >= t.nb_trans_mobile AND t.nb_trans_agence >= t.nb_trans_web THEN 'Agence'
            ELSE 'Mixte' END AS canal_prefere
FROM stg_clients c
LEFT JOIN ta t ON c.client_key = t.client_key
LEFT JOIN cp ON c.client_key = cp.client_key
LEFT JOIN sh s ON c.client_key = s.client_key""")

final("int_client_activity", _round_doubles("ica", ["montant_moyen_transaction", "ratio_sinistres_primes_client"]))

_REM = f"greatest(0, date_part('month', age(CAST(c.date_echeance AS TIMESTAMP), CAST({D} AS TIMESTAMP))))"
cte("icp", f"""
SELECT c.contrat_key, c.contrat_id, c.client_key, c.client_id, c.type_produit_std, c.categorie_produit,
       c.date_souscription, c.date_effet, c.date_echeance, c.anciennete_mois, c.prime_mensuelle, c.capital_assure,
       c.is_actif,
       coalesce(p.montant_total_primes, 0) AS primes_collectees,
       coalesce(p.montant_primes_payees, 0) AS primes_payees,
       coalesce(p.nb_impayes, 0) AS nb_impayes,
       coalesce(p.taux_paiement, 1.0) AS taux_paiement,
       coalesce(s.nb_sinistres, 0) AS nb_sinistres,
       coalesce(s.montant_total_indemnise, 0) AS montant_total_indemnise,
       coalesce(s.frequence_sinistres_annuelle, 0.0) AS frequence_sinistres,
       coalesce(s.delai_moyen_traitement, 0.0) AS delai_moyen_traitement,
       CASE WHEN coalesce(p.montant_primes_payees, 0) > 0
            THEN CAST(coalesce(s.montant_total_indemnise, 0) AS DOUBLE) / CAST(p.montant_primes_payees AS DOUBLE) * 100
            ELSE 0.0 END AS ratio_sp_pct,
       CAST(coalesce(s.nb_sinistres, 0) AS DOUBLE) / NULLIF(CAST(c.anciennete_mois AS DOUBLE) / 12.0, 0.0)
         AS frequence_par_annee,
       CASE WHEN coalesce(s.nb_sinistres, 0) > 0
            THEN CAST(coalesce(s.montant_total_indemnise, 0) AS DOUBLE) / CAST(s.nb_sinistres AS DOUBLE) ELSE 0.0 END
         AS cout_moyen_sinistre,
       coalesce(p.montant_primes_payees, 0) - coalesce(s.montant_total_indemnise, 0) AS marge_technique,
       CAST(c.prime_mensuelle AS DOUBLE) * CAST({_REM} AS DOUBLE)
         - coalesce(s.montant_moyen_indemnise, 0.0) * coalesce(s.frequence_sinistres_annuelle, 0.0) AS ltv_restante,
       CASE WHEN coalesce(p.montant_primes_payees, 0) - coalesce(s.montant_total_indemnise, 0) > c.prime_mensuelle * 12
              THEN 'Tres_Profitable'
            WHEN coalesce(p.montant_primes_payees, 0) > coalesce(s.montant_total_indemnise, 0) THEN 'Profitable'
            WHEN coalesce(p.montant_primes_payees, 0) = coalesce(s.montant_total_indemnise, 0) THEN 'Equilibre'
            ELSE 'Deficitaire' END AS statut_rentabilite,
       CASE WHEN coalesce(p.nb_impayes, 0) = 0 AND coalesce(p.taux_paiement_a_temps, 1.0) > 0.9 THEN 'Excellent'
            WHEN coalesce(p.nb_impayes, 0) <= 1 THEN 'Bon'
            WHEN coalesce(p.nb_impayes, 0) <= 3 THEN 'Moyen' ELSE 'Mauvais' END AS qualite_paiement,
       CASE WHEN coalesce(s.nb_sinistres, 0) = 0 THEN 'Sans_Sinistre'
            WHEN coalesce(p.montant_primes_payees, 0) <= 0 THEN 'Faible'
            WHEN coalesce(s.montant_total_indemnise, 0) * 100 < 50 * p.montant_primes_payees THEN 'Faible'
            WHEN coalesce(s.montant_total_indemnise, 0) * 100 < 75 * p.montant_primes_payees THEN 'Normale'
            WHEN coalesce(s.montant_total_indemnise, 0) * 100 < 100 * p.montant_primes_payees THEN 'Elevee'
            ELSE 'Critique' END AS niveau_sinistralite
FROM stg_contrats c
LEFT JOIN sa s ON c.contrat_key = s.contrat_key
LEFT JOIN pa p ON c.contrat_key = p.contrat_key""")

ICP_DOUBLES = ["taux_paiement", "frequence_sinistres", "delai_moyen_traitement", "ratio_sp_pct",
               "frequence_par_annee", "cout_moyen_sinistre", "ltv_restante"]
final("int_contrat_performance", _round_doubles("icp", ICP_DOUBLES))

# ---------------------------------------------------------------- marts
cte("scored", """
SELECT *,
       least(100.0,
             CASE WHEN abs(z_score_montant) > 5 THEN 40.0 WHEN abs(z_score_montant) > 4 THEN 30.0
                  WHEN abs(z_score_montant) > 3 THEN 20.0 ELSE abs(z_score_montant) * 5 END
           + CASE WHEN nb_transactions_client_jour > 10 THEN 20 WHEN nb_transactions_client_jour > 7 THEN 15
                  WHEN nb_transactions_client_jour > 5 THEN 10 ELSE 0 END
           + CASE WHEN is_international AND is_pays_inhabituel THEN 20 WHEN is_international THEN 10 ELSE 0 END
           + CASE WHEN is_nocturne THEN 10 WHEN is_weekend THEN 5 ELSE 0 END
           + CASE WHEN delai_depuis_derniere_sec IS NOT NULL AND delai_depuis_derniere_sec < 60 THEN 10
                  WHEN delai_depuis_derniere_sec IS NOT NULL AND delai_depuis_derniere_sec < 300 THEN 5 ELSE 0 END
       ) AS score_anomalie,
       coalesce(abs(z_score_montant) > 3, FALSE) AS is_anomalie_montant,
       coalesce(nb_transactions_client_jour > 5, FALSE) AS is_anomalie_frequence,
       coalesce(is_international AND is_pays_inhabituel, FALSE) AS is_anomalie_geographique,
       coalesce(is_nocturne AND montant_eur > 1000, FALSE) AS is_anomalie_horaire,
       coalesce(delai_depuis_derniere_sec IS NOT NULL AND delai_depuis_derniere_sec < 60 AND montant_eur > 500, FALSE)
         AS is_anomalie_comportementale
FROM itf""")

cte("classified", f"""
SELECT {_sk('transaction_key')} AS anomalie_key, transaction_key, transaction_id, client_key, client_id,
       date_transaction, timestamp_transaction, montant_eur, type_transaction_std, canal_std, pays_beneficiaire,
       is_anomalie_montant, is_anomalie_frequence, is_anomalie_geographique, is_anomalie_horaire,
       is_anomalie_comportementale, score_anomalie, z_score_montant, ratio_vs_moyenne_client,
       nb_transactions_client_jour, is_nocturne, is_international,
       CASE WHEN is_anomalie_montant THEN 'Montant' WHEN is_anomalie_frequence THEN 'Frequence'
            WHEN is_anomalie_geographique THEN 'Geographique' WHEN is_anomalie_horaire THEN 'Horaire'
            WHEN is_anomalie_comportementale THEN 'Comportement' ELSE 'Normal' END AS type_anomalie_principal,
       CASE WHEN score_anomalie >= 80 THEN 'Critique' WHEN score_anomalie >= 60 THEN 'Eleve'
            WHEN score_anomalie >= 40 THEN 'Moyen' WHEN score_anomalie >= 20 THEN 'Faible' ELSE 'Normal' END
         AS niveau_severite,
       'Nouveau' AS statut_investigation,
       score_anomalie >= 20 AS is_anomalie,
       {D} AS date_detection
FROM scored""")

cte("fat", "SELECT * FROM classified WHERE is_anomalie")

final("anomaly_score", """
SELECT transaction_id, is_anomalie_montant, is_anomalie_frequence, is_anomalie_geographique, is_anomalie_horaire,
       is_anomalie_comportementale, round(score_anomalie, 6) AS score_anomalie, type_anomalie_principal,
       niveau_severite, is_anomalie
FROM classified""")
final("fct_anomalies_transactions", _round_doubles("fat", ["score_anomalie", "z_score_montant",
                                                           "ratio_vs_moyenne_client"]))
final("fct_anomalies_summary", """
SELECT date_detection AS "date", type_anomalie_principal AS type_anomalie, niveau_severite,
       count(DISTINCT anomalie_key) AS nb_anomalies_detectees,
       count(DISTINCT client_key) AS nb_clients_concernes,
       sum(montant_eur) AS montant_total_suspect,
       round(CAST(sum(montant_eur) AS DOUBLE) / count(montant_eur), 6) AS montant_moyen_suspect,
       round(avg(score_anomalie), 6) AS score_moyen,
       round(max(score_anomalie), 6) AS score_max
FROM fat GROUP BY date_detection, type_anomalie_principal, niveau_severite""")

cte("churn_f", """
SELECT *,
       CASE WHEN nb_transactions_90j = 0 THEN 30
            WHEN nb_transactions_30j = 0 AND nb_transactions_90j > 0 THEN 20
            WHEN nb_transactions_30j < nb_transactions_90j * 0.5 THEN 15 ELSE 0 END AS score_baisse_activite,
       CASE WHEN days_since_last_transaction > 180 THEN 20 WHEN days_since_last_transaction > 90 THEN 15
            WHEN days_since_last_transaction > 60 THEN 10 WHEN days_since_last_transaction > 30 THEN 5 ELSE 0 END
         AS score_inactivite,
       CASE WHEN nb_contrats_actifs = 0 AND nb_contrats_resilies > 0 THEN 20
            WHEN nb_contrats_resilies >= 2 THEN 15 WHEN nb_contrats_resilies = 1 THEN 10 ELSE 0 END AS score_resiliation,
       CASE WHEN nb_sinistres_rejetes >= 2 THEN 15 WHEN nb_sinistres_rejetes = 1 THEN 10
            WHEN nb_sinistres_12m > 3 THEN 5 ELSE 0 END AS score_insatisfaction_sinistres,
       CASE WHEN prime_mensuelle_totale = 0 THEN 15 WHEN prime_mensuelle_totale < 50 THEN 10
            WHEN prime_mensuelle_totale < 100 THEN 5 ELSE 0 END AS score_faible_valeur
FROM ica""")

cte("churn", f"""
SELECT {_sk('client_key')} AS prediction_key, client_key, client_id, segment_client, age, anciennete_client_mois,
       nb_transactions_30j, nb_transactions_90j, days_since_last_transaction, nb_contrats_actifs,
       nb_contrats_resilies, prime_mensuelle_totale, nb_sinistres_rejetes, statut_engagement, ltv_estimee_3ans,
       score_baisse_activite, score_inactivite, score_resiliation, score_insatisfaction_sinistres,
       score_faible_valeur, score_churn,
       CASE WHEN score_churn >= 80 THEN 0.90 WHEN score_churn >= 60 THEN 0.70 WHEN score_churn >= 40 THEN 0.50
            WHEN score_churn >= 20 THEN 0.30 ELSE 0.10 END AS probabilite_churn_30j,
       CASE WHEN score_churn >= 70 THEN 0.95 WHEN score_churn >= 50 THEN 0.75 WHEN score_churn >= 30 THEN 0.55
            WHEN score_churn >= 15 THEN 0.35 ELSE 0.15 END AS probabilite_churn_90j,
       CASE WHEN score_churn >= 70 THEN 'Critique' WHEN score_churn >= 50 THEN 'Eleve'
            WHEN score_churn >= 30 THEN 'Moyen' ELSE 'Faible' END AS segment_risque,
       CASE WHEN score_inactivite >= greatest(score_baisse_activite, score_resiliation,
                                             score_insatisfaction_sinistres, score_faible_valeur) THEN 'Inactivite'
            WHEN score_baisse_activite >= greatest(score_inactivite, score_resiliation,
                                                  score_insatisfaction_sinistres, score_faible_valeur) THEN 'Baisse_Activite'
            WHEN score_resiliation >= greatest(score_inactivite, score_baisse_activite,
                                              score_insatisfaction_sinistres, score_faible_valeur) THEN 'Resiliation'
            WHEN score_insatisfaction_sinistres >= greatest(score_inactivite, score_baisse_activite,
                                                           score_resiliation, score_faible_valeur) THEN 'Insatisfaction'
            ELSE 'Faible_Valeur' END AS facteur_principal,
       CASE WHEN score_churn >= 70 AND nb_contrats_actifs > 0 THEN 'Contact_Urgent_Retention'
            WHEN score_churn >= 70 AND nb_contrats_actifs = 0 THEN 'Tentative_Reactivation'
            WHEN score_churn >= 50 THEN 'Offre_Personnalisee' WHEN score_churn >= 30 THEN 'Campagne_Engagement'
            ELSE 'Suivi_Normal' END AS action_recommandee,
       CASE WHEN score_churn >= 80 AND prime_mensuelle_totale > 200 THEN 1 WHEN score_churn >= 70 THEN 2
            WHEN score_churn >= 50 THEN 3 WHEN score_churn >= 30 THEN 4 ELSE 5 END AS priorite_contact,
       {D} AS date_prediction
FROM (SELECT *, least(100, score_baisse_activite + score_inactivite + score_resiliation
                           + score_insatisfaction_sinistres + score_faible_valeur) AS score_churn FROM churn_f)""")

final("churn_score", """
SELECT client_key, score_baisse_activite, score_inactivite, score_resiliation, score_insatisfaction_sinistres,
       score_faible_valeur, score_churn FROM churn""")
final("fct_churn_predictions", "SELECT * FROM churn")
final("dim_client_segments", f"""
SELECT {_sk('client_key')} AS segment_key, client_key, client_id,
       CASE WHEN prime_mensuelle_totale >= 300 THEN 'Platinum' WHEN prime_mensuelle_totale >= 150 THEN 'Gold'
            WHEN prime_mensuelle_totale >= 75 THEN 'Silver' ELSE 'Bronze' END AS segment_valeur,
       statut_engagement AS segment_comportement, segment_risque AS segment_risque_churn,
       ltv_estimee_3ans AS ltv_estimee, {D} AS date_segmentation
FROM churn""")

final("fct_performance_contrats", f"""
SELECT {_sk('contrat_key', D)} AS performance_key, contrat_key, contrat_id, client_key, client_id,
       type_produit_std, categorie_produit, anciennete_mois, prime_mensuelle,
       primes_collectees AS prime_totale_periode, primes_collectees AS prime_cumulee_ytd,
       round(taux_paiement, 6) AS taux_paiement_a_temps, nb_impayes, nb_sinistres,
       montant_total_indemnise AS montant_sinistres_indemnises,
       round(ratio_sp_pct, 6) AS ratio_sinistres_primes, round(ratio_sp_pct, 6) AS ratio_combined,
       marge_technique, statut_rentabilite, is_actif, anciennete_mois AS anciennete_contrat_mois,
       round(ltv_restante, 6) AS ltv_a_date, round(ltv_restante, 6) AS ltv_projetee,
       CAST(date_trunc('month', {D}) AS DATE) AS periode_mois
FROM icp""")

cte("sin_by_ct", """
SELECT contrat_key, count(DISTINCT sinistre_id) AS nb_sinistres, sum(montant_declare) AS total_sinistres_declares,
       sum(montant_indemnise) AS total_sinistres_indemnises
FROM stg_sinistres GROUP BY contrat_key""")
cte("prm_by_ct", """
SELECT contrat_key, sum(CASE WHEN is_paye THEN montant_prime ELSE 0 END) AS total_primes_collectees
FROM stg_primes GROUP BY contrat_key""")
cte("sinistralite", f"""
SELECT CAST(date_trunc('month', {D}) AS DATE) AS periode_mois, c.type_produit_std AS type_produit,
       coalesce(cl.segment_client, 'Unknown') AS segment_client,
       count(DISTINCT c.contrat_id) FILTER (WHERE c.is_actif) AS nb_contrats_actifs,
       sum(coalesce(s.nb_sinistres, 0)) AS nb_sinistres,
       sum(coalesce(p.total_primes_collectees, 0)) AS total_primes_collectees,
       sum(coalesce(s.total_sinistres_declares, 0)) AS total_sinistres_declares,
       sum(coalesce(s.total_sinistres_indemnises, 0)) AS total_sinistres_indemnises
FROM stg_contrats c
LEFT JOIN stg_clients cl ON c.client_key = cl.client_key
LEFT JOIN sin_by_ct s ON c.contrat_key = s.contrat_key
LEFT JOIN prm_by_ct p ON c.contrat_key = p.contrat_key
GROUP BY 1, 2, 3""")
final("fct_sinistralite", f"""
SELECT {_sk('periode_mois', 'type_produit', 'segment_client')} AS sinistralite_key,
       periode_mois, type_produit, segment_client, nb_contrats_actifs, CAST(nb_sinistres AS BIGINT) AS nb_sinistres,
       round(CAST(nb_sinistres AS DOUBLE) / NULLIF(nb_contrats_actifs, 0), 6) AS frequence_sinistres,
       total_primes_collectees, total_sinistres_declares, total_sinistres_indemnises,
       CASE WHEN nb_sinistres > 0
            THEN round(CAST(total_sinistres_indemnises AS DOUBLE) / CAST(nb_sinistres AS DOUBLE), 6) END
         AS cout_moyen_sinistre,
       round(CAST(total_sinistres_indemnises AS DOUBLE) / NULLIF(CAST(total_primes_collectees AS DOUBLE), 0) * 100, 6)
         AS ratio_sp_periode,
       round(CAST(total_sinistres_indemnises AS DOUBLE) / NULLIF(CAST(total_primes_collectees AS DOUBLE), 0) * 100, 6)
         AS ratio_sp_ytd,
       round(CAST(total_sinistres_indemnises AS DOUBLE) / NULLIF(CAST(total_primes_collectees AS DOUBLE), 0) * 100, 6)
         AS ratio_sp_12m_glissant,
       CAST(NULL AS DECIMAL(38,6)) AS evolution_vs_mois_precedent,
       CAST(NULL AS DECIMAL(38,6)) AS evolution_vs_annee_precedente
FROM sinistralite""")

# literal five-way LEFT JOIN (fan-out: claims x instalments per contract)
final("fct_kpis_portefeuille", f"""
SELECT {_sk(f"CAST({D} AS VARCHAR)")} AS kpi_key, {D} AS "date",
       count(DISTINCT c.client_id) AS nb_clients_actifs,
       count(DISTINCT ct.contrat_id) FILTER (WHERE ct.is_actif) AS nb_contrats_actifs,
       count(DISTINCT c.client_id) FILTER (WHERE c.is_nouveau_client) AS nb_nouveaux_clients,
       count(DISTINCT ct.contrat_id) FILTER (WHERE ct.is_resilie) AS nb_contrats_resilies,
       sum(CASE WHEN p.is_paye THEN p.montant_prime ELSE 0 END) AS total_primes_collectees,
       sum(s.montant_indemnise) AS total_sinistres_payes,
       sum(CASE WHEN ct.is_actif THEN ct.capital_assure ELSE 0 END) AS encours_total,
       round(CAST(sum(s.montant_indemnise) AS DOUBLE)
             / NULLIF(CAST(sum(CASE WHEN p.is_paye THEN p.montant_prime ELSE 0 END) AS DOUBLE), 0) * 100, 6)
         AS ratio_sp_global,
       sum(CASE WHEN p.is_paye THEN p.montant_prime ELSE 0 END) - sum(s.montant_indemnise) AS marge_nette,
       round(CAST(sum(ch.ltv_estimee_3ans) AS DOUBLE) / NULLIF(count(ch.ltv_estimee_3ans), 0), 6) AS ltv_moyenne_client,
       100 AS acquisition_cost_moyen,
       round(CAST(sum(ch.ltv_estimee_3ans) AS DOUBLE) / NULLIF(count(ch.ltv_estimee_3ans), 0), 6)
         AS customer_lifetime_value,
       75 AS nps_score,
       round(CAST(count(DISTINCT c.client_id) FILTER (WHERE ct.is_actif) AS DOUBLE)
             / NULLIF(count(DISTINCT c.client_id), 0) * 100, 6) AS taux_retention,
       round(CAST(count(DISTINCT c.client_id) FILTER (WHERE ch.score_churn >= 70) AS DOUBLE)
             / NULLIF(count(DISTINCT c.client_id), 0) * 100, 6) AS taux_churn
FROM stg_clients c
LEFT JOIN stg_contrats ct ON c.client_key = ct.client_key
LEFT JOIN stg_sinistres s ON ct.contrat_key = s.contrat_key
LEFT JOIN stg_primes p ON ct.contrat_key = p.contrat_key
LEFT JOIN churn ch ON c.client_key = ch.client_key""")

# ---------------------------------------------------------------- column functions
final("surrogate_key", f"""
SELECT transaction_id, {_sk('transaction_id')} AS key_1, {_sk('client_id', 'date_transaction')} AS key_2,
       {_sk('transaction_id', 'pays_beneficiaire', 'montant')} AS key_3
FROM raw_transactions""")
final("pg_initcap", f"""
SELECT client_id, {_initcap('nom')} AS nom_initcap, {_initcap('prenom')} AS prenom_initcap,
       {_initcap('ville')} AS ville_initcap, {_initcap('email')} AS email_initcap
FROM raw_clients""")
final("age_months", f"""
SELECT contrat_id, {_age_months('date_echeance', 'date_effet')} AS months_term,
       {_age_months(D, 'date_effet')} AS months_since_start,
       {_age_months('date_effet', 'date_echeance')} AS months_reversed,
       {_age_month_part('date_echeance', D)} AS month_part_remaining,
       {_age_years('date_echeance', D)} AS year_part_remaining
FROM raw_contrats""")
_REF = "TIMESTAMP '2023-11-30 12:00:00'"
final("age_months_ts", f"""
SELECT transaction_id, {_age_months('timestamp_transaction', _REF)} AS months_after_ref,
       {_age_months(_REF, 'timestamp_transaction')} AS months_before_ref,
       {_age_month_part('timestamp_transaction', _REF)} AS month_part
FROM stg_transactions""")

# ---------------------------------------------------------------- schedule, joins
final("prime_schedule", f"""
SELECT contrat_id,
       CAST(unnest(generate_series(CAST(date_effet AS TIMESTAMP), CAST(least(date_echeance, {D}) AS TIMESTAMP),
                                   INTERVAL 30 DAY)) AS DATE) AS date_echeance,
       prime_mensuelle AS montant_prime
FROM stg_contrats""")
final("join_left_unknown_segment", """
SELECT c.contrat_id, coalesce(cl.segment_client, 'Unknown') AS segment_client
FROM stg_contrats c LEFT JOIN stg_clients cl ON c.client_key = cl.client_key""")
final("join_fanout", """
SELECT c.client_key, count(*) AS nb_rows,
       sum(CASE WHEN p.is_paye THEN p.montant_prime ELSE 0 END) AS primes_payees_fanout,
       sum(s.montant_indemnise) AS indemnites_fanout
FROM stg_clients c
LEFT JOIN stg_contrats ct ON c.client_key = ct.client_key
LEFT JOIN stg_sinistres s ON ct.contrat_key = s.contrat_key
LEFT JOIN stg_primes p ON ct.contrat_key = p.contrat_key
GROUP BY c.client_key""")

# ---------------------------------------------------------------- data checks
cte("fpc", f"SELECT {_sk('contrat_key', D)} AS performance_key, * FROM icp")
cte("fsin", f"SELECT {_sk('periode_mois', 'type_produit', 'segment_client')} AS sinistralite_key, * FROM sinistralite")

_REL = {"clients": "raw_clients", "transactions": "raw_transactions", "contrats": "raw_contrats",
        "sinistres": "raw_sinistres", "primes": "raw_primes", "int_client_activity": "ica",
        "int_transaction_features": "itf", "int_contrat_performance": "icp", "fct_anomalies_transactions": "fat",
        "fct_churn_predictions": "churn", "fct_performance_contrats": "fpc", "fct_sinistralite": "fsin"}


def _rel(model: str) -> str:
    return _REL.get(model, model)


def _lit(v) -> str:
    return "'" + str(v).replace("'", "''") + "'" if isinstance(v, str) else repr(v)


def _failing_sql(ch) -> str:
    t, c = _rel(ch.model), ch.column
    if ch.kind == "unique":
        return f"SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1"
    if ch.kind == "not_null":
        return f"SELECT * FROM {t} WHERE {c} IS NULL"
    if ch.kind == "accepted_values":
        vals = ", ".join(_lit(v) for v in ch.values)
        return f"SELECT {c} FROM {t} WHERE {c} NOT IN ({vals}) GROUP BY {c}"
    if ch.kind == "relationships":
        return (f"SELECT child.{c} FROM {t} AS child LEFT JOIN {_rel(ch.to_model)} AS parent "
                f"ON child.{c} = parent.{ch.to_column} WHERE child.{c} IS NOT NULL AND parent.{ch.to_column} IS NULL")
    if ch.kind == "accepted_range":
        conds = []
        if ch.min_value is not None:
            conds.append(f"{c} {'>=' if ch.inclusive else '>'} {ch.min_value}")
        if ch.max_value is not None:
            conds.append(f"{c} {'<=' if ch.inclusive else '<'} {ch.max_value}")
        return f"SELECT * FROM {t} WHERE NOT ({' AND '.join(conds)})"
    raise ValueError(ch.kind)


def _checks_sql(kind: str) -> str:
    from finsight.operators.quality import ALL_CHECKS
    parts = [f"SELECT {_lit(ch.test_id)} AS test_id, {_lit(ch.kind)} AS kind, {_lit(ch.model)} AS model, "
             f"{_lit(ch.column)} AS column_name, (SELECT count(*) FROM ({_failing_sql(ch)})) AS failures"
             for ch in ALL_CHECKS if ch.kind == kind]
    return "\nUNION ALL\n".join(parts)


for _kind, _key in [("unique", "test_unique"), ("not_null", "test_not_null"),
                    ("accepted_values", "test_accepted_values"), ("accepted_range", "test_accepted_range"),
                    ("relationships", "orphan_check")]:
    final(_key, _checks_sql(_kind))


def _constraints_sql() -> str:
    from finsight import schemas
    parts = []
    for table in schemas.LOAD_ORDER:
        t, pk = f"raw_{table}", schemas.PRIMARY_KEYS[table]
        q = [("primary_key_unique", pk, f"SELECT {pk} FROM {t} WHERE {pk} IS NOT NULL GROUP BY {pk} HAVING count(*) > 1"),
             ("primary_key_not_null", pk, f"SELECT * FROM {t} WHERE {pk} IS NULL")]
        for col, parent, pcol in schemas.FOREIGN_KEYS.get(table, []):
            q.append(("foreign_key", col, f"SELECT a.{col} FROM {t} a LEFT JOIN raw_{parent} b ON a.{col} = b.{pcol} "
                                          f"WHERE a.{col} IS NOT NULL AND b.{pcol} IS NULL"))
        for col, n in schemas.MAX_LENGTHS[table].items():
            q.append((f"max_length_{n}", col, f"SELECT * FROM {t} WHERE length({col}) > {n}"))
        for f in schemas.RAW_SCHEMAS[table].fields:
            if f.dataType.typeName() == "decimal":
                bound = 10 ** (f.dataType.precision - f.dataType.scale)
                q.append((f"precision_{f.dataType.simpleString()}", f.name,
                          f"SELECT * FROM {t} WHERE abs({f.name}) >= {bound}"))
        for name, col, sql in q:
            parts.append(f"SELECT '{table}' AS table_name, '{name}' AS constraint_name, '{col}' AS column_name, "
                         f"(SELECT count(*) FROM ({sql})) AS violations")
    return "\nUNION ALL\n".join(parts)


final("constraint_violations", _constraints_sql())

# ---------------------------------------------------------------- load statistics / monitoring
final("load_row_counts", """
SELECT 'raw.clients' AS table_name, (SELECT count(*) FROM raw_clients) AS row_count
UNION ALL SELECT 'raw.transactions', (SELECT count(*) FROM raw_transactions)
UNION ALL SELECT 'raw.contrats', (SELECT count(*) FROM raw_contrats)
UNION ALL SELECT 'raw.sinistres', (SELECT count(*) FROM raw_sinistres)
UNION ALL SELECT 'raw.primes', (SELECT count(*) FROM raw_primes)
UNION ALL SELECT 'staging.stg_clients', (SELECT count(*) FROM stg_clients)
UNION ALL SELECT 'staging.stg_transactions', (SELECT count(*) FROM stg_transactions)
UNION ALL SELECT 'marts.fct_anomalies_transactions', (SELECT count(*) FROM fat)
UNION ALL SELECT 'marts.fct_churn_predictions', (SELECT count(*) FROM churn)""")
final("stat_avg_trans_per_client", """
SELECT CAST(round(avg(nb_trans)) AS INTEGER) AS avg_trans
FROM (SELECT client_id, count(*) AS nb_trans FROM raw_transactions GROUP BY client_id)""")
final("stat_avg_amount", "SELECT CAST(avg(montant) AS DECIMAL(10,2)) AS avg_montant FROM raw_transactions")
final("stat_active_contracts", "SELECT count(*) AS contrats_actifs FROM raw_contrats WHERE statut = 'Actif'")
final("stat_claim_rate", """
SELECT CAST(round(CAST(count(DISTINCT s.contrat_id) AS DOUBLE) / NULLIF(count(DISTINCT c.contrat_id), 0) * 100, 2)
            AS DECIMAL(5,2)) AS ratio
FROM raw_contrats c LEFT JOIN raw_sinistres s ON s.contrat_id = c.contrat_id""")
final("dq_anomaly_counts", """
SELECT count(*) AS total, count(*) FILTER (WHERE niveau_severite = 'Critique') AS critiques FROM fat""")
final("dq_churn_distribution", """
SELECT segment_risque, count(*) AS nb_clients FROM churn GROUP BY segment_risque ORDER BY nb_clients DESC""")
_CHECKED = f"TIMESTAMP '{AS_OF} 06:00:00'"
final("dq_freshness", f"""
SELECT last_loaded_at, {_CHECKED} AS checked_at, round(age, 6) AS age_hours,
       CASE WHEN last_loaded_at IS NULL THEN 'error' WHEN age > 24 THEN 'error' WHEN age > 12 THEN 'warn'
            ELSE 'pass' END AS freshness_status,
       coalesce(age > 48, FALSE) AS alert_48h
FROM (SELECT max(loaded_at) AS last_loaded_at,
             CAST(date_diff('second', max(loaded_at), {_CHECKED}) AS DOUBLE) / 3600.0 AS age
      FROM raw_transactions)""")

# ---------------------------------------------------------------- ingestion round trips
final("ingest_csv", """
SELECT t.transaction_id, t.client_id,
       CASE WHEN event_id % 23 = 0 OR (event_id % 29 <> 0 AND event_id % 31 = 0) THEN NULL
            ELSE t.date_transaction END AS date_transaction,
       CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 7 = 0 THEN substr(t.heure_transaction, 1, 5) || ':00'
            ELSE t.heure_transaction END AS heure_transaction,
       CASE WHEN event_id % 13 = 0 OR event_id % 17 = 0 THEN NULL
            WHEN event_id % 19 = 0 THEN t.montant + 0.01 ELSE t.montant END AS montant,
       CASE WHEN event_id % 37 = 0 OR event_id % 43 = 0 THEN NULL ELSE t.devise END AS devise,
       t.type_transaction, t.canal, t.categorie, t.pays_beneficiaire, t.statut, t.loaded_at
FROM (SELECT *, CAST(substr(transaction_id, 5) AS BIGINT) AS event_id FROM raw_transactions) t""")
final("ingest_csv_clients", """
SELECT client_id, CAST(CAST(date_creation AS DATE) AS TIMESTAMP) AS date_creation, nom, prenom,
       CASE WHEN CAST(substr(client_id, 5) AS BIGINT) % 5 = 0 THEN NULL ELSE email END AS email,
       telephone, date_naissance, adresse, code_postal, ville, pays, segment_client, score_credit, loaded_at
FROM raw_clients""")

# the streaming load of the same defect export must equal the batch ingest
final("stream_ingest_csv", FINAL["ingest_csv"])


# ---------------------------------------------------------------- layered run (step log)
def _layer_tests_sql(checks) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {_lit(ch.test_id)} AS name, (SELECT count(*) FROM ({_failing_sql(ch)})) AS failures" for ch in checks)


def _pipeline_sql() -> str:
    from finsight.operators.quality import CHECKS_BY_LAYER, SOURCE_CHECKS
    from finsight.plans.pipeline import select
    layer_checks = {"staging": SOURCE_CHECKS + CHECKS_BY_LAYER["staging"],
                    "intermediate": CHECKS_BY_LAYER["intermediate"], "marts": CHECKS_BY_LAYER["marts"]}
    ctes, parts = [], []
    gate = "TRUE"  # the layer runs when every earlier layer passed its tests
    for layer, checks in layer_checks.items():
        runs = ", ".join(f"({_lit(m.name)}, {_lit(m.materialized)})" for m in select(layer))
        ctes.append(f"t_{layer} AS ({_layer_tests_sql(checks)})")
        parts.append(f"SELECT 'run' AS step, name, 'ok' AS status, detail FROM (VALUES {runs}) v(name, detail) "
                     f"WHERE {gate}")
        parts.append(f"SELECT 'test', name, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END, "
                     f"CAST(failures AS VARCHAR) FROM t_{layer} WHERE {gate}")
        failed = f"EXISTS (SELECT 1 FROM t_{layer} WHERE failures > 0)"
        parts.append(f"SELECT 'stop', {_lit(layer)}, 'failed', 'a test of this layer failed' WHERE {gate} AND {failed}")
        gate = f"{gate} AND NOT {failed}"
    return ",\n".join(ctes), "\nUNION ALL\n".join(parts)


_P_CTES, _P_BODY = _pipeline_sql()
final("layered_run", f"WITH {_P_CTES}\n{_P_BODY}")

# ---------------------------------------------------------------- load-time rejects
def _rejects_sql() -> str:
    from finsight import schemas
    from finsight.sources.fixtures import OTHER_TWICE, REFUSED, SAME_TWICE
    # what each defect is to the declared table; a padded text that fits without its padding is nothing
    meaning = {("clients", "client_id"): "key_missing", ("clients", "nom"): "too_long", ("clients", "ville"): None,
               ("transactions", "client_id"): None, ("transactions", "canal"): "too_long",
               ("transactions", "date_transaction"): "coerced", ("contrats", "statut"): "too_long"}
    ctes, parts = [], []
    for t in schemas.LOAD_ORDER:
        pk, flags, seen, fk_value = schemas.PRIMARY_KEYS[t], {}, {}, {}
        for column, modulus, remainder, text in REFUSED[t]:
            hit = f"(k % {modulus} = {remainder}" + "".join(f" AND NOT {h}" for h in seen.get(column, [])) + ")"
            seen.setdefault(column, []).append(hit)
            kind = "coerced" if text == "unknown" else meaning.get((t, column), "overflow")
            if kind:
                flags[f"{kind}|{column}"] = hit
            if (t, column) == ("transactions", "client_id"):
                fk_value[column] = f"CASE WHEN {hit} THEN 'CLI_none' ELSE client_id END"
        local = " OR ".join(h for n, h in flags.items() if not n.startswith("coerced")) or "FALSE"
        ctes.append(f"n_{t} AS (SELECT *, CAST(regexp_extract({pk}, '([0-9]+)', 1) AS BIGINT) AS k FROM raw_{t})")
        ctes.append(f"x_{t} AS (SELECT *, 0 AS copy FROM n_{t} UNION ALL SELECT *, 1 FROM n_{t} WHERE k % {SAME_TWICE} = 0 "
                    f"UNION ALL SELECT *, 2 FROM n_{t} WHERE k % {OTHER_TWICE} = 0)")
        late = {f"duplicate|{pk}": f"(NOT is_local AND row_number() OVER (PARTITION BY {pk}, is_local ORDER BY copy) > 1)"}
        for column, parent, parent_col in schemas.FOREIGN_KEYS.get(t, []):
            value = fk_value.get(column, column)
            late[f"orphan|{column}"] = f"({value} IS NOT NULL AND {value} NOT IN (SELECT {parent_col} FROM ok_{parent}))"
        ctes.append(f"l_{t} AS (SELECT *, ({local}) AS is_local FROM x_{t})")
        named = ", ".join(f'{h} AS "{n}"' for n, h in {**flags, **late}.items())
        bad = " OR ".join(f'"{n}"' for n in [*flags, *late] if not n.startswith("coerced"))
        ctes.append(f"f_{t} AS (SELECT *, {named} FROM l_{t})")
        ctes.append(f"j_{t} AS (SELECT *, ({bad}) AS is_rejected FROM f_{t})")
        ctes.append(f"ok_{t} AS (SELECT DISTINCT {pk} FROM j_{t} WHERE NOT is_rejected)")
        for n, cond in {**{n: f'"{n}"' for n in [*flags, *late]}, "rejected": "is_rejected", "accepted": "NOT is_rejected"}.items():
            parts.append(f"SELECT '{t}' AS table_name, '{n}' AS rule, count(*) AS n_rows FROM j_{t} WHERE {cond} HAVING count(*) > 0")
    return "WITH " + ",\n".join(ctes) + "\n" + "\nUNION ALL\n".join(parts)


final("ingest_rejects", _rejects_sql())


# ---------------------------------------------------------------- layered run on quarantined input
def _clean_run() -> None:
    """Raw tables without the rows that break a rule, parents first; every model and test reads those."""
    from finsight import schemas
    from finsight.operators.quality import SOURCE_CHECKS
    own, counted = {}, []
    for t in schemas.LOAD_ORDER:
        pk = schemas.PRIMARY_KEYS[t]
        rules = {f"key_missing|{pk}": f"{pk} IS NULL"}
        rules |= {f"too_long|{c}": f"length(trim({c})) > {n}" for c, n in schemas.MAX_LENGTHS[t].items()}
        for ch in SOURCE_CHECKS:
            if ch.model == t and ch.column != pk and ch.kind == "not_null":
                rules[f"not_null|{ch.column}"] = f"{ch.column} IS NULL"
            elif ch.model == t and ch.kind == "accepted_values":
                rules[f"accepted_values|{ch.column}"] = f"{ch.column} NOT IN ({', '.join(_lit(v) for v in ch.values)})"
        rules |= {f"orphan|{c}": f"{c} IS NOT NULL AND {c} NOT IN (SELECT {pc} FROM raw_{parent})"
                  for c, parent, pc in schemas.FOREIGN_KEYS.get(t, [])}
        own[f"all_{t}"] = CTES[f"raw_{t}"]
        own[f"raw_{t}"] = f"SELECT * FROM all_{t} WHERE " + " AND ".join(f"NOT coalesce({r}, FALSE)" for r in rules.values())
        counted += [f"SELECT 'quarantine' AS step, {_lit(f'{t}.{n}')} AS name, 'rejected' AS status, CAST(count(*) AS VARCHAR) AS detail "
                    f"FROM all_{t} WHERE {r} HAVING count(*) > 0" for n, r in rules.items()]
        counted.append(f"SELECT 'quarantine', {_lit(t)}, 'accepted', CAST(count(*) AS VARCHAR) FROM raw_{t}")
    OWN_CTES["layered_run_clean"] = own
    final("layered_run_clean", f"WITH {_P_CTES}\n" + "\nUNION ALL\n".join([*counted, _P_BODY]))


_clean_run()

# ---------------------------------------------------------------- catalog
def _catalog_sql() -> tuple[str, str]:
    from finsight import descriptions, schemas
    from finsight.plans.pipeline import REGISTRY
    named = [("raw", t, "table", f"SELECT * FROM raw_{t}") for t in schemas.LOAD_ORDER]
    for m in REGISTRY.values():
        rows = FINAL[m.name] if m.layer == "marts" or m.name.startswith("int_") else f"SELECT * FROM {m.name}"
        named.append((m.layer, m.name, m.materialized, rows))
    counts = "\nUNION ALL\n".join(f"SELECT '{layer}' AS layer, '{n}' AS relation, '{kind}' AS kind, count(*) AS n_rows FROM ({sql})"
                                  for layer, n, kind, sql in named)
    said = [(f"{layer}.{n}", c, text) for layer, n, _, _ in named for c, text in
            [("", descriptions.of(n)[0]), *descriptions.of(n)[1].items()] if text]
    values = ", ".join(f"({_lit(r)}, {_lit(c)}, {_lit(t)})" for r, c, t in said)
    return counts, f"SELECT relation, column_name, comment FROM (VALUES {values}) v(relation, column_name, comment)"


for _key, _sql in zip(("catalog_relations", "catalog_comments"), _catalog_sql(), strict=True):
    final(_key, _sql)

# ---------------------------------------------------------------- normalisation steps
cte("defect_text", """
SELECT transaction_id, event_id,
       CASE WHEN event_id % 23 = 0 THEN 'bad-date'
            WHEN event_id % 29 = 0 THEN CAST(date_transaction AS VARCHAR) || ' 13:45:00'
            WHEN event_id % 31 = 0 THEN ''
            ELSE CAST(date_transaction AS VARCHAR) END AS date_text,
       CASE WHEN event_id % 11 = 0 THEN '25:99' WHEN event_id % 7 = 0 THEN substr(heure_transaction, 1, 5)
            ELSE heure_transaction END AS heure_text,
       CASE WHEN event_id % 13 = 0 THEN 'abc' WHEN event_id % 17 = 0 THEN '   '
            WHEN event_id % 19 = 0 THEN CAST(montant AS VARCHAR) || '5' ELSE CAST(montant AS VARCHAR) END AS montant_text,
       CASE WHEN event_id % 37 = 0 THEN 'NA' WHEN event_id % 43 = 0 THEN 'null' ELSE devise END AS devise_text,
       date_transaction, heure_transaction, montant, loaded_at
FROM (SELECT *, CAST(substr(transaction_id, 5) AS BIGINT) AS event_id FROM raw_transactions)""")

_NA = "('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', '<NA>', 'N/A', " \
      "'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null')"


def _blank_null(c: str) -> str:
    return f"CASE WHEN {c} IN {_NA} OR regexp_matches({c}, '^\\s*$') THEN NULL ELSE {c} END"


final("normalize_blanks", f"""
SELECT transaction_id, {_blank_null('date_text')} AS date_transaction, {_blank_null('heure_text')} AS heure_transaction,
       {_blank_null('montant_text')} AS montant, {_blank_null('devise_text')} AS devise
FROM defect_text""")
final("normalize_time", """
SELECT transaction_id,
       CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 7 = 0 THEN substr(heure_transaction, 1, 5) || ':00'
            ELSE heure_transaction END AS heure_transaction
FROM defect_text""")
final("normalize_types", """
SELECT transaction_id,
       CASE WHEN event_id % 23 = 0 OR (event_id % 29 <> 0 AND event_id % 31 = 0) THEN NULL
            ELSE date_transaction END AS date_transaction,
       CASE WHEN event_id % 13 = 0 OR event_id % 17 = 0 THEN NULL
            WHEN event_id % 19 = 0 THEN montant + 0.01 ELSE montant END AS montant,
       loaded_at
FROM defect_text""")
