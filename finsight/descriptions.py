"""What the layers, relations and columns are, as comments of the catalog and of stored columns."""

from __future__ import annotations

# The published descriptions.
LAYERS = {
    "raw": "Données brutes non transformées - réplique exacte des sources",
    "staging": "Données nettoyées, typées et standardisées",
    "intermediate": "Agrégations et calculs intermédiaires réutilisables",
    "marts": "Modèles métier prêts pour la visualisation",
}

# Relation -> (description, column -> description).
RELATIONS: dict[str, tuple[str, dict[str, str]]] = {
    "clients": ("Données clients (KYC)", {
        "client_id": "Identifiant unique du client",
        "email": "Email du client",
        "segment_client": "Segment marketing du client",
        "score_credit": "Score de crédit (300-850)"}),
    "transactions": ("Transactions bancaires", {
        "transaction_id": "Identifiant unique de la transaction",
        "client_id": "Référence au client",
        "montant": "Montant de la transaction en EUR",
        "date_transaction": "Date de la transaction"}),
    "contrats": ("Contrats d'assurance", {
        "contrat_id": "Identifiant unique du contrat",
        "client_id": "Référence au client",
        "type_produit": "Type de produit (Auto, Habitation, etc.)",
        "prime_mensuelle": "Prime mensuelle en EUR"}),
    "sinistres": ("Sinistres déclarés", {
        "sinistre_id": "Identifiant unique du sinistre",
        "contrat_id": "Référence au contrat",
        "montant_declare": "Montant déclaré du sinistre",
        "montant_indemnise": "Montant indemnisé"}),
    "primes": ("Échéances et paiements de primes", {
        "prime_id": "Identifiant unique de l'échéance",
        "contrat_id": "Référence au contrat",
        "statut_paiement": "Statut du paiement"}),
    "stg_clients": ("Clients nettoyés et standardisés avec métriques calculées", {
        "client_key": "Clé surrogate unique du client",
        "client_id": "Identifiant métier du client",
        "age": "Âge du client en années",
        "score_credit_categorie": "Catégorie de score crédit"}),
    "stg_transactions": ("Transactions standardisées avec indicateurs temporels", {
        "transaction_key": "Clé surrogate unique de la transaction",
        "montant_eur": "Montant en EUR",
        "type_transaction_std": "Type de transaction standardisé"}),
    "stg_contrats": ("Contrats d'assurance avec calculs de durée", {
        "contrat_key": "Clé surrogate unique du contrat",
        "prime_mensuelle": "Prime mensuelle en EUR"}),
    "stg_sinistres": ("Sinistres avec ratios d'indemnisation", {
        "sinistre_key": "Clé surrogate unique du sinistre",
        "taux_indemnisation_pct": "Taux d'indemnisation en pourcentage"}),
    "stg_primes": ("Primes avec statuts de paiement", {
        "prime_key": "Clé surrogate unique de la prime"}),
    "int_client_activity": ("Vue consolidée de l'activité client (transactions, contrats, sinistres)", {
        "client_key": "Clé unique du client",
        "statut_engagement": "Niveau d'engagement (Actif, Modéré, Dormant)",
        "ltv_estimee_3ans": "Life Time Value estimée sur 3 ans"}),
    "int_transaction_features": ("Features calculées pour la détection d'anomalies", {
        "transaction_key": "Clé unique de la transaction",
        "z_score_montant": "Z-score du montant (écart à la moyenne en nb d'écart-types)",
        "ratio_vs_moyenne_client": "Ratio du montant vs la moyenne du client sur 30j"}),
    "int_contrat_performance": ("Performance et rentabilité des contrats", {
        "contrat_key": "Clé unique du contrat",
        "ratio_sp_pct": "Ratio Sinistres/Primes en pourcentage (KPI clé)",
        "statut_rentabilite": "Classification de rentabilité"}),
    "fct_anomalies_transactions": ("Transactions suspectes détectées avec score d'anomalie", {
        "anomalie_key": "Clé unique de l'anomalie",
        "score_anomalie": "Score d'anomalie (0-100)",
        "niveau_severite": "Niveau de sévérité de l'anomalie"}),
    "fct_churn_predictions": ("Prédictions de risque de churn avec recommandations", {
        "prediction_key": "Clé unique de la prédiction",
        "score_churn": "Score de risque de churn (0-100)",
        "segment_risque": "Segment de risque"}),
    "fct_performance_contrats": ("Performance détaillée de chaque contrat", {
        "performance_key": "Clé unique",
        "ratio_sinistres_primes": "Ratio S/P en pourcentage"}),
    "fct_sinistralite": ("Sinistralité agrégée par produit et segment", {}),
    "fct_kpis_portefeuille": ("KPIs globaux du portefeuille", {}),
}


def of(relation: str) -> tuple[str, dict[str, str]]:
    """The comment of a relation and those of its columns; empty where nothing is said."""
    return RELATIONS.get(relation, ("", {}))
