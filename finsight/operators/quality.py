"""Declarative data checks (J1-J10). Each check compiles to a *failing rows* DataFrame (empty =
pass); ``summary`` turns a list of checks into one row per check with its failure count.

Semantics (per check kind):
* unique           — one failing row per value occurring more than once (NULLs ignored);
* not_null         — every row whose value is NULL;
* accepted_values  — one failing row per distinct value outside the list (NULL passes);
* relationships    — every child row whose non-NULL key has no parent row (left anti join);
* accepted_range   — every row outside [min, max] (bounds inclusive unless stated; NULL passes).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finsight import schemas
from finsight.operators import repeats


@dataclass(frozen=True)
class Check:
    kind: str
    model: str
    column: str
    values: tuple = ()
    to_model: str | None = None
    to_column: str | None = None
    min_value: float | None = None
    max_value: float | None = None
    inclusive: bool = True
    severity: str = "error"
    extra: dict = field(default_factory=dict, compare=False, hash=False)

    @property
    def test_id(self) -> str:
        return f"{self.kind}__{self.model}__{self.column}"


def _u(model, col):
    return [Check("unique", model, col), Check("not_null", model, col)]


# The declared tests of every layer (62).
SOURCE_CHECKS = [
    *_u("clients", "client_id"), Check("not_null", "clients", "email"),
    *_u("transactions", "transaction_id"), Check("not_null", "transactions", "client_id"),
    Check("relationships", "transactions", "client_id", to_model="clients", to_column="client_id"),
    Check("not_null", "transactions", "montant"), Check("not_null", "transactions", "date_transaction"),
    *_u("contrats", "contrat_id"), Check("not_null", "contrats", "client_id"),
    Check("relationships", "contrats", "client_id", to_model="clients", to_column="client_id"),
    Check("accepted_values", "contrats", "type_produit", values=("Auto", "Habitation", "Santé", "Vie", "Épargne")),
    *_u("sinistres", "sinistre_id"), Check("not_null", "sinistres", "contrat_id"),
    Check("relationships", "sinistres", "contrat_id", to_model="contrats", to_column="contrat_id"),
    *_u("primes", "prime_id"), Check("not_null", "primes", "contrat_id"),
    Check("relationships", "primes", "contrat_id", to_model="contrats", to_column="contrat_id"),
    Check("accepted_values", "primes", "statut_paiement", values=("Payé", "Impayé", "Retard")),
]
STAGING_CHECKS = [
    *_u("stg_clients", "client_key"), *_u("stg_clients", "client_id"),
    Check("accepted_range", "stg_clients", "age", min_value=16, max_value=120),
    Check("accepted_values", "stg_clients", "score_credit_categorie", values=("Excellent", "Bon", "Moyen", "Faible")),
    *_u("stg_transactions", "transaction_key"), Check("not_null", "stg_transactions", "montant_eur"),
    Check("accepted_values", "stg_transactions", "type_transaction_std",
          values=("Virement", "Prélèvement", "Carte", "Chèque", "Espèces", "Autre")),
    *_u("stg_contrats", "contrat_key"),
    Check("accepted_range", "stg_contrats", "prime_mensuelle", min_value=0, inclusive=False),
    *_u("stg_sinistres", "sinistre_key"),
    Check("accepted_range", "stg_sinistres", "taux_indemnisation_pct", min_value=0, max_value=100),
    *_u("stg_primes", "prime_key"),
]
INTERMEDIATE_CHECKS = [
    *_u("int_client_activity", "client_key"),
    Check("accepted_values", "int_client_activity", "statut_engagement", values=("Actif", "Modere", "Dormant")),
    *_u("int_transaction_features", "transaction_key"),
    *_u("int_contrat_performance", "contrat_key"),
    Check("accepted_range", "int_contrat_performance", "ratio_sp_pct", min_value=0, inclusive=True),
    Check("accepted_values", "int_contrat_performance", "statut_rentabilite",
          values=("Tres_Profitable", "Profitable", "Equilibre", "Deficitaire")),
]
MART_CHECKS = [
    *_u("fct_anomalies_transactions", "anomalie_key"),
    Check("accepted_range", "fct_anomalies_transactions", "score_anomalie", min_value=0, max_value=100),
    Check("accepted_values", "fct_anomalies_transactions", "niveau_severite",
          values=("Normal", "Faible", "Moyen", "Eleve", "Critique")),
    *_u("fct_churn_predictions", "prediction_key"),
    Check("accepted_range", "fct_churn_predictions", "score_churn", min_value=0, max_value=100),
    Check("accepted_values", "fct_churn_predictions", "segment_risque", values=("Faible", "Moyen", "Eleve", "Critique")),
    *_u("fct_performance_contrats", "performance_key"),
    *_u("fct_sinistralite", "sinistralite_key"),
]
CHECKS_BY_LAYER = {"raw": SOURCE_CHECKS, "staging": STAGING_CHECKS, "intermediate": INTERMEDIATE_CHECKS,
                   "marts": MART_CHECKS}
ALL_CHECKS = [c for layer in CHECKS_BY_LAYER.values() for c in layer]


def failing_rows(check: Check, tables: dict[str, DataFrame]) -> DataFrame:
    df = tables[check.model]
    c = F.col(check.column)
    if check.kind == "unique":
        return (df.filter(c.isNotNull()).groupBy(c.alias("unique_field"))
                .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))
    if check.kind == "not_null":
        return df.filter(c.isNull())
    if check.kind == "accepted_values":
        return (df.filter(c.isNotNull() & ~c.isin(list(check.values))).groupBy(c.alias("value_field"))
                .agg(F.count(F.lit(1)).alias("n_records")))
    if check.kind == "relationships":
        parent = tables[check.to_model].select(F.col(check.to_column).alias("__parent_key")).distinct()
        child = df.filter(c.isNotNull())
        return child.join(parent, c == F.col("__parent_key"), "left_anti")
    if check.kind == "accepted_range":
        return df.filter(~range_ok(c, check))
    raise ValueError(f"unknown check kind {check.kind}")


def range_ok(c: Column, check: Check) -> Column:
    """TRUE inside the range; NULL (-> not failing) for NULL values."""
    conds = []
    if check.min_value is not None:
        conds.append(c >= check.min_value if check.inclusive else c > check.min_value)
    if check.max_value is not None:
        conds.append(c <= check.max_value if check.inclusive else c < check.max_value)
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)


def row_fails(check: Check) -> Column:
    """TRUE for a failing row of a row-local check (not_null, accepted_range)."""
    c = F.col(check.column)
    return c.isNull() if check.kind == "not_null" else ~range_ok(c, check)


def _counted(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, failures): how many rows each condition holds for, all in one pass over ``df``."""
    counts = df.agg(*[F.count_if(cond).alias(f"r{k}") for k, cond in enumerate(rules.values())])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"r{k}").alias("failures"))
                                            for k, name in enumerate(rules)])))


def _distinct_bad_values(df: DataFrame, checks: list[Check]) -> DataFrame:
    """(rule, failures): distinct values outside the list of each accepted_values check, one pass over ``df``."""
    bad = [F.when(~F.col(ch.column).isin(list(ch.values)),
                  F.struct(F.lit(ch.test_id).alias("rule"), F.col(ch.column).cast("string").alias("v"))) for ch in checks]
    return df.select(F.explode(F.array_compact(F.array(*bad))).alias("x")).select("x.rule", "x.v").distinct() \
        .groupBy("rule").agg(F.count(F.lit(1)).alias("failures"))


def _exchanged(checks: dict[str, Check], tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """One row (failures) for each unique or relationships check, by the rule's name.

    Unique values are told by their hashes first (``repeats``); children are counted by key before they look for their parent."""
    unique = {rule: tables[ch.model].select(ch.column) for rule, ch in checks.items() if ch.kind == "unique"}
    again = repeats.repeated(unique) if unique else {}
    out = {}
    for rule, ch in checks.items():
        if ch.kind == "unique" and again[rule].n:
            suspects = again[rule].suspects(unique[rule], ch.column)
            out[rule] = failing_rows(ch, {ch.model: suspects}).agg(F.count(F.lit(1)).alias("failures"))
        elif ch.kind == "unique":
            out[rule] = unique[rule].sparkSession.range(1).select(F.lit(0).cast("long").alias("failures"))
        else:
            children = tables[ch.model].where(F.col(ch.column).isNotNull()).groupBy(F.col(ch.column).alias("__child_key")) \
                .agg(F.count(F.lit(1)).alias("__n"))
            parents = tables[ch.to_model].select(F.col(ch.to_column).alias("__parent_key"))
            out[rule] = children.join(parents, F.col("__child_key") == F.col("__parent_key"), "left_anti") \
                .agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("failures"))
    return out


def summary(checks: list[Check], tables: dict[str, DataFrame]) -> DataFrame:
    """One row per check: (test_id, kind, model, column_name, failures).

    The row-local checks of a table share one pass, its accepted_values checks another; unique and
    relationships checks need an exchange of their own."""
    spread = _exchanged({ch.test_id: ch for ch in checks if ch.kind in ("unique", "relationships")}, tables)
    parts = [failures.select(F.lit(rule).alias("rule"), "failures") for rule, failures in spread.items()]
    for model in dict.fromkeys(ch.model for ch in checks):
        own = [ch for ch in checks if ch.model == model]
        local = {ch.test_id: row_fails(ch) for ch in own if ch.kind in ("not_null", "accepted_range")}
        if local:
            parts.append(_counted(tables[model], local))
        listed = [ch for ch in own if ch.kind == "accepted_values"]
        if listed:
            parts.append(_distinct_bad_values(tables[model], listed))
    counts = reduce(DataFrame.unionByName, parts)
    declared = counts.sparkSession.range(1).select(F.inline(F.array(*[F.struct(
        F.lit(ch.test_id).alias("test_id"), F.lit(ch.kind).alias("kind"), F.lit(ch.model).alias("model"),
        F.lit(ch.column).alias("column_name")) for ch in checks])))
    return declared.join(F.broadcast(counts), declared["test_id"] == counts["rule"], "left") \
        .select("test_id", "kind", "model", "column_name", F.coalesce("failures", F.lit(0)).alias("failures"))


# ---------------------------------------------------------------- J10 load-time constraints
def constraint_violations(raw: dict[str, DataFrame]) -> DataFrame:
    """What the source DDL would reject at load: duplicate / NULL primary keys, orphan foreign
    keys, over-long strings and numbers overflowing their declared precision. One row per
    (table, constraint, column) with its violation count; the row-local ones share one pass per table."""
    parts, spread = [], {}
    named = lambda d, t: d.select(
        F.lit(t).alias("table_name"), F.split("rule", "\\|")[0].alias("constraint_name"),
        F.split("rule", "\\|")[1].alias("column_name"), F.col("failures").alias("violations"))
    for table in schemas.LOAD_ORDER:
        df = raw[table]
        pk = schemas.PRIMARY_KEYS[table]
        local = {f"primary_key_not_null|{pk}": F.col(pk).isNull()}
        for col, n in schemas.MAX_LENGTHS[table].items():
            local[f"max_length_{n}|{col}"] = F.length(F.col(col)) > n
        for f in schemas.RAW_SCHEMAS[table].fields:
            if f.dataType.typeName() == "decimal":
                bound = 10 ** (f.dataType.precision - f.dataType.scale)
                local[f"precision_{f.dataType.simpleString()}|{f.name}"] = F.abs(F.col(f.name)) >= bound
        parts.append(named(_counted(df, local), table))
        spread[f"primary_key_unique|{pk}|{table}"] = Check("unique", table, pk)
        spread |= {f"foreign_key|{col}|{table}": Check("relationships", table, col, to_model=parent, to_column=pcol)
                   for col, parent, pcol in schemas.FOREIGN_KEYS.get(table, [])}
    parts += [named(failures.select(F.lit(rule).alias("rule"), "failures"), spread[rule].model)
              for rule, failures in _exchanged(spread, raw).items()]
    return reduce(DataFrame.unionByName, parts)


def quarantine(raw_df: DataFrame, table: str, parents: dict[str, DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Split a raw table into (accepted, rejected) rows by the load-time constraints that are
    row-local (NULL key, over-long string). Duplicate keys and orphans are reported by
    ``constraint_violations`` rather than dropped."""
    pk = schemas.PRIMARY_KEYS[table]
    bad = F.col(pk).isNull()
    for col, n in schemas.MAX_LENGTHS[table].items():
        bad = bad | F.coalesce(F.length(F.col(col)) > n, F.lit(False))
    flagged = raw_df.withColumn("__rejected", bad)
    return (flagged.filter(~F.col("__rejected")).drop("__rejected"),
            flagged.filter(F.col("__rejected")).drop("__rejected"))
