"""Model registry and layered runner (K1-K3).

Every model is a function of upstream DataFrames and ``Params``. ``run_pipeline`` walks the
layers in order: build the layer's models (staging and intermediate as lazy views, marts
written as Parquet tables and read back, which also cuts their lineage), run the layer's
declared checks (the source checks run with the staging layer), store failing rows under
``<root>/test_failures/<test_id>``, and stop before the next layer when a check of severity
``error`` fails. Models can be selected by tag.

With ``quarantine`` the run goes on instead: raw rows that break a declared rule of their table (keys, lengths, foreign keys, and
the source checks) are set aside under ``<root>/quarantine`` before the first layer, with those that refer to them, and the
layers are built and tested on the others.

Tables are published in one step (``sources.snapshots``); each says which raw rows and parameters it was made from, and a later run takes
it only if both are its own.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finsight import schemas
from finsight.operators import features, quality, staging
from finsight.params import Params
from finsight.plans import marts
from finsight.sources import loader, rejects, snapshots

LAYERS = ["staging", "intermediate", "marts"]


@dataclass(frozen=True)
class Model:
    name: str
    layer: str
    deps: tuple[str, ...]
    build: Callable[..., DataFrame]
    tags: frozenset = field(default_factory=frozenset)
    materialized: str = "view"
    partition_by: tuple[str, ...] = ()


def _m(name, layer, deps, build, tags=(), materialized="view", partition_by=()):
    return Model(name, layer, tuple(deps), build, frozenset((layer, *tags)), materialized, tuple(partition_by))


REGISTRY: dict[str, Model] = {m.name: m for m in [
    _m("stg_clients", "staging", ["clients"], staging.stg_clients, ["clients"]),
    _m("stg_transactions", "staging", ["transactions"], staging.stg_transactions, ["transactions"]),
    _m("stg_contrats", "staging", ["contrats"], staging.stg_contrats, ["contrats"]),
    _m("stg_sinistres", "staging", ["sinistres"], staging.stg_sinistres, ["sinistres"]),
    _m("stg_primes", "staging", ["primes"], staging.stg_primes, ["primes"]),
    _m("int_client_activity", "intermediate",
       ["stg_clients", "stg_transactions", "stg_contrats", "stg_sinistres"], features.client_activity, ["client"]),
    _m("int_transaction_features", "intermediate", ["stg_transactions"], features.transaction_features,
       ["transactions", "anomalies"]),
    _m("int_contrat_performance", "intermediate", ["stg_contrats", "stg_sinistres", "stg_primes"],
       features.contrat_performance, ["contrats", "portefeuille"]),
    _m("fct_anomalies_transactions", "marts", ["int_transaction_features"], marts.fct_anomalies_transactions,
       ["anomalies"], "table", partition_by=["date_detection"]),
    _m("fct_anomalies_summary", "marts", ["fct_anomalies_transactions"], marts.fct_anomalies_summary,
       ["anomalies", "summary"], "table"),
    _m("fct_churn_predictions", "marts", ["int_client_activity"], marts.fct_churn_predictions, ["churn"], "table"),
    _m("dim_client_segments", "marts", ["fct_churn_predictions"], marts.dim_client_segments,
       ["churn", "dimensions"], "table"),
    _m("fct_performance_contrats", "marts", ["int_contrat_performance"], marts.fct_performance_contrats,
       ["portefeuille"], "table"),
    _m("fct_sinistralite", "marts", ["stg_contrats", "stg_clients", "stg_sinistres", "stg_primes"],
       marts.fct_sinistralite, ["portefeuille"], "table"),
    _m("fct_kpis_portefeuille", "marts",
       ["stg_clients", "stg_contrats", "stg_sinistres", "stg_primes", "fct_churn_predictions"],
       marts.fct_kpis_portefeuille, ["portefeuille", "kpis"], "table"),
]}


def select(layer: str | None = None, tags: set[str] | None = None) -> list[Model]:
    """K2: models of a layer and/or carrying all of ``tags``, in dependency order."""
    out = [m for m in topo_order() if (layer is None or m.layer == layer) and (not tags or tags <= m.tags)]
    return out


def topo_order() -> list[Model]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen or n not in REGISTRY:
            return
        for d in REGISTRY[n].deps:
            visit(d)
        seen.append(n)

    for name in REGISTRY:
        visit(name)
    return [REGISTRY[n] for n in seen]


@dataclass
class StepResult:
    step: str
    name: str
    status: str
    detail: str = ""


class PipelineFailed(RuntimeError):
    pass


def run_pipeline(spark: SparkSession, raw: dict[str, DataFrame], p: Params, root: str,
                 layers: list[str] | None = None, tags: set[str] | None = None,
                 run_tests: bool = True, raise_on_failure: bool = False,
                 materialize_all: bool = False, reuse_materialized: bool = True,
                 raw_id: str | None = None, quarantine: bool = False) -> tuple[dict[str, DataFrame], list[StepResult]]:
    """K1: run → test → next layer. Returns the built relations and a step log.

    ``materialize_all=True`` writes views too (staging, intermediate): each layer is then computed
    once and read by every downstream model and test, and every layer boundary cuts the lineage
    (the recommended mode on large inputs). ``raw_id`` names the state of the raw rows (``loader.snapshot_id``): tables
    of an earlier run are only taken, and those of this run only offered, with such a name. ``quarantine`` sets bad raw rows
    aside and goes on with the others."""
    log: list[StepResult] = []
    root = root.rstrip("/")
    if quarantine:
        raw = _quarantined(spark, raw, root, log)
    rel: dict[str, DataFrame] = dict(raw)
    key = None if raw_id is None else run_key(p, f"{raw_id} quarantined" if quarantine else raw_id)

    def ensure(name: str) -> DataFrame:
        """An upstream relation that was not selected resolves to the table an earlier run with the
        same raw rows and parameters wrote under ``root`` (like a reference to an existing relation); otherwise
        it is built on demand as a lazy view."""
        if name not in rel:
            up = REGISTRY[name]
            stored = _read_stored(spark, root, up, key) if reuse_materialized else None
            if stored is not None:
                rel[name] = stored
                log.append(StepResult("read", name, "ok", "stored table"))
            else:
                rel[name] = up.build(*[ensure(d) for d in up.deps], p)
                log.append(StepResult("run", name, "ok", "upstream view"))
        return rel[name]

    for layer in layers or LAYERS:
        for m in select(layer, tags):
            df = m.build(*[ensure(d) for d in m.deps], p)
            if m.materialized == "table" or materialize_all:
                df = _store(spark, df, root, m, key)
            rel[m.name] = df
            log.append(StepResult("run", m.name, "ok", "table" if materialize_all else m.materialized))
        if run_tests:
            declared = quality.CHECKS_BY_LAYER[layer]
            if layer == "staging":  # source tests are declared with, and run by, the staging layer
                declared = quality.SOURCE_CHECKS + declared
            checks = [c for c in declared if c.model in rel and (c.to_model is None or c.to_model in rel)]
            if not _test(spark, checks, rel, root, log):
                return _stop(rel, log, layer, raise_on_failure)
    return rel, log


def run_key(p: Params, raw_id: str) -> str:
    """What a stored table depends on: the raw rows, the as-of date and every parameter."""
    return f"{raw_id} {p!r}"


def _store(spark: SparkSession, df: DataFrame, root: str, m: Model, key: str | None) -> DataFrame:
    """Publish a model's table under the key of this run (none: no later run takes it)."""
    rows = df.hint("rebalance", *m.partition_by) if m.partition_by else df
    found = snapshots.publish(rows, root, f"{m.layer}/{m.name}", key or "", m.partition_by)
    return spark.read.parquet(found.path).select(*df.columns)


def _read_stored(spark: SparkSession, root: str, m: Model, key: str | None) -> DataFrame | None:
    """The stored table of a model if a run on the same raw rows with the same parameters published it, else None."""
    found = snapshots.current(spark, root, f"{m.layer}/{m.name}")
    return spark.read.parquet(found.path) if found is not None and key and found.key == key else None


def read_model(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The stored table of a model, whichever run published it."""
    m = REGISTRY[name]
    return snapshots.read(spark, root, f"{m.layer}/{m.name}")


def source_rules(table: str) -> dict[str, Column]:
    """The declared source checks of a table that a row breaks by itself, beyond its key."""
    own = [c for c in quality.SOURCE_CHECKS if c.model == table and c.column != schemas.PRIMARY_KEYS[table]]
    rules = {f"not_null|{c.column}": F.col(c.column).isNull() for c in own if c.kind == "not_null"}
    return rules | {f"accepted_values|{c.column}": F.col(c.column).isNotNull() & ~F.col(c.column).isin(list(c.values))
                    for c in own if c.kind == "accepted_values"}


def _quarantined(spark: SparkSession, raw: dict[str, DataFrame], root: str, log: list[StepResult]) -> dict[str, DataFrame]:
    """The raw rows that break no rule, parents first; the others stay under ``<root>/quarantine`` with their reasons."""
    kept: dict[str, DataFrame] = {}
    given = set(raw.keys())
    for table in [t for t in schemas.LOAD_ORDER if t in given]:
        rules = source_rules(table)
        got = loader.load_table(spark, table, rejects.typed_rules(raw[table], table, rules), f"{root}/quarantine", more=rules,
                                cascade=False, checked=set(kept), cheap=True)
        kept[table] = loader.read_table(spark, f"{root}/quarantine", table)
        log += [StepResult("quarantine", f"{table}.{rule}", "rejected", str(n)) for rule, n in sorted(got.counts.items())]
        log.append(StepResult("quarantine", table, "accepted", str(got.rows)))
    return kept


def _test(spark: SparkSession, checks, rel, root: str, log: list[StepResult]) -> bool:
    if not checks:
        return True
    counts = {r["test_id"]: r["failures"] for r in quality.summary(checks, rel).collect()}  # one row per check
    ok = True
    for ch in checks:
        n = counts[ch.test_id]
        if n:
            quality.failing_rows(ch, rel).write.mode("overwrite").parquet(f"{root}/test_failures/{ch.test_id}")
            ok = ok and ch.severity != "error"
        log.append(StepResult("test", ch.test_id, "pass" if n == 0 else "fail", str(n)))
    return ok


def _stop(rel, log, layer, raise_on_failure):
    log.append(StepResult("stop", layer, "failed", "a test of this layer failed"))
    if raise_on_failure:
        raise PipelineFailed(f"tests failed in layer {layer}")
    return rel, log


def log_frame(spark: SparkSession, log: list[StepResult]) -> DataFrame:
    return spark.createDataFrame([(s.step, s.name, s.status, s.detail) for s in log],
                                 "step string, name string, status string, detail string") \
        .withColumn("seq", F.monotonically_increasing_id())
