"""The relations of a run under their names in the catalog: one database a layer, ``SELECT ... FROM marts.fct_sinistralite``.

Raw tables and marts are tables, staging and intermediate models are views; each carries its comments (``descriptions``). They
stand for the stored versions of a run (``pipeline.run_pipeline(materialize_all=True)``): a table's location and a view's text
name a version's folder, and registering a later run replaces both, so names only ever show complete tables. Nothing is read
or copied but the listing of a partitioned table's folders."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from finsight import descriptions, schemas
from finsight.plans.pipeline import REGISTRY
from finsight.sources import loader, snapshots


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(*parts: str) -> str:
    return ".".join(f"`{p.replace('`', '``')}`" for p in parts)


def _columns(rows: DataFrame, comments: dict[str, str], types: bool) -> str:
    out = []
    for f in rows.schema.fields:
        said = f" COMMENT {_text(comments[f.name])}" if f.name in comments else ""
        out.append(_name(f.name) + (f" {f.dataType.simpleString()}" if types else "") + said)
    return ", ".join(out)


def databases(spark: SparkSession, prefix: str = "") -> None:
    """One database a layer, with its comment."""
    for layer, comment in descriptions.LAYERS.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_name(prefix + layer)} COMMENT {_text(comment)}")


def register_view(spark: SparkSession, database: str, relation: str, rows: DataFrame, path: str) -> None:
    """A view over a stored version."""
    comment, columns = descriptions.of(relation)
    names = ", ".join(_name(c) for c in rows.columns)
    spark.sql(f"CREATE OR REPLACE VIEW {_name(database, relation)} ({_columns(rows, columns, types=False)}) "
              f"COMMENT {_text(comment)} AS SELECT {names} FROM parquet.{_name(path)}")


def register_table(spark: SparkSession, database: str, relation: str, rows: DataFrame, path: str,
                   partition_by: tuple[str, ...] = ()) -> None:
    """A table whose rows are a stored version; the files are the run's, dropping the name leaves them."""
    comment, columns = descriptions.of(relation)
    ordered = rows.select(*[c for c in rows.columns if c not in partition_by], *partition_by)
    by = f" PARTITIONED BY ({', '.join(map(_name, partition_by))})" if partition_by else ""
    spark.sql(f"DROP TABLE IF EXISTS {_name(database, relation)}")
    spark.sql(f"CREATE TABLE {_name(database, relation)} ({_columns(ordered, columns, types=True)}) USING parquet{by} "
              f"LOCATION {_text(path)} COMMENT {_text(comment)}")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {_name(database, relation)}")


def register(spark: SparkSession, root: str, raw_root: str | None = None, prefix: str = "") -> list[tuple[str, str, str]]:
    """Register what is stored under ``root`` (and the loaded raw tables): (layer, relation, kind) of each."""
    databases(spark, prefix)
    done = []
    for table in schemas.LOAD_ORDER if raw_root else ():
        found = snapshots.current(spark, raw_root, table)
        if found is not None and found.key != loader.EMPTIED:
            by = (loader.PARTITION_BY[table],) if table in loader.PARTITION_BY else ()
            register_table(spark, f"{prefix}raw", table, loader.read_table(spark, raw_root, table), f"{found.path}/{loader.ACCEPTED}", by)
            done.append(("raw", table, "table"))
    for m in REGISTRY.values():
        found = snapshots.current(spark, root, f"{m.layer}/{m.name}")
        if found is None:
            continue
        rows = spark.read.parquet(found.path)
        if m.materialized == "table":
            register_table(spark, prefix + m.layer, m.name, rows, found.path, m.partition_by)
        else:
            register_view(spark, prefix + m.layer, m.name, rows, found.path)
        done.append((m.layer, m.name, m.materialized))
    return done


def relations(spark: SparkSession, prefix: str = "") -> list[tuple[str, str, str]]:
    """(layer, relation, kind) as the catalog lists them."""
    return [(layer, t.name, "view" if t.tableType == "VIEW" else "table") for layer in descriptions.LAYERS
            for t in spark.catalog.listTables(prefix + layer) if not t.isTemporary]


def comments(spark: SparkSession, prefix: str = "") -> list[tuple[str, str, str]]:
    """(layer.relation, column or empty for the relation, comment) as the catalog holds them."""
    out = []
    for layer, relation, _ in relations(spark, prefix):
        about = spark.catalog.getTable(_name(prefix + layer, relation)).description
        out += [(f"{layer}.{relation}", "", about)] if about else []
        out += [(f"{layer}.{relation}", c.name, c.description) for c in spark.catalog.listColumns(_name(prefix + layer, relation))
                if c.description]
    return out


def unregister(spark: SparkSession, prefix: str = "") -> None:
    """Drop the names; the stored versions stay."""
    for layer in descriptions.LAYERS:
        try:
            spark.sql(f"DROP DATABASE {_name(prefix + layer)} CASCADE")
        except AnalysisException as e:
            if e.getCondition() != "SCHEMA_NOT_FOUND":
                raise
