"""Relations by name in the catalog: one database a layer, comments, replaced by the next run."""

import os

from conftest import SF_SMOKE
from finsight import descriptions, schemas
from finsight.params import Params
from finsight.plans import catalog, pipeline
from finsight.plans.queries import Models
from finsight.sources import loader, rejects


def test_names_show_the_last_run(spark, scratch_dir):
    m, raw_root = Models(spark, SF_SMOKE), f"{scratch_dir}/raw"
    for t in ("clients", "transactions", "contrats"):
        loader.load_table(spark, t, rejects.typed_rules(m.raw[t], t), raw_root, cascade=False)
    raw = {t: loader.read_table(spark, raw_root, t) for t in ("clients", "transactions", "contrats")}
    pipeline.run_pipeline(spark, raw, Params(), scratch_dir, layers=["staging"], tags={"clients"}, run_tests=False, materialize_all=True)
    try:
        done = catalog.register(spark, scratch_dir, raw_root, "t1_")
        assert ("staging", "stg_clients", "view") in done and ("raw", "transactions", "table") in done
        n = m.stg("clients").count()
        assert spark.sql("SELECT count(*) FROM t1_staging.stg_clients").first()[0] == n
        assert spark.sql("SELECT count(*) FROM t1_raw.transactions WHERE date_transaction IS NOT NULL").first()[0] \
            == m.raw["transactions"].where("date_transaction IS NOT NULL").count()
        assert spark.table("t1_raw.clients").schema.simpleString() == schemas.CLIENTS.simpleString()
        said = {(r, c): t for r, c, t in catalog.comments(spark, "t1_")}
        assert said["staging.stg_clients", ""] == descriptions.of("stg_clients")[0]
        assert said["raw.contrats", "type_produit"] == "Type de produit (Auto, Habitation, etc.)"
        assert spark.catalog.getDatabase("t1_marts").description == descriptions.LAYERS["marts"]
        # the next run replaces what the name shows
        few = {"clients": raw["clients"].where("email IS NOT NULL").limit(3)}
        pipeline.run_pipeline(spark, few, Params(), scratch_dir, layers=["staging"], tags={"clients"}, run_tests=False, materialize_all=True)
        catalog.register(spark, scratch_dir, prefix="t1_")
        assert spark.sql("SELECT count(*) FROM t1_staging.stg_clients").first()[0] == 3
    finally:
        catalog.unregister(spark, "t1_")
    assert not spark.catalog.databaseExists("t1_raw") and os.path.isdir(f"{raw_root}/clients")
    assert loader.read_table(spark, raw_root, "clients").count() == m.raw["clients"].count()
    catalog.unregister(spark, "t1_")  # nothing left to drop


def test_every_described_column_exists(spark):
    from finsight.plans.queries import QUERIES, check_tables
    tables = check_tables(Models(spark, SF_SMOKE))
    for relation, (_, columns) in descriptions.RELATIONS.items():
        if columns:
            have = schemas.RAW_SCHEMAS[relation].fieldNames() if relation in schemas.RAW_SCHEMAS else tables[relation].columns
            assert set(columns) <= set(have), relation
    assert set(descriptions.RELATIONS) - set(schemas.RAW_SCHEMAS) <= set(pipeline.REGISTRY)
    assert QUERIES
