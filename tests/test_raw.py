"""Exports of the source tables read back with canonical types give the same jobs' results."""

import os
import tempfile

import pytest

from periodix.catalog import plan_fact, world
from periodix.plans.plan_fact import fact_by_month, plan_by_month, plan_fact_mart
from periodix.operators.positions import contract_positions
from periodix.sources.raw import RAW_SCHEMAS, SOURCE_ATTRS, raw_sources, read_raw
from periodix.sources.views import register_views
from tests.conftest import SF_SMALL


def test_raw_sources_round_trip(spark):
    base = tempfile.mkdtemp(prefix="periodix-raw-")   # a new folder per run
    w = world(spark, SF_SMALL)
    for name, attr in SOURCE_ATTRS.items():
        df = getattr(w, attr)
        if name == "raw_spider__gandoper":
            df = df.drop("Ispol")                        # descriptive only: an export without it reads as nulls
        df.write.parquet(os.path.join(base, name))
    src = raw_sources(spark, base)
    g = read_raw(spark, base, "raw_spider__gandoper")
    assert [f.name for f in g.schema.fields] == [c for c, _ in RAW_SCHEMAS["raw_spider__gandoper"]]
    assert g.where("Ispol IS NOT NULL").count() == 0
    mart = plan_fact_mart(plan_by_month(src.gandoper, unique_key=True), fact_by_month(src.archive), src.gandoper,
                          contract_positions(src.vdc))
    assert mart.count() == plan_fact(w).count()


def test_missing_column_is_named(spark):
    base = tempfile.mkdtemp(prefix="periodix-raw-")   # a new folder per run
    world(spark, SF_SMALL).technique_workers.drop("hours", "res_code").write.parquet(os.path.join(base, "1_c__technique_workers"))
    with pytest.raises(ValueError, match="res_code, hours"):
        read_raw(spark, base, "1_c__technique_workers")


def test_views_over_real_exports(spark):
    base = tempfile.mkdtemp(prefix="periodix-raw-")   # a new folder per run
    w = world(spark, SF_SMALL)
    for name, attr in SOURCE_ATTRS.items():
        getattr(w, attr).write.parquet(os.path.join(base, name))
    assert set(register_views(raw_sources(spark, base))) == set(SOURCE_ATTRS)
    assert spark.sql("SELECT count(*) FROM raw_spider__calen_except").first()[0] > 0


def test_build_entry_point(spark):
    import json

    from periodix.catalog import cost_params
    from periodix.plans.build import main

    base = tempfile.mkdtemp(prefix="periodix-cli-")   # a new folder per run
    w = world(spark, SF_SMALL)
    for name, attr in SOURCE_ATTRS.items():
        getattr(w, attr).write.parquet(os.path.join(base, "src", name))
    cp = cost_params(w)
    params = {"own_contractor_name": w.params.own_contractor_name,
              "placeholder_analytics": list(w.params.placeholder_analytics),
              "plan_unique_key": True,
              "costs": {k: (list(v) if isinstance(v, tuple) else v) for k, v in cp.__dict__.items()}}
    with open(os.path.join(base, "params.json"), "w", encoding="utf-8") as fh:
        json.dump(params, fh, ensure_ascii=False)
    counts = main([os.path.join(base, "src"), os.path.join(base, "params.json"), os.path.join(base, "out")])
    assert counts["unique_position_key"] == 0
    assert os.path.isdir(os.path.join(base, "out", "plan_fact_mart"))
