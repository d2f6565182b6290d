"""The rule compiler: counts by hand, one scan a fact, large dimensions, and a whole load that breaks no rule."""

import glob
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from portflow import schemas
from portflow.operators import rules
from portflow.plans import constraints, jobs
from portflow.sources.testdata import model

from tests.test_end_to_end import _feeds

SF = "/root/testdata/sf0.001"

RULES = rules.TableRules(not_null=("a", "name"), max_len={"name": 3}, checks={"positive": "a > 0", "known": "name IN ('x', 'yy')"},
                         foreign={"a": ("dim", "id"), "b": ("dim", "id")}, unique=(("a", "name"), ("b",)))


def _frames(spark):
    fact = spark.createDataFrame([(1, "x", 1), (1, "x", None), (None, "long", 7), (-1, None, 2), (2, "zz", 2)], "a int, name string, b int")
    dim = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id int")
    return {"fact": fact, "dim": dim}


@pytest.mark.parametrize("bound", [100, 0])
def test_counts_by_hand(spark, bound):
    got = {(r["kind"], r["rule"]): r["violations"] for r in rules.violations("fact", RULES, _frames(spark), max_broadcast_rows=bound).collect()}
    assert got == {("not_null", "a"): 1, ("not_null", "name"): 1, ("max_len", "name"): 1, ("check", "positive"): 1, ("check", "known"): 2,
                   ("foreign", "a"): 1, ("foreign", "b"): 1, ("unique", "a,name"): 2, ("unique", "b"): 2}


def test_broken_rules_abort(spark):
    with pytest.raises(rules.ConstraintError, match=r"fact.a \(foreign\): 1"):
        rules.assert_clean(rules.violations("fact", RULES, _frames(spark), ("foreign",)))
    rules.assert_clean(rules.violations("dim", rules.TableRules(checks={"any": "id > 0"}), _frames(spark)))
    with pytest.raises(ValueError):
        rules.violations("fact", rules.TableRules(), _frames(spark))


def test_facts_are_scanned_once(spark):
    m = model(spark, SF)
    frames = constraints.model_frames(m)
    for table, source in (("fact_trade", "lineitem"), ("fact_crossing", "orders"), ("fact_wait", "events")):
        found = rules.violations(table, constraints.star_schema(m.p.borders)[table], frames)
        plan = found._jdf.queryExecution().sparkPlan().toString()
        assert sum("FileScan" in x and f"{source}.parquet" in x for x in plan.splitlines()) == 1, plan
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_all_rules_of_the_schema_are_there():
    star = constraints.star_schema()
    n = {kind: sum(len(r.names(kind)) for r in star.values()) for kind in rules.KINDS}
    assert n == {"not_null": 49, "max_len": 17, "check": 18, "foreign": 10, "unique": 11}


def test_large_dimensions_give_the_same(spark):
    star = constraints.star_schema()
    frames = constraints.model_frames(model(spark, SF))
    small, large = (sorted(map(tuple, rules.violations("fact_trade", star["fact_trade"], frames, max_broadcast_rows=n).collect())) for n in (10_000, 0))
    assert small == large and len(small) == 25


def test_loose_files_and_archives_load_alike_and_clean(spark, workdir):
    """Months in archives, some twice, give the rows that loose files give; the written warehouse breaks no rule."""
    feeds = _feeds(workdir)
    loose = jobs.national_rows(spark, feeds).drop("_file")
    os.makedirs(f"{workdir}/zips")
    months = {y: sorted(glob.glob(f"{workdir}/nat/{y}-*/*.csv")) for y in (2022, 2023)}
    for y, paths in months.items():
        with zipfile.ZipFile(f"{workdir}/zips/{y}.zip", "w", zipfile.ZIP_DEFLATED) as z:
            for p in paths + months[2023][:2] * (y == 2022):
                z.write(p, os.path.basename(p))
    mixed = jobs.FeedPaths(national=[f"{workdir}/nat/{y}-*/*.csv" for y in (2019, 2020, 2021, 2022, 2024)], crossing=feeds.crossing, wait=feeds.wait, mirror=feeds.mirror, archives=f"{workdir}/zips/*.zip")
    rows = jobs.national_rows(spark, mixed)
    assert rows.drop("_file").exceptAll(loose).count() == 0 == loose.exceptAll(rows.drop("_file")).count()
    assert rows.where(F.col("_file").contains("2022.zip")).select("MONTH").distinct().count() == 2
    assert rows.dtypes == jobs.national_rows(spark, feeds).dtypes and [f.name for f in schemas.NATIONAL_CSV.fields] == rows.columns[:-1]
    counts = jobs.load_feeds(spark, mixed, f"{workdir}/wh")
    assert counts["fact_trade"] == 71 * 5 * 2 + 1
    found = rules.schema_violations(constraints.star_schema(), constraints.warehouse_frames(spark, f"{workdir}/wh"))
    assert [tuple(r) for r in found.where("violations > 0").collect()] == []
    assert spark.read.parquet(f"{workdir}/wh/dim_date").agg(F.min("date_id")).first()[0] == 19960101


def test_cell_against_its_known_value(spark):
    from dataclasses import replace

    from portflow.plans.checks import dq_v3_cell
    from portflow.sources.testdata import Params

    sf = "/root/testdata/sf0.01"
    month = model(spark, sf).trade().where("port_id = 1 AND direction = 'Import' AND data_source = 'national'") \
        .join(model(spark, sf).dim_mode().where("mode_canonical_name = 'Truck'"), "mode_id").agg(F.min("date_id")).first()[0]
    cell = replace(Params(), check_cell=("Truck", "Import", month))
    r = dq_v3_cell(model(spark, sf, cell)).first()
    assert r["n"] > 0 and r["expected"] is None and r["as_expected"] is None
    known = replace(cell, check_cell_value=float(r["value_usd"]))
    assert dq_v3_cell(model(spark, sf, known)).first()["as_expected"] is True
    assert dq_v3_cell(model(spark, sf, replace(known, check_cell_value=1.0))).first()["as_expected"] is False
