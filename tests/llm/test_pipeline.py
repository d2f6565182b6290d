"""The pipeline's stages against their operators, one after the other, and the registered queries."""

import duckdb
import pytest

import corpus_pipeline
from portflow.llm import decontamination, quality_rules, queries, simhash
from portflow.llm.common import table, written

SF = "/root/testdata/sf0.001"


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages(spark):
    docs = table(spark, SF, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = written(stage(spark, docs, SF), name.replace(" ", "_"))
        assert out.columns == docs.columns
        kept[name], docs = (docs, out), out
    before, after = kept["quality rules"]
    assert ids(after) == ids(quality_rules.quality_rules(before).where("kept")) and after.count() < before.count()
    before, after = kept["line dedup"]
    assert ids(before) == ids(after) and after.where("n_chars <> length(text)").count() == 0
    before, after = kept["near dedup"]
    assert ids(after) == ids(simhash.near_duplicates(before).where("doc_id = component_id"))
    before, after = kept["decontamination"]
    assert ids(after) == ids(decontamination.contamination(before, table(spark, SF, "benchmark")).where("not contaminated"))
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert sorted({r["doc_id"] for r in packed.collect()}) == ids(docs)


def test_run_equals_its_stages(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_oracles(spark, key):
    con = duckdb.connect()
    for name in ("documents", "benchmark", "pages", "labels", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    got = queries.QUERIES[key](spark, SF)
    cur = con.execute(queries.ORACLE[key])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(got.columns)
    want = sorted((tuple(r) for r in cur.fetchall()), key=str)
    assert sorted((tuple(r) for r in got.select(*names).collect()), key=str) == want
