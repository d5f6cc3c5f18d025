"""Registered queries against their SQL, and the pipeline against its stages' own rules."""

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from sessionloom.llm import quality_rules, simhash, toxicity, winnowing
from sessionloom.llm.oracles import ORACLES
from sessionloom.llm.queries import QUERIES

TABLES = ["documents", "pages", "benchmark", "labels", "embeddings"]
NATIVE = ["op1_mixing", "op5_quality_rules", "op6_decontamination", "op9_licenses"]


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    expected = sorted((tuple(r[columns.index(c)] for c in sorted(columns)) for r in result.fetchall()), key=repr)
    assert sorted((tuple(r) for r in df.select(sorted(columns)).collect()), key=repr) == expected


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans_hold_no_python(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


def test_all_are_registered():
    names = set(contract.queries())
    assert set(QUERIES) < names and "pipeline" in names
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}


def test_pipeline_follows_its_stages(spark, sf_dir):
    """Each stage keeps exactly what its operator's own verdict keeps of the stage before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("labels", "benchmark"))
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    verdicts = [
        lambda d: ids(quality_rules.judged(d, "doc_id").filter("kept")),
        lambda d: ids(toxicity.scored(d, labels).filter("predicted = 0")),
        lambda d: {r.component for r in simhash.clustered(d).collect()},
        lambda d: ids(winnowing.contamination(d, bench).filter("not contaminated")),
    ]
    for (name, stage), verdict in zip(corpus_pipeline.STAGES, verdicts):
        out = stage(spark, docs, sf_dir)
        assert out.columns == corpus_pipeline.COLUMNS, name
        kept = ids(out)
        assert kept == verdict(docs) and out.count() == len(kept) > 0, name
        docs = spark.createDataFrame(out.collect(), out.schema).repartition(2)
    mix = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert ids(mix) <= ids(docs) and mix.columns == [*corpus_pipeline.COLUMNS, "epoch"]
