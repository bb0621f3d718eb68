"""The registered queries over whole small tables, and the pipeline."""

from __future__ import annotations

import pytest

import corpus_pipeline
from checks.compare import connect, normal
from tickloom.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_operators_are_registered():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert normal(df.columns, [tuple(r) for r in df.collect()]) == normal(columns, cursor.fetchall())


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        sizes.append(docs.count())
    toxic, exact, near, mixed = sizes[1:5]
    assert sizes[0] >= toxic >= exact >= near == mixed > 0
    kept = {r["doc_id"] for r in before.select("doc_id").collect()}
    packed = docs.select("doc_id", "sequence_id", "offset", "length").collect()
    assert {r["doc_id"] for r in packed} == kept
    fill = {}
    for r in packed:
        fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
    assert max(fill.values()) <= 1024
    texts = [r["text"] for r in before.collect()]
    assert len({"".join(t.split()) for t in texts}) == len(texts)


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "piece", "sequence_id", "offset", "length"} <= set(out.columns)
    assert out.count() > 0
