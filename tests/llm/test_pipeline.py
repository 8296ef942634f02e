"""The pipeline, stage by stage, against plain Python on what the stage before kept."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from stockroom.llm.secrets import scan

from . import brute
from .test_decontam import brute as contaminated
from .test_packing import check

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    extra = spark.createDataFrame(
        [(10_001, None, "en", "x", None), (10_002, "", "en", "x", 0), (None, "a null id is kept", None, None, 17),
         (10_003, "secret = 'abcdefgh' end", "en", "x", 23)],
        docs.schema,
    )
    out = [docs.union(extra).cache()]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], FOLDER).cache())
    return out


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secret_scan", "packing"]
    assert all(s.columns == stages[0].columns for s in stages[1:5])


def test_toxic_documents_go(spark, stages):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    before, after = (s.join(labels, "doc_id") for s in stages[:2])
    assert after.filter("toxic = 0").count() >= 0.9 * before.filter("toxic = 0").count()
    assert {10_001, 10_002, None, 10_003} <= {r.doc_id for r in stages[1].collect()}


def test_one_of_each_group_stays(stages):
    want = brute.components([p for p in pairs(stages[1]) if p[0] is not None], 80)
    got = sorted(d for d, _ in pairs(stages[2]) if d is not None)
    assert got == sorted(d for d, (_, c) in want.items() if d == c)


def test_passages_go(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    want = [d for d, found in contaminated(pairs(stages[2]), items) if not found]
    assert sorted((d for d, _ in pairs(stages[3])), key=str) == sorted(want, key=str)


def test_secrets_are_masked(stages):
    assert {d for d, _ in pairs(stages[3])} == {d for d, _ in pairs(stages[4])}
    assert scan(stages[4]).filter(F.size("spans") > 0).isEmpty()
    after = dict(pairs(stages[4]))
    assert after[10_003] == "[SECRET]' end"
    clean = [(d, t) for d, t in pairs(stages[3]) if not any(brute.secrets(t)[:3]) and d != 10_003]
    assert all(after[d] == t for d, t in clean)


def test_packed_whole(stages):
    bins, least = check(stages[5].collect(), pairs(stages[4]), 4096)
    assert bins <= least + 1


def test_registered():
    assert "pipeline" in contract.queries() and "pipeline" not in contract.oracle_sql()
