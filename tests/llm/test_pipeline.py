"""Each stage of the pipeline against brute force on its own input."""

from collections import Counter

import pytest
from test_linededup import brute_force as lines
from test_mixing import brute_force as mix
from test_ngramjoin import brute_force as near
from test_packing import check

import __spark_entry__ as entry
import corpus_pipeline
from tamarack.llm.queries import PIPELINE_MIX, REFERENCE, op9_toxicity
from tamarack.llm.scratch import Scratch


@pytest.fixture(scope="module")
def stages(spark, sf):
    scratch, docs = Scratch(spark, "test"), spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.write(stage(spark, docs, sf), name)
        out.append(docs)
    return out


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_columns(stages):
    assert all(d.columns == stages[0].columns for d in stages[:5])


def test_toxic_documents_go(spark, sf, stages):
    clean = {r.doc_id for r in op9_toxicity(spark, sf).where("predicted = 0").collect()}
    assert sorted(rows(stages[1])) == sorted(r for r in rows(stages[0]) if r[0] in clean)


def test_repeated_lines_go(stages):
    expected = [(i, t, len(t)) for i, t, _, _ in lines(rows(stages[1]), 10)]
    assert sorted(tuple(r) for r in stages[2].select("doc_id", "text", "n_chars").collect()) == sorted(expected)


def test_one_of_each_group_stays(stages):
    kept = {r[0] for r in near(rows(stages[2])) if r[4]}
    assert sorted(rows(stages[3])) == sorted(r for r in rows(stages[2]) if r[0] in kept)


def test_epochs(stages):
    given = [r.asDict() for r in stages[3].collect()]
    for r in given:
        r["domain"] = "crawl" if r["source"] == "src0" else "reference" if r["source"] in REFERENCE else "forum"
    expected = Counter({i: n for i, _, n in mix(given, PIPELINE_MIX) if n})
    assert Counter(r[0] for r in rows(stages[4])) == expected


def test_packed(stages):
    check(rows(stages[4]), stages[5].collect())


def test_run_is_the_stages(spark, sf, stages):
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = entry.queries()["pipeline"](spark, sf)
    assert Counter(got.select(*names).collect()) == Counter(stages[5].select(*names).collect())
    assert set(entry.oracle_sql()) <= set(entry.queries())
