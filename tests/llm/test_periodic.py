import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tamarack.llm import periodic
from tamarack.llm.queries import op11_periodic_runs, with_repeats


def brute_force(words, least):
    """Every period's stretches, unless a smaller period holds in them."""
    n, out = len(words), []
    for q in range(1, n):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least, 2 * q) and j > i:
                part = words[i:i + length]
                if all(any(part[k] != part[k + p] for k in range(length - p)) for p in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.sampled_from([2, 3, 4, 12]))
def test_runs_of_few_words(words, least):
    assert periodic.runs(np.array(words, np.int64), least) == brute_force(words, least)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**9), st.integers(1, 6), st.sampled_from([2, 12]))
def test_runs_of_planted_repeats(seed, kinds, least):
    """Repeats within repeats, with single words changed."""
    draw = random.Random(seed)
    words = [draw.randrange(kinds) for _ in range(draw.randrange(1, 12))]
    for _ in range(4):
        words = (words * draw.randrange(1, 4) + [draw.randrange(50)] * draw.randrange(3))[:150]
        words[draw.randrange(len(words))] = draw.randrange(kinds)
    assert periodic.runs(np.array(words, np.int64), least) == brute_force(words, least)


def test_long_runs():
    for words, run in ((np.tile(np.arange(3), 40_000), (0, 120_000, 3)), (np.tile(np.arange(30_000), 4), (0, 120_000, 30_000))):
        assert periodic.runs(words) == [run]
    assert periodic.runs(np.arange(200_000) % 150_000) == []


def expected(doc_id, text):
    words = with_repeats({"doc_id": doc_id}, (text or "").encode().split())
    found = brute_force(words, 12)
    drop = {i for s, n, q in found for i in range(s + q, s + n)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2])) if found else (None, None, None)
    sha = lambda s: hashlib.sha256(s).hexdigest()
    return (
        doc_id, len(found), *best, None if not found else 1000 * best[1] // best[2], sha("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()),
        sha(b" ".join(w for i, w in enumerate(words) if i not in drop)),
    )


def test_query_is_brute_force(spark, tmp_path, documents):
    draw = random.Random(5)
    rows = [(i, " ".join(draw.choice("abcdefg") * draw.randint(1, 2) for _ in range(draw.randint(0, 120)))) for i in range(300)]
    rows += [(300, None), (301, ""), (302, " \t\n\x0b "), (303, "a b " * 30), (303, "a b " * 30), (None, "x y z " * 9), (304, "one word\x85 here " * 12), (305, "Uno dos\ntres " * 2)]
    documents(rows).withColumn("_runs", F.lit(1)).write.parquet(f"{tmp_path}/documents.parquet")
    got = op11_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr(expected(*r)) for r in rows)
    assert sum(r.n_runs for r in got.collect()) > 25


@pytest.mark.parametrize("clash", ["_runs", "_kept"])
def test_odd_rows(spark, documents, clash):
    """Null, empty, repeated and very long texts; columns that the operator writes."""
    long = "w1 w2 w3 w4 w5 w6 w7 " * 30_000
    df = documents([(1, None), (2, ""), (3, long), (3, long)]).withColumn(clash, F.lit("clash"))
    got = periodic.with_runs(df).orderBy("doc_id").collect()
    assert [len(r._runs) for r in got] == [0, 0, 1, 1]
    assert got[2]._runs[0].asDict() == {"start": 0, "length": 210_000, "period": 7}
    assert [r._kept for r in got] == ["", "", "w1 w2 w3 w4 w5 w6 w7", "w1 w2 w3 w4 w5 w6 w7"]
