import math

import numpy as np
import pytest

from tamarack.llm import embeddings
from tamarack.llm.queries import op8_embedding_near_dedup


def brute_force(rows, threshold=0.9):
    ok = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    unit = [np.array(v) / np.abs(v).max() / np.linalg.norm(np.array(v) / np.abs(v).max()) if good else None for (_, v), good in zip(rows, ok, strict=True)]
    n = len(rows)
    near = [[i != j and ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= threshold for j in range(n)] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            x = todo.pop()
            new = {j for j in range(n) if near[x][j]} - seen
            seen |= new
            todo += new
        root = min(rows[j][0] for j in seen)
        out.append((rows[i][0], sum(near[i]), root, rows[i][0] == root))
    return sorted(out)


def result(spark, rows, how=embeddings.Setting()):
    df = spark.createDataFrame([(i, v, 0, "clash") for i, v in rows], "vec_id long, embedding array<double>, label int, node string")
    return sorted(tuple(r) for r in embeddings.near_dedup(df, how).collect())


def groups(n, size, spread, dims=16, seed=0):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(n, dims))
    return [(i, (centres[i % n] + spread * draw.normal(size=dims)).tolist()) for i in range(n * size)]


def test_same_as_all_pairs(spark):
    rows = groups(60, 5, 0.25)
    expected = brute_force(rows)
    assert len({r[1] for r in expected}) > 3
    got = result(spark, rows, embeddings.Setting(per_list=8, block=16))
    assert sum(r[1] for r in got) >= 0.9 * sum(r[1] for r in expected)
    assert all(g[1] <= e[1] for g, e in zip(got, expected, strict=True))


def test_all_lists_visited_is_exact(spark):
    rows = groups(40, 6, 0.3, seed=4)
    assert result(spark, rows, embeddings.Setting(per_list=8, block=16, nearest=10**6, probes=10**6)) == brute_force(rows)


def test_recall_at_the_threshold_holds_with_many_lists(spark):
    """Pairs planted just above the threshold, over about as many lists as vectors: 12 visits lose a tenth."""
    draw = np.random.default_rng(5)
    x, away = (embeddings.unit(draw.normal(size=(400, 64))) for _ in range(2))
    away = embeddings.unit(away - (away * x).sum(1, keepdims=True) * x)
    y = 0.801 * x + np.sqrt(1 - 0.801**2) * away
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([x, y]))]
    got = result(spark, rows, embeddings.Setting(threshold=0.8, per_list=1, sample_per_centroid=8))
    assert sum(r[1] for r in got) >= 0.95 * 800
    assert sum(r[3] for r in got) <= 400 + 0.05 * 400


def test_hot_group_over_many_cells(spark):
    rows = groups(1, 150, 0.05) + [(1000 + i, v) for i, v in groups(30, 1, 0, seed=3)]
    assert result(spark, rows, embeddings.Setting(block=16)) == brute_force(rows)


def test_odd_rows(spark):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [math.nan, 1.0]), (6, [math.inf, 1.0]), (7, [1.0, 0.0]), (8, [1.0, 0.0]), (9, [1e200, 1e-200]), (10, [1e-300, 0.0]), (11, [1.0, 0.0, 0.0]), (12, [-1.0, 0.0])]
    assert result(spark, rows) == brute_force(rows)
    assert result(spark, [(1, None)]) == [(1, 0, 1, True)]
    assert result(spark, []) == []


@pytest.mark.parametrize("usual", [10**6, 10, 1, 0])
def test_vectors_of_every_length_are_searched(spark, usual):
    """With codebooks for each length, for the most frequent one, and for none."""
    rows = groups(20, 4, 0.1) + [(1000 + i, v) for i, v in groups(6, 3, 0.05, dims=3, seed=2)] + [(2000, [1.0]), (2001, [5.0]), (2002, [-1.0])]
    rows += [(3000, [1.0, 0.0, 0.0]), (3001, [1.0, 0.01, 0.0])]
    expected = brute_force(rows)
    assert expected[-1][1] >= 1
    assert result(spark, rows, embeddings.Setting(block=16, usual=usual, nearest=10**6, probes=10**6)) == expected


def test_query_finds_planted_copies(spark, sf, tmp_path):
    """The given table holds no pair at 0.9, so near copies of its vectors are added: all pairs against the query."""
    given = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    draw = np.random.default_rng(1)
    near = [(100_000 + i, (np.array(v) + 0.04 * np.linalg.norm(v) * draw.normal(size=len(v))).tolist()) for i, (_, v) in enumerate(given[:300])]
    schema = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").schema
    spark.createDataFrame(given + near, schema).write.parquet(f"{tmp_path}/embeddings.parquet")
    stored = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{tmp_path}/embeddings.parquet").collect()]
    x = embeddings.unit(np.array([v for _, v in stored], np.float64))
    links = (x @ x.T >= 0.9).sum(1) - 1
    got = {r.vec_id: r for r in op8_embedding_near_dedup(spark, str(tmp_path)).collect()}
    assert links.sum() > 400 and len(got) == len(stored)
    assert {i: got[i].n_links for i, _ in stored} == {i: n for (i, _), n in zip(stored, links)}
    assert sum(not r.kept for r in got.values()) == sum(i >= 100_000 and n > 0 for (i, _), n in zip(stored, links))


def test_repeated_rows(spark):
    assert result(spark, [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [2.0, 4.0])]) == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False)]
