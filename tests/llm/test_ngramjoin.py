import random
import re

import pytest
from pyspark.sql import functions as F

from tamarack.llm import ngramjoin
from tamarack.llm.graph import components
from tamarack.llm.queries import op4_ngram_jaccard_join
from tamarack.llm.scratch import Scratch


def grams(text, n=5):
    words = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").lower().encode())
    return {tuple(words[i:i + n]) for i in range(max(len(words) - n + 1, 1))} if words else set()


def brute_force(rows, threshold=0.8):
    """doc_id, class_id, n_links, set_id, kept by comparing all pairs."""
    sets = [grams(t) for _, t in rows]
    near = [[bool(i != j and a and b and len(a & b) >= threshold * len(a | b)) for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    out = []
    for i, (doc_id, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            x = todo.pop()
            new = {j for j, yes in enumerate(near[x]) if yes} - seen
            seen |= new
            todo += new
        class_id = min(rows[j][0] for j in seen)
        out.append((doc_id, class_id, sum(near[i]), min(rows[j][0] for j in range(len(rows)) if j == i or sets[i] and sets[j] == sets[i]), doc_id == class_id))
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("doc_id", "class_id", "n_links", "set_id", "kept").collect())


def test_query_equals_all_pairs(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    expected = brute_force(rows)
    assert any(r[2] for r in expected)
    assert result(op4_ngram_jaccard_join(spark, sf)) == expected


@pytest.mark.parametrize("limit", [("BLOCK", 8), ("GRAMS", 500)])
def test_hot_group_over_many_cells(spark, documents, monkeypatch, limit):
    monkeypatch.setattr(ngramjoin, *limit)
    draw = random.Random(5)
    base = [f"w{draw.randrange(10**6)}" for _ in range(120)]

    def near(i):
        words = list(base)
        for _ in range(draw.randrange(4)):
            words[draw.randrange(120)] = f"x{i}"
        return " ".join(words)

    rows = [(i, near(i)) for i in range(70)] + [(100 + i, " ".join(f"y{i}z{k}" for k in range(30))) for i in range(20)] + [(200 + i, near(0)) for i in range(3)]
    assert result(ngramjoin.jaccard_join(documents(rows))) == brute_force(rows)


def test_odd_rows(documents):
    long = " ".join(f"t{i % 5003}" for i in range(200_000))
    rows = [(1, None), (2, ""), (3, " \n!"), (4, "one two"), (5, "One, two!"), (6, long), (7, long), (7, long), (8, "a b c d e f")]
    assert result(ngramjoin.jaccard_join(documents(rows))) == [
        (1, 1, 0, 1, True), (2, 2, 0, 2, True), (3, 3, 0, 3, True), (4, 4, 1, 4, True), (5, 4, 1, 4, False),
        (6, 6, 2, 6, True), (7, 6, 2, 6, False), (7, 6, 2, 6, False), (8, 8, 0, 8, True),
    ]


def test_empty_table_and_clashing_columns(spark, documents):
    assert result(ngramjoin.jaccard_join(documents([]))) == []
    assert documents([]).columns == ngramjoin.one_per_class(documents([])).columns
    odd = documents([(2, "a b c d e f g"), (1, "a b c d e f g"), (None, "q r s t u v")]).withColumnRenamed("lang", "node").withColumnRenamed("source", "bands")
    kept = ngramjoin.one_per_class(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "None"]


def test_one_row_of_each_class(spark, documents):
    """Equal doc_ids and none, equal rows, wordless rows; other columns of any kind."""
    text, near = "a b c d e f g h i j k l m n o p q r s t u v w x y z", "b c d e f g h i j k l m n o p q r s t u v w x y z"
    rows = [(1, text), (1, text), (1, near), (2, text), (None, "q r s t u v"), (None, "q r s t u v"), (None, "Q r s t u v!"), (3, ""), (3, ""), (None, None), (None, None), (4, "lone words here")]
    given = documents(rows).withColumn("_row", F.create_map(F.lit("k"), "source")).withColumn("class", F.lit("clash")).withColumn("address", F.lit(7)).withColumn("_several", F.lit(True))
    kept = ngramjoin.one_per_class(given)
    assert kept.dtypes == given.dtypes
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got[0][0] == 1 and got[0][1] in (text, near)
    assert got[1:4] == [(3, ""), (3, ""), (4, "lone words here")]
    assert got[4][0] is None and got[4][1].lower().startswith("q r s") and got[5:] == [(None, None), (None, None)]


def test_many_copies_of_a_row(spark, documents):
    rows = [(1, "one two three four five six")] * 3000 + [(i, f"one two three four five six x{i}") for i in range(2, 50)]
    kept = ngramjoin.one_per_class(documents(rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(range(1, 50))


@pytest.mark.parametrize(("threshold", "recall"), [(0.8, 0.99), (0.8, 0.9995), (0.5, 0.95), (0.9, 0.999), (0.05, 0.99), (0.01, 0.99)])
def test_bands_reach_their_recall(threshold, recall):
    shape = ngramjoin.choose_bands(threshold, recall)
    assert 1 - (1 - threshold**shape.rows) ** shape.bands >= recall
    assert shape.bands * shape.rows <= 128 or shape.rows == 1


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1002), (1002, 1000), (2000, 2000)] + [(5000, 4000 + i) for i in range(50)]
    found = dict(components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test")).collect())
    assert found == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000, 1002: 1000} | {4000 + i: 4000 for i in range(50)} | {5000: 4000}
