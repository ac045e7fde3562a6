import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tamarack.llm import toxicity
from tamarack.llm.queries import op9_toxicity


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 150), st.integers(1, 30), st.integers(1, 12), st.integers(0, 10**6))
def test_neighbours_are_exact(examples, terms, k, seed):
    """Block-max search against all cosines."""
    draw = np.random.default_rng(seed)
    dense = draw.random((examples, terms)) * (draw.random((examples, terms)) < 0.3)
    dense /= np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-12)
    example, term = np.nonzero(dense)
    index = toxicity.Index(example, term, dense[example, term], terms, toxicity.Setting(block=8, rest=float(draw.choice([0.05, 0.5, 1.0]))))
    dense = dense[:index.examples]
    if not len(dense):
        return
    queries = draw.random((9, terms)) * (draw.random((9, terms)) < 0.4)
    queries /= np.maximum(np.linalg.norm(queries, axis=1, keepdims=True), 1e-12)
    docs, own = np.nonzero(queries)
    without = draw.integers(0, len(dense), 9) if seed % 2 else None
    got = index.nearest(docs, own, queries[docs, own], 9, k, without)
    for i, (found, scores) in enumerate(zip(*got)):
        cosines = dense @ queries[i]
        if without is not None:
            cosines[without[i]] = 0
        best = [e for e in np.lexsort((np.arange(len(dense)), -cosines)) if cosines[e] > 1e-15][:k]
        assert np.allclose(scores, cosines[best])
        assert np.allclose(cosines[found], cosines[best])


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    scored = op9_toxicity(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").select("score", "predicted", "toxic").toPandas()
    toxic = scored["toxic"] == 1
    assert toxic.sum() > 50
    assert scored["score"].between(0, 1).all()
    # About three in ten of this table's toxic labels are on texts without any toxic word.
    assert scored.loc[toxic, "predicted"].mean() >= 0.65
    assert scored.loc[~toxic, "predicted"].mean() <= 0.02


def labelled(spark, documents, n=200):
    """One in four is toxic."""
    rows = [(i, f"plain words number {i % 37} and more {'vile scum ' * 2 if i % 4 == 1 else 'kind help '}x{i}") for i in range(n)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 1)) for i in range(n)] + [(0, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    return documents(rows), labels


def test_odd_rows(spark, documents):
    df, labels = labelled(spark, documents)
    model = toxicity.fit(df, labels)
    odd = documents([(1, None), (2, ""), (3, "!!!"), (None, "you vile scum"), (4, "kind help"), (5, "vile scum " * 50_000), (5, "vile scum " * 50_000)])
    got = toxicity.scored(odd.withColumn("_score", F.lit("clash")), model)
    assert got.columns == [*odd.columns, "_score", "_neighbours", "_cosines"]
    scores = [(r.doc_id, r._score, len(r._neighbours)) for r in got.collect()]
    none = {s for i, s, _ in scores if i in (1, 2, 3)}
    assert len(none) == 1 and all(0 <= s < 0.5 for s in none)
    assert all(s > 0.9 for i, s, _ in scores if i in (None, 5)) and all(s < 0.5 for i, s, _ in scores if i == 4)
    assert all(n for i, _, n in scores if i in (None, 4, 5))


def test_labels_of_one_class_or_none(spark, documents):
    df, labels = labelled(spark, documents, 20)
    for few in (labels.where("toxic = 1"), labels.limit(0)):
        model = toxicity.fit(df, few)
        assert {r._score for r in toxicity.scored(df, model).collect()} == {0.0}


def test_held_out_rows_teach_nothing(spark, documents):
    df, labels = labelled(spark, documents)
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r.doc_id: r._score for r in toxicity.scored(df, toxicity.fit(df, x)).collect()} for x in (labels, flipped))
    assert a == b


def test_rare_toxic_words_find_their_example(spark, documents):
    """A near copy of a toxic example whose words no other example holds."""
    df, labels = labelled(spark, documents)
    rare = "zorgle fnarp quibbix drell vantosk"
    free = next(i for i in range(500, 600) if not spark.range(1).select(toxicity.held_out(F.lit(i))).first()[0])
    model = toxicity.fit(df.unionAll(documents([(free, rare)])), labels.unionAll(spark.createDataFrame([(free, 1, 1)], labels.schema)))
    got = toxicity.scored(documents([(1000, rare + " mulg")]), model).first()
    assert free in got._neighbours and max(got._cosines) > 0.8 and got._score >= 0.5
