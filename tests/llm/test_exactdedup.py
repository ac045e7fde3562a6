from pyspark.sql import functions as F

from tamarack.llm.exactdedup import exact_dedup
from tamarack.operators import joins


def brute_force(rows):
    lower = [(i, (t or "").translate({c: c + 32 for c in range(65, 91)})) for i, t in rows]
    out = []
    for i, t in lower:
        same = [j for j, u in lower if u == t]
        keep = max((j for j in same if j is not None), default=None)
        out.append((i, keep, len(same), i == keep))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept").collect()), key=str)


ROWS = [(1, "Abc"), (2, "aBC"), (3, "ÄB"), (4, "äb"), (5, None), (6, ""), (7, "x" * 500_000), (8, "X" * 500_000), (9, "y"), (9, "Y"), (None, "abc"), (None, "n"), (10, "z")]


def test_normalisation_and_odd_rows(documents):
    df = documents(ROWS).withColumnRenamed("lang", "digest").withColumnRenamed("source", "salt")
    assert result(exact_dedup(df)) == brute_force(ROWS)
    assert result(exact_dedup(documents([]))) == []


def test_equal_digests_are_not_equal_texts(documents):
    assert result(exact_dedup(documents(ROWS), digest=lambda t: F.substring(F.sha2(t, 256), 1, 1))) == brute_force(ROWS)
    assert result(exact_dedup(documents(ROWS), digest=lambda t: F.lit("same"))) == brute_force(ROWS)


def test_hot_text(documents, monkeypatch):
    monkeypatch.setattr(joins, "HOT", 4)
    rows = [(i, "hot") for i in range(400)] + [(1000 + i, f"t{i // 2}") for i in range(300)]
    assert result(exact_dedup(documents(rows).repartition(13))) == brute_force(rows)
