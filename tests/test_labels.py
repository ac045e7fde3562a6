import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tamarack.operators import filters, keys, summaries

CROSSWALK = "gene string, rsid string, allele_name string, function_term string, usable_label boolean, src_ord int"


def crosswalk(spark):
    return spark.createDataFrame([
        ("g", "two", "*2", "No function", True, 1), ("g", "two", "*3", "Normal function", True, 2),
        ("g", "mixed", "*5", "Unknown function", False, 3), ("g", "mixed", "*4", "No function", True, 4),
        ("g", "same", "*7", "No function", True, 6), ("g", "same", "*6", "No function", True, 5),
        ("g", None, "*8", "No function", True, 7), ("g", "bad", "*9", "Unknown function", False, 8),
        ("g", "nul", "*10", None, False, 9), ("g", "nul", "*11", "No function", True, 10),
    ], CROSSWALK)


def test_conflicts_over_all_and_over_usable_labels(spark):
    everything = keys.conflicting_keys(crosswalk(spark), ["gene", "rsid"], "function_term").collect()
    assert {(r.rsid, r.n_distinct_functions) for r in everything} == {("two", 2), ("mixed", 2)}
    usable = keys.conflicting_keys(crosswalk(spark), ["gene", "rsid"], "function_term", "usable_label").collect()
    assert {r.rsid for r in usable} == {"two"}


def settled(spark, strict, rows=None):
    found = keys.settled_labels(
        crosswalk(spark) if rows is None else rows, ["gene", "rsid"], "function_term", "usable_label", "allele_name", ["src_ord"], strict
    )
    return {(r.rsid, r.allele_name, r.function_term) for r in found.collect()}


def test_settled_labels(spark):
    relaxed = {("mixed", "*4", "No function"), ("same", "*6", "No function"), ("nul", "*11", "No function")}
    assert settled(spark, strict=False) == relaxed
    assert settled(spark, strict=True) == relaxed - {("mixed", "*4", "No function")}


@pytest.mark.parametrize("strict", [False, True])
def test_settled_labels_with_a_hot_key(spark, strict):
    draw = random.Random(5)
    terms = ["No function", "Normal function", "Unknown function"]
    rows = [
        ("g", "hot" if draw.random() < 0.4 else f"k{draw.randrange(150)}", f"*{i}", draw.choice(terms), None, i) for i in range(600)
    ]
    rows = [(g, "calm" if r == "hot" and i % 2 else r, a, "No function" if r == "hot" and i % 2 else t, t != "Unknown function" or (r == "hot" and i % 2 == 1), i)
            for g, r, a, t, _, i in rows]
    groups = defaultdict(list)
    for g, r, a, t, u, i in rows:
        groups[r].append((i, a, t, u))
    expected = set()
    for r, members in groups.items():
        considered = {t for _, _, t, u in members if strict or u}
        usable = [(i, a, t) for i, a, t, u in members if u]
        if usable and len(considered) == 1:
            expected.add((r, min(usable)[1], min(usable)[2]))
    assert settled(spark, strict, spark.createDataFrame(rows, CROSSWALK).repartition(6)) == expected


def test_null_keys_stay_in_anti_join(spark):
    kept = keys.without_keys(crosswalk(spark), ["gene", "rsid"], crosswalk(spark).filter("rsid is not null"))
    assert [r.allele_name for r in kept.collect()] == ["*8"]


def test_padded_names_meet_and_duplicates_fan_out(spark):
    alleles = spark.createDataFrame([("g", " *2"), ("g", "*3"), ("h", "*2")], "gene string, allele_name string")
    labels = spark.createDataFrame([("g", "*2 ", "a"), ("g", "*2", "b")], "gene string, allele_name string, function_term string")
    joined = {(r.gene, r.allele_name, r.function_term) for r in keys.attach_labels(alleles, labels, ["gene", "allele_name"]).collect()}
    assert joined == {("g", "*2", "a"), ("g", "*2", "b"), ("g", "*3", None), ("h", "*2", None)}


def test_predicates_on_nulls(spark):
    rows = spark.createDataFrame([("*1",), ("*2",), (None,)], "a string")
    assert rows.filter(filters.not_reference(F.col("a"), "*1")).count() == 2
    assert [r[0] for r in rows.select(filters.usable(F.col("a"), ["*1"])).collect()] == [True, False, False]
    assert [r[0] for r in rows.select(filters.mentions_any(F.col("a"), ["1"])).collect()] == [True, False, False]
    kept, aside = filters.split(rows, F.col("a") == "*1")
    assert (kept.count(), aside.count()) == (1, 2)


def test_required_columns(spark):
    rows = spark.createDataFrame([(1, 2)], "a int, b int")
    assert filters.require_columns(rows, ["a"]) is rows
    with pytest.raises(ValueError, match="c"):
        filters.require_columns(rows, ["a", "c"])
    assert filters.preview(rows).count() == 1


def test_payload_guard(spark):
    rows = spark.createDataFrame([("PA1", "A"), ("PA2", "A"), ("PA9", "B"), ("PA2", None)], "accession string, gene string")
    accepted, rejected = filters.payload_guard(rows, "accession", "gene", {"A": "PA1", "B": "PA2"})
    assert [r.accession for r in accepted.collect()] == ["PA1"] and rejected.count() == 3


def test_summaries(spark):
    rows = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), ("c",), (None,)], "v string")
    assert summaries.most_frequent(rows, "v").first().v == "a"
    assert {r.v: r.n for r in summaries.counts_for_classes(rows, "v", ["a", "x"]).collect()} == {"a": 2, "x": 0}
    weights = {r.v: r.weight for r in summaries.class_weights(rows.dropna(), "v").collect()}
    assert weights == {"a": 5 / 6, "b": 5 / 6, "c": 5 / 3}
    assert {r.column: (r.n_present, r.n_total) for r in summaries.coverage(rows, ["v"]).collect()} == {"v": (5, 6)}
    assert {r.v for r in filters.without_rare_classes(rows, "v", 2).collect()} == {"a", "b"}
