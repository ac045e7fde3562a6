import random

import pytest
from pyspark.sql import functions as F

from tamarack.functions.text import chrom_name
from tamarack.operators import intervals

TRACK = "chrom string, start0 bigint, end0 bigint, value double"
BLOCKS = "chrom string, src_start bigint, src_end bigint, dst_chrom string, dst_start bigint, dst_end bigint, strand int, ord int"


def test_interval_ends_gaps_and_missing_positions(spark):
    track = spark.createDataFrame([("chr1", 9, 12, 1.0), ("chr1", 12, 13, 2.0), ("chr1", 20, 30, 3.0), ("chr2", 0, 100, 4.0)], TRACK)
    rows = spark.createDataFrame(
        [(1, "chr1", 9), (2, "chr1", 10), (3, "chr1", 12), (4, "chr1", 13), (5, "chr1", 14), (6, None, 10), (7, "chr1", None), (8, "chr1", 10)],
        "id int, chrom string, position bigint",
    )
    scored = intervals.with_scores(rows, track, "chrom", "position", "score").collect()
    assert {r.id: r.score for r in scored} == {1: None, 2: 1.0, 3: 1.0, 4: 2.0, 5: None, 6: None, 7: None, 8: 1.0}


@pytest.mark.parametrize("width", [None, 3, 64])
def test_overlapping_track_against_brute_force(spark, width):
    draw = random.Random(3)
    track = [("c%d" % draw.randrange(2), s := draw.randrange(300), s + draw.randrange(0, 60), float(i)) for i in range(150)]
    track += [("c0", 100, 140, float(i)) for i in range(200)]  # a hot bin of copies
    points = [("c%d" % draw.randrange(3), draw.randrange(1, 320)) for _ in range(400)] + [("c0", 120)] * 200
    found = intervals.with_scores(
        spark.createDataFrame(points, "chrom string, position bigint").repartition(5), spark.createDataFrame(track, TRACK).repartition(3),
        "chrom", "position", "score", width,
    ).collect()
    assert len(found) == len(points)
    for row in found:
        hits = [(s, e, v) for c, s, e, v in track if c == row.chrom and s <= row.position - 1 < e]
        assert row.score == (min(hits)[2] if hits else None)


@pytest.mark.parametrize("width", [None, 1, 16])
def test_intervals_of_all_lengths_against_brute_force(spark, width):
    """From one position to a whole chromosome, starting at any place of the tree of bins."""
    draw = random.Random(8)
    track = [("c", s := draw.randrange(1 << 20), s + 1 + draw.randrange(1 << draw.randrange(20)), float(i)) for i in range(120)]
    track += [("c", 0, 1 << 20, -1.0), ("d", 4096, 8192, 1.0), ("d", 4095, 8193, 2.0), ("d", 64, 4096, 3.0)]
    points = [("c", draw.randrange(1, 1 << 20)) for _ in range(300)] + [("d", p) for e in (64, 4095, 4096, 8192, 8193) for p in (e, e + 1)]
    points += [("c", e + d) for _, s, e, _ in track[:30] for d in (0, 1)]
    hits = intervals.scores_at(
        spark.createDataFrame(sorted(set(points)), "chrom string, position bigint"), spark.createDataFrame(track, TRACK), "score", width
    ).collect()
    found = {(r.chrom, r.position): r.score for r in hits}
    assert len(found) == len(hits)
    for c, p in points:
        over = [(s, e, v) for k, s, e, v in track if k == c and s <= p - 1 < e]
        assert found.get((c, p)) == (min(over)[2] if over else None)


def test_a_long_block_spreads_over_bins(spark):
    """One block over a whole chromosome neither widens the bins nor becomes many rows."""
    track = spark.createDataFrame([("c", 0, 100_000_000, 1.0)], TRACK)
    width, top = intervals.measured_bins(track, "start0", "end0")
    assert width <= intervals.WIDEST
    binned = intervals._binned(track, F.col("start0"), F.col("end0"), width, top, [F.col("value")], [F.col("start0")])
    assert binned.count() <= 2 * intervals.FAN * (top + 1)
    points = spark.range(1, 1_000_001).select(F.lit("c").alias("chrom"), (F.col("id") * 97).alias("position"))
    assert points.select(intervals._bin(F.col("position"), width)).distinct().count() > 50_000
    assert intervals.scores_at(points, track, "score").agg(F.count("score"), F.sum("score")).first()[:] == (1_000_000, 1_000_000.0)


def test_liftover(spark):
    blocks = spark.createDataFrame([
        ("1", 101, 200, "A", 1001, 1100, 1, 2), ("1", 151, 250, "B", 5001, 5100, -1, 1), ("1", 300, 300, "C", 7, 7, 1, 3),
    ], BLOCKS)
    rows = spark.createDataFrame([("1", p) for p in (100, 101, 150, 151, 200, 250, 251, 300)], "chrom string, position bigint")
    lifted = intervals.with_liftover(rows, blocks, "chrom", "position", "to").collect()
    assert {r.position: (r.to_chrom, r.to_start) for r in lifted} == {
        100: (None, None), 101: ("A", 1001), 150: ("A", 1050), 151: ("B", 5100), 200: ("B", 5051), 250: ("B", 5001),
        251: (None, None), 300: ("C", 7),
    }


def test_chained_lookup(spark):
    near = spark.createDataFrame([("chr1", 0, 1000, 0.5)], TRACK)
    far = spark.createDataFrame([("chrM", 49, 50, 9.0)], TRACK)
    blocks = spark.createDataFrame([("chr1", 1, 100, "MT", 41, 140, 1, 1)], BLOCKS)
    rows = spark.createDataFrame([("chr1", 10), ("chr1", 11), ("chr1", 500), ("chr2", 10)], "chrom string, position bigint")
    found = intervals.conservation(rows, "chrom", "position", near, blocks, far, chrom_name).collect()
    assert {(r.chrom, r.position): (r.phylop100way, r.hg19_chrom, r.hg19_start, r.gerp_score) for r in found} == {
        ("chr1", 10): (0.5, "MT", 50, 9.0), ("chr1", 11): (0.5, "MT", 51, None), ("chr1", 500): (0.5, None, None, None),
        ("chr2", 10): (None, None, None, None),
    }


def test_no_nested_loops_in_the_plan(spark):
    track = spark.range(100).selectExpr("'c' as chrom", "id * 10 as start0", "id * 10 + 10 as end0", "double(id) as value")
    rows = spark.range(1, 100).selectExpr("'c' as chrom", "id as position")
    plan = intervals.with_scores(rows, track, "chrom", "position", "score", 64)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
