import random

import pytest
from pyspark.sql import functions as F

from tamarack.operators import grid, reshape


def cells(spark, gene, table):
    rows = [(gene, i, j, v) for i, line in enumerate(table) for j, v in enumerate(line)]
    return spark.createDataFrame(rows, "gene string, row_idx int, col_idx int, value string")


TABLE = [
    ["Title", None, None, None],
    ["Label", "l1", "l2", "l3"],
    ["An allele", None, None, None],  # above any rsid row
    ["rsID", "wrong", "wrong", "wrong"],
    ["Effect on allele", None, None, None],
    [" RSID ", "rs1", None, "rs3"],
    ["Some Allele", None, None, None],
    [" *1 ", "A", None, "C"],
    ["*2", None, "G", None],
    ["  ", "x", "x", "x"],
    ["*3", "T", "T", "T"],
]


def test_pairs_stop_at_the_blank_name(spark):
    found = {(r.allele_name, r.variant_label, r.rsid, r.allele_nt_value, r.src_ord) for r in grid.allele_variants(cells(spark, "G", TABLE)).collect()}
    assert found == {("*1", "l1", "rs1", "A", 7), ("*1", "l3", "rs3", "C", 7), ("*2", "l2", None, "G", 8)}
    header = grid.header_rows(cells(spark, "G", TABLE)).first()
    assert (header.rsid_row, header.header_row) == (5, 6)


def test_blank_row_may_be_absent_from_the_cells(spark):
    sparse = cells(spark, "G", TABLE).filter("row_idx <> 9 and value is not null")
    assert {r.allele_name for r in grid.allele_variants(sparse).collect()} == {"*1", "*2"}


def test_blank_row_right_under_the_header(spark):
    table = [line for line in TABLE[:7]] + [["", "x", None, None], ["*2", "y", None, None]]
    assert grid.allele_variants(cells(spark, "G", table)).count() == 0


def test_grids_without_header_rows_are_reported(spark):
    both = cells(spark, "G", TABLE).unionByName(cells(spark, "H", [["x", "y"], ["Allele", "z"]]))
    assert [r.gene for r in grid.unreadable_grids(both).collect()] == ["H"]
    assert {r.gene for r in grid.allele_variants(both).collect()} == {"G"}


def by_hand(rows, label_row=1):
    """One grid row after the other."""
    name = {r: (v or "").strip() for r, c, v in rows if c == 0}
    first = min((r for r, n in name.items() if n.lower() == "rsid"), default=None)
    header = min((r for r, n in name.items() if first is not None and r > first and n.lower().endswith("allele") and "effect" not in n.lower()), default=None)
    if header is None:
        return None, set()
    rsid, out, r = max(x for x, n in name.items() if n.lower() == "rsid" and x < header), set(), header + 1
    value = {(r, c): v for r, c, v in rows if c and v is not None}
    while name.get(r):
        out |= {(name[r], value.get((label_row, c)), value.get((rsid, c)), v, r) for (x, c), v in value.items() if x == r}
        r += 1
    return (rsid, header), out


@pytest.mark.parametrize("block", [1, 2, 3, 7, 1024])
def test_grids_across_blocks(spark, monkeypatch, block):
    """Random grids with missing rows, many marks and gaps at the ends of blocks."""
    monkeypatch.setattr(grid, "ROWS", block)
    draw, made = random.Random(block), []
    for g in range(40):
        names = draw.choices(["rsid", "some allele", "effect on allele", "", None, "n"], [1, 1, 1, 0.3, 0.3, 6], k=draw.randint(1, 25))
        for r, n in enumerate(names):
            if draw.random() < 0.95:
                made += [(f"g{g}", r, 0, n and f" {n}{r if n == 'n' else ''} ")] + [(f"g{g}", r, c, draw.choice([None, f"v{r}.{c}"])) for c in range(1, 4)]
    df = spark.createDataFrame(made, "gene string, row_idx int, col_idx int, value string").repartition(5)
    expected = {g: by_hand([m[1:] for m in made if m[0] == g]) for g in {m[0] for m in made}}
    assert {r.gene: (r.rsid_row, r.header_row) for r in grid.header_rows(df).collect()} == {g: h for g, (h, _) in expected.items() if h}
    assert {r.gene for r in grid.unreadable_grids(df).collect()} == {g for g, (h, _) in expected.items() if not h}
    got = {(r.gene, r.allele_name, r.variant_label, r.rsid, r.allele_nt_value, r.src_ord) for r in grid.allele_variants(df).collect()}
    assert got == {(g, *row) for g, (_, rows) in expected.items() for row in rows} and got


def test_one_huge_grid(spark, tmp_path):
    """200,000 rows under one header; the cells are read once, to gather the rows."""
    body = spark.range(200_000).select(F.lit("G").alias("gene"), (F.col("id") + 7).cast("int").alias("row_idx"), F.inline(F.array(
        F.struct(F.lit(0).alias("col_idx"), F.concat(F.lit("*"), "id").alias("value")), F.struct(F.lit(1).alias("col_idx"), F.lit("A").alias("value")),
        F.struct(F.lit(3).alias("col_idx"), F.col("id").cast("string").alias("value")),
    )))
    cells(spark, "G", TABLE).filter("row_idx < 7").unionByName(body).unionByName(cells(spark, "G", [["after", "x"]]).withColumn("row_idx", F.lit(300_000))).write.parquet(str(tmp_path / "cells"))
    found = grid.allele_variants(spark.read.parquet(str(tmp_path / "cells")))
    row = found.agg(F.count("*"), F.count_distinct("allele_name"), F.max("src_ord"), F.min("rsid"), F.max("rsid"), F.min("variant_label")).first()
    assert tuple(row) == (400_000, 200_000, 200_006, "rs1", "rs3", "l1")
    assert all(str(tmp_path / "cells") not in f for f in found.inputFiles())  # later steps read the gathered rows


def test_arrays_to_rows_and_metric_columns(spark):
    rows = spark.createDataFrame([(1, [1.0, 2.0, 3.0, 4.0])], "id int, a array<double>")
    long = reshape.class_arrays_to_rows(rows, ["id"], "a", ["c", "d d"], ["x", "y"], "v")
    assert {(r["class"], r.feature, r.v) for r in long.collect()} == {("c", "x", 1.0), ("c", "y", 2.0), ("d d", "x", 3.0), ("d d", "y", 4.0)}
    wide = reshape.metric_columns(long.filter("feature = 'x'"), ["id"], "class", "v", ["c", "d d"], "f1_").first()
    assert (wide.f1_c, wide.f1_d_d) == (1.0, 3.0)
