"""Wide spreadsheet-like grids, held as cells, to long (row name, column) pairs.

The cells are gathered by grid row once. Where the header is and where the names end is read off the names alone, in
blocks of ``ROWS`` grid rows, so neither a huge grid nor one with many marks is worked by one task.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamarack.functions.text import stripped
from tamarack.session import written

#: Grid rows of a block.
ROWS = 1024


def _names(cells: DataFrame) -> DataFrame:
    return cells.filter("col_idx = 0").select("gene", "row_idx", stripped(F.col("value")).alias("name"))


def _bounds(names: DataFrame) -> DataFrame:
    """(gene, rsid_row, header_row, last_row) of each grid; nulls where the header rows cannot be found.

    ``last_row`` is the last of the named rows that follow the header without a gap; the header itself if there are none.
    """
    text, row = F.lower(F.col("name")), F.col("row_idx")
    marks = {
        "named": F.col("name") != "", "rsids": text == "rsid", "alleles": text.endswith("allele") & ~text.contains("effect"),
    }
    block = F.floor(row / ROWS).cast("int").alias("block")
    blocks = names.groupBy("gene", block).agg(*[F.collect_set(F.when(found, row)).alias(name) for name, found in marks.items()])  # ROWS entries at most
    grid = Window.partitionBy("gene")  # one row per block
    least = lambda rows: F.min(F.array_min(rows)).over(grid)
    placed = blocks.withColumn("_first", least(F.col("rsids")))
    placed = placed.withColumn("header_row", least(F.filter("alleles", lambda r: r > F.col("_first"))))
    placed = placed.withColumn("rsid_row", F.max(F.array_max(F.filter("rsids", lambda r: r < F.col("header_row")))).over(grid))

    start, end = F.col("block") * ROWS, (F.col("block") + 1) * ROWS
    below = F.greatest(F.col("header_row") + 1, start)
    inside = F.when(below < end, F.array_min(F.array_except(F.sequence(below, end - 1), "named")))
    following: Column = F.lead("block").over(grid.orderBy("block"))
    goes_on = (following == F.col("block") + 1) & F.array_contains(F.lead("named").over(grid.orderBy("block")), end)
    gap = F.when(F.col("header_row") < end, F.coalesce(inside, F.when(~F.coalesce(goes_on, F.lit(False)), end)))
    return placed.withColumn("_gap", gap).groupBy("gene").agg(
        F.first("rsid_row").alias("rsid_row"), F.first("header_row").alias("header_row"), (F.min("_gap") - 1).alias("last_row")
    )


def header_rows(cells: DataFrame) -> DataFrame:
    """(gene, rsid_row, header_row): the first "... allele" row without "effect" below an "rsid" row, and the last
    "rsid" row above it. Grids without both are left out."""
    return _bounds(_names(cells)).filter("header_row is not null").select("gene", "rsid_row", "header_row")


def unreadable_grids(cells: DataFrame) -> DataFrame:
    """The grids whose header rows cannot be found."""
    named = cells.select("gene", "row_idx", F.when(F.col("col_idx") == 0, stripped(F.col("value"))).alias("name"))
    return _bounds(named).filter("header_row is null").select("gene")


def allele_variants(cells: DataFrame, label_row: int = 1) -> DataFrame:
    """(gene, allele_name, variant_label, rsid, allele_nt_value), one row per filled cell of a named row.

    ``src_ord`` is the grid row, for operators that keep the first allele of a key. A cell is held once.
    """
    cell = F.when((F.col("col_idx") >= 1) & F.col("value").isNotNull(), F.struct("col_idx", "value"))
    # One row per grid row: the only pass over the cells.
    rows = written(cells.groupBy("gene", "row_idx").agg(
        F.max(F.when(F.col("col_idx") == 0, stripped(F.col("value")))).alias("name"), F.collect_list(cell).alias("cells"),
    ), "grid-rows")
    # One row per grid, and one per column: written, so that their sizes decide how they are joined.
    bounds = written(_bounds(rows.select("gene", "row_idx", "name")).filter("header_row is not null"), "grid-bounds")
    placed = rows.join(bounds, "gene")
    at = lambda place: F.max(F.when(F.col("row_idx") == place, F.col("value")))
    heads = placed.filter((F.col("row_idx") == F.col("rsid_row")) | (F.col("row_idx") == label_row)).select("gene", "row_idx", "rsid_row", F.inline("cells"))
    columns = written(heads.groupBy("gene", "col_idx").agg(at(F.lit(label_row)).alias("variant_label"), at(F.col("rsid_row")).alias("rsid")), "grid-columns")
    filled = placed.filter("row_idx > header_row and row_idx <= last_row").select("gene", "row_idx", F.col("name").alias("allele_name"), F.inline("cells"))
    return filled.join(columns, ["gene", "col_idx"], "left").select(
        "gene", "allele_name", "variant_label", "rsid", F.col("value").alias("allele_nt_value"), F.col("row_idx").alias("src_ord")
    )
