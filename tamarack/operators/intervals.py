"""Point lookups in score tracks and assembly maps.

A lookup depends on the position alone, so rows are first reduced to distinct positions (with a map-side combine,
which also removes hot positions), the positions meet the intervals in bins, and one left join brings the results
back to the rows.

Bins form a tree: a bin of level 0 is at most ``WIDEST`` positions wide, and a bin of each level above holds ``FAN`` of
the level below. An interval is cut into the widest bins that lie in it and, at its two ends, ranges within bins of
level 0. So a short interval gives two or three rows and a whole chromosome some dozens, a bin of level 0 holds at most
WIDEST positions and WIDEST * (WIDEST + 1) / 2 ranges, and a bin above one row, that of the interval that wins in it.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.operators.joins import left_lookup

WIDEST = 1024
FAN = 8


def distinct_positions(df: DataFrame, chrom: str, position: str) -> DataFrame:
    return df.select(F.col(chrom).alias("chrom"), F.col(position).alias("position")).dropna().distinct()


def measured_bins(track: DataFrame, start: str, end: str, width: int | None = None, least: int = 64) -> tuple[int, int]:
    """Width of level 0, a power of two, and the highest level whose bins the longest interval could hold.

    The width is about the mean length, but never above ``WIDEST``: longer intervals take more levels.
    """
    length = F.col(end) - F.col(start)
    mean, longest = track.filter(length > 0).agg(F.avg(length), F.max(length)).first()
    width = _power_of_two(width or min(WIDEST, max(least, mean or 0)))
    top = 0
    while width * FAN ** (top + 1) <= (longest or 0):
        top += 1
    return width, top


def _power_of_two(width: float) -> int:
    return 1 << max(0, math.ceil(math.log2(width)))


def _bin(position: Column, width: int) -> Column:
    return F.shiftright(position, width.bit_length() - 1)


def _numbers_between(low: Column, high: Column) -> Column:
    """low .. high - 1, none where low >= high."""
    return F.when(low < high, F.sequence(low, high - 1)).otherwise(F.array().cast("array<bigint>"))


def _pieces(start: Column, end: Column, width: int, top: int) -> Column:
    """Array of (_level, _bin) that cut the interval: fewer than 2 * FAN bins of each level."""
    fan = FAN.bit_length() - 1
    levels = []
    for level in range(top + 1):
        size = width * FAN**level
        # Level 0 takes the bins the interval only touches as well.
        low, high = (_bin(start, size), _bin(end - 1, size) + 1) if level == 0 else (_bin(start + size - 1, size), _bin(end, size))
        levels.append((low, high))
    pieces = []
    for level, (low, high) in enumerate(levels):
        bins = _numbers_between(low, high)
        if level < top:
            above_low, above_high = levels[level + 1]
            sides = F.concat(_numbers_between(low, F.shiftleft(above_low, fan)), _numbers_between(F.shiftleft(above_high, fan), high))
            bins = F.when(above_low < above_high, sides).otherwise(bins)
        pieces.append(_of_level(bins, level))
    return F.concat(*pieces)


def _of_level(bins: Column, level: int) -> Column:
    return F.transform(bins, lambda number: F.struct(F.lit(level).alias("_level"), number.alias("_bin")))


def _binned(
    track: DataFrame, start: Column, end: Column, width: int, top: int, payload: list[Column], order: list[Column]
) -> DataFrame:
    """One row per (chrom, level, bin, clipped range), holding the first payload in ``order``."""
    bins = track.filter(end > start).select(
        "chrom", start.alias("_start"), end.alias("_end"), F.struct(*order, *payload).alias("_hit"),
        F.inline(_pieces(start, end, width, top)),
    )
    # A bin above level 0 lies in the interval whole, so its range says nothing.
    low = F.when(F.col("_level") == 0, F.greatest("_start", F.col("_bin") * width)).otherwise(0)
    high = F.when(F.col("_level") == 0, F.least("_end", (F.col("_bin") + 1) * width)).otherwise((1 << 62))
    return bins.groupBy("chrom", "_level", "_bin", low.alias("_low"), high.alias("_high")).agg(F.min("_hit").alias("_hit"))


def first_hit(
    positions: DataFrame, track: DataFrame, start: str, end: str, payload: list[str], order: list[str],
    width: int | None = None, position: str = "position", chrom: str = "chrom",
) -> DataFrame:
    """(chrom, position, payload...) for each 1-based position inside a 0-based half-open interval.

    Where intervals overlap, the first in ``order`` (then by start) wins. Positions must be distinct; those
    outside every interval are left out, as the join back to the rows is a left join. ``width`` is rounded up to a
    power of two.
    """
    width, top = measured_bins(track, start, end, width)
    bins = _binned(
        track, F.col(start), F.col(end), width, top,
        payload=[F.col(column).alias(f"_p_{column}") for column in payload],
        order=[F.col(column).alias(f"_o_{column}") for column in [*order, start, end]],
    )
    points = positions.select(F.col(chrom).alias("chrom"), F.col(position).alias("_position"))
    places = F.array(*[F.struct(F.lit(level).alias("_level"), _bin(F.col("_position") - 1, width * FAN**level).alias("_bin")) for level in range(top + 1)])
    placed = points.select("*", F.inline(places))
    inside = (F.col("_low") < F.col("_position")) & (F.col("_position") <= F.col("_high"))
    hits = placed.join(bins, ["chrom", "_level", "_bin"]).filter(inside)
    if top == 0:
        # Grouping by a superset of the join keys needs no shuffle of its own.
        found = hits.groupBy("chrom", "_level", "_bin", "_position").agg(F.min("_hit").alias("_hit"))
    else:
        found = hits.groupBy("chrom", "_position").agg(F.min("_hit").alias("_hit"))
    return found.select(
        F.col("chrom").alias(chrom), F.col("_position").alias(position),
        *[F.col(f"_hit._p_{column}").alias(column) for column in payload],
    )


def scores_at(positions: DataFrame, track: DataFrame, name: str, width: int | None = None) -> DataFrame:
    """(chrom, position, score) from a track of (chrom, start0, end0, value)."""
    return first_hit(positions, track, "start0", "end0", ["value"], [], width).withColumnRenamed("value", name)


def lifted(positions: DataFrame, blocks: DataFrame, width: int | None = None) -> DataFrame:
    """(chrom, position, to_chrom, to_start, to_end) by the first block that holds the position.

    Blocks are 1-based and closed, as published assembly maps are; strand -1 counts from the far end.
    """
    ranges = blocks.withColumn("_src_start0", F.col("src_start") - 1)
    fields = ["src_start", "dst_chrom", "dst_start", "dst_end", "strand"]
    hits = first_hit(positions, ranges, "_src_start0", "src_end", fields, ["ord"], width)
    offset = F.col("position") - F.col("src_start")
    target = F.when(F.col("strand") == -1, F.col("dst_end") - offset).otherwise(F.col("dst_start") + offset)
    return hits.select(
        "chrom", "position", F.col("dst_chrom").alias("to_chrom"), target.alias("to_start"), target.alias("to_end")
    )


def attach(rows: DataFrame, resolved: DataFrame, chrom: str, position: str) -> DataFrame:
    """Bring per-position results back to the rows. ``resolved`` holds each position once."""
    keyed = resolved.withColumnsRenamed({"chrom": "_chrom", "position": "_position"})
    return left_lookup(rows, keyed, {chrom: "_chrom", position: "_position"})


def with_scores(rows: DataFrame, track: DataFrame, chrom: str, position: str, name: str, width: int | None = None) -> DataFrame:
    positions = distinct_positions(rows, chrom, position)
    return attach(rows, scores_at(positions, track, name, width), chrom, position)


def with_liftover(rows: DataFrame, blocks: DataFrame, chrom: str, position: str, prefix: str, width: int | None = None) -> DataFrame:
    names = {f"to_{part}": f"{prefix}_{part}" for part in ("chrom", "start", "end")}
    positions = distinct_positions(rows, chrom, position)
    return attach(rows, lifted(positions, blocks, width).withColumnsRenamed(names), chrom, position)


def conservation(
    rows: DataFrame, chrom: str, position: str, near_track: DataFrame, blocks: DataFrame, far_track: DataFrame,
    far_chrom_name=lambda column: column,
    near_width: int | None = None, block_width: int | None = None, far_width: int | None = None,
) -> DataFrame:
    """Score at the position, lifted position, and score at the lifted position.

    The three lookups are chained on distinct positions; the wide rows are joined once. ``far_chrom_name`` fits
    the lifted chromosome name to the second track.
    """
    positions = distinct_positions(rows, chrom, position)
    lift = lifted(positions, blocks, block_width).withColumn("_far_chrom", far_chrom_name(F.col("to_chrom")))
    far = scores_at(distinct_positions(lift, "_far_chrom", "to_start"), far_track, "gerp_score", far_width)
    lift = attach(lift, far, "_far_chrom", "to_start").drop("_far_chrom").withColumnsRenamed(
        {"to_chrom": "hg19_chrom", "to_start": "hg19_start", "to_end": "hg19_end"}
    )
    near = scores_at(positions, near_track, "phylop100way", near_width)
    return attach(rows, near.join(lift, ["chrom", "position"], "full"), chrom, position)
