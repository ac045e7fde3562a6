"""Filters, predicates and quarantine splits."""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_panel(column: Column, panel: list[str]) -> Column:
    return column.isin(panel)


def semi_panel(df: DataFrame, panel: DataFrame, key: str) -> DataFrame:
    """Panel membership when the panel is itself a table."""
    return df.join(panel.select(key), key, "left_semi")


def mentions_any(column: Column, panel: list[str]) -> Column:
    """Substring membership. One symbol may sit inside another; such hits are kept."""
    return F.coalesce(reduce(or_, [column.contains(symbol) for symbol in panel]), F.lit(False))


def not_reference(column: Column, reference: str) -> Column:
    """True for every value but the reference one; null names stay."""
    return ~column.eqNullSafe(F.lit(reference))


def usable(term: Column, terms: list[str]) -> Column:
    return F.coalesce(term.isin(terms), F.lit(False))


def any_missing(*columns: str) -> Column:
    return reduce(or_, [F.col(column).isNull() for column in columns])


def split(df: DataFrame, keep: Column) -> tuple[DataFrame, DataFrame]:
    """(rows that pass, rows that do not); a null verdict counts as not passing."""
    verdict = F.coalesce(keep, F.lit(False))
    return df.filter(verdict), df.filter(~verdict)


def without_rare_classes(df: DataFrame, label: str, at_least: int) -> DataFrame:
    """Keeps the classes with ``at_least`` rows. One row per class is broadcast; the rows stay where they are."""
    frequent = df.groupBy(label).count().filter(F.col("count") >= at_least).select(label)
    return df.join(F.broadcast(frequent), label, "left_semi")


def without_class(df: DataFrame, label: str, term: str) -> DataFrame:
    return df.filter(not_reference(F.col(label), term))


def confident(df: DataFrame, confidence: str, threshold: float) -> DataFrame:
    return df.filter(F.col(confidence) >= threshold)


def payload_guard(df: DataFrame, accession: str, returned: str, expected: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(payloads whose gene is the one expected for their accession, rejected payloads)."""
    by_accession = [F.lit(part) for gene, code in expected.items() for part in (code, gene)]
    marked = df.withColumn("expected_gene", F.try_element_at(F.create_map(*by_accession), F.col(accession)))
    return split(marked, F.col("expected_gene") == F.col(returned))


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    missing = [column for column in required if column not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def preview(df: DataFrame, rows: int = 5, order: list[str] | None = None) -> DataFrame:
    """A few rows to look at; the same ones each time if an order is given."""
    return (df.orderBy(*order) if order else df).limit(rows)
