"""Scalar column expressions: identifiers, coordinates and display text. Raw text that does not parse is null."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamarack.functions.vocab import NULL_TOKENS


BLANKS = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def stripped(text: Column) -> Column:
    """Without white space of any kind at both ends: tabs, line breaks and no-break spaces too."""
    return F.btrim(text, F.lit(BLANKS))


def null_tokens_to_null(value: Column) -> Column:
    return F.when(~value.isin(NULL_TOKENS), value)


def whole_number(value: Column) -> Column:
    """Integer of a float text, truncated towards zero."""
    return value.try_cast("double").try_cast("bigint")


def rsid(value: Column) -> Column:
    """``123`` or ``123.0`` -> ``rs123``; ``-1`` and missing markers -> null."""
    text = value.cast("string")
    return F.when(~text.isin("-1", "nan"), F.concat(F.lit("rs"), whole_number(text).cast("string")))


def without_chr(chrom: Column) -> Column:
    """Drops every ``chr`` in the text, not only a leading one."""
    return F.replace(chrom.cast("string"), F.lit("chr"), F.lit(""))


def chrom_name(chrom: Column) -> Column:
    """Trimmed name with one ``chr`` prefix; the mitochondrial spellings become ``chrM``."""
    text = stripped(chrom.cast("string"))
    return (
        F.when(F.upper(text).isin("MT", "M"), F.lit("chrM"))
        .when(text.startswith("chr"), text)
        .otherwise(F.concat(F.lit("chr"), text))
    )


def zero_based_start(position: Column) -> Column:
    """A 1-based position p covers the half-open range [p - 1, p)."""
    return position - 1


def _alleles_present(ref: Column, alt: Column) -> Column:
    return ~ref.isin("", "nan") & ~alt.isin("", "nan")


def region_key(chrom: Column, start: Column, variant_id: Column, ref: Column, alt: Column) -> Column:
    """``chrom pos id ref alt . . .``; null when an allele is missing or the position does not parse."""
    fields = [
        without_chr(chrom), whole_number(start).cast("string"), F.coalesce(variant_id, F.lit(".")), ref, alt,
        F.lit(". . ."),
    ]
    spaced = [part for field in fields for part in (field, F.lit(" "))][:-1]
    return F.when(_alleles_present(ref, alt), F.concat(*spaced))


def hgvs(chrom: Column, start: Column, ref: Column, alt: Column) -> Column:
    """``chr1:g.100A>G``. The text form is right for single-base changes; see ``is_snv``."""
    text = F.concat(
        F.lit("chr"), without_chr(chrom), F.lit(":g."), whole_number(start).cast("string"), ref, F.lit(">"), alt
    )
    return F.when(_alleles_present(ref, alt), text)


def is_snv(ref: Column, alt: Column) -> Column:
    return F.coalesce((F.length(ref) == 1) & (F.length(alt) == 1), F.lit(False))


def ordinal(value: Column, order: dict[str, int]) -> Column:
    """Maps a term to its rank; terms outside the map are null."""
    pairs = [F.lit(part) for pair in order.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), value)


def snake_label(name: Column) -> Column:
    return F.replace(name, F.lit(" "), F.lit("_"))


def plain_feature(name: Column, categorical: str = "most_severe_consequence") -> Column:
    """Strips the encoder's prefixes from a feature name."""
    without_category = F.replace(name, F.lit(f"cat__{categorical}_"), F.lit(""))
    return F.replace(without_category, F.lit("num__"), F.lit(""))


def short_name(name: Column, width: int = 60) -> Column:
    return F.when(F.length(name) > width, F.concat(F.substring(name, 1, width), F.lit("..."))).otherwise(name)


def one_decimal_percent(share: Column) -> Column:
    return F.format_string("%.1f%%", share * 100)


def whole_percent(share: Column) -> Column:
    return F.floor(share * 100).cast("int")
