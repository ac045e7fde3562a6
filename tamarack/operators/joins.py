"""Left joins for keys of which a few, or none at all, may hold most rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A key with more than 1/HOT of all rows is hot; there are fewer than HOT of them at any size.
HOT = 2000


def _zero(*keys: str) -> Column:
    """0, as a value of the rows: a literal would be folded away and with it the equality that spreads the other side."""
    return F.pmod(F.xxhash64(*keys), F.lit(1)).cast("bigint")


def attach(rows: DataFrame, facts: DataFrame, key: str, weight: str, total: int, spread: Column | str) -> DataFrame:
    """``rows`` with the other columns of ``facts``, which has one row per ``key``; nulls where there is none.

    ``weight`` counts the rows of a key, ``total`` all rows. The facts of hot keys, fewer than ``HOT`` whatever the
    size, are broadcast; their rows then go to the shuffled join under numbers drawn from ``spread``, so no task gets
    the rows of a hot key. Columns of ``facts`` must have names that ``rows`` does not.
    """
    names = [c for c in facts.columns if c != key]
    packed = facts.select(F.col(key).alias("_key"), F.struct(*names).alias("_facts"), (F.col(weight) * HOT > total).alias("_hot"))
    hot = packed.where("_hot").select(F.col("_key").alias("_hot_key"), F.col("_facts").alias("_hot_facts"))
    marked = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
    number = F.when(F.col("_hot_key").isNull(), 0).otherwise(1 + F.pmod(F.xxhash64(spread), F.lit(1 << 30)))
    cold = packed.where("not _hot").select("_key", _zero("_key").alias("_zero"), F.col("_facts").alias("_cold_facts"))
    met = marked.withColumn("_number", number).join(cold, (F.col(key) == F.col("_key")) & (F.col("_number") == F.col("_zero")), "left")
    found = F.coalesce("_hot_facts", "_cold_facts")
    return met.select(*rows.columns, *[found[n].alias(n) for n in names])


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(field.dataType) for field in kind)
    return not isinstance(kind, (T.MapType, T.VariantType, T.UserDefinedType))


def left_lookup(rows: DataFrame, table: DataFrame, keys: dict[str, str]) -> DataFrame:
    """``rows`` with the other columns of ``table`` where all ``keys`` (column of rows -> column of table) agree.

    ``table`` holds each key once; its columns have names that ``rows`` does not. A row with a null key matches nothing:
    it goes to the shuffle under a number drawn from its values, so that null keys spread over all tasks. A repeated
    task draws the same numbers.
    """
    values = [F.col(f"`{field.name}`") for field in rows.schema if _hashable(field.dataType)]
    none = F.lit(False)
    for key in keys:
        none = none | F.col(key).isNull()
    numbered = rows.withColumn("_number", F.when(none, F.xxhash64(F.spark_partition_id(), *values)).otherwise(0))
    same = F.col("_number") == F.col("_zero")
    for key, other in keys.items():
        same = same & (F.col(key) == F.col(other))
    met = numbered.join(table.withColumn("_zero", _zero(*keys.values())), same, "left")
    return met.drop("_number", "_zero", *keys.values())
