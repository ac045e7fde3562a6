"""Mixing sources to target weights: budgets down a domain-language-source tree, then token-prefixes of seeded epochs.

Every node shares its budget among its children by weight. A child takes no more than its rows hold in ``max_epochs``
epochs; what it cannot take goes to its siblings, and only when all of them are full to the siblings of its parent
(a child is capped at its whole subtree's capacity, level by level from the top). A leaf's budget is worth some whole
epochs and a prefix of one more, ordered by a hash of seed, epoch and doc_id.

A prefix is found in two steps: totals per slice of the hash, then rows only within the one slice it ends in, so a
leaf with a third of all rows is never ordered by one task; there are as many slices as keep one to ``SLICE_ROWS`` rows
at any size. Leaves that the tree names are broadcast, as its size is the parameter's; leaves that follow from the rows
(``others``) meet them by a join that splits hot leaves. Only DataFrame functions are used.

Rows: null or empty texts hold no tokens and go along where their place is before the prefix's end; leaves that the
weights do not name (a null language or source, say) get no budget, or that of the weight ``others``; repeated rows are rows of their own, ties of the
hash are ordered by tokens and a digest of the text; an empty table gives an empty one; other columns pass.
"""

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tamarack.llm.scratch import Scratch
from tamarack.operators.joins import attach

LEVELS = ("domain", "lang", "source")
#: Rows of a slice of the largest leaf, about.
SLICE_ROWS = 4096

#: weight and children of each domain: weight and children of each language: weight of each source
Tree = dict[str, tuple[float, dict[str, tuple[float, dict[str, float]]]]]


@dataclass(frozen=True)
class Mix:
    tree: Tree
    share: float = 1.0  # of the tokens that the named leaves hold
    max_epochs: int = 4
    seed: int = 17
    others: float | None = None  # weight of the domains, languages and sources of the rows that the tree does not name


def tokens(text: Column) -> Column:
    """Pieces between blanks, tabs and line ends."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^ \t\r\n]+")).cast("long")


def named_leaves(spark: SparkSession, tree: Tree) -> DataFrame:
    """One row per leaf of the parameter, with the weights on its path; weights of 0 and less are left out."""
    leaves = [
        F.struct(*(F.lit(v).alias(n) for n, v in zip(("domain", "lang", "source", "domain_weight", "lang_weight", "source_weight"), (d, l, s, float(dw), float(lw), float(sw)), strict=True)))
        for d, (dw, langs) in tree.items() for l, (lw, sources) in langs.items() for s, sw in sources.items() if min(dw, lw, sw) > 0
    ]
    return spark.range(1).select(F.inline(F.array(*leaves)))


def matched(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join with a table of leaves or nodes in which null is a value like any other."""
    right = right.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    return left.join(F.broadcast(right), same, how).drop(*[f"_of_{k}" for k in keys])


def met(rows: DataFrame, table: DataFrame, keys: list[str], mix: Mix, size: int) -> DataFrame:
    """``matched`` on the left, for a table of leaves with their ``_rows`` that need not be small; ``size`` counts all rows."""
    if mix.others is None:
        return matched(rows, table.drop("_rows"), keys, "left")
    keyed = rows.withColumn("_leaf", F.struct(*keys))  # a struct, in which null equals null
    facts = table.select(F.struct(*keys).alias("_leaf"), *[c for c in table.columns if c not in keys])
    return attach(keyed, facts, "_leaf", "_rows", size, "_text").drop("_leaf", "_rows")


def weighted(totals: DataFrame, mix: Mix) -> DataFrame:
    """The leaves that rows hold, with the weights on their path: those of the tree, and others where they have a weight."""
    leaves = named_leaves(totals.sparkSession, mix.tree)
    if mix.others is None:
        return matched(totals, leaves, list(LEVELS))
    for i, level in enumerate(LEVELS):
        named = leaves.select(*LEVELS[: i + 1], f"{level}_weight").distinct()
        totals = matched(totals, named, list(LEVELS[: i + 1]), "left").fillna(float(mix.others), [f"{level}_weight"])
    return totals


def shared(parents: DataFrame, children: DataFrame, level: int) -> DataFrame:
    """Budgets of the children of each parent: by weight, capped by capacity, shortages spread over the siblings.

    With siblings in the order of capacity per weight the full ones come first, and what they leave is worth the same
    per weight to all others. That worth is read off at the first sibling it does not fill.
    """
    above, name = ["root", *LEVELS[:level]], LEVELS[level]
    order = Window.partitionBy(*above).orderBy(F.col("capacity") / F.col("weight"), name)
    earlier, later = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    held = children.where("capacity > 0").transform(matched, parents.select(*above, F.col("budget").alias("of_parent")), above)
    worth = (F.col("of_parent") - F.coalesce(F.sum("capacity").over(earlier), F.lit(0.0))) / F.sum("weight").over(later)
    ranked = held.withColumn("worth", worth)
    open_worth = F.when(F.col("capacity") > F.col("worth") * F.col("weight"), F.col("worth"))
    everyone = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return ranked.withColumn("level", F.first(open_worth, ignorenulls=True).over(everyone)).select(
        *above, name, "capacity", F.when(F.col("level").isNull(), F.col("capacity")).otherwise(F.least("capacity", F.col("level") * F.col("weight"))).alias("budget"),
    )


def leaf_budgets(held: DataFrame, mix: Mix) -> DataFrame:
    """domain, lang, source, held, capacity, budget, of a table of leaves with their weights and tokens (``held``)."""
    leaves = held.select(F.lit(0).alias("root"), "*", (F.col("held") * float(mix.max_epochs)).alias("capacity"))
    nodes = [
        leaves.groupBy("root", *LEVELS[: i + 1]).agg(F.max(f"{level}_weight").alias("weight"), F.sum("capacity").alias("capacity"))
        for i, level in enumerate(LEVELS)
    ]
    budgets = leaves.groupBy("root").agg(F.least(F.sum("held") * mix.share, F.sum("capacity")).alias("budget"))
    for i in range(len(LEVELS)):
        budgets = shared(budgets, nodes[i], i)
    held = leaves.select("held", *[F.col(c).alias(f"_of_{c}") for c in LEVELS])
    return budgets.join(held, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in LEVELS]).select(*LEVELS, "held", "capacity", "budget")


def measured(documents: DataFrame, domain: Column) -> DataFrame:
    """The table with what the choice of a row depends on, which replaces columns of the same names."""
    return documents.drop("_domain", "_tokens", "_text").select(
        "*", domain.alias("_domain"), tokens(F.col("text")).alias("_tokens"), F.md5(F.coalesce("text", F.lit(""))).alias("_text"),
    )


def place(seed: int) -> Column:
    """The row's place in the epoch that its leaf ends in."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_epochs").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))


def prefix_ends(documents: DataFrame, domain: Column, mix: Mix, scratch: Scratch) -> tuple[DataFrame, int]:
    """One row per leaf that gets a budget: whole epochs, and the last row of the prefix of one more epoch; and the rows of all."""
    rows = scratch.write(measured(documents, domain).select("doc_id", "_domain", "lang", "source", "_tokens", "_text"), "measured")
    totals = rows.groupBy(F.col("_domain").alias("domain"), "lang", "source").agg(F.sum("_tokens").alias("held"), F.count("*").alias("_rows"))
    totals = scratch.write(totals, "totals")
    largest, size = totals.agg(F.max("_rows"), F.sum("_rows")).first()
    digits = max(1, math.ceil(math.log((largest or 1) / SLICE_ROWS + 1, 16)))
    budgets = leaf_budgets(weighted(totals.drop("_rows"), mix), mix)
    # Whole tokens, so that rounding of the shares decides nothing.
    whole = F.floor(F.col("budget") + 1e-6)
    leaf = ["_domain", "lang", "source"]
    counted = totals.select(F.col("domain").alias("_domain"), "lang", "source", "_rows")
    same = [F.col(c).eqNullSafe(F.col(f"_of{c}")) for c in leaf]
    plan = scratch.write(budgets.where("held > 0").select(
        F.col("domain").alias("_domain"), "lang", "source", "held", whole.alias("budget"), F.floor(whole / F.col("held")).alias("_epochs"), (whole % F.col("held")).alias("_part"),
    ).join(counted.withColumnsRenamed({c: f"_of{c}" for c in leaf}), same).select(*leaf, "_epochs", "_part", "_rows"), "budgets")
    keyed = met(rows, plan, leaf, mix, size or 0).where("_part is not null")
    keyed = keyed.withColumn("_place", place(mix.seed)).withColumn("_slice", F.substring("_place", 1, digits))
    slices = keyed.groupBy(*leaf, "_slice").agg(F.sum("_tokens").alias("in_slice"), F.max("_part").alias("_part"))
    running = Window.partitionBy(*leaf).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    reached = slices.withColumn("before", F.coalesce(F.sum("in_slice").over(running), F.lit(0)))
    last = reached.where("before < _part and before + in_slice >= _part").groupBy(*leaf).agg(F.max(F.struct("_slice", "before")).alias("last")).select(*leaf, "last.*")
    if mix.others is None:
        at_end = matched(keyed, last, [*leaf, "_slice"])
    else:
        ends = last.join(counted.withColumnsRenamed({c: f"_of{c}" for c in leaf}), same).select(*leaf, F.col("_slice").alias("_last"), "before", "_rows")
        at_end = met(keyed, ends, leaf, mix, size or 0).where("_slice = _last")
    in_slice = Window.partitionBy(*leaf).orderBy("_place", "_tokens", "_text").rowsBetween(Window.unboundedPreceding, -1)
    end = at_end.withColumn("ahead", F.col("before") + F.coalesce(F.sum("_tokens").over(in_slice), F.lit(0))).where("ahead < _part")
    ends = end.groupBy(*leaf).agg(F.max(F.struct("_place", "_tokens", "_text")).alias("_end"))
    joined = plan.join(ends.withColumnsRenamed({c: f"_of{c}" for c in leaf}), same, "left")
    return scratch.write(joined.select(*leaf, "_epochs", "_end", "_rows"), "ends"), size or 0


def mixed(documents: DataFrame, domain: Column, mix: Mix) -> DataFrame:
    """The table with ``_domain``, ``_tokens`` and ``_copies`` (replacing columns of these names, ``_epochs``, ``_end``,
    ``_leaf``, ``_rows`` and ``_text``): in how many epochs of its leaf the row is taken.

    A prefix is the shortest run of rows that holds the leaf's budget.
    """
    scratch = Scratch(documents.sparkSession, "mixing")
    ends, size = prefix_ends(documents, domain, mix, scratch)
    scratch.drop("measured", "budgets", "totals")
    rows = met(measured(documents.drop("_epochs", "_end", "_copies", "_leaf", "_rows"), domain), ends, ["_domain", "lang", "source"], mix, size)
    here = F.struct(place(mix.seed).alias("_place"), "_tokens", "_text")
    copies = F.coalesce("_epochs", F.lit(0)) + F.coalesce((here <= F.col("_end")).cast("long"), F.lit(0))
    added = ("_domain", "_tokens", "_copies")
    return rows.select(*[c for c in documents.columns if c not in (*added, "_epochs", "_end", "_leaf", "_rows", "_text")], "_domain", "_tokens", copies.alias("_copies"))


def in_epochs(rows: DataFrame) -> DataFrame:
    """Each row once per epoch it is taken in, under the columns it came with."""
    return rows.where("_copies > 0").withColumn("_epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).drop("_domain", "_tokens", "_copies", "_epoch")
