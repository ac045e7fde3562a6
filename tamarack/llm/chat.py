"""Chat formatting: every assistant turn becomes an example whose context is all that came before it.

A conversation is rendered once, turn by turn, with a running character position. An example is a prefix of that
rendering: ``context_chars`` characters of context, then the trainable span. Shuffles move each rendering once; the
examples, which repeat their contexts, are cut from it row by row. Only DataFrame functions are used.

Rows: a null text or role is empty; turns come in the order of (turn, role, text), null turns first, so ties and
repeated rows have one defined order and each is a turn of its own; rows of null conv_id are one conversation; an
empty table gives empty tables; other columns are ignored.
"""

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURNS_PER_BLOCK = 256


@dataclass(frozen=True)
class Template:
    """A turn is ``open`` role ``between`` text ``close``. Control strings inside roles and texts are escaped.

    Escaping puts one more backslash behind the first character of a control string, whether or not some are there
    already; unescaping takes one away. So no rendered role or text holds a control string, and a text that looked
    escaped before comes back as it was. No control string may hold another one.
    """

    open: str = "<|im_start|>"
    between: str = "<|im_sep|>"
    close: str = "<|im_end|>"
    others: tuple[str, ...] = ("<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    trainable: str = "assistant"

    def patterns(self) -> dict[str, str]:
        """For each first character, what may follow it to make a control string."""
        marks = sorted({self.open, self.between, self.close, *self.others})
        return {first: "|".join(re.escape(m[1:]) for m in marks if m[0] == first) for first in sorted({m[0] for m in marks})}

    def escape(self, text: Column) -> Column:
        put = lambda c, x: F.regexp_replace(c, rf"{re.escape(x[0])}(\\*(?:{x[1]}))", rf"{x[0]}\\$1")
        return reduce(put, self.patterns().items(), text)

    def unescape(self, text: Column) -> Column:
        take = lambda c, x: F.regexp_replace(c, rf"{re.escape(x[0])}\\(\\*(?:{x[1]}))", rf"{x[0]}$1")
        return reduce(take, self.patterns().items(), text)

    def render(self, role: Column, text: Column) -> Column:
        return F.concat(F.lit(self.open), self.escape(role), F.lit(self.between), self.escape(text), F.lit(self.close))

    def role_of(self, rendered: Column) -> Column:
        inner = F.substring_index(rendered, self.between, 1)
        return self.unescape(inner.substr(F.lit(len(self.open) + 1), F.length(inner)))

    def text_of(self, rendered: Column) -> Column:
        inner = F.substring_index(rendered, self.between, -1)
        return self.unescape(inner.substr(F.lit(1), F.length(inner) - len(self.close)))


def keyed(conversations: DataFrame, template: Template) -> DataFrame:
    """The turns, rendered, under keys without nulls: conversation and block of turn numbers."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    return conversations.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), template.render(role, text).alias("rendered"),
        F.coalesce(F.col("conv_id").cast("string"), F.lit("null")).alias("conv"),
        F.coalesce(F.floor(F.col("turn") / TURNS_PER_BLOCK), F.lit(-(1 << 62))).alias("block"),
    ).withColumn("chars", F.length("rendered").cast("long"))


def rendered_turns(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, conv, block, position, rendered, chars, start (in its conversation), trainable, target_start, target_chars.

    A conversation is cut into blocks of turn numbers, so that a very long one is ordered by many tasks; its blocks are
    shifted by the totals of those before, which need no texts. The texts are shuffled once.
    """
    turns = keyed(conversations, template)
    totals = turns.groupBy("conv", "block").agg(F.count("*").alias("n"), F.sum("chars").alias("sum"))
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("conv", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("turns_before"), F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("chars_before"))
    order = Window.partitionBy("conv", "block").orderBy("turn", "role", "text")
    running = F.sum("chars").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("chars")
    header = F.length(F.substring_index("rendered", template.between, 1)) + len(template.between)
    placed = turns.join(before, ["conv", "block"]).select(
        "conv_id", "conv", "block", "rendered", "chars", (F.col("role") == template.trainable).alias("trainable"), header.alias("header"),
        (F.col("turns_before") + F.row_number().over(order) - 1).alias("position"), (F.col("chars_before") + running).alias("start"),
    )
    return placed.select(
        "conv_id", "conv", "block", "position", "rendered", "chars", "start", "trainable",
        (F.col("start") + F.col("header")).alias("target_start"), (F.col("chars") - F.col("header") - len(template.close)).alias("target_chars"),
    )


def conversations_of(turns: DataFrame) -> DataFrame:
    """conv_id, conv, whole (all turns rendered), spans of its trainable turns, in order. Blocks are joined first."""
    span = F.struct(
        "position", F.col("start").alias("context_chars"), "target_start", "target_chars", (F.col("start") + F.col("chars")).alias("example_chars"),
    )
    blocks = turns.groupBy("conv", "block").agg(
        F.first("conv_id").alias("conv_id"), F.min("position").alias("position"), joined("rendered", "position").alias("rendered"),
        F.array_sort(F.collect_list(F.when(F.col("trainable"), span))).alias("spans"),
    )
    spans = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("position", "spans"))), lambda b: b["spans"]))
    return blocks.groupBy("conv").agg(F.first("conv_id").alias("conv_id"), joined("rendered", "position").alias("whole"), spans.alias("spans"))


def prefix_targets(turns: DataFrame) -> DataFrame:
    """One example per trainable turn: ``text`` is all that came before it, ``context_chars`` characters, and the turn.

    conv_id, conv, position, context_chars, target_start, target_chars, example_chars, text. Of the text,
    ``target_chars`` characters from ``target_start`` on are trainable: only that reply. Each text is cut from the
    conversation as its row is made, so no more than one is held, but written out they grow with the square of a
    conversation's length.
    """
    examples = conversations_of(turns).select("conv_id", "conv", "whole", F.inline("spans"))
    return examples.withColumn("text", F.col("whole").substr(F.lit(1), F.col("example_chars").cast("int"))).drop("whole")


def written_out(turns: DataFrame, examples: DataFrame) -> DataFrame:
    """conv_id, position, text (context and reply), target_start, target_chars of the examples of ``turns``."""
    return examples.select("conv_id", "position", "text", "target_start", "target_chars")


def joined(name: str, key: str) -> Column:
    """The texts of a group behind each other, in the order of ``key``."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(key, name))), lambda t: t[name]), "")


def read_back(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation: digests of what its rendering holds, unescaped, and of what its examples train on.

    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_examples, context_chars (of all examples).
    The texts of a block are joined first, then the blocks, for a digest needs the whole conversation in one value.
    """
    rendered = F.col("rendered")
    said = F.concat(template.role_of(rendered), F.lit("\n"), template.text_of(rendered), F.lit("\n"))
    # Of each whole example, context and reply, the span under the loss mask.
    reply = F.col("text").substr((F.col("target_start") + 1).cast("int"), F.col("target_chars").cast("int"))
    losses = prefix_targets(turns).select("conv", "position", "context_chars", template.unescape(reply).alias("loss")).groupBy("conv").agg(
        F.count("*").alias("n_examples"), F.sum("context_chars").alias("context_chars"), joined("loss", "position").alias("loss"),
    )
    blocks = turns.select("conv_id", "conv", "block", "position", "chars", said.alias("said")).groupBy("conv", "block").agg(
        F.first("conv_id").alias("conv_id"), F.min("position").alias("position"), F.count("*").alias("n_turns"), F.sum("chars").alias("chars"), joined("said", "position").alias("said"),
    )
    sums = [F.sum(n).alias(n) for n in ("n_turns", "chars")]
    wholes = blocks.groupBy("conv").agg(F.first("conv_id").alias("conv_id"), *sums, joined("said", "position").alias("said"))
    both = wholes.join(losses, "conv", "left").fillna(0, ["n_examples", "context_chars"]).fillna("", ["loss"])
    return both.select(
        "conv_id", "n_turns", F.sha2("said", 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), F.col("chars").alias("formatted_chars"), "n_examples", "context_chars",
    )
