import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tamarack.llm import chat

PARTS = ["<|im_start|>", "<|im_sep|>", "<|im_end|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<\\s>", "[\\\\INST]", "\\", "<", "[", "\n", "é", "x ", "$1"]
texts = st.lists(st.sampled_from(PARTS), max_size=8).map("".join)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(texts, texts), min_size=1, max_size=40))
def test_rendering_round_trips(spark, rows):
    template = chat.Template()
    df = spark.createDataFrame(rows, "role string, text string").withColumn("r", template.render(F.col("role"), F.col("text")))
    marks = [template.open, template.between, template.close, *template.others]
    for row in df.select("role", "text", "r", template.role_of(F.col("r")).alias("role2"), template.text_of(F.col("r")).alias("text2")).collect():
        assert (row.role2, row.text2) == (row.role, row.text)
        inner = row.r[len(template.open):-len(template.close)].split(template.between)
        assert len(inner) == 2
        assert not any(m in part for part in inner for m in marks)


def test_examples_are_prefixes(spark, monkeypatch):
    monkeypatch.setattr(chat, "TURNS_PER_BLOCK", 3)
    said = [(7, n, ("user", "assistant")[n % 2], None if n == 3 else f"text {n}") for n in range(11)] + [(8, 0, "user", "alone"), (None, 1, "assistant", "a"), (None, None, None, "b")]
    df = spark.createDataFrame(said, "conv_id long, turn long, role string, text string").withColumn("rendered", F.lit("clash"))
    turns = chat.rendered_turns(df)
    examples = chat.written_out(turns, chat.prefix_targets(turns)).collect()
    whole = [chat.Template().open + r + "<|im_sep|>" + (t or "") + "<|im_end|>" for c, _, r, t in said if c == 7]
    mine = {e.position: e for e in examples if e.conv_id == 7}
    assert sorted(mine) == [1, 3, 5, 7, 9]
    for position, e in mine.items():
        assert e.text == "".join(whole[:position + 1])
        assert e.text[e.target_start:e.target_start + e.target_chars] == (said[position][3] or "")
    read = {r.conv_id: r for r in chat.read_back(turns).collect()}
    loss = "".join(t or "" for c, _, r, t in said if c == 7 and r == "assistant")
    assert (read[7].n_turns, read[7].loss_sha256) == (11, hashlib.sha256(loss.encode()).hexdigest())
    assert (read[8].n_turns, read[8].loss_chars, read[None].n_turns, read[None].n_examples) == (1, 0, 2, 1)


def test_loss_is_cut_from_whole_examples(spark, monkeypatch):
    """Every example holds its context, and what the query digests comes from the examples alone."""
    monkeypatch.setattr(chat, "TURNS_PER_BLOCK", 2)
    said = [(7, n, ("user", "assistant")[n % 2], f"[INST] é {n}") for n in range(7)]
    turns = chat.rendered_turns(spark.createDataFrame(said, "conv_id long, turn long, role string, text string"))
    whole = [r.rendered for r in turns.orderBy("position").collect()]
    examples = chat.prefix_targets(turns)
    assert {e.position: (e.text, e.context_chars) for e in examples.collect()} == {n: ("".join(whole[:n + 1]), len("".join(whole[:n]))) for n in (1, 3, 5)}
    monkeypatch.setattr(chat, "prefix_targets", lambda turns: examples.withColumn("text", F.regexp_replace("text", "é 1", "é X")))
    row = chat.read_back(turns).first()
    assert row.loss_sha256 == hashlib.sha256("[INST] é X[INST] é 3[INST] é 5".encode()).hexdigest()


def test_repeated_turns_have_one_order(spark):
    df = spark.createDataFrame([(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, "assistant", "")], "conv_id long, turn long, role string, text string")
    row = chat.read_back(chat.rendered_turns(df)).first()
    assert (row.n_turns, row.n_examples, row.loss_chars) == (4, 1, 0)
    assert row.turns_sha256 == hashlib.sha256(b"user\na\nuser\na\nuser\nb\nassistant\n\n").hexdigest()


def test_very_long_texts(spark):
    """A reply of some million characters full of control strings, after a context as long."""
    long = "word [INST] <|im_end|> é " * 100_000
    df = spark.createDataFrame([(1, 0, "user", long), (1, 1, "assistant", long + "!"), (1, 2, "assistant", "")], "conv_id long, turn long, role string, text string")
    turns = chat.rendered_turns(df)
    row = chat.read_back(turns).first()
    assert (row.loss_chars, row.loss_sha256) == (len(long) + 1, hashlib.sha256((long + "!").encode()).hexdigest())
    rendered = [r.rendered for r in turns.orderBy("position").collect()]
    assert (row.n_examples, row.context_chars, row.formatted_chars) == (2, 2 * len(rendered[0]) + len(rendered[1]), sum(map(len, rendered)))
