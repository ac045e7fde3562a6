import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tamarack.llm import spelling
from tamarack.llm.queries import op12_spelling_variants


def one_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_force(counts, ratio=10):
    near = {w: [x for x in counts if one_apart(w, x)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return out


def altered(doc_id, word):
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
    return word[:h % len(word)] + word[h % len(word) + 1:] if h % 31 == 0 else word


def counted(rows):
    low = str.maketrans(spelling.UPPER, spelling.LOWER)
    counts = Counter(altered(i, w) for i, t in rows for w in re.findall("[A-Za-zÀ-ÿ]+", (t or "").translate(low)))
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def variants(draw, stem, n):
    out = [stem]
    for _ in range(n):
        w, at, letter = draw.choice(out), draw.randrange(len(stem)), draw.choice("abcxyzé")
        out.append(draw.choice([w[:at] + w[at + 1:], w[:at] + letter + w[at:], w[:at] + letter + w[at + 1:]]))
    return out


def some_words(seed, n):
    draw = random.Random(seed)
    stems = ["".join(draw.choice(["an", "er", "ti", "on", "é", "x"]) for _ in range(draw.randint(4, 7))) for _ in range(n)]
    return {w: draw.choice([2, 3, 20, 25, 300, 4000]) for s in stems for w in variants(draw, s, 12) if len(w) >= 7}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("abü", min_size=2, max_size=9), unique=True, max_size=40), st.sampled_from([["aüb"], ["a", "bü"], ["a", "b", "ü"]]))
def test_search_of_one_shard(words, letters):
    none = np.zeros(len(words), bool)
    found = [(words[i], words[j]) for a, b in spelling.near_pairs(words, none.astype(np.int64), none, none, letters, 1) for i, j in zip(a, b)] if words else []
    assert Counter(frozenset(p) for p in found) == Counter(frozenset((a, b)) for i, a in enumerate(words) for b in words[:i] if one_apart(a, b))


@pytest.mark.parametrize("shard", [40_000, 60, 3])
def test_all_pairs(spark, shard):
    """Shards of a few words are cut at every depth."""
    counts = some_words(3, 30)
    words = spark.createDataFrame(list(counts.items()), "word string, n long").withColumn("root", F.lit(1))
    got = spelling.grouped_variants(words, spelling.Setting(shard=shard))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(counts) and set(rows) == brute_force(counts)
    assert sum(r[1] is not None and r[1] != r[2] for r in rows) > 5


def test_query_is_brute_force(spark, tmp_path, documents):
    draw = random.Random(4)
    words = [w for w, n in some_words(9, 12).items() for _ in range(min(n, 40))]
    draw.shuffle(words)
    rows = [(i, " ".join(w if draw.random() < 0.8 else w.upper() for w in words[i * 9:i * 9 + 9]) + draw.choice([".", "\n", "1x", "÷×"])) for i in range(len(words) // 9)]
    long = "ab" * 3000
    rows += [(None, "lettering letterin lettering letterin"), (None, None), (1, ""), (1, "12 . ,"), (7, f"{long} {long} {long}c {long}c"), (8, f"x{long[1:]} x{long[1:]}")]
    documents(rows).withColumn("word", F.lit("clash")).write.parquet(f"{tmp_path}/documents.parquet")
    counts = counted(rows)
    assert any(len(w) > 5000 for w in counts)
    got = [tuple(r) for r in op12_spelling_variants(spark, str(tmp_path)).collect()]
    assert len(got) == len(counts) and set(got) == brute_force(counts)


def test_query_on_the_small_table(spark, sf):
    """Every word of the table by deleted letters: two words are near if one, or one letter less of both, agrees."""
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    counts, holes = counted(rows), {}
    for w in counts:
        for i in range(len(w)):
            holes.setdefault((i, w[:i] + w[i + 1:]), set()).add(w)
    near = {w: set() for w in counts}
    for (_, rest), group in holes.items():
        for w in group:
            near[w] |= group - {w}
        if rest in counts:
            near[rest] |= group
            for w in group:
                near[w].add(rest)
    got = op12_spelling_variants(spark, sf).collect()
    assert {r.word: (r.n, r.n_near) for r in got} == {w: (counts[w], len(near[w])) for w in counts}
    for r in got:
        best = min(near[r.word], key=lambda x: (-counts[x], x), default=None)
        assert r.form == (best if best and counts[best] >= 10 * r.n else None)
        assert (r.root == r.word) == (r.form is None)
