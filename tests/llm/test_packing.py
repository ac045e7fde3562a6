import bisect
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tamarack.llm import packing
from tamarack.llm.queries import op5_best_fit_packing, tokenizer

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.lists(st.sampled_from(["<|endoftext|>", " ", "\t", " ", "\u0085", "　", "'s", "a", "1", "²", "é", "é", "東", "\U0001f600", "!"]), max_size=20).map("".join)))
def test_same_ids_as_the_library(text):
    assert tokenizer().load().encode_to_numpy(text, allowed_special="all").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def best_fit(lengths, capacity):
    gaps, n = [], 0
    for x in sorted(lengths, reverse=True):
        i = bisect.bisect_left(gaps, x)
        if i < len(gaps):
            bisect.insort(gaps, gaps.pop(i) - x)
        else:
            n += 1
            bisect.insort(gaps, capacity - x)
    return n


@settings(max_examples=200, deadline=None)
@given(st.integers(2, 40), st.lists(st.integers(1, 40), max_size=120))
def test_plan_places_everything_gaplessly(capacity, lengths):
    lengths = [min(x, capacity) for x in lengths]
    counts = np.bincount(np.array(lengths, int), minlength=capacity + 1)
    filled, seen = defaultdict(list), Counter()
    for length, first, n, sequence, offset in packing.packing_plan(counts, capacity).tolist():
        assert first == seen[length]
        seen[length] += n
        for k in range(n):
            filled[sequence + k].append((offset, length))
    assert seen == Counter(lengths)
    for pieces in filled.values():
        pieces.sort()
        assert [p[0] for p in pieces] == np.cumsum([0, *(p[1] for p in pieces)])[:-1].tolist()
        assert sum(p[1] for p in pieces) <= capacity
    assert len(filled) <= best_fit(lengths, capacity)


def check(rows, placed):
    """Pieces hold their documents' ids, sequences are gapless and within the capacity."""
    left = Counter()
    for doc_id, text in rows:
        ids = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, (start, length) in enumerate(packing.cuts(len(ids), 2048)):
            left[doc_id, piece, start, length, zlib.crc32(np.array(ids[start:start + length], "<u4").tobytes())] += 1
    assert left == Counter((p.doc_id, p.piece, p.start, p.length, p.ids_crc32) for p in placed)
    filled = defaultdict(list)
    for p in placed:
        filled[p.sequence_id].append((p.offset, p.length))
    for pieces in filled.values():
        pieces.sort()
        assert [p[0] for p in pieces] == np.cumsum([0, *(p[1] for p in pieces)])[:-1].tolist()
        assert sum(p[1] for p in pieces) <= 2048
    assert len(filled) <= best_fit([p.length for p in placed], 2048)


def test_query_against_the_library(spark, sf):
    check([(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()], op5_best_fit_packing(spark, sf).collect())


def test_odd_rows_and_sequences(documents):
    rows = [(1, None), (2, ""), (3, "word " * 20_000), (4, "a b c"), (4, "a b c"), (None, "null id"), (5, "<|endoftext|>"), (6, "x" * 50_000)]
    df = documents(rows).withColumnRenamed("lang", "length").withColumnRenamed("source", "piece")
    placed = packing.packed(df, tokenizer(), with_ids=True)
    check(rows, placed.collect())
    whole = packing.sequences(placed).collect()
    assert sum(len(s.ids) for s in whole) == sum(p.length for p in placed.collect())
    assert max(len(s.ids) for s in whole) <= 2048


@pytest.mark.parametrize(("n", "pieces"), [(1, [(0, 1)]), (2048, [(0, 2048)]), (2049, [(0, 1), (1, 2048)]), (4096, [(0, 2048), (2048, 2048)])])
def test_cuts(n, pieces):
    assert packing.cuts(n, 2048) == pieces
