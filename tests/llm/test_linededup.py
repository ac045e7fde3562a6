import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tamarack.llm import linededup


def brute_force(rows, threshold):
    key = lambda line: line.encode().lower().strip(b" \t\n\x0b\x0c\r")
    seen = {}
    for _, text in rows:
        for k in {key(line) for line in (text or "").split("\n")}:
            seen[k] = seen.get(k, 0) + 1
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if not (key(line) and seen[key(line)] >= threshold)]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "text", "_n_lines", "_n_dropped").collect()), key=str)


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 3000), st.integers(0, 2**32 - 1))
def test_perfect_hash(n, seed):
    keys = np.unique(np.random.default_rng(seed).integers(-(2**63), 2**63 - 1, (n, 2)), axis=0)
    if n:
        keys[: n // 3, 0] = keys[0, 0]  # halves may be equal
        keys = np.unique(keys, axis=0)
    assert sorted(linededup.PerfectHash.of(keys).numbers(keys)) == list(range(len(keys)))


def test_rest_that_no_level_places(monkeypatch):
    monkeypatch.setattr(linededup, "LEVELS", 1)
    keys = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, (500, 2))
    perfect = linededup.PerfectHash.of(keys)
    assert len(perfect.rest)
    assert sorted(perfect.numbers(keys)) == list(range(500))
    shard = linededup.Shard(linededup.packed_shard(0, keys, np.arange(500), 300).to_pylist()[0], 300)
    assert shard.found(keys).tolist() == np.minimum(np.arange(500), 300).tolist()
    assert (shard.found(keys + 1) == 0).mean() > 0.99


@pytest.mark.parametrize("probes", [5, 1 << 19])
def test_many_blocks_and_shards(documents, monkeypatch, probes):
    monkeypatch.setattr(linededup, "PROBES_PER_COPY", probes)
    monkeypatch.setattr(linededup, "DOCUMENTS_PER_BLOCK", 7)
    monkeypatch.setattr(linededup, "KEYS_PER_SHARD", 20)
    rows = [(i, "\n".join(["Hot line ", f"own {i}", *(f"shared {j}" for j in range(8) if i % (j + 2) == 0), "", "hot LINE\t"])) for i in range(60)]
    assert result(linededup.deduped_lines(documents(rows), threshold=10)) == brute_force(rows, 10)


def test_odd_rows(documents):
    rows = [(1, None), (2, ""), (3, "\n\n"), (None, "a"), (4, "a"), (4, "a"), (5, "A \x0b"), (6, "ä"), (7, "Ä"), (8, "a\xa0"), (9, "long " * 100_000 + "\na"), (10, "b\r\nB")]
    odd = documents(rows).withColumnRenamed("lang", "block").withColumnRenamed("source", "_n_lines").withColumnRenamed("n_chars", "h1")
    clean = linededup.deduped_lines(odd, threshold=3)
    assert clean.columns == ["doc_id", "text", "block", "h1", "_n_lines", "_n_dropped"]
    assert result(clean) == brute_force(rows, 3)
