import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tamarack.llm import mixing

TREE = {"d1": (2.0, {"en": (3.0, {"a": 1.0, "b": 1.0}), "de": (1.0, {"a": 1.0})}), "d2": (1.0, {"en": (1.0, {"c": 2.0, "e": 0.0})})}


def share(budget, children):
    """Budgets by weight, capped, the rest to those not full, round by round: {name: (weight, capacity)}."""
    out, open_ = {}, {n: c for n, c in children.items() if c[1] > 0}
    while open_:
        weight = sum(w for w, _ in open_.values())
        full = [n for n, (w, c) in open_.items() if c <= budget * w / weight + 1e-9]
        if not full:
            return out | {n: budget * w / weight for n, (w, _) in open_.items()}
        for n in full:
            out[n] = open_.pop(n)[1]
            budget -= out[n]
    return out


def brute_force(rows, mix):
    held = {}
    for r in rows:
        r["tokens"] = len(re.findall(r"[^ \t\r\n]+", r["text"] or ""))
        held[r["domain"], r["lang"], r["source"]] = held.get((r["domain"], r["lang"], r["source"]), 0) + r["tokens"]
    named = {(d, l, s): held.get((d, l, s), 0) for d, (dw, ls) in mix.tree.items() for l, (lw, ss) in ls.items() for s, sw in ss.items() if min(dw, lw, sw) > 0}
    capacity = lambda *path: sum(v * mix.max_epochs for k, v in named.items() if k[:len(path)] == path)
    plan = {}
    top = min(sum(named.values()) * mix.share, capacity())
    for d, b in share(top, {d: (mix.tree[d][0], capacity(d)) for d in mix.tree}).items():
        langs = mix.tree[d][1]
        for l, c in share(b, {l: (langs[l][0], capacity(d, l)) for l in langs}).items():
            sources = langs[l][1]
            for s, e in share(c, {s: (sources[s], capacity(d, l, s)) for s in sources}).items():
                plan[d, l, s] = divmod(int(e + 1e-6), named[d, l, s])
    out = []
    for leaf in {(r["domain"], r["lang"], r["source"]) for r in rows}:
        epochs, part = plan.get(leaf, (0, 0))
        own = [r for r in rows if (r["domain"], r["lang"], r["source"]) == leaf]
        own.sort(key=lambda r: (hashlib.md5(f"{mix.seed}:{epochs}:{'null' if r['doc_id'] is None else r['doc_id']}".encode()).hexdigest(), r["tokens"], hashlib.md5((r["text"] or "").encode()).hexdigest()))
        ahead = 0
        for r in own:
            out.append((r["doc_id"], r["tokens"], epochs + (leaf in plan and ahead < part)))
            ahead += r["tokens"]
    return sorted(out, key=str)


def table(spark, n=400, odd=True):
    rows = [{"doc_id": i, "text": "w " * (i * 7919 % 23), "lang": ("en", "en", "de", "fr")[i % 4], "source": "abcde"[i * 31 % 5], "domain": "d1" if i % 3 else "d2"} for i in range(n)]
    if odd:
        rows += [{"doc_id": 5000 + i, "text": t, "lang": l, "source": "a", "domain": "d1"} for i, (t, l) in enumerate([(None, "en"), ("", "en"), ("x " * 3000, "en"), ("y", None)])]
        rows += [{"doc_id": None, "text": "no id", "lang": "de", "source": "a", "domain": "d1"}] + [dict(rows[0]), dict(rows[0])]
    return rows, spark.createDataFrame([tuple(r.values()) for r in rows], "doc_id long, text string, lang string, source string, domain string")


@pytest.mark.parametrize(("portion", "epochs"), [(0.3, 1), (1.0, 1), (1.0, 3), (2.5, 3), (9.0, 2)])
def test_same_as_brute_force(spark, portion, epochs):
    mix = mixing.Mix(TREE, portion, epochs, 3)
    rows, df = table(spark)
    df = df.withColumn("_copies", F.lit("clash")).withColumn("budget", F.lit("clash"))
    got = mixing.mixed(df, F.col("domain"), mix)
    assert sorted((tuple(r) for r in got.select("doc_id", "_tokens", "_copies").collect()), key=str) == brute_force(rows, mix)
    assert mixing.in_epochs(got).columns == ["doc_id", "text", "lang", "source", "domain", "budget"]


@pytest.mark.parametrize("rows_per_slice", [5, 4096])
def test_leaves_of_the_rows_meet_them_without_a_broadcast(spark, monkeypatch, rows_per_slice):
    """With ``others`` every leaf of the rows has a weight; a leaf of most rows, thin slices, clashing names."""
    monkeypatch.setattr(mixing, "SLICE_ROWS", rows_per_slice)
    rows, df = table(spark)
    named = {k: {l: dict(s) for l, (_, s) in langs.items()} for k, (_, langs) in TREE.items()}
    tree = {}
    for r in rows:  # the tree spelled out, for brute force
        dw, langs = TREE.get(r["domain"], (2.0, {}))
        lw, sources = langs.get(r["lang"], (2.0, {}))
        tree.setdefault(r["domain"], (dw, {}))[1].setdefault(r["lang"], (lw, {}))[1][r["source"]] = named.get(r["domain"], {}).get(r["lang"], {}).get(r["source"]) or 2.0  # a weight of 0 names nothing
    got = mixing.mixed(df.withColumn("_leaf", F.lit("clash")).withColumn("_rows", F.lit(1)), F.col("domain"), mixing.Mix(TREE, 1.4, 3, 3, others=2.0))
    assert got.columns == ["doc_id", "text", "lang", "source", "domain", "_domain", "_tokens", "_copies"]
    assert sorted((tuple(r) for r in got.select("doc_id", "_tokens", "_copies").collect()), key=str) == brute_force(rows, mixing.Mix(tree, 1.4, 3, 3))


def test_shortage_goes_to_siblings_first(spark):
    """b is short: its shortage goes to a, its sibling, and nothing of it to another language or domain."""
    rows = [("d1", "en", "a", 1000), ("d1", "en", "b", 10), ("d1", "de", "a", 1000), ("d2", "en", "c", 1000)]
    held = spark.createDataFrame(rows, "domain string, lang string, source string, held long").join(mixing.named_leaves(spark, TREE), list(mixing.LEVELS))
    got = {(r.domain, r.lang, r.source): r.budget for r in mixing.leaf_budgets(held, mixing.Mix(TREE, share=900 / 3010, max_epochs=1)).collect()}
    assert {k: round(v, 6) for k, v in got.items()} == {("d1", "en", "a"): 440, ("d1", "en", "b"): 10, ("d1", "de", "a"): 150, ("d2", "en", "c"): 300}


def test_no_python_in_the_plan(spark, sf):
    from tamarack.llm import chat
    from tamarack.llm.queries import op3_mixing, table as read

    for df in (op3_mixing(spark, sf), chat.read_back(chat.rendered_turns(read(spark, sf, "conversations")))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_leaves_the_pipeline_does_not_name_stay(spark):
    """Null and new languages and sources hold a leaf of their own."""
    from corpus_pipeline import to_target_weights

    rows = [(i, f"some words {i}", "en", "src0") for i in range(200)]
    odd = [(1000 + i, "two words", lang, source) for i, (lang, source) in enumerate([(None, "src0"), ("pt", "src1"), ("en", "src99"), ("en", None), (None, None)])]
    got = to_target_weights(spark, spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, source string"), "")
    assert {r.doc_id for r in got.collect()} >= {r[0] for r in odd}
