"""Spelling variants: words one letter apart, found by a search of frequency-vector tries; rare ones follow frequent ones.

1. A word's frequency vector counts its letters by group; groups are balanced over the vocabulary's letters. One changed
   letter moves one count up and one down, a longer word has one count more: a surplus and a deficit of one at most.
2. Two words one letter apart share their first letters or their last ones, so each word goes to two shards, by either.
   A shard of many words is cut by the counts of the first groups, at the depth that the data asks for; words then also
   visit the shards one surplus and one deficit away, the larger ones only, so that each pair meets once.
3. A shard's vectors form a trie, one group a level. A depth-first search walks it against itself: pairs of nodes, with
   the budget that is left. Words of leaf pairs that share a half are compared letter by letter.

Each word's shards return its number of near words and the most frequent of them; pairs are never written. A word's form
is that one, if it is ``ratio`` times as frequent; forms of forms are followed to the end by doubling, as many rounds as
the logarithm of the longest chain, which the ratio bounds. A word is the form of no more words than it has neighbours.

Rows: null texts have no words, a table without words gives none; ties go to the smallest word in code-point order; a word's
length is not bounded (words beyond 64 letters are compared one pair at a time); other columns are ignored.
"""

from dataclasses import dataclass
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.llm.scratch import Scratch
from tamarack.llm.textops import mixed64
from tamarack.llm.workers import prepare

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Letters of words compared in arrays; longer words are compared as strings.
WIDTH = 64
#: Node pairs that a step of the search takes up at once.
STEP = 1 << 17


@dataclass(frozen=True)
class Setting:
    least_letters: int = 7
    least_count: int = 2
    ratio: int = 10  # by which a form is more frequent
    groups: int = 16
    shard: int = 40_000  # words of a task, about


def runs_of_letters(documents: DataFrame) -> DataFrame:
    """doc_id and word for each longest run of Latin letters, A-Z lower-cased."""
    lowered = F.translate("text", UPPER, LOWER)
    return documents.select("doc_id", F.explode(F.split(lowered, "[^a-zÀ-ÿ]+")).alias("word")).where("word <> ''")


def vocabulary(words: DataFrame, how: Setting = Setting()) -> DataFrame:
    """word and n of the words long and frequent enough; counts are combined before the shuffle."""
    long = words.where(F.length("word") >= how.least_letters)
    return long.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= how.least_count)


def letter_groups(words: DataFrame, groups: int) -> list[str]:
    """Letters of about equal counts, the largest group first. The driver sees one row per letter."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).where("letter <> ''").groupBy("letter").count().collect()
    out = [[0, ""] for _ in range(groups)]
    for row in sorted(letters, key=lambda r: (-r["count"], r["letter"])):
        least = min(out, key=lambda g: g[0])
        least[0] += row["count"]
        least[1] += row["letter"]
    return [g for _, g in sorted(out, key=lambda g: (-g[0], g[1])) if g]


def shards(words: DataFrame, groups: list[str], how: Setting) -> DataFrame:
    """word, n, tail, affix, key, visits: the words of each shard. Only shards of too many words have keys."""
    size = how.least_letters // 2
    vector = F.array(*[F.length("word") - F.length(F.translate("word", g, "")) for g in groups])
    both = words.select("word", "n", vector.alias("vector"), F.explode(F.array(F.lit(False), F.lit(True))).alias("tail"))
    affix = F.when(F.col("tail"), F.expr(f"right(word, {size})")).otherwise(F.expr(f"left(word, {size})"))
    rows = both.withColumn("affix", affix)
    many = rows.groupBy("tail", "affix").count().where(F.col("count") > how.shard).select("tail", "affix")
    levels = sorted({min(2 ** i, len(groups)) for i in range(1, len(groups).bit_length() + 1)})
    cut = rows.join(many, ["tail", "affix"], "left_semi").select("tail", "affix", "vector", F.explode(F.array(*map(F.lit, levels))).alias("level"))
    counts = cut.groupBy("tail", "affix", "level", F.expr("slice(vector, 1, level)").alias("key")).count()
    largest = counts.groupBy("tail", "affix", "level").agg(F.max("count").alias("most"))
    # A vector and affix of more words than that have no depth that splits them; they stay one shard.
    depth = largest.groupBy("tail", "affix").agg(F.coalesce(F.min(F.when(F.col("most") <= how.shard, F.col("level"))), F.lit(len(groups))).alias("depth"))
    placed = rows.join(depth, ["tail", "affix"], "left").withColumn("depth", F.coalesce("depth", F.lit(0))).withColumn("own", F.expr("slice(vector, 1, depth)"))
    # From (up, down) = (depth, depth), no step, to any two different steps.
    steps = "transform(sequence(0, depth * (depth + 2)), s -> struct(s div (depth + 1) as up, s % (depth + 1) as down))"
    moved = F.expr(f"transform(filter({steps}, s -> s.up <> s.down), s -> transform(own, (x, k) -> x + if(k = s.up, 1, 0) - if(k = s.down, 1, 0)))")
    placed = placed.withColumn("away", F.when(F.col("depth") > 0, F.filter(moved, lambda key: ~F.exists(key, lambda x: x < 0) & (key > F.col("own")))))
    home = F.array(F.struct(F.col("own").alias("key"), F.lit(False).alias("visits")))
    guests = F.transform(F.coalesce("away", F.array().cast("array<array<int>>")), lambda key: F.struct(key.alias("key"), F.lit(True).alias("visits")))
    return placed.select("word", "n", "tail", "affix", F.explode(F.concat(home, guests)).alias("at")).select("word", "n", "tail", "affix", "at.key", "at.visits")


class Trie:
    """Frequency vectors of a shard's words, sorted; a node of level k is a stretch that agrees in the first k counts."""

    def __init__(self, vectors: np.ndarray):
        order = np.lexsort(vectors.T[::-1])
        ordered = vectors[order]
        new = np.ones(ordered.shape, bool)
        new[1:] = ordered[1:] != ordered[:-1]
        new = np.logical_or.accumulate(new, axis=1)
        self.words, self.depth = order, vectors.shape[1]
        #: Per level: each node's parent and count, and where the children of each node start.
        self.levels, above = [], np.zeros(len(ordered), np.int64)
        for k in range(self.depth):
            first = np.flatnonzero(new[:, k])
            parent = above[first]
            self.levels.append((parent, ordered[first, k], np.searchsorted(parent, np.arange((above[-1] if len(above) else 0) + 2))))
            above = np.cumsum(new[:, k]) - 1
        self.starts = np.append(first, len(ordered)) if len(ordered) else np.zeros(1, np.int64)
        self.wide = int(vectors.max(initial=0)) + 2
        self.leaf = np.empty(len(ordered), np.int64)
        self.leaf[order] = above

    def close(self):
        """Leaf pairs (u, v), u not after v, up to one surplus and one deficit apart; with the difference in length.

        Depth first: the newest pairs of nodes go on, a bounded number at a time.
        """
        nodes = np.arange(len(self.levels[0][0]))  # of the first level, the shard, which near words share
        stack = [(1, nodes, nodes, np.zeros(len(nodes), np.int8), np.zeros(len(nodes), np.int8))]
        while stack:
            level, u, v, surplus, deficit = stack.pop()
            if len(u) > STEP:
                stack += [(level, *(a[i:i + STEP] for a in (u, v, surplus, deficit))) for i in range(0, len(u), STEP)]
            elif level == self.depth:
                yield u, v, surplus.astype(np.int64) - deficit
            elif len(u):
                stack.append((level + 1, *self._children(level, u, v, surplus, deficit)))

    def _children(self, level: int, u, v, surplus, deficit):
        parent, count, starts = self.levels[level]
        keys = parent * self.wide + count + 1
        pair, child = _spread(starts[u], starts[u + 1])
        out = []
        for step in (-1, 0, 1):
            # Before the first difference u and v are one node, and v goes on to the larger count.
            fits = surplus[pair] == 0 if step > 0 else (deficit[pair] == 0) & (u[pair] != v[pair]) if step < 0 else np.ones(len(pair), bool)
            p, c = pair[fits], child[fits]
            wanted = v[p] * self.wide + count[c] + 1 + step
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            here = keys[at] == wanted
            p = p[here]
            out.append((c[here], at[here], surplus[p] + np.int8(step > 0), deficit[p] + np.int8(step < 0)))
        return tuple(np.concatenate(parts) for parts in zip(*out))


def _spread(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each range, its number again and again, and the members."""
    counts = ends - starts
    owner = np.repeat(np.arange(len(starts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts - starts, counts)


class Halves:
    """Words by their leaf and one half; a half is the first or last ``letters // 2``, of a word or of one a letter shorter."""

    def __init__(self, words: list[str], leaf: np.ndarray):
        self.table = {}
        for tail in (False, True):
            for shorter in (0, 1):
                cut = [(len(w) - shorter) // 2 for w in words]
                hashes = np.fromiter((hash(w[len(w) - k:] if tail else w[:k]) for w, k in zip(words, cut)), np.int64, len(words)).view(np.uint64)
                keys = self._key(leaf, hashes)
                order = np.argsort(keys)
                self.table[tail, shorter] = hashes, order, keys[order]

    @staticmethod
    def _key(leaf: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        return mixed64(hashes + mixed64(leaf.astype(np.uint64)))

    def shared(self, a: np.ndarray, leaf: np.ndarray, a_shorter: int, b_shorter: int):
        """Pairs of a word of ``a`` and one of its ``leaf`` that share a half, each pair once."""
        out = []
        for tail in (False, True):
            hashes, order, keys = self.table[tail, b_shorter]
            wanted = self._key(leaf, self.table[tail, a_shorter][0][a])
            owner, at = _spread(np.searchsorted(keys, wanted), np.searchsorted(keys, wanted, "right"))
            out.append((a[owner], order[at]))
        heads_a, heads_b = self.table[False, a_shorter][0], self.table[False, b_shorter][0]
        x, y = out[1]
        once = heads_a[x] != heads_b[y]
        return np.concatenate([out[0][0], x[once]]), np.concatenate([out[0][1], y[once]])


class Letters:
    """Whether two words are one letter apart: what they share in front and behind covers the longer one but a letter."""

    def __init__(self, words: list[str]):
        self.words = words
        self.length = np.fromiter(map(len, words), np.int64, len(words))
        self.width = int(min(self.length.max(initial=0), WIDTH))
        self.front, self.back = (self._matrix(words, way) for way in (1, -1))

    def _matrix(self, words: list[str], way: int) -> np.ndarray:
        padded = "".join((w[::way] if len(w) <= self.width else "").ljust(self.width, "\0") for w in words)
        return np.frombuffer(padded.encode("utf-32-le"), np.uint32).reshape(len(words), self.width)

    def one_apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        longer = np.maximum(self.length[a], self.length[b])
        both = np.minimum(self.length[a], self.length[b])
        out = longer - both <= 1
        short = longer <= self.width
        x, y = a[short], b[short]
        shared = [np.minimum(np.logical_and.accumulate(m[x] == m[y], axis=1).sum(1), both[short]) for m in (self.front, self.back)]
        out[short] &= shared[0] + shared[1] >= longer[short] - 1
        for i in np.flatnonzero(out & ~short):
            first, second = self.words[a[i]], self.words[b[i]]
            in_common = len(commonprefix([first, second])) + len(commonprefix([first[::-1], second[::-1]]))
            out[i] = in_common >= longer[i] - 1
        return out


def frequency_vectors(words: list[str], groups: list[str]) -> np.ndarray:
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
    known = np.frombuffer("".join(groups).encode("utf-32-le"), np.uint32)
    group = np.repeat(np.arange(len(groups)), [len(g) for g in groups])[np.argsort(known)]
    return np.bincount(owner * len(groups) + group[np.searchsorted(np.sort(known), codes)], minlength=len(words) * len(groups)).reshape(len(words), -1)


def near_pairs(words: list[str], cell: np.ndarray, visits: np.ndarray, tail: np.ndarray, groups: list[str], affix: int):
    """Arrays of pairs one letter apart, in the same cell, not both visitors; in tail cells only those of other heads."""
    trie = Trie(np.column_stack([cell, frequency_vectors(words, groups)]))
    halves, letters = Halves(words, trie.leaf), Letters(words)
    heads = np.fromiter((hash(w[:affix]) for w in words), np.int64, len(words))
    for u, v, longer in trie.close():
        for by in (-1, 0, 1):
            some = longer == by
            a_leaf, b_leaf = (v[some], u[some]) if by < 0 else (u[some], v[some])  # b is the longer one
            owner, at = _spread(trie.starts[a_leaf], trie.starts[a_leaf + 1])
            a, b = halves.shared(trie.words[at], b_leaf[owner], 0, abs(by))
            meets = ~(visits[a] & visits[b]) & ~(tail[a] & (heads[a] == heads[b])) & ((trie.leaf[a] != trie.leaf[b]) | (a < b))
            a, b = a[meets], b[meets]
            near = letters.one_apart(a, b)
            yield a[near], b[near]


def neighbours(words: DataFrame, how: Setting = Setting()) -> DataFrame:
    """word, n, n_near, best (n and word of the most frequent near word; null without one) for a table of word and n."""
    spark = prepare(words.sparkSession)
    groups = letter_groups(words, how.groups)
    rows = shards(words, groups, how)
    bins = max(1, -(-2 * words.count() // how.shard))
    affix = how.least_letters // 2
    cell = F.xxhash64("tail", "affix", F.concat_ws(",", F.col("key").cast("array<string>")))
    rows = rows.withColumn("cell", F.concat_ws("|", "tail", "affix", F.concat_ws(",", F.col("key").cast("array<string>")))).withColumn("bin", F.pmod(cell, F.lit(bins)).cast("int"))

    def search(table: pa.Table) -> pa.Table:
        names, n = table["word"].to_pylist(), table["n"].to_numpy()
        cells = table["cell"].combine_chunks().dictionary_encode().indices.to_numpy()
        visits, tail = (table[c].to_numpy() for c in ("visits", "tail"))
        order = sorted(range(len(names)), key=lambda i: (-n[i], names[i]))
        rank = np.empty(len(names), np.int64)
        rank[order] = np.arange(len(names))
        near, best = np.zeros(len(names), np.int64), np.full(len(names), len(names))
        for a, b in near_pairs(names, cells, visits, tail, groups, affix):
            for x, y in ((a, b), (b, a)):
                near += np.bincount(x, minlength=len(names))
                np.minimum.at(best, x, rank[y])
        some = np.flatnonzero(near)
        top = [order[r] for r in best[some]]
        return pa.table({"word": [names[i] for i in some], "near": near[some], "best_n": n[top] if len(top) else pa.array([], pa.int64()), "best": [names[i] for i in top]}, pa.schema([("word", pa.string()), ("near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())]))

    found = rows.select("word", "n", "tail", "cell", "visits", "bin").groupBy("bin").applyInArrow(search, "word string, near long, best_n long, best string")
    all_words = words.select("word", "n", F.lit(0).cast("long").alias("near"), F.lit(None).cast("struct<less:bigint,word:string>").alias("best"))
    partly = found.select("word", F.lit(None).cast("long").alias("n"), "near", F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word")).alias("best"))
    return all_words.unionAll(partly).groupBy("word").agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), F.min("best").alias("best"))


def grouped_variants(words: DataFrame, how: Setting = Setting()) -> DataFrame:
    """word, form, root, n, n_near, form_n of a table of word and n."""
    scratch = Scratch(prepare(words.sparkSession), "spelling")
    words = scratch.write(words, "words")
    found = neighbours(words, how)
    follows: Column = -F.col("best.less") >= how.ratio * F.col("n")
    formed = scratch.write(found.select("word", F.when(follows, F.col("best.word")).alias("form"), "n", "n_near", F.when(follows, -F.col("best.less")).alias("form_n")), "formed")
    scratch.drop("words")
    ends, i = scratch.write(formed.where("form is not null").select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "ends-0"), 0
    while not ends.where("moved").isEmpty():
        on = ends.select(F.col("word").alias("_at"), F.col("root").alias("_on"))
        step = ends.join(on, F.col("root") == F.col("_at"), "left").select("word", F.coalesce("_on", "root").alias("root"), F.col("_on").isNotNull().alias("moved"))
        ends = scratch.write(step, f"ends-{i + 1}")
        scratch.drop(f"ends-{i}")
        i += 1
    ends = ends.select(F.col("word").alias("_word"), "root")
    return formed.join(ends, F.col("word") == F.col("_word"), "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
