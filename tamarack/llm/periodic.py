"""Runs of repeated word sequences, by a suffix automaton whose link tree keeps last occurrences under link-cut access.

A run is a stretch of words with smallest period q (words q apart are identical), at least ``max(least, 2 * q)`` words
long, that neither neighbour extends. Words are appended to a suffix automaton one by one. Each preferred path of its
link tree carries the position at which its strings ended last; the access of the new state walks these segments, from
the longest suffix to the empty one, and recolours them. A segment of strings up to ``longest`` words that ended ``d``
words earlier gives, when ``d <= longest``, a square of period d at the new word; d is the smallest period then, since
the occurrence is the last one, and the stretch reaches ``d + longest`` words back exactly, since a longer suffix ended
elsewhere. Squares of one start and period are one run, which ends at the last of them.

The automaton works on pieces only: every word of a run lies in a sequence of ``least // 2`` words that occurs once
more in the same piece, so words outside such sequences cut the text without touching a run. A document is read in one
task, in arrays of about 70 bytes a word of its longest piece.

Rows: a null or empty text has no words and no run; repeated rows are worked alike; other columns stay, ``_runs`` and
``_kept`` are replaced. Words are runs of other characters than ASCII white space, compared byte by byte.
"""

from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.llm.workers import prepare

LEAST = 12


class Automaton:
    """Suffix automaton of one word sequence with the squares that each appended word completes.

    States are numbers. The first transition of a state is in two arrays, further ones in a dict of its own. The link
    tree is a link-cut tree: ``left``, ``right`` and ``up`` are its splay trees, one per preferred path, ordered by
    depth; ``up`` of a splay root is the parent of its path's top, and ``last`` of a splay root the colour of the path.
    """

    def __init__(self, words: int):
        size = 2 * words + 2
        self.word, self.to, self.more = array("q", [-1]) * size, array("i", [0]) * size, {}
        self.link, self.length = array("i", [0]) * size, array("i", [0]) * size
        self.left, self.right, self.up, self.last = (array("i", [0]) * size for _ in range(4))
        self.states, self.end, self.n = 2, 1, 0  # 0 is no state, 1 the empty string

    def _next(self, state: int, word: int) -> int:
        if self.word[state] == word:
            return self.to[state]
        more = self.more.get(state)
        return more.get(word, 0) if more else 0

    def _set(self, state: int, word: int, to: int) -> None:
        if self.word[state] in (-1, word):
            self.word[state], self.to[state] = word, to
        else:
            self.more.setdefault(state, {})[word] = to

    def append(self, word: int) -> list[tuple[int, int]]:
        """(start, period) of the stretches of whole squares that end at the new word."""
        new, p = self.states, self.end
        self.states += 1
        self.length[new] = self.n + 1
        while p and not self._next(p, word):
            self._set(p, word, new)
            p = self.link[p]
        if not p:
            self.link[new] = 1
        else:
            q = self._next(p, word)
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._cloned(p, q, word)
        self.up[new] = self.link[new]
        self.end, self.n = new, self.n + 1
        return self._access(new)

    def _cloned(self, p: int, q: int, word: int) -> int:
        """A copy of ``q`` for its shorter strings: put right above ``q`` on the same path, so with the same colour."""
        clone = self.states
        self.states += 1
        self.length[clone], self.link[clone] = self.length[p] + 1, self.link[q]
        self.word[clone], self.to[clone] = self.word[q], self.to[q]
        if q in self.more:
            self.more[clone] = dict(self.more[q])
        self._splay(q)
        above = self.left[q]
        self.left[clone], self.up[clone], self.left[q] = above, q, clone
        if above:
            self.up[above] = clone
        self.link[q] = clone
        while p and self._next(p, word) == q:
            self._set(p, word, clone)
            p = self.link[p]
        return clone

    def _access(self, new: int) -> list[tuple[int, int]]:
        left, right, up, last, n = self.left, self.right, self.up, self.last, self.n
        squares, below, state = [], new, up[new]
        while state != 1 and state:
            self._splay(state)
            ended, longest = last[state], self.length[state]
            if n - ended <= longest:
                squares.append((ended - longest, n - ended))
            lower = right[state]
            if lower:
                last[lower] = ended  # the rest of the old path keeps its colour
            right[state], up[below] = below, state
            below, state = state, up[state]
        last[below] = n
        return squares

    def _splay(self, x: int) -> None:
        left, right, up = self.left, self.right, self.up
        while True:
            p = up[x]
            if not p or (left[p] != x and right[p] != x):
                return
            g = up[p]
            if g and (left[g] == p or right[g] == p):
                self._rotate(p if (left[g] == p) == (left[p] == x) else x)
            self._rotate(x)

    def _rotate(self, x: int) -> None:
        left, right, up = self.left, self.right, self.up
        p = up[x]
        g = up[p]
        if left[p] == x:
            inner = right[x]
            left[p], right[x] = inner, p
        else:
            inner = left[x]
            right[p], left[x] = inner, p
        if inner:
            up[inner] = p
        up[p], up[x] = x, g
        if g and left[g] == p:
            left[g] = x
        elif g and right[g] == p:
            right[g] = x
        else:
            self.last[x] = self.last[p]  # x is the root now


def pieces(words: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Start and end of the longest stretches in which each word is in some ``width`` words that occur there twice."""
    todo, out = [(0, len(words))], []
    while todo:
        start, end = todo.pop()
        if end - start < 2 * width:
            continue
        part = words[start:end].astype(np.uint64)
        sums = np.zeros(len(part) - width + 1, np.uint64)
        for k in range(width):
            sums = sums * np.uint64(0x9E3779B97F4A7C15) + part[k:k + len(sums)]
        order = np.argsort(sums, kind="stable")
        same = np.flatnonzero(sums[order[1:]] == sums[order[:-1]])
        if not len(same):
            continue
        edge = np.zeros(len(part) + 1, np.int64)
        again = np.unique(np.concatenate([order[same], order[same + 1]]))
        np.add.at(edge, again, 1)
        np.add.at(edge, again + width, -1)
        inside = np.diff(np.concatenate([[0], (np.cumsum(edge[:-1]) > 0).astype(np.int8), [0]]))
        found = [(start + int(a), start + int(b)) for a, b in zip(np.flatnonzero(inside == 1), np.flatnonzero(inside == -1))]
        if found == [(start, end)]:
            out.append((start, end))
        else:
            todo += found
    return out


def runs(words: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """start, length, period of every run of the word numbers, by start, then period."""
    out = []
    for first, end in pieces(words, max(least // 2, 1)):
        automaton, ends = Automaton(end - first), {}
        for at, word in enumerate(words[first:end].tolist(), 1):
            for square in automaton.append(word):
                ends[square] = at
        out += [(first + start, at - start, period) for (start, period), at in ends.items() if at - start >= least]
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay: those that no run holds after its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:-1]) <= 0


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def numbered(words: list[bytes]) -> np.ndarray:
    numbers = {}
    return np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))


def with_runs(documents: DataFrame, words_of=None, least: int = LEAST) -> DataFrame:
    """The table with ``_runs`` (structs of start, length, period in words) and ``_kept``, the text without repetitions.

    ``words_of(row, words)`` may change the words of a row (a dict of its columns but the text) before the search.
    """
    prepare(documents.sparkSession)
    documents = documents.drop("_runs", "_kept")
    names = documents.columns
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def search(batches):
        for batch in batches:
            others = batch.drop_columns(["text"]).to_pylist() if words_of else None
            found, texts = [], []
            for i, text in enumerate(batch["text"].to_pylist()):
                words = split_words(text)
                if words_of:
                    words = words_of(others[i], words)
                here = runs(numbered(words), least)
                found.append([dict(zip(("start", "length", "period"), r)) for r in here])
                stay = kept(len(words), here)
                texts.append(b" ".join(words if stay.all() else [words[k] for k in np.flatnonzero(stay)]).decode())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind), pa.array(texts, pa.string())], [*names, "_runs", "_kept"])

    empty = F.array().cast("array<struct<start:bigint,length:bigint,period:bigint>>")
    return documents.mapInArrow(search, documents.select("*", empty.alias("_runs"), F.lit("").alias("_kept")).schema)
