"""Words, word hashes and shingles of many texts at once, as numpy arrays.

A word is a longest run of ASCII letters and digits and of bytes beyond ASCII, of the lower-cased text in UTF-8. Its
hash is a polynomial over its bytes, read off running sums, so no word becomes a Python object.
"""

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Bytes worked on at once: bounds the memory of very long texts.
CHUNK = 1 << 19

IN_WORD = np.zeros(256, bool)
IN_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def mixed64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = powers(BASE, 2 * CHUNK), powers(INVERSE, 2 * CHUNK)


def _chunks(raw: np.ndarray, inside: np.ndarray):
    """Start and end of pieces of about CHUNK bytes that end between words (a longer word is a piece of its own)."""
    start = 0
    while start < len(raw):
        end = min(start + CHUNK, len(raw))
        while end < len(raw) and inside[end] and inside[end - 1]:
            gap = np.flatnonzero(~inside[end:end + CHUNK])
            end = end + int(gap[0]) if len(gap) else min(end + CHUNK, len(raw))
        yield start, end
        start = end


class Words:
    """The words of some texts: ``doc`` (number of the text) and ``hash``, in order."""

    def __init__(self, texts: list[str | None]):
        joined = [(t or "").lower().encode() for t in texts]
        raw = np.frombuffer(b"\n".join(joined), np.uint8)
        starts_of_texts = np.cumsum([0, *(len(t) + 1 for t in joined)])[:-1]
        inside = IN_WORD[raw]
        docs, hashes = [], []
        for start, end in _chunks(raw, inside):
            at, until, sums, down = _running(raw[start:end], inside[start:end])
            docs.append(np.searchsorted(starts_of_texts, at + start, side="right") - 1)
            hashes.append(mixed64((sums[until] - sums[at]) * down[at]))
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        self.texts = len(texts)
        self.doc, self.hash = join(docs, np.int64), join(hashes, np.uint64)


def _running(raw: np.ndarray, inside: np.ndarray):
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    up, down = (_UP, _DOWN) if len(raw) < len(_UP) else (powers(BASE, len(raw) + 1), powers(INVERSE, len(raw) + 1))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=sums[1:])
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), sums, down


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """doc and hash of every run of ``n`` words; a text of fewer words has one run, of all its words."""
    doc, count = words.doc, len(words.doc)
    per_doc = np.bincount(doc, minlength=words.texts)
    first = np.concatenate([[0], np.cumsum(per_doc)[:-1]]).astype(np.int64)
    run = np.zeros(max(count - n + 1, 0), np.uint64)
    for i in range(n):
        run = run * BASE + words.hash[i:count - n + 1 + i] if len(run) else run
    whole = doc[:count - n + 1] == doc[n - 1:] if len(run) else np.zeros(0, bool)
    docs, hashes = doc[:len(run)][whole], mixed64(run[whole])
    short = np.flatnonzero((per_doc > 0) & (per_doc < n))
    extra = np.zeros(len(short), np.uint64)
    for k, d in enumerate(short):
        total = np.uint64(0)
        with np.errstate(over="ignore"):
            for h in words.hash[first[d]:first[d] + per_doc[d]]:
                total = total * BASE + h
            extra[k] = total + np.uint64(per_doc[d])
    docs, hashes = np.concatenate([docs, short]), np.concatenate([hashes, mixed64(extra)])
    order = np.argsort(docs, kind="stable")
    return docs[order], hashes[order]
