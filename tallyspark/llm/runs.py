"""Periodic runs of words, found with suffix trees, and their removal.

A run is a longest stretch of consecutive words with smallest period q (words
q apart are equal).  For the words of a text:

1. Stretches that may hold a run are cut out.  A run of at least ``least_words``
   words and ``repeats`` periods holds each of its 3-word windows at least
   ``repeats - 1`` times, so windows that are rarer inside their stretch end it;
   no run is cut, and what is left is a small part of most texts.
2. Ukkonen's algorithm builds the suffix trees of the stretches, joined by
   unique letters, and of their reversal.  The Euler tour of a tree, kept as the
   least depth between one leaf and the next, with a table of minima over powers
   of two answers a lowest common ancestor in constant time, which is the longest
   common extension of two places (to the left in the reversal's tree).
3. The root of every run is, in one of the two letter orders, the longest
   Lyndon word at one of its places.  That word ends at the next smaller
   (greater) suffix, by the order of the leaves.  Each place gives two candidates;
   both are extended to both sides, and those of at least two periods are runs.

A text is the work of one task; memory is some hundred bytes a word of its
stretches and a few bytes a word of the rest.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WHITE

LEAST_WORDS = 6
REPEATS = 4
_GAP = re.compile(rb"[\x20\x09-\x0D]")
_PIECE = 1 << 20
#: rounds of step 1; more would only cut finer
_ROUNDS = 8


class SuffixTree:
    """The suffix tree of ``letters``, whose last letter occurs once."""

    def __init__(self, letters: list[int]) -> None:
        self._build(letters)
        self._tour()

    def _build(self, s: list[int]) -> None:
        n = len(s)
        sigma = max(s) + 1
        first, last, link, leaf = [0], [0], [0], [-1]
        go: dict[int, int] = {}
        node = edge = length = waiting = 0
        for i, c in enumerate(s):
            waiting += 1
            unlinked = 0
            while waiting:
                if not length:
                    edge = i
                key = node * sigma + s[edge]
                child = go.get(key)
                if child is None:
                    go[key] = len(first)
                    first.append(i)
                    last.append(n)
                    link.append(0)
                    leaf.append(i - waiting + 1)
                    if unlinked:
                        link[unlinked] = node
                        unlinked = 0
                else:
                    begin = first[child]
                    span = (last[child] if last[child] <= i else i + 1) - begin
                    if length >= span:
                        edge += span
                        length -= span
                        node = child
                        continue
                    if s[begin + length] == c:
                        length += 1
                        if unlinked:
                            link[unlinked] = node
                        break
                    split = len(first)
                    go[key] = split
                    go[split * sigma + c] = split + 1
                    go[split * sigma + s[begin + length]] = child
                    first += (begin, i)
                    last += (begin + length, n)
                    link += (0, 0)
                    leaf += (-1, i - waiting + 1)
                    first[child] = begin + length
                    if unlinked:
                        link[unlinked] = split
                    unlinked = split
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - waiting + 1
        self.n, self.sigma = n, sigma
        self._first, self._last, self._leaf, self._go = first, last, leaf, go

    def _tour(self) -> None:
        """Leaves in rising order, and between neighbours the tour's least depth."""
        n, leaf = self.n, self._leaf
        keys = np.fromiter(self._go.keys(), np.int64, len(self._go))
        children = np.fromiter(self._go.values(), np.int64, len(self._go))
        order = np.argsort(keys)
        parents = keys[order] // self.sigma
        children = children[order]
        begin = np.searchsorted(parents, np.arange(len(leaf) + 1)).tolist()
        child = children.tolist()
        span = (np.array(self._last) - np.array(self._first)).tolist()
        depth = [0] * len(leaf)
        order_of_leaves, least = [], []
        stack, turned = [0], [0]
        low = 0
        while stack:
            v = stack.pop()
            at = turned.pop()
            if at >= 0:
                low = at
            if leaf[v] >= 0:
                order_of_leaves.append(leaf[v])
                least.append(low)
                continue
            d = depth[v]
            a, b = begin[v], begin[v + 1]
            for k in range(b - 1, a - 1, -1):
                w = child[k]
                depth[w] = d + span[w]
                stack.append(w)
                turned.append(d if k > a else -1)
        self.leaves = np.array(order_of_leaves, np.int64)
        self.rank = np.empty(n, np.int64)
        self.rank[self.leaves] = np.arange(n)
        # level j holds the minima of 2**j neighbours
        self.minima = [np.array(least, np.int32)]
        step = 1
        while 2 * step <= n:
            below = self.minima[-1]
            self.minima.append(np.minimum(below[:-step], below[step:]))
            step *= 2
        del self._first, self._last, self._leaf, self._go

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How far the suffixes at the different places ``a`` and ``b`` agree."""
        x, y = self.rank[a], self.rank[b]
        x, y = np.minimum(x, y) + 1, np.maximum(x, y)
        level = np.frexp((y - x + 1).astype(np.float64))[1] - 1
        out = np.empty(len(x), np.int64)
        for j in np.unique(level):
            at = np.flatnonzero(level == j)
            minima = self.minima[j]
            out[at] = np.minimum(minima[x[at]], minima[y[at] - (1 << int(j)) + 1])
        return out


def _next_beyond(rank: list[int]) -> tuple[list[int], list[int]]:
    """For each place the next one of smaller and of greater rank, or the end."""
    n = len(rank)
    smaller, greater = [n] * n, [n] * n
    falling: list[int] = []
    rising: list[int] = []
    for i, r in enumerate(rank):
        while falling and rank[falling[-1]] > r:
            smaller[falling.pop()] = i
        while rising and rank[rising[-1]] < r:
            greater[rising.pop()] = i
        falling.append(i)
        rising.append(i)
    return smaller, greater


def stretches(ids: np.ndarray, least_words: int = LEAST_WORDS, repeats: int = REPEATS) -> list[tuple[int, int]]:
    """Separate parts [a, b) of ``ids`` that hold every run of the sizes given."""
    n = len(ids)
    if n < least_words:
        return []
    k = int(ids.max()) + 1
    if k < 1 << 20:
        wide = ids.astype(np.int64)
        grams = (wide[:-2] * k + wide[1:-1]) * k + wide[2:]
    else:
        _, pairs = np.unique(ids[:-1].astype(np.int64) * k + ids[1:], return_inverse=True)
        _, grams = np.unique(pairs[:-1].astype(np.int64) * k + ids[2:], return_inverse=True)
    often = repeats - 1
    rising = np.sort(grams)
    if len(rising) < often or not (rising[often - 1:] == rising[: len(rising) - often + 1]).any():
        return []
    place, part = np.arange(len(grams)), np.zeros(len(grams), np.int64)
    for _ in range(_ROUNDS):
        order = np.lexsort((grams[place], part))
        g, p = grams[place][order], part[order]
        edge = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (p[1:] != p[:-1]), [True]]))
        count = np.diff(edge)
        keep = np.empty(len(place), bool)
        keep[order] = np.repeat(count >= often, count)
        kept = place[keep]
        if not len(kept):
            return []
        # longest stretches of neighbouring windows, without those too short
        start = np.concatenate([[True], np.diff(kept) > 1])
        part = np.cumsum(start) - 1
        wide_enough = np.bincount(part) >= least_words - 2
        held = wide_enough[part]
        done = keep.all() and held.all()
        place, part = kept[held], part[held]
        if done or not len(place):
            break
    if not len(place):
        return []
    cut = np.flatnonzero(np.diff(place) > 1)
    begins = place[np.concatenate([[0], cut + 1])]
    ends = place[np.concatenate([cut, [len(place) - 1]])] + 3
    # windows of neighbouring stretches may overlap by up to two words; each
    # stretch stands for itself
    return list(zip(begins.tolist(), ends.tolist()))


def find_runs(ids: np.ndarray, least_words: int = LEAST_WORDS, repeats: int = REPEATS) -> list[tuple[int, int, int]]:
    """The runs ``(start, length, period)`` of at least ``least_words`` words and
    ``repeats`` (3 or more) periods, by start, then period."""
    if least_words < 6 or repeats < 3:
        raise ValueError("runs have at least 6 words and 3 periods")
    parts = stretches(ids, least_words, repeats)
    if not parts:
        return []
    kinds, letters = np.unique(np.concatenate([ids[a:b] for a, b in parts]), return_inverse=True)
    size = sum(b - a + 1 for a, b in parts)
    text = np.empty(size, np.int64)
    origin = np.empty(size, np.int64)
    at = done = 0
    for i, (a, b) in enumerate(parts):
        text[at: at + b - a] = letters[done: done + b - a]
        text[at + b - a] = len(kinds) + i  # a letter of its own
        origin[at: at + b - a + 1] = np.arange(a, b + 1)
        at, done = at + b - a + 1, done + b - a
    n = size
    forward = SuffixTree(text.tolist())
    # reversed, with one more unique letter at its end
    backward = SuffixTree([*text[::-1].tolist(), len(kinds) + len(parts)])
    i = np.tile(np.arange(n), 2)
    p = np.concatenate([np.array(x) for x in _next_beyond(forward.rank.tolist())]) - i
    use = (i + p < n) & (repeats * p <= n)
    i, p = i[use], p[use]
    right = forward.extension(i, i + p)
    # left: the words before i and before i + p
    left = np.zeros(len(i), np.int64)
    inner = np.flatnonzero(i > 0)
    left[inner] = backward.extension(n - i[inner], n - i[inner] - p[inner])
    length = left + p + right
    found = (length >= least_words) & (length >= repeats * p)
    runs = np.unique(np.stack([origin[(i - left)[found]], p[found], length[found]], axis=1), axis=0)
    return [(start, size, period) for start, period, size in runs.tolist()]


def _words(text: bytes) -> tuple[np.ndarray, list[bytes]]:
    """(number of each word, the different words)"""
    known: dict[bytes, int] = {}
    out, at = [], 0
    while at < len(text):
        gap = _GAP.search(text, at + _PIECE) if at + _PIECE < len(text) else None
        end = gap.start() if gap else len(text)
        out.append(np.array([known.setdefault(w, len(known)) for w in text[at:end].split()], np.int32))
        at = end
    return (np.concatenate(out) if out else np.empty(0, np.int32)), list(known)


def collapse(text: bytes, least_words: int = LEAST_WORDS,
             repeats: int = REPEATS) -> tuple[list[tuple[int, int, int]], bytes]:
    """(runs, the text's words joined by one space without those that any run
    holds after its first period)"""
    ids, words = _words(text)
    runs = find_runs(ids, least_words, repeats)
    if runs:
        edges = np.zeros(len(ids) + 1, np.int64)
        for start, length, period in runs:
            edges[start + period] += 1
            edges[start + length] -= 1
        ids = ids[np.cumsum(edges[:-1]) == 0]
    return runs, b" ".join(map(words.__getitem__, ids.tolist()))


def collapse_runs(docs: DataFrame, least_words: int = LEAST_WORDS, repeats: int = REPEATS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``runs`` (array of ``start,
    length, period`` by start, then period; words are numbered from 0),
    ``strongest`` (the run of most periods; ties: smallest start, then period;
    null without runs) and ``text`` (kept words joined by one space).

    Words are ``[^\\x20\\x09-\\x0D]+``.  A null or empty text has no words and
    gives no runs and an empty text; a null ``doc_id`` stays null; repeated rows
    are judged each; other columns are not read; no rows give none.
    """
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def as_struct(run: tuple[int, int, int]) -> dict[str, int]:
        return dict(zip(("start", "length", "period"), run))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.binary())
            held, size, begin = [], 0, 0
            for k in range(batch.num_rows):
                text = texts[k].as_py()
                runs, kept = collapse(text, least_words, repeats) if text else ([], b"")
                # quotients of whole numbers below 2**26 are equal only where they are
                best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
                held.append(([as_struct(r) for r in runs], best and as_struct(best), kept))
                size += len(kept)
                if size >= _PIECE or k + 1 == batch.num_rows:
                    runs, best, kept = zip(*held)
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(begin, len(held)), pa.array(runs, pa.list_(run_type)), pa.array(best, run_type),
                         pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "runs", "strongest", "text"])
                    held, size, begin = [], 0, k + 1

    kind = "struct<start: bigint, length: bigint, period: bigint>"
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        run, f"doc_id bigint, runs array<{kind}>, strongest {kind}, text string")
