"""Periodic run detection: suffix automaton with link-cut access, word by word.

A run is a maximal stretch of words with smallest period q that is at least
``least`` words and ``repeats`` periods long. Over a stretch of words the
suffix automaton is built and its suffix-link tree is kept as a link-cut
forest whose preferred paths are the nodes last reached by one prefix.
Appending word i accesses the node of that prefix: the path to the root
falls into segments, each with the end e of its last occurrence and the
length L of its longest string; that string ends at e and at i, so the words
repeat with period i - e over L + (i - e) words up to i, a square as soon as
L >= i - e. L is the longest such match, so the stretch already starts where
the run starts, and following it as i grows extends it to the run. The
distance to the *last* occurrence is the smallest period. Every access gives
the path its new end; the number of segments is amortised logarithmic.

The automaton is only built where a run can be. Behind a run's first period
every three words have occurred at most q words before, and with at least k
periods (k - 1) q - 2 such places follow each other; stretches without that,
seen in hashed word triples, are left out (a collision of hashes only adds
places), which loses no run.

Defined cases: a NULL, empty or blank text has no words, no run and an empty
collapsed text; repeated rows get equal results; an empty table gives an
empty result; result columns replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

LEAST_WORDS = 6
LEAST_PERIODS = 4
RESULTS = ("runs", "collapsed")
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


class SuffixAutomaton:
    """Automaton of a word sequence; ``prefix[i]`` is the state of the first i + 1 words."""

    def __init__(self, ids: list[int]):
        self.length, self.link, self.prefix = [0], [-1], []
        step: list[dict[int, int]] = [{}]
        length, link = self.length, self.link
        last = 0
        for c in ids:
            cur = len(length)
            length.append(length[last] + 1)
            link.append(0)
            step.append({})
            p = last
            while p >= 0 and c not in step[p]:
                step[p][c] = cur
                p = link[p]
            if p >= 0:
                q = step[p][c]
                if length[q] == length[p] + 1:
                    link[cur] = q
                else:
                    clone = len(length)
                    length.append(length[p] + 1)
                    link.append(link[q])
                    step.append(dict(step[q]))
                    while p >= 0 and step[p].get(c) == q:
                        step[p][c] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            self.prefix.append(cur)
            last = cur


class LastOccurrence:
    """Link-cut forest over a rooted tree: every preferred path carries the mark of its last access.

    A preferred path is one splay tree ordered by depth; its mark sits at the
    splay root, as all nodes of a path have the same one.
    """

    def __init__(self, parent: list[int]):
        n = len(parent) + 1  # node v of the tree is v + 1 here, 0 is "none"
        self.up = [0] + [p + 1 for p in parent]
        self.left, self.right = [0] * n, [0] * n
        self.mark = [-1] * n

    def _splay(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        y = up[x]
        while y and (left[y] == x or right[y] == x):
            z = up[y]
            inner = z and (left[z] == y or right[z] == y)
            # the node that goes up: y first where x, y, z are in line, else x
            if inner and (left[z] == y) == (left[y] == x):
                self._rotate(y)
            elif inner:
                self._rotate(x)
            self._rotate(x)
            y = up[x]

    def _rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        y = up[x]
        z = up[y]
        if left[y] == x:
            b = left[y] = right[x]
            right[x] = y
        else:
            b = right[y] = left[x]
            left[x] = y
        if b:
            up[b] = y
        up[y], up[x] = x, z
        if z and left[z] == y:
            left[z] = x
        elif z and right[z] == y:
            right[z] = x
        else:  # y was the root of its splay tree
            self.mark[x] = self.mark[y]

    def access(self, node: int, mark: int) -> list[tuple[int, int]]:
        """(deepest node, old mark) of each segment from ``node`` to the root; the path gets ``mark``."""
        up, right, marks = self.up, self.right, self.mark
        segments = []
        u, below = node + 1, 0
        while u:
            self._splay(u)
            old = marks[u]
            if old >= 0:
                segments.append((u - 1, old))
            if right[u]:
                marks[right[u]] = old
            right[u] = below
            below = u
            u = up[u]
        marks[below] = mark
        return segments


def _stretch_runs(ids: list[int], least: int, repeats: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of one stretch."""
    sam = SuffixAutomaton(ids)
    last = LastOccurrence(sam.link)
    length = sam.length
    ends: dict[tuple[int, int], int] = {}
    for i, node in enumerate(sam.prefix):
        for u, e in last.access(node, i):
            p, match = i - e, length[u]
            if match >= (repeats - 1) * p and match + p >= least:
                ends[i - match - p + 1, p] = i
    return [(s, e - s + 1, p) for (s, p), e in ends.items()]


def _places(ids: np.ndarray, least: int, repeats: int) -> list[tuple[int, int]]:
    """Stretches [from, to) outside which no run lies; every run is inside one, with a word to spare on both sides."""
    n = len(ids)
    if n < least:
        return []
    # places that follow each other in the shortest run: all but the last period's and a triple's last two words
    floor = min(max(least, repeats * q) - q - 2 for q in range(1, least + 1))
    if floor < 1:  # too short for triples to tell
        return [(0, n)]
    x = ids.astype(np.uint64)
    code = x[:-2] * _MIX[0] + x[1:-1] * _MIX[1] + x[2:] * _MIX[2]
    order = np.argsort(code, kind="stable")
    same = code[order[1:]] == code[order[:-1]]
    if not same.any():
        return []
    back = np.zeros(n - 2, np.int64)
    back[order[1:][same]] = (order[1:] - order[:-1])[same]
    ok = back > 0
    while True:
        edge = np.flatnonzero(np.diff(np.concatenate(([0], ok.view(np.int8), [0]))))
        a, b = edge[::2], edge[1::2]
        cap = (b - a + 2) // (repeats - 1)
        wide = b - a >= floor
        a, b, cap = a[wide], b[wide], cap[wide]
        if not len(a):
            return []
        limit = np.zeros(n - 1, np.int64)
        limit[a] += cap
        limit[b] -= cap
        new = ok & (back <= np.cumsum(limit)[:-1])
        if (new == ok).all():
            return [(max(0, int(i - c - 1)), min(n, int(j + 3))) for i, j, c in zip(a, b, cap)]
        ok = new


def word_runs(words: list, least: int = LEAST_WORDS, repeats: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a word list, by start, then period."""
    if least < 1 or repeats < 2:
        raise ValueError("a run needs at least one word and two periods")
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    found = set()
    for i, j in _places(ids, least, repeats):
        for s, size, p in _stretch_runs(ids[i:j].tolist(), least, repeats):
            # a run cut by the edge of its stretch lies inside another one
            if (s > 0 or i == 0) and (s + size < j - i or j == len(ids)):
                found.add((s + i, size, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """Words outside the repetitions: of every run only the first period stays."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for s, size, p in runs:
        change[s + p] += 1
        change[s + size] -= 1
    gone = np.cumsum(change[:-1]) > 0
    return [w for w, g in zip(words, gone.tolist()) if not g]


def find_runs(docs: DataFrame, text_col: str = "text", least: int = LEAST_WORDS, repeats: int = LEAST_PERIODS) -> DataFrame:
    """Add ``runs`` (array of start, length, period) and ``collapsed`` (kept words joined by one space)."""
    @F.pandas_udf("runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            runs, kept = [], []
            for t in batch:
                # bytes split at ASCII white space only
                words = t.encode("utf-8", "surrogatepass").split() if t else []
                found = word_runs(words, least, repeats)
                runs.append([{"start": s, "length": size, "period": p} for s, size, p in found])
                kept.append(b" ".join(collapse(words, found)).decode("utf-8", "replace"))
            yield pd.DataFrame({"runs": runs, "collapsed": kept})

    rows = docs.select(F.struct("*").alias("r"), of(F.col(f"`{text_col}`")).alias("f"))
    names = [f"r.`{c}`" for c in docs.columns if c.lower() not in RESULTS]
    return rows.select(*names, "f.runs", "f.collapsed")
