"""Periodic runs of words, by a suffix automaton whose link tree is kept in link-cut form.

Words are appended one by one.  Each appended word adds a state to the suffix automaton and opens (accesses) the path
from it to the root of the link tree; the path takes the new end position as its colour.  Every stretch of one old colour p that the access
passes says: the longest string there, of length L, ended at p before and ends at i now.  With distance q = i - p this is the
square-bearing string of period q that ends at i, q + L words long; it is kept if it has four periods, extended as far as the period holds,
and stands as one run.  For a run of smallest period q and four periods or more this stretch is always met at the run's last word: a later
occurrence of the same L >= 3q words would give it a smaller period.

The automaton runs only over stretches that can hold a run.  A run of period q ends in 3q - 2 places or more (3 at least) whose three words
also ended q places before; so the distance to the last equal triple is at most q there.  Stretches of places with such a
distance that are shorter than thrice their least distance less 2 hold no run.  The test drops nothing that holds one.

Words: ``[^\\x20\\x09-\\x0D]+``.  A run: consecutive words with smallest period q (words q apart are equal), at least
max(least, 4q) long, which no neighbouring word extends.  Defined results: null or blank text has no words, no runs and the empty
text's digest; a null id leaves its words as they are; rows are handled one by one, so repeated rows and ids are alike; an empty table
gives no rows; extra columns are kept.  Ties of the greatest run: smallest start, then period.  Very long texts stay in one
row as they came: a task holds the automaton of one stretch (about 300 bytes a word).
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerlink.llm.frames import fresh, modest_batches

#: Periods that a run holds at least, and words.
PERIODS, LEAST = 4, 6

RESULT = T.StructType([
    T.StructField("n_runs", T.LongType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("period", T.LongType()), T.StructField("exponent_milli", T.LongType()),
    T.StructField("runs_sha256", T.StringType()), T.StructField("collapsed_sha256", T.StringType())])


class LinkCutAutomaton:
    """A suffix automaton over integer letters; its link tree is cut into paths of one colour (the last end position), each path a splay
    tree by depth.  ``append`` returns (distance, length) of each stretch of an old colour."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [0], [0]
        # State s is node s + 1; node 0 stands for none.  up: parent in the splay tree, or of a path's top the node it hangs from.
        self.left, self.right, self.up, self.colour = [0, 0], [0, 0], [0, 0], [-1, -1]
        self.last, self.at = 0, -1

    def _node(self, length: int, link: int, follow: dict[int, int]) -> int:
        self.next.append(follow)
        self.length.append(length)
        self.link.append(link)
        for x in (self.left, self.right, self.up):
            x.append(0)
        self.colour.append(-1)
        return len(self.length) - 1

    def _is_top(self, x: int) -> bool:
        p = self.up[x]
        return not p or self.left[p] != x and self.right[p] != x

    def _rotate(self, x: int) -> None:
        left, right, up = self.left, self.right, self.up
        p = up[x]
        g = up[p]
        if g:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x
        if left[p] == x:
            c = left[p] = right[x]
            right[x] = p
        else:
            c = right[p] = left[x]
            left[x] = p
        if c:
            up[c] = p
        up[p], up[x] = x, g

    def _splay(self, x: int) -> int:
        """Bring ``x`` to the top of its splay tree; the path's colour, which stands at the top."""
        top = x
        while not self._is_top(top):
            top = self.up[top]
        colour = self.colour[top]
        while not self._is_top(x):
            p = self.up[x]
            if not self._is_top(p):
                g = self.up[p]
                self._rotate(p if (self.left[g] == p) == (self.left[p] == x) else x)
            self._rotate(x)
        self.colour[x] = colour
        return colour

    def append(self, letter: int) -> list[tuple[int, int]]:
        follow, link, length = self.next, self.link, self.length
        self.at += 1
        new = self._node(length[self.last] + 1, 0, {})
        p = self.last
        while letter not in follow[p]:
            follow[p][letter] = new
            if not p:
                p = -1
                break
            p = link[p]
        if p >= 0:
            q = follow[p][letter]
            if length[q] != length[p] + 1:
                clone = self._node(length[p] + 1, link[q], dict(follow[q]))
                # the clone stands just above q on q's path
                self._splay(q + 1)
                above = self.left[q + 1]
                self.left[clone + 1], self.left[q + 1], self.up[clone + 1] = above, clone + 1, q + 1
                if above:
                    self.up[above] = clone + 1
                link[q] = clone
                while follow[p].get(letter) == q:
                    follow[p][letter] = clone
                    if not p:
                        break
                    p = link[p]
                q = clone
            link[new] = q
        self.up[new + 1] = link[new] + 1
        self.last = new
        return self._access(new + 1)

    def _access(self, x: int) -> list[tuple[int, int]]:
        met, below = [], 0
        while x:
            colour = self._splay(x)
            if colour >= 0 and x > 1:
                met.append((self.at - colour, self.length[x - 1]))
            deeper = self.right[x]
            if deeper:
                self.colour[deeper] = colour
            self.right[x] = below
            below, x = x, self.up[x]
        self.colour[below] = self.at
        return met


def stretches(words: np.ndarray) -> list[tuple[int, int]]:
    """[start, stop) of the places that can hold a run."""
    n = len(words)
    if n < LEAST:
        return []
    w = words.astype(np.int64)
    size = int(w.max()) + 1
    pairs = np.unique(w[:-1] * size + w[1:], return_inverse=True)[1]
    triples = pairs[:-1] * size + w[2:]
    order = np.argsort(triples, kind="stable")
    same = np.flatnonzero(triples[order][1:] == triples[order][:-1])
    gap = np.zeros(n, np.int64)  # by the place of a triple's last word; 0: none before
    gap[order[same + 1] + 2] = order[same + 1] - order[same]
    ok = np.concatenate(([False], (gap > 0) & (gap <= n // PERIODS), [False]))
    edge = np.flatnonzero(ok[1:] != ok[:-1])
    found: list[tuple[int, int]] = []
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        if b - a >= max(3, (PERIODS - 1) * int(gap[a:b].min()) - 2):
            first = max(0, a - 2 - (b - a + 2) // (PERIODS - 1))
            while found and first <= found[-1][1]:
                first = min(first, found.pop()[0])
            found.append((first, b))
    return found


def find_runs(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and period."""
    letters, n, found = words.tolist(), len(words), set()
    for first, stop in stretches(words):
        automaton = LinkCutAutomaton()
        for i in range(first, stop):
            for q, length in automaton.append(letters[i]):
                if length >= (PERIODS - 1) * q and q + length >= LEAST and (i + 1 == n or letters[i + 1] != letters[i + 1 - q]):
                    start = i - q - length + 1
                    while start and letters[start - 1] == letters[start - 1 + q]:
                        start -= 1
                    found.add((start, i + 1 - start, q))
    return sorted(found)


def planted_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a text whose tail repeats: one id in ten, by the checksum of the id (fixed rule of the query)."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    tail = words[a:a + p]
    return words[:a] + (tail * -(-(n - a) // p))[:n - a]


def describe(words: list[bytes]) -> tuple:
    """The values of RESULT for one text."""
    seen: dict[bytes, int] = {}
    runs = find_runs(np.array([seen.setdefault(w, len(seen)) for w in words], np.int64))
    top: tuple[int | None, ...] = (None, None, None, None)
    if runs:
        start, length, period = runs[0]
        for s, n, q in runs[1:]:
            if n * period > length * q:
                start, length, period = s, n, q
        top = (start, length, period, 1000 * length // period)
        drop = np.zeros(len(words) + 1, np.int64)
        for s, n, q in runs:
            drop[s + q] += 1
            drop[s + n] -= 1
        kept = np.flatnonzero(np.cumsum(drop[:-1]) == 0)
        words = [words[i] for i in kept.tolist()]
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (len(runs), *top, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest())


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True, result_col: str = "runs",
                  rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """``docs`` with a struct RESULT (under another name if ``result_col`` is taken).  ``rewrite``: (id, words) -> words, before runs are sought."""
    modest_batches(docs.sparkSession)
    kept = [c for c in docs.columns if keep_text or c != text_col]
    name = fresh(docs.select(*kept), result_col)
    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField(name, RESULT)])
    types = pa.struct([(f.name, pa.string() if isinstance(f.dataType, T.StringType) else pa.int64()) for f in RESULT])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, text in zip(b.column(id_col), b.column(text_col), strict=True):
                words = (text.as_py() or "").encode().split()  # bytes split at blank and \x09-\x0D alone
                if rewrite is not None:
                    words = rewrite(i.as_py(), words)
                rows.append(dict(zip(RESULT.names, describe(words), strict=True)))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], pa.array(rows, type=types)], names=[*kept, name])

    return docs.mapInArrow(run, schema)
