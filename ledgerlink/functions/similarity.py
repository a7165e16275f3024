"""Token-sort ratio as a native expression.

ratio(a, b) = (1 - (|a| + |b| - 2*LCS(a, b)) / (|a| + |b|)) * 100 on the token-sorted
strings, i.e. the normalised insertion/deletion similarity; either side empty -> 0.
The double arithmetic is written in that order on purpose so the value equals the usual
library result bit for bit, which matters for the inclusive threshold.

LCS uses the bit-parallel recurrence (Allison-Dix, Hyyro): the state of the shorter
string ``a`` lives in machine words and each character of the longer string ``b`` costs
one add/or/and step per word.  Strings of up to 62 characters use one 64-bit word; longer
ones use 62-bit words with the addition carry passed from word to word, so there is no
length limit and no Python on the path.  Two engines compute the LCS:

* ``jvm``: Spark SQL higher-order expressions.  No Python, but Spark evaluates
  lambdas interpreted, about 47 us per 20-character pair.
* ``arrow`` (default): an Arrow-batched pandas UDF that runs the same recurrence vectorised
  over every pair of a batch with numpy (one array operation per character position, not
  per pair); about 5x faster measured (113k vs 21k pairs/s/core on 566k name pairs).
  Pairs whose shorter string exceeds 62 characters are done with Python integers inside
  the same batch.

Both give identical LCS lengths; the ratio is always computed by the JVM expression.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD_BITS = 62                       # payload bits per word; 2 * (2^62 - 1) + 1 < 2^63
LOW_BITS = (1 << WORD_BITS) - 1


def _char_masks(a: str, b: str) -> str:
    """For each character of ``b``: the bit set of positions i where a[i] equals it.
    Built in one array pass per pair (O(|a|*|b|)), so nothing inside the recurrence's
    lambda needs re-evaluating per step."""
    return (f"transform(split({b}, ''), c -> aggregate(transform(split({a}, ''), "
            f"(x, i) -> if(x = c, shiftleft(1L, i), 0L)), 0L, (p, q) -> p | q))")


def lcs_single_word_sql(a: str, b: str, la: str) -> str:
    """LCS when ``a`` (length ``la``) has at most 62 characters."""
    full = f"(shiftleft(1L, {la}) - 1L)"
    state = (f"aggregate({_char_masks(a, b)}, {full}, "
             f"(v, m) -> ((v + (v & m)) | (v - (v & m))) & {full})")
    return f"({la} - bit_count({state}))"


def lcs_multi_word_sql(a: str, b: str, la: str) -> str:
    """LCS for any length of ``a``: one 62-bit word per 62 characters, carry rippling up."""
    words = f"sequence(0, (({la} + {WORD_BITS - 1}) div {WORD_BITS}) - 1)"
    width = f"least({WORD_BITS}, {la} - w * {WORD_BITS})"
    full_w = f"(shiftleft(1L, {width}) - 1L)"
    masks = (f"transform(split({b}, ''), c -> transform({words}, w -> aggregate(transform(split({a}, ''), "
             f"(x, i) -> if(x = c AND i >= w * {WORD_BITS} AND i < (w + 1) * {WORD_BITS}, "
             f"shiftleft(1L, i - w * {WORD_BITS}), 0L)), 0L, (p, q) -> p | q)))")
    start = f"transform({words}, w -> {full_w})"
    add = "(v[w] + (v[w] & m[w]) + st.c)"
    step = (f"(v, m) -> aggregate({words}, named_struct('c', 0L, 'o', cast(array() AS array<bigint>)), "
            f"(st, w) -> named_struct('c', shiftright({add}, {WORD_BITS}), "
            f"'o', array_append(st.o, (({add} & {LOW_BITS}L) | (v[w] - (v[w] & m[w]))) & {full_w})), "
            f"st -> st.o)")
    state = f"aggregate({masks}, {start}, {step})"
    return f"({la} - aggregate({state}, 0, (acc, x) -> acc + bit_count(x)))"


def lcs_sql(a: str, b: str, la: str) -> str:
    """LCS of ``a`` (the shorter, length ``la``) and ``b``; picks the word layout per row."""
    return (f"CASE WHEN {la} <= {WORD_BITS} THEN {lcs_single_word_sql(a, b, la)} "
            f"ELSE {lcs_multi_word_sql(a, b, la)} END")


def token_sort_ratio_from_lcs(lcs: Column | str, a_len: Column | str, b_len: Column | str) -> Column:
    lcs, a_len, b_len = (F.col(c) if isinstance(c, str) else c for c in (lcs, a_len, b_len))
    total = (a_len + b_len).cast("double")
    dist = (a_len + b_len - F.lit(2) * lcs).cast("double")
    return F.when((a_len == 0) | (b_len == 0), F.lit(0.0)).otherwise(
        (F.lit(1.0) - dist / total) * F.lit(100.0))


def lcs_length(a: str, b: str) -> Column:
    """LCS length of two string columns (by name), shorter one chosen per row."""
    la, lb = f"char_length({a})", f"char_length({b})"
    return F.expr(f"CASE WHEN {la} <= {lb} THEN {lcs_sql(a, b, la)} ELSE {lcs_sql(b, a, lb)} END")


def token_sort_ratio(a_sorted: str, b_sorted: str) -> Column:
    """Ratio of two already token-sorted string columns (by name)."""
    return token_sort_ratio_from_lcs(lcs_length(a_sorted, b_sorted),
                                     F.char_length(a_sorted), F.char_length(b_sorted))


def _arrow_lcs_udf():
    """Built inside a function so the UDF pickles by value (executors need no copy of
    this package)."""
    import numpy as np

    pop8 = np.array([bin(i).count("1") for i in range(256)], dtype=np.int64)

    def codes(strings, lengths):
        out = np.zeros((len(strings), int(lengths.max())), dtype=np.uint32)
        out[np.arange(out.shape[1]) < lengths[:, None]] = np.frombuffer("".join(strings).encode("utf-32-le"), dtype=np.uint32)
        return out

    def lcs_words(x, y):
        masks = {}
        for i, ch in enumerate(x):
            masks[ch] = masks.get(ch, 0) | (1 << i)
        full = (1 << len(x)) - 1
        v = full
        for ch in y:
            u = v & masks.get(ch, 0)
            v = ((v + u) | (v - u)) & full
        return len(x) - bin(v).count("1")

    def lcs_batch(a: pd.Series, b: pd.Series) -> pd.Series:
        a = a.fillna("").to_numpy(dtype=object)
        b = b.fillna("").to_numpy(dtype=object)
        n = len(a)
        out = np.zeros(n, dtype=np.int64)
        la = np.fromiter((len(x) for x in a), dtype=np.int64, count=n)
        lb = np.fromiter((len(x) for x in b), dtype=np.int64, count=n)
        swap = la > lb
        short, long_ = np.where(swap, b, a), np.where(swap, a, b)
        ls, ll = np.minimum(la, lb), np.maximum(la, lb)
        one_word = np.nonzero((ls <= 62) & (ls > 0))[0]
        if len(one_word):
            one_word = one_word[np.argsort(-ll[one_word], kind="stable")]  # longest first: rows that still have characters stand in front
            k = len(one_word)
            sl, ln = ls[one_word], ll[one_word]
            cs, cl = codes(short[one_word], sl), codes(long_[one_word], ln)
            seen = np.zeros(int(max(cs.max(), cl.max())) + 1, dtype=bool)  # numbers the characters without sorting them
            seen[0] = seen[cs] = seen[cl] = True
            number = np.cumsum(seen) - 1
            base = np.arange(k) * (int(number[-1]) + 1)
            cs_i, cl_i = base + number[cs.T], base + number[cl.T]
            masks = np.zeros(k * (int(number[-1]) + 1), dtype=np.uint64)
            for i in range(len(cs_i)):            # one pass per character position of the shorter string
                live = cs_i[i][sl > i]
                masks[live] |= np.uint64(1) << np.uint64(i)
            full = (np.uint64(1) << sl.astype(np.uint64)) - np.uint64(1)
            v = full.copy()
            left = np.searchsorted(-ln, -np.arange(len(cl_i)))  # how many have a character at a position
            for j, n_j in enumerate(left):        # one step per character position of the longer string
                w = v[:n_j]
                u = w & masks[cl_i[j, :n_j]]
                v[:n_j] = ((w + u) | (w - u)) & full[:n_j]
            ones = pop8[v.view(np.uint8)].reshape(k, 8).sum(axis=1)
            out[one_word] = sl - ones
        for r in np.nonzero(ls > 62)[0]:
            out[r] = lcs_words(short[r], long_[r])
        return pd.Series(out, dtype="int64")

    return F.pandas_udf(lcs_batch, T.LongType())


def lcs_length_arrow(a: Column | str, b: Column | str) -> Column:
    """LCS length of two string columns, vectorised per Arrow batch (see module notes)."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    return _arrow_lcs_udf()(a, b)
