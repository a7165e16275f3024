"""Lossless pruning of name pairs before they are scored.

The token-sort ratio of two names can only reach a threshold t if their longest common subsequence has at least
t * (la + lb) / 200 characters, and that many characters must be common to both names whatever their order.  Two tests
follow from this, both necessary conditions, so no pair that passes is lost:

prefix index   A name is the set of its characters numbered by occurrence (``a1 a2 b1 ...``), in one order for all names.
               Two sets that share n elements share one among the first ``size - n + 1`` of each.  Names therefore meet on
               (block, element) for those few elements only, rarest first, and a pair is kept where it meets first.
signature      Five bits for each of the 37 characters of a clean name (one for each of its first five occurrences) in
               four 64-bit words, and the number of further characters.  ``bit_count`` of the words' intersections plus the
               smaller remainder bounds the common characters from above, inside generated code.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters of a clean name, rarest in company names first.
CHARACTERS = "qzjxk0987654321vwybfghpmudclsrtnoiae "
OCCURRENCES, PER_WORD = 5, 12
WORDS = -(-len(CHARACTERS) // PER_WORD)
#: Scores are doubles: a pair at the threshold may not be lost to rounding.
SLACK = 1e-6


def elements(name: Column) -> Column:
    """The name's characters numbered by occurrence, in index order: place of the character less 64 for each occurrence so far,
    so that the n-th of a kind stands before the (n-1)-th of any."""
    letters = F.sort_array(F.filter(F.split(name, ""), lambda c: c != ""))
    # bound once as an array of one: a lambda would sort the letters anew for every letter
    numbered = F.transform(F.array(letters), lambda all_: F.sort_array(F.transform(
        all_, lambda c, i: F.instr(F.lit(CHARACTERS), c) - F.lit(64) * (i + F.lit(2) - F.array_position(all_, c)).cast("int"))))
    return F.get(numbered, F.lit(0))


def occurrences(name: str) -> Column:
    """How often each of ``CHARACTERS`` occurs in the column ``name``, at most ``OCCURRENCES``: one native pass over
    the text for each, whatever its length, instead of a sort and a look-up for each of its characters."""
    return F.expr(f"transform(split('{CHARACTERS}', ''), c -> least(char_length({name}) - char_length(replace({name}, c, '')), {OCCURRENCES}))")


def signature(counts: str, length: str) -> Column:
    """struct(w0..w3, rest) of a name by its columns of ``occurrences`` and length: a bit for each, and how many characters have none."""
    words = [F.expr(f"aggregate(slice({counts}, {w * PER_WORD + 1}, {PER_WORD}), 0L, "
                    f"(acc, n) -> shiftleft(acc, {OCCURRENCES}) | (shiftleft(1L, n) - 1L))").alias(f"w{w}") for w in range(WORDS)]
    return F.struct(*words, F.expr(f"{length} - aggregate({counts}, 0, (acc, n) -> acc + n)").alias("rest"))


def _arrow_signature_udf():
    """Built inside a function so the UDF pickles by value (executors need no copy of this package)."""
    import numpy as np

    characters, most, per_word, n_words = CHARACTERS, OCCURRENCES, PER_WORD, WORDS
    number = np.full(129, len(characters), dtype=np.int64)  # of a character by its code; codes from 128 on count as 128
    number[[ord(c) for c in characters]] = np.arange(len(characters))

    def signatures(names: pd.Series) -> pd.DataFrame:
        names = names.fillna("").to_numpy(dtype=object)
        n, kinds = len(names), len(characters) + 1
        lengths = np.fromiter((len(x) for x in names), dtype=np.int64, count=n)
        codes = np.frombuffer("".join(names).encode("utf-32-le"), dtype=np.uint32)
        places = np.repeat(np.arange(n) * kinds, lengths) + number[np.minimum(codes, 128)]
        counts = np.minimum(np.bincount(places, minlength=n * kinds).reshape(n, kinds)[:, :-1], most)
        bits, out = (np.int64(1) << counts) - 1, {}
        for w in range(n_words):
            word = np.zeros(n, dtype=np.int64)
            for column in bits[:, w * per_word:(w + 1) * per_word].T:
                word = (word << most) | column
            out[f"w{w}"] = word
        return pd.DataFrame({**out, "rest": (lengths - counts.sum(axis=1)).astype(np.int32)})

    return F.pandas_udf(signatures, ", ".join([f"w{w} bigint" for w in range(n_words)] + ["rest int"]))


def signature_arrow(name: Column | str) -> Column:
    """The same struct from the column ``name`` itself, counted for all names of an Arrow batch at once."""
    return _arrow_signature_udf()(F.col(name) if isinstance(name, str) else name)


def most_common_characters(a: str, b: str) -> Column:
    """Upper bound of the characters that two names (by their signature columns) have in common."""
    shared = [F.bit_count(F.col(f"{a}.w{w}").bitwiseAND(F.col(f"{b}.w{w}"))) for w in range(WORDS)]
    return reduce(lambda x, y: x + y, shared) + F.least(F.col(f"{a}.rest"), F.col(f"{b}.rest"))


def can_reach(a: str, b: str, len_a: Column, len_b: Column, threshold: float) -> Column:
    return most_common_characters(a, b) >= (len_a + len_b) * F.lit(threshold / 200.0) - F.lit(SLACK)


def index_elements(of: str, size: Column, least_partner: Column, threshold: float) -> Column:
    """The elements under which a name is indexed: enough of its rarest ones to meet every partner of ``least_partner``
    characters or more that can reach the threshold."""
    common = F.ceil((size + least_partner) * F.lit(threshold / 200.0) - F.lit(SLACK)).cast("int")
    return F.slice(of, F.lit(1), F.greatest(F.least(size - common + 1, size), F.lit(1)))
