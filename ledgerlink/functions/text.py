"""Name, address and list normalisation as native Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values, equal to the reference's cleaning rules:
# corporate suffix tokens dropped from company names (at any position).
CORPORATE_SUFFIXES = ("inc", "corp", "corporation", "ltd", "limited", "llc", "co")
# street words shortened by address normalisation.
ADDRESS_ABBREVIATIONS = {"street": "st", "road": "rd", "avenue": "ave", "boulevard": "blvd", "drive": "dr"}

LIST_DELIMITER = "|"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _spaced_words(c: Column | str) -> Column:
    """lower-case; each run of characters outside [a-z0-9] becomes one space."""
    return F.regexp_replace(F.lower(F.coalesce(_col(c), F.lit(""))), r"[^a-z0-9]+", " ")


def _whole_word(words) -> str:
    """Regex matching any of ``words`` as a whole space-delimited token."""
    alternatives = "|".join(re.escape(w) for w in sorted(words, key=len, reverse=True))
    return rf"(^| )({alternatives})(?= |$)"


def _squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, " {2,}", " "))


def clean_name(c: Column | str) -> Column:
    """Company name key: null/blank -> '', suffix tokens removed anywhere, single-space joined.
    Regex-only (code-generated; no per-token lambdas)."""
    dropped = F.regexp_replace(_spaced_words(c), _whole_word(CORPORATE_SUFFIXES), "$1")
    return _squeeze(dropped)


def normalize_address(c: Column | str) -> Column:
    """Address key: same tokenisation as names, street words abbreviated, nothing dropped."""
    out = _spaced_words(c)
    for word, short in ADDRESS_ABBREVIATIONS.items():
        out = F.regexp_replace(out, _whole_word([word]), f"$1{short}")
    return _squeeze(out)


# whitespace as Python's str.strip sees it: ASCII, information separators, NEL, Unicode separators
_WS = r"\s\x1c-\x1f\x85\p{Z}"


def _tidy_list(c: Column | str) -> Column:
    """Pipe list with whitespace around items removed and blank items dropped."""
    s = F.regexp_replace(F.coalesce(_col(c), F.lit("")), rf"[{_WS}]*\|[{_WS}]*", "|")
    s = F.regexp_replace(s, r"\|{2,}", "|")
    return F.regexp_replace(s, rf"^[{_WS}|]+|[{_WS}|]+$", "")


# the same characters one by one, for trim: no regular expression runs over the items
_WS_CHARACTERS = " \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


# the same without the blank, as a class that is only looked at for text beyond ASCII's printable characters
_WS_BUT_BLANK = r"[\t-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def _untidy(text: Column) -> Column:
    """Whether a list may have something to trim or drop: an empty item, a blank next to a delimiter or an end,
    or another kind of white space anywhere.  Plain searches; the classes are one comparison a character for most text."""
    ended = F.concat(F.lit(LIST_DELIMITER), text, F.lit(LIST_DELIMITER))
    return (ended.contains("||") | ended.contains("| ") | ended.contains(" |")
            | (text.rlike("[^ -~]") & text.rlike(_WS_BUT_BLANK)))


def parse_list(c: Column | str) -> Column:
    """Pipe-delimited text -> array<string>: null/'' -> [], items trimmed, blank items dropped.
    Item by item (interpreted lambdas) only where the text has something to trim or drop."""
    text = F.coalesce(_col(c), F.lit(""))
    items = F.split(text, r"\|")
    trimmed = F.filter(F.transform(items, lambda x: F.trim(x, F.lit(_WS_CHARACTERS))), lambda x: x != "")
    return F.when(_untidy(text), trimmed).otherwise(items)


def list_size(c: Column | str) -> Column:
    """Number of non-blank items of a pipe list (0 for null or ''); tidied first only where it isn't tidy."""
    items = lambda text: F.char_length(text) - F.char_length(F.replace(text, F.lit(LIST_DELIMITER), F.lit(""))) + F.lit(1)
    text, tidy = F.coalesce(_col(c), F.lit("")), _tidy_list(c)
    return F.when(~_untidy(text), items(text)).when(tidy == "", F.lit(0)).otherwise(items(tidy))


def block_key(clean: Column | str, chars: int = 6) -> Column:
    """Blocking key of a clean name: its first ``chars`` characters."""
    return F.substring(_col(clean), 1, chars)


def sort_tokens(clean: Column | str) -> Column:
    """Whitespace tokens sorted and re-joined by one space (token-sort form)."""
    return F.array_join(F.sort_array(F.split(_col(clean), " ")), " ")
