"""Toxicity: a lexicon trie met by Levenshtein automata, and context windows that tell quotation from abuse.

1. *Lexicon.*  Over a bounded sample of labelled texts, words and word stems (beginnings of words, written ``stem*``) are counted by label.  Those
   that toxic texts hold more often, beyond chance (``LEAST_G``), make the lexicon, all of them: strong ones ``STRONG`` times as often, weak
   ones ``WEAK`` times.  It goes to every task, so more than ``MOST_TERMS`` are an error.
2. *Tries.*  A word meets a term if the Levenshtein automaton of the word, run down a trie of the terms, accepts it: within 1 edit for terms
   of ``ONE_EDIT`` letters, 2 for ``TWO_EDITS``, 0 for shorter ones and stems.  Words are cut at white space; of one that holds other signs each run of
   letters and digits is looked up, as the lexicon was learnt, and the whole with digits and signs that stand for letters read as such.
   Each distinct word is looked up once a task.
3. *Context.*  Around each hit, ``NEAR`` words on either side tell whether it stands in quotation marks or after a reporting word, and
   whether someone is addressed.  Hits count apart as quoted or not, strong, weak or misspelled (strong words only).
4. *Score.*  A logistic model of these counts, fitted to the sampled texts, scores every whole text in one pass.

Neither labels nor language, source or id enter a score.  Defined results.  Null or empty text has no hits and the score of a text without hits, which is below
0.5 unless most labelled texts without hits are toxic.  Without labels of both kinds the lexicon is empty and every score is the share of toxic labels (0 without labels; 0.5 at most).  Several labels for one
id count as toxic if one is; null labels are left out.  Labelled rows equal in id and text are learnt from once.  Ties: of equal hashes the lesser id is taken.  Rows with equal texts get
equal scores; null or repeated ids are scored like any other row.  Very long texts are scored whole, one at a time.  Empty table: no rows.
Extra columns are ignored.
"""

from __future__ import annotations

import bisect
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlink.llm.frames import stage, text_hash

#: Labelled texts that the lexicon and the model are learnt from, at most (those of the least id hashes).
LABELLED = 20_000
#: More terms than any lexicon of so many texts should hold; beyond it learning stops with an error.
MOST_TERMS = 200_000
LEAST_TEXTS, LEAST_G, STRONG, WEAK = 4, 30.0, 20.0, 4.0
STEMS = (4, 5, 6, 7)
#: A stem is taken if it is in so many times the toxic texts of any kept term that it covers or that covers it.
STEM_GAIN = 1.2
ONE_EDIT, TWO_EDITS = 5, 9
NEAR = 8
#: Distinct words that a task remembers.
REMEMBERED = 400_000
ROWS = 256

# Fixed lists: signs read as letters; opening and closing quotation marks; reporting words; words of address.
LETTER_SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
QUOTES = "\"“”„«»‹›‘’"
REPORTING = frozenset("said says wrote writes called calls quote quoted word words term insult phrase sagte schrieb nannte wort begriff dit écrit appelé mot dijo escribió llamó palabra".split())
ADDRESS = frozenset("you your you're u ur yourself du dich dir dein deine ihr euch tu te toi ton ta vous votre tú ti usted vosotros vuestro".split())

#: Logarithms of one plus a count.
FEATURES = ("strong", "weak", "misspelled", "quoted_strong", "quoted_weak", "quoted_misspelled", "addressed", "density")


def fold(word: str) -> str:
    """A lower-case word as the automata read it: without signs at its ends, with signs that stand for letters read so."""
    if word.isalpha() and word.isascii():
        return word
    a, b = 0, len(word)
    while a < b and not (word[a].isalnum() or word[a] in "@$"):
        a += 1
    while a < b and not (word[b - 1].isalnum() or word[b - 1] in "@$"):
        b -= 1
    core = word[a:b]
    if not core.isalpha() and any(c in LETTER_SIGNS for c in core) and any(c.isalpha() for c in core):
        core = "".join(LETTER_SIGNS.get(c, c) for c in core)
    return core if core.isascii() else unicodedata.normalize("NFC", core)


#: What the lexicon is learnt from: runs of letters and digits, of three or more.
RUNS = re.compile(r"[^\W_]{3,}")


def edits(term: str) -> int:
    return 0 if term.endswith("*") or len(term) < ONE_EDIT else 1 if len(term) < TWO_EDITS else 2


class Trie:
    """Terms by their beginnings.  ``ends``: the edits that a term ending at a node allows (-1: none ends there); ``allow``: the most below a node."""

    def __init__(self, terms: dict[str, int]):
        self.next: list[dict[str, int]] = [{}]
        self.ends, self.allow = [-1], [-1]
        for t, k in sorted(terms.items()):
            at = 0
            self.allow[0] = max(self.allow[0], k)
            for c in t:
                if c not in self.next[at]:
                    self.next[at][c] = len(self.next)
                    self.next.append({})
                    self.ends.append(-1)
                    self.allow.append(-1)
                at = self.next[at][c]
                self.allow[at] = max(self.allow[at], k)
            self.ends[at] = k

    def node(self, beginning: str) -> int:
        at = 0
        for c in beginning:
            at = self.next[at][c]
        return at

    def meets(self, word: str, at: int = 0) -> bool:
        """Whether the Levenshtein automaton of ``word``, run down from a node, accepts a term within the edits it allows.

        The automaton's state is the edits spent at each place of the word; a branch ends when all exceed what any term below allows."""
        todo = [(at, list(range(len(word) + 1)))]
        while todo:
            node, row = todo.pop()
            if row[-1] <= self.ends[node]:
                return True
            for c, child in self.next[node].items():
                own = [row[0] + 1]
                least = own[0]
                for i, w in enumerate(word):
                    x = row[i] if w == c else min(row[i], row[i + 1], own[i]) + 1
                    own.append(x)
                    if x < least:
                        least = x
                if least <= self.allow[child]:
                    todo.append((child, own))
        return False


class Lexicon:
    """Strong and weak terms and stems, and the tries of the strong terms that allow edits.

    Of a term cut into k + 1 parts, k edits leave one as it is: the first at the word's start, the last at its end, or the middle one (of
    three) at most one place off.  So automata run only below the beginning that a word shares with terms, below the ending (in the
    trie of reversed terms), or in the trie of the terms with its middle part."""

    def __init__(self, strong: list[str], weak: list[str]):
        whole = {t: edits(t) for t in strong if not t.endswith("*")}
        self.known = {t: 2 for t in weak if not t.endswith("*")} | dict.fromkeys(whole, 1)
        self.stems = {t[:-1]: 2 for t in weak if t.endswith("*")} | {t[:-1]: 1 for t in strong if t.endswith("*")}
        self.begins = {s[:STEMS[0]] for s in self.stems}
        loose = {t: k for t, k in whole.items() if k}
        cut = {t: [len(t) * i // (k + 1) for i in range(k + 2)] for t, k in loose.items()}
        self.forward, self.backward = Trie(loose), Trie({t[::-1]: k for t, k in loose.items()})
        self.heads = {t[:c[1]]: self.forward.node(t[:c[1]]) for t, c in cut.items()}
        self.tails = {t[c[-2]:][::-1]: self.backward.node(t[c[-2]:][::-1]) for t, c in cut.items()}
        middles: dict[tuple[int, str], dict[str, int]] = {}
        for t, c in cut.items():
            for off in (-1, 0, 1) if loose[t] == 2 else ():
                middles.setdefault((c[1] + off, t[c[1]:c[2]]), {})[t] = 2
        self.middles = {part: Trie(terms) for part, terms in middles.items()}
        self.head_sizes, self.tail_sizes = (sorted({len(p) for p in x}) for x in (self.heads, self.tails))
        self.middle_places = sorted({(at, len(p)) for at, p in self.middles})
        self.shortest, self.longest = min((len(t) - k for t, k in loose.items()), default=1), max((len(t) + k for t, k in loose.items()), default=0)

    def hit(self, word: str) -> int:
        """0: no term; 1: a strong term, or a word that begins with a strong stem; 2: likewise weak; 3: a strong term misspelled."""
        kind = self.known.get(word, 0)
        if kind != 1 and word[:STEMS[0]] in self.begins:
            for n in STEMS:
                found = self.stems.get(word[:n], 0) if len(word) > n else 0
                kind = min(kind or found, found or kind)
        if kind or not self.shortest <= len(word) <= self.longest:
            return kind
        for n in self.head_sizes:
            node = self.heads.get(word[:n])
            if node is not None and self.forward.meets(word[n:], node):
                return 3
        back = word[::-1]
        for n in self.tail_sizes:
            node = self.tails.get(back[:n])
            if node is not None and self.backward.meets(back[n:], node):
                return 3
        for at, n in self.middle_places:
            trie = self.middles.get((at, word[at:at + n]))
            if trie is not None and trie.meets(word):
                return 3
        return 0


def _context(words: list[str], at: int) -> tuple[bool, bool]:
    """(quoted, addressed) of the word at a place."""
    before, after = words[max(0, at - NEAR):at], words[at + 1:at + 1 + NEAR]
    own = words[at]
    opened = own[:1] in QUOTES or any(w[:1] in QUOTES for w in before)
    closed = own.rstrip(".,;:!?")[-1:] in QUOTES or any(w.rstrip(".,;:!?")[-1:] in QUOTES for w in after)
    bare = {w.strip(".,;:!?" + QUOTES) for w in before}
    quoted = (opened and closed) or bool(bare & REPORTING and opened)
    return quoted, bool((bare | {w.strip(".,;:!?" + QUOTES) for w in after}) & ADDRESS)


class Scanner:
    """The trie inside a task, with the words it has met."""

    def __init__(self, terms: tuple[list[str], list[str]]):
        self.lexicon, self.seen, self.hits = Lexicon(*terms), set(), {}
        self.read: dict[str, int] = {}

    def _hit(self, word: str) -> int:
        """A folded word comes with many signs around it, and is looked up once."""
        kind = self.read.get(word)
        if kind is None:
            kind = self.read[word] = self.lexicon.hit(word)
        return kind

    def kinds(self, word: str) -> list[int]:
        """The kinds of hits in a word without white space: those of its runs of letters and digits, or of the whole as it is meant to be read."""
        whole, runs = fold(word), RUNS.findall(word)
        read = self._hit(whole)
        if runs == [whole] or read == 1 and whole.isalnum():
            return [read] if read else []
        found = [k for k in map(self._hit, runs) if k]
        if len(runs) < 2:
            found = [min(k for k in (read, *found) if k)] if read or found else []
        return found or ([read] if read else [])

    def features(self, text: str) -> list[float]:
        words = text.lower().split()
        distinct = set(words)
        if len(self.seen) > REMEMBERED:
            self.seen, self.hits, self.read = set(), {}, {}
        new = distinct - self.seen
        self.seen |= new
        for w in new:
            kinds = self.kinds(w)
            if kinds:
                self.hits[w] = kinds
        out = [0.0] * len(FEATURES)
        if self.hits.keys().isdisjoint(distinct):
            return out
        for at, w in enumerate(words):
            kinds = self.hits.get(w)
            if kinds:
                quoted, addressed = _context(words, at)
                for kind in kinds:
                    out[(kind - 1) + 3 * quoted] += 1
                out[6] += addressed and not quoted
        hits = out[0] + out[1] + out[2]
        out[:7] = np.log1p(out[:7]).tolist()
        out[7] = float(np.log1p(1000 * hits / len(words)))
        return out


# ---- learning -------------------------------------------------------------------------------------------------------

def _beginnings(words: Column, n: int) -> Column:
    return F.transform(F.filter(words, lambda w: F.length(w) > n), lambda w: F.concat(F.substring(w, 1, n), F.lit("*")))


def lexicon(texts: DataFrame) -> tuple[list[str], list[str]]:
    """(strong, weak) terms from rows (text, toxic): a table of word and stem counts, of which those beyond chance come to the driver."""
    words = F.array_distinct(F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), "[^\\p{L}\\p{N}]+"), lambda w: F.length(w) > 2))
    stems = [_beginnings(words, n) for n in STEMS]
    terms = texts.select("toxic", F.explode(F.array_distinct(F.concat(words, *stems))).alias("term"))
    counts = terms.groupBy("term").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("fine"))
    total = texts.agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("fine")).first()
    if not total["bad"] or not total["fine"]:
        return [], []
    share, both = total["bad"] / (total["bad"] + total["fine"]), F.col("bad") + F.col("fine")
    part = lambda c, s: F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / (both * s))).otherwise(0.0)
    ratio = ((F.col("bad") + 0.5) / (total["bad"] + 1)) / ((F.col("fine") + 0.5) / (total["fine"] + 1))
    found = counts.withColumn("ratio", ratio).filter((F.col("bad") >= LEAST_TEXTS) & (F.col("ratio") >= WEAK) & (2 * (part("bad", share) + part("fine", 1 - share)) >= LEAST_G))
    rows = found.limit(MOST_TERMS + 1).collect()
    if len(rows) > MOST_TERMS:
        raise ValueError(f"more than {MOST_TERMS} terms are beyond chance; raise LEAST_G or LEAST_TEXTS")
    words = {r["term"] for r in rows if not r["term"].endswith("*")}
    bad = {r["term"]: r["bad"] for r in rows}
    strong = {r["term"]: r["ratio"] >= STRONG for r in rows}
    kept: tuple[set[str], set[str]] = ({t for t in words if strong[t]}, {t for t in words if not strong[t]})
    ordered = tuple(sorted(own) for own in kept)
    for r in sorted((r for r in rows if r["term"].endswith("*")), key=lambda r: (-r["ratio"], -len(r["term"]), r["term"])):
        # a stem has to add to the words and stems that it covers, or that cover it, already
        own, known = kept[not strong[r["term"]]], ordered[not strong[r["term"]]]
        beginning = r["term"][:-1]
        near = [f"{beginning[:n]}*" for n in STEMS if n < len(beginning) and f"{beginning[:n]}*" in own]
        for t in known[bisect.bisect_left(known, beginning):]:
            if not t.startswith(beginning):
                break
            near.append(t)
        if r["bad"] >= STEM_GAIN * max((bad[t] for t in near), default=0):
            own.add(r["term"])
            bisect.insort(known, r["term"])
    return ordered


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Weights (last: the constant) of a logistic model, by Newton's steps."""
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        share = min(max(share, 1e-6), 0.5)
        return np.append(np.zeros(x.shape[1]), np.log(share / (1 - share)))
    a = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.diag([penalty] * x.shape[1] + [1e-6])
    w = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p) + 1e-9)[:, None]) + ridge, a.T @ (p - y) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def features(rows: DataFrame, terms: tuple[list[str], list[str]], text_col: str = "text") -> DataFrame:
    """``rows`` with the counts (array<double>) in place of the text."""
    kept = [c for c in rows.columns if c != text_col]
    schema = T.StructType([*[rows.schema[c] for c in kept], T.StructField("features", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(terms)
        for b in batches:
            for first in range(0, b.num_rows, ROWS):
                part = b.slice(first, ROWS)
                found = pa.array([scanner.features(t or "") for t in part.column(text_col).to_pylist()], type=pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], found], names=schema.names)

    return rows.mapInArrow(run, schema)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[tuple[list[str], list[str]], np.ndarray]:
    """(terms, weights) from the texts of at most LABELLED rows of ``labels``."""
    named = labels.select(F.col(f"`{id_col}`").alias("label_id"), F.col(f"`{label_col}`").cast("int").alias("toxic")).filter("label_id is not null and toxic is not null")
    chosen = (named.groupBy("label_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("label_id"), "label_id").limit(LABELLED))
    texts = docs.select(F.col(f"`{id_col}`").alias("label_id"), F.col(f"`{text_col}`").alias("text")).withColumn("hash", text_hash(F.col("text")))
    labelled = texts.join(F.broadcast(chosen), "label_id")  # LABELLED rows of two numbers at most
    # an id may name many texts: of the distinct ones, too, LABELLED at most; only numbers are sorted for that
    bound = labelled.select("label_id", "toxic", "hash").distinct().orderBy(F.xxhash64("label_id"), "label_id", "hash").limit(LABELLED)
    bound = stage(bound, "labels")
    texts = stage(texts.join(F.broadcast(bound), ["label_id", "hash"]).dropDuplicates(["label_id", "hash"]).select("toxic", "text"), "labelled")
    terms = lexicon(texts)
    grouped = features(texts, terms).groupBy("features", "toxic").agg(F.count("*").alias("n")).orderBy("toxic", "features").collect()  # LABELLED rows at most
    x = np.array([r["features"] for r in grouped], dtype=float).reshape(-1, len(FEATURES))
    n = np.array([r["n"] for r in grouped], dtype=int)
    y = np.array([r["toxic"] for r in grouped], dtype=float)
    return terms, fit(np.repeat(x, n, axis=0), np.repeat(y, n))


def score(docs: DataFrame, terms: tuple[list[str], list[str]], weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted, n_terms, n_misspelled, n_quoted): the hits outside quotation, and those inside."""
    rows = features(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")), terms)
    sum_of = F.lit(float(weights[-1]))
    for i, w in enumerate(weights[:-1]):
        sum_of = sum_of + F.col("features")[i] * float(w)
    value = F.lit(1.0) / (F.lit(1.0) + F.exp(-sum_of))
    hits = lambda i: F.round(F.expm1(F.col("features")[i])).cast("long")
    return (rows.withColumn("score", value).select("id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                                                   (hits(0) + hits(1)).alias("n_terms"), hits(2).alias("n_misspelled"), (hits(3) + hits(4) + hits(5)).alias("n_quoted")))
