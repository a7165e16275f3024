"""N-gram Jaccard join by signature trees: exact near-duplicate classes of whole texts.

A text's set holds the hashes of its distinct runs of five words (a shorter text is one run).  Two sets link
when ``100 * |A & B| >= 75 * |A | B|``.  No link between different sets is missed; nothing is sampled or capped.

1. *Sets.*  Texts with the same set collapse to one node (``min`` and ``any_value``: pre-aggregated, so a group of
   exact copies of any size leaves each task as one row).
2. *Nodes that can link.*  A linked node shares three quarters of its runs with another node.  Two lossless tests,
   both counting in how many nodes a run lies: first over the ``n - ceil(3n/4) + l(n)`` least hashes of each set
   (linked sets share at least ``l`` of these), then over all runs of the nodes that remain.
3. *Order by rarity.*  With the runs of fewest nodes first, the ``n - ceil(3n/4) + 1`` first runs of two linked sets share one (a probe).
   Any order that is the same for all sets would do; this one keeps widely shared passages out.
4. *First round.*  Each node is compared with the least node of those it shares its rarest probe with.  A group of near
   copies of any size links up in as many comparisons as it has nodes, and its pairs are never enumerated.
5. *Signature trees.*  Probes whose nodes now lie in one component are settled.  Of the nodes of other probes those stay that have three quarters of
   their runs in common with other components: what a component has to itself can't make a link that is still to be found.  Their probes are
   chosen anew from these runs, few for the smaller of two sets and more for the larger.  Nodes that probes connect make a tree: leaves of up to
   ``LEAF`` nodes, inner nodes of ``FAN``, each a stored row with the OR of its members' run and probe bitmaps, their ranges of size and component,
   and the most runs that can be common.  Leaves meet themselves first.  Then trees are built again over what is still open and traversed from
   the top, level by level: a pair of tree nodes is left when it lies in one component, shares no probe, the sizes can't match, or the bits in common
   plus the runs hidden behind shared bits fall short of the overlap needed.  Members are listed for leaf pairs that survive, and only
   members that their own bitmaps don't rule out send their sets, which are compared exactly if no link joined them before.
   Each pair is a row of its own, so a hot group spreads over the cluster.
6. *Classes* are the connected components of all links found.

Frequent runs are those that hold a small share of the rows of a batch, counted for every batch of all rows and summed; the
``HOT_RUNS`` most frequent are broadcast.  Their rows skip the shuffle that counts: being frequent is all that it
would tell.  Which runs are in that list never changes a result.

Defined results.  Null or empty text, or white space alone: empty set, linked with nothing.  Null id: the row
takes part, and its class is the least id that isn't null among all members (null if there is none).  Repeated rows: the same set, hence the same
class.  Repeated ids: each row has the class of its own text.  Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ledgerlink.llm.components import components
from ledgerlink.llm.frames import fresh, stage, text_hash
from ledgerlink.llm.wordgrams import NOT_SPACE, chunks, gram_hashes, mix, word_hashes

RUN = 5
LEAF = 64
FAN = 8
#: Bits of a tree's bitmaps: 16 for each run of its largest set, within these bounds; bits of a node's probes; size bands of 1 / BANDS of a set's size.
LEAST_BITS, MOST_BITS, PROBE_BITS, BANDS = 1 << 10, 1 << 16, 1 << 14, 20
#: Frequent runs: in HOT_LEAST texts and one of HOT_SHARE of a batch, and of these the HOT_RUNS most frequent (16 bytes each).
HOT_LEAST, HOT_SHARE, HOT_RUNS = 8, 128, 20_000
#: Bits of the filters (2 MB each, whatever the input) that keep rows of other nodes out of a pass.
FILTER_BITS = 1 << 24
#: A table of nodes (40 bytes a row at most) is broadcast up to this count, and shuffled beyond it.
BROADCAST_ROWS = 1 << 19
#: Texts whose frequent runs are counted together, and texts handled at once.
BATCH, ROWS = 1024, 256


# ---- sets -----------------------------------------------------------------------------------------------------------

def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """The sorted distinct run hashes of each text."""
    out: list[np.ndarray] = []
    for _, _, data, bounds in chunks(column):
        words, rows = word_hashes(data, bounds, NOT_SPACE)
        grams, whole = gram_hashes(words, rows, RUN)
        count = np.diff(rows)
        for i, n in enumerate(count.tolist()):
            if n >= RUN:
                out.append(np.unique(grams[rows[i]:rows[i + 1] - RUN + 1]))
            elif n:
                out.append(mix(gram_hashes(words[rows[i]:rows[i + 1]], np.array([0, n]), n)[0] + np.uint64(n)))
            else:
                out.append(np.empty(0, np.uint64))
    return out


def set_key(s: np.ndarray) -> int:
    """A 64-bit hash of a set of hashes (sum of their images; with its size it identifies the set)."""
    return int(mix(np.array([mix(s ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64) + np.uint64(len(s))], dtype=np.uint64)).view(np.int64)[0])


def _rounded_up(n: int) -> int:
    return (3 * n + 3) // 4


def _shared_least(n):  # noqa: ANN001 - int or Column expression alike
    return n // 16 + 1


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(parts) + 1, dtype=np.int64)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts).view(np.int64) if parts else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), pa.array(flat))


def _passes(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = hashes.view(np.uint64) % np.uint64(FILTER_BITS)
    return ((table[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)


def _frequent_in(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(runs, texts) of the runs that are frequent in a batch."""
    runs, texts = np.unique(np.concatenate([np.empty(0, np.uint64), *sets]), return_counts=True)
    often = texts >= max(HOT_LEAST, len(sets) // HOT_SHARE)
    return runs[often], texts[often]


def _keyed(rows: DataFrame) -> DataFrame:
    """(id, text_hash, n, key) of rows (id, text_hash, text); the last row of a batch also lists its frequent runs."""
    found = T.ArrayType(T.StructType([T.StructField("run", T.LongType()), T.StructField("texts", T.LongType())]))
    schema = T.StructType([rows.schema["id"], rows.schema["text_hash"], T.StructField("n", T.LongType()), T.StructField("key", T.LongType()), T.StructField("frequent", found)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, BATCH):
                b = whole.slice(first, BATCH)
                sets = shingle_sets(b.column("text"))
                runs, texts = _frequent_in(sets)
                pairs = pa.StructArray.from_arrays([pa.array(runs.view(np.int64)), pa.array(texts.astype(np.int64))], names=["run", "texts"])
                bounds = np.zeros(b.num_rows + 1, dtype=np.int32)
                bounds[-1] = len(runs)
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("text_hash"), pa.array([len(s) for s in sets], type=pa.int64()),
                                                  pa.array([set_key(s) for s in sets], type=pa.int64()), pa.ListArray.from_arrays(pa.array(bounds), pairs)], names=schema.names)

    return rows.mapInArrow(run, schema)


def _hot_runs(keyed: DataFrame) -> bytes:
    """The most frequent runs as sorted 64-bit integers, HOT_RUNS at most."""
    top = (keyed.select(F.explode("frequent").alias("f")).groupBy(F.col("f.run").alias("run")).agg(F.sum("f.texts").alias("texts"))
           .orderBy(F.desc("texts"), "run").limit(HOT_RUNS).select("run").collect())
    return np.sort(np.array([r["run"] for r in top], dtype=np.int64).view(np.uint64)).tobytes()


def _is_hot(hot: np.ndarray, s: np.ndarray) -> np.ndarray:
    if not len(hot):
        return np.zeros(len(s), dtype=bool)
    return hot[np.minimum(np.searchsorted(hot, s), len(hot) - 1)] == s


def _with_runs(rows: DataFrame, wanted: str, hot: bytes, of_ids: bytes, of_keys: bytes | None = None) -> DataFrame:
    """(id, text_hash, n, key, runs, hot) of rows (id, id_hash, text_hash, text).

    wanted "first": runs are the first of the counting order without the hot ones, whose number is hot.  "cold": likewise of the whole set.
    "all": the whole set.
    ``of_ids``, ``of_keys``: bit filters of the rows that are wanted; they may let others pass."""
    longs = T.ArrayType(T.LongType())
    schema = T.StructType([rows.schema["id"], rows.schema["text_hash"], T.StructField("n", T.LongType()), T.StructField("key", T.LongType()),
                           T.StructField("runs", longs), T.StructField("hot", T.LongType())])
    shared = rows.sparkSession.sparkContext.broadcast((hot, of_ids, of_keys))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = np.frombuffer(shared.value[0], dtype=np.uint64)
        ids, keys = [np.frombuffer(x, dtype=np.uint8) if x is not None else None for x in shared.value[1:]]
        for b in batches:
            b = b.filter(pa.array(_passes(ids, b.column("id_hash").to_numpy())))
            for first in range(0, b.num_rows, ROWS):
                part = b.slice(first, ROWS)
                sets = shingle_sets(part.column("text"))
                n = np.array([len(s) for s in sets], dtype=np.int64)
                key = np.array([set_key(s) for s in sets], dtype=np.int64)
                if keys is not None:
                    keep = np.flatnonzero(_passes(keys, key))
                    part, n, key, sets = part.take(pa.array(keep, type=pa.int64())), n[keep], key[keep], [sets[i] for i in keep]
                count = np.zeros(len(sets), dtype=np.int64)
                for i, s in enumerate(sets if wanted != "all" else []):
                    if wanted == "first":
                        s = s[:len(s) - _rounded_up(len(s)) + _shared_least(len(s))]
                    is_hot = _is_hot(often, s)
                    sets[i], count[i] = s[~is_hot], is_hot.sum()
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("text_hash"), pa.array(n), pa.array(key), _lists(sets), pa.array(count)], names=schema.names)

    return rows.mapInArrow(run, schema)


# ---- nodes that can link --------------------------------------------------------------------------------------------

def _shared_runs(rows: DataFrame, node: str) -> DataFrame:
    """(node, shared): in how many of its runs each node meets a different one, of rows (node, runs, hot).

    Hot runs count as shared.  Some nodes may be there twice (see ``_with_runs``): their counts are too
    high then, never too low."""
    own = F.struct(F.lit(None).cast("long").alias("run"), F.col("hot").alias("hot"))
    # a row of its own for the number of hot runs, at a place of its own among the runs
    each = F.transform("runs", lambda r: F.struct(r.alias("run"), F.lit(None).cast("long").alias("hot")))
    runs = rows.select(node, F.explode(F.when(F.col("hot") > 0, F.concat(each, F.array(own))).otherwise(each)).alias("r")).select(node, F.coalesce("r.run", F.xxhash64(node)).alias("run"), "r.hot")
    by = W.partitionBy("run")
    met = runs.select(node, "hot", F.min(node).over(by).alias("_a"), F.max(node).over(by).alias("_b"))
    return met.filter("_a <> _b or hot is not null").groupBy(node).agg(F.sum(F.coalesce("hot", F.lit(1))).alias("shared"))


def _filter_bits(hashes: DataFrame) -> bytes:
    """A bit filter of fixed size (FILTER_BITS / 8 bytes) of the one column of ``hashes``."""
    bit = F.pmod(F.col(hashes.columns[0]), F.lit(FILTER_BITS)).cast("long") + 1  # Spark's buckets count from 1
    out = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for p in (hashes.select(bit.alias("bit")).groupBy(F.expr("bitmap_bucket_number(bit)").alias("bucket"))
              .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bit))").alias("bits")).collect()):
        out[(p["bucket"] - 1) * 4096:p["bucket"] * 4096] = np.frombuffer(bytes(p["bits"]), dtype=np.uint8)
    return out.tobytes()


# ---- signature trees ------------------------------------------------------------------------------------------------

def bitmap(s: np.ndarray, width: int) -> bytes:
    """The bits of a set of runs: run modulo width."""
    bits = np.zeros(width, dtype=bool)
    bits[s % np.uint64(width)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def width_of(n: int) -> int:
    """Bits for a set of n runs: a power of two, four to eight for each run."""
    return 1 << max(7, (4 * n - 1).bit_length())


class Node:
    """A tree node: the OR of its members' bitmaps, their size range, the most runs that can be common with others, and how many its bits can hide."""

    def __init__(self, members: list["Node"] | None = None, n: int = 0, bits: int = 0, width: int = 0, shared: int | None = None):
        self.members = members or []
        self.shared = max(m.shared for m in members) if members else n if shared is None else shared
        self.least, self.most = (n, n) if not members else (min(m.least for m in members), max(m.most for m in members))
        self.width = width or min(m.width for m in members)
        self.bits, self.folded = bits, {}

    def at(self, width: int) -> tuple[int, int]:
        """(bits, hidden) at a width that is no more than its own: halves are folded together."""
        if width not in self.folded:
            if self.members:
                parts = [m.at(width) for m in self.members]
                bits = 0
                for p in parts:
                    bits |= p[0]
                self.folded[width] = bits, max(p[1] for p in parts)
            else:
                bits, w = self.bits, self.width
                while w > width:
                    w //= 2
                    bits = bits & ((1 << w) - 1) | bits >> w
                self.folded[width] = bits, self.shared - bits.bit_count()
        return self.folded[width]


def tree(leaves: list[Node]) -> Node:
    """Inner nodes of FAN members each, up to one root."""
    while len(leaves) > 1:
        leaves = [Node(leaves[i:i + FAN]) for i in range(0, len(leaves), FAN)]
    return leaves[0]


def may_link(a: Node, b: Node) -> bool:
    """Whether sets below the two nodes can link: sizes within 3 of 4, and 7 * overlap >= 3 * (|A| + |B|).

    Runs in both sets have their bits in both bitmaps; besides one run for each such bit, a set has only its hidden
    runs (those that share a bit with another run of the set)."""
    if 4 * a.most < 3 * b.least or 4 * b.most < 3 * a.least or 7 * min(a.shared, b.shared) < 3 * (a.least + b.least):
        return False
    width = min(a.width, b.width)
    (x, hidden_a), (y, hidden_b) = a.at(width), b.at(width)
    return 7 * ((x & y).bit_count() + min(hidden_a, hidden_b)) >= 3 * (a.least + b.least)


def traverse(a: Node, b: Node) -> Iterator[tuple[Node, Node]]:
    """Pairs of sets (nodes without members) below a and b that no bound rules out."""
    todo = [(a, b)]
    while todo:
        x, y = todo.pop()
        if may_link(x, y):
            if not x.members and not y.members:
                yield x, y
            else:
                todo += [(c, d) for c in x.members or [x] for d in y.members or [y]]


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= 75 * (len(a) + len(b) - both) and both > 0


def _survivors(pairs: DataFrame) -> DataFrame:
    """(pair, side, node) of the nodes that the traversal of their leaf pair can't rule out, of rows (pair, left, right: node, comp, n, shared, bits)."""

    def below(members: pa.Array) -> tuple[list[tuple[int, int]], dict[int, int], Node]:
        named = list(zip(members.field("node").to_pylist(), members.field("comp").to_pylist(), strict=True))
        each = [Node(n=n, bits=int.from_bytes(x, "little"), width=8 * len(x), shared=k)
                for n, k, x in zip(*[members.field(c).to_pylist() for c in ("n", "shared", "bits")], strict=True)]
        return named, {id(x): i for i, x in enumerate(each)}, tree(sorted(each, key=lambda m: m.least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[int, int, int]] = []
            for r in range(batch.num_rows):
                pair, own = batch.column("pair")[r].as_py(), batch.column("same")[r].as_py()
                (a, at_a, x), (b, at_b, y) = (below(batch.column(c)[r].values) for c in ("left", "right"))
                met: set[tuple[int, int]] = set()
                for i, j in traverse(x, y):
                    (node, comp), (other, its) = a[at_a[id(i)]], b[at_b[id(j)]]
                    if comp != its:
                        met |= {(0, node), (0 if own else 1, other)}
                found += [(pair, *x) for x in sorted(met)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], type=pa.int64()), pa.array([x[1] for x in found], type=pa.int32()),
                                              pa.array([x[2] for x in found], type=pa.int64())], names=["pair", "side", "node"])

    return pairs.mapInArrow(run, "pair bigint, side int, node bigint")


def _sides(members: pa.Array) -> tuple[list[int], list[int]]:
    """Places of the members of side 0 and of side 1 (of side 0 again where a leaf meets itself)."""
    side = members.field("side").to_pylist()
    left, right = ([i for i, k in enumerate(side) if k == want] for want in (0, 1))
    return left, right or left


def leaf_links(left: list[tuple[int, int, np.ndarray]], right: list[tuple[int, int, np.ndarray]]) -> list[tuple[int, int]]:
    """Links between sets (node, comp, runs) of two leaves that join what no link joined before."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    def bottom(sets: list[tuple[int, int, np.ndarray]]) -> list[Node]:
        return [Node(n=len(s), bits=int.from_bytes(bitmap(s, width_of(len(s))), "little"), width=width_of(len(s))) for _, _, s in sets]

    a, b = bottom(left), bottom(right)
    place = {id(x): s for x, s in zip([*a, *b], [*left, *right], strict=True)}
    out = []
    for x, y in traverse(*(tree(sorted(k, key=lambda m: m.least)) for k in (a, b))):
        (i, ci, s), (j, cj, t) = place[id(x)], place[id(y)]
        ra, rb = root(ci), root(cj)
        if ra != rb and linked(s, t):
            parent[max(ra, rb)] = min(ra, rb)
            out.append((i, j))
    return out


def _search(pairs: DataFrame) -> DataFrame:
    """Links (a, b) of rows (members): arrays of structs (side, node, comp, runs); a leaf met with itself has side 0 only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[int, int]] = []
            for r in range(batch.num_rows):
                members = batch.column("members")[r].values
                node, comp, runs = (members.field(c) for c in ("node", "comp", "runs"))
                sets = [(node[i].as_py(), comp[i].as_py(), np.sort(runs[i].values.to_numpy().view(np.uint64))) for i in range(len(members))]
                left, right = _sides(members)
                if left and right:
                    found += leaf_links([sets[i] for i in left], [sets[i] for i in right])
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], type=pa.int64()), pa.array([y for _, y in found], type=pa.int64())], names=["a", "b"])

    return pairs.mapInArrow(run, "a bigint, b bigint")


def _open(probes: DataFrame, info: DataFrame) -> DataFrame:
    """The nodes (node) one of whose probes lies in more than one component."""
    runs = _looked_up(info.select("node", "comp"), probes, "node").groupBy("run").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x <> y").select("run")
    return probes.join(runs, "run", "left_semi").select("node").distinct()


def _reopened(near: DataFrame, info: DataFrame) -> DataFrame:
    """(node, n, comp, shared, runs, short, long) of the nodes that can link outside their component, of sets ``near`` (node, runs).

    Linked sets of two components have only runs in common that lie in more than one component; their number is ``shared``.  The smaller set
    has one of the ``shared - ceil(6n/7) + 1`` first (``short``) in common with the ``shared - ceil(3n/4) + 1`` first of the larger one (``long``)."""
    rows = _looked_up(info.select("node", "n", "comp"), near.select("node", "runs"), "node").dropDuplicates(["node"])
    each = stage(rows.select("node", "n", "comp", F.explode("runs").alias("run")), "open-runs")
    several = each.groupBy("run").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count("*").alias("nodes")).filter("x <> y").select("run", "nodes")
    own = W.partitionBy("node")  # the runs of one set
    ranked = each.join(several, "run").withColumns({"shared": F.count("*").over(own), "place": F.row_number().over(own.orderBy("nodes", "run"))})
    first = lambda least: F.collect_list(F.when(F.col("place") <= F.col("shared") - least + 1, F.col("run")))
    found = ranked.filter("shared >= (3 * n + 3) div 4").groupBy("node", "n", "comp", "shared").agg(
        F.collect_list("run").alias("runs"), first(F.expr("(6 * n + 6) div 7")).alias("short"), first(F.expr("(3 * n + 3) div 4")).alias("long"))
    return stage(found, "open-sets")


def _probe_bits(*lists: list[np.ndarray]) -> list[bytes]:
    return [bitmap(np.concatenate(x), PROBE_BITS) for x in lists]


SUMMARY = "least bigint, most bigint, shared bigint, first bigint, last bigint, hidden bigint, bits binary, short binary, long binary"
MEMBERS = "array<struct<node: bigint, comp: bigint, n: bigint, shared: bigint, bits: binary>>"


def _leaf_rows(groups: DataFrame) -> DataFrame:
    """Leaves (tree, place, SUMMARY, members) of rows (tree, width, place, sets: node, n, comp, shared, runs, short, long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in range(b.num_rows):
                sets, width = b.column("sets")[r].values, b.column("width")[r].as_py()
                node, n, comp, shared = (sets.field(c).to_pylist() for c in ("node", "n", "comp", "shared"))
                runs, short, long = ([sets.field(c)[i].values.to_numpy().view(np.uint64) for i in range(len(sets))] for c in ("runs", "short", "long"))
                bits = np.zeros(width, dtype=bool)
                hidden = 0
                for x in runs:
                    at = np.unique(x % np.uint64(width))
                    bits[at] = True
                    hidden = max(hidden, len(x) - len(at))
                members = [{"node": d, "comp": c, "n": k, "shared": m, "bits": bitmap(x, width_of(m))}
                           for d, c, k, m, x in zip(node, comp, n, shared, runs, strict=True)]
                out.append((b.column("tree")[r].as_py(), b.column("place")[r].as_py(), min(n), max(n), max(shared), min(comp), max(comp), hidden,
                            np.packbits(bits, bitorder="little").tobytes(), *_probe_bits(short, long), members))
            yield _as_batch(out, schema)

    schema = ["tree", "place", *[c.split()[0] for c in SUMMARY.split(", ")], "members"]
    return groups.mapInArrow(run, f"tree bigint, place bigint, {SUMMARY}, members {MEMBERS}")


def _inner_rows(groups: DataFrame) -> DataFrame:
    """Inner nodes (tree, place, SUMMARY) of rows (tree, place, below: structs of SUMMARY)."""

    def merged(parts: list[bytes]) -> bytes:
        return np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in parts]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in range(b.num_rows):
                below = b.column("below")[r].values
                least, most, shared, first, last, hidden, *bitmaps = (below.field(c).to_pylist() for c in schema[2:])
                out.append((b.column("tree")[r].as_py(), b.column("place")[r].as_py(), min(least), max(most), max(shared), min(first), max(last), max(hidden),
                            *[merged(x) for x in bitmaps]))
            yield _as_batch(out, schema)

    schema = ["tree", "place", *[c.split()[0] for c in SUMMARY.split(", ")]]
    return groups.mapInArrow(run, f"tree bigint, place bigint, {SUMMARY}")


def _as_batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = {"bits": pa.binary(), "short": pa.binary(), "long": pa.binary(), "members": pa.list_(pa.struct([
        ("node", pa.int64()), ("comp", pa.int64()), ("n", pa.int64()), ("shared", pa.int64()), ("bits", pa.binary())]))}
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), type=kinds.get(k, pa.int64())) for k, c in zip(names, columns, strict=True)], names=names)


def _levels(opened: DataFrame, inner: bool = True) -> list[DataFrame]:
    """Leaves and, if ``inner``, inner nodes of the signature trees over open nodes, from the leaves up to where each tree has FAN nodes at most.

    Nodes that a probe connects, directly or through others, make a tree.  In a tree they are ordered by size band, component (those alone in theirs first),
    and runs that can be common; so whole components and weak nodes share leaves, and their bounds leave them early."""
    rows = opened.select("node", F.explode(F.array_distinct(F.concat("short", "long"))).alias("run"))
    hubs = rows.groupBy("run").agg(F.min("node").alias("hub"), F.max("node").alias("other")).filter("hub <> other").select("run", "hub")
    tree_of = stage(components(rows.join(hubs, "run").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()).withColumnRenamed("component", "tree"), "trees")
    crowds = opened.groupBy("comp").agg(F.count("*").alias("crowd"))
    widths = opened.join(tree_of, "node").groupBy("tree").agg(F.max("shared").alias("k"), F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x <> y").select(
        "tree", F.least(F.lit(MOST_BITS), F.greatest(F.lit(LEAST_BITS), F.expr("shiftleft(1L, 4 + cast(ceil(log2(k)) as int))"))).cast("long").alias("width"))
    sized = opened.join(tree_of, "node").join(widths, "tree").join(crowds, "comp").withColumns({
        "band": F.floor(F.log("n") * BANDS), "own": F.when(F.col("crowd") > 1, F.col("comp"))}).drop("crowd")
    order = ["tree", "band", "own", "shared", "node"]
    dealt = stage(sized.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "ordered")
    # numbers without gaps: those within a partition plus the counts of the partitions before (a row a partition)
    part = F.shiftright("at", 33)
    before = dealt.groupBy(part.alias("part")).agg(F.count("*").alias("n_part")).select(
        "part", (F.sum("n_part").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, 0)) - F.col("n_part")).alias("before"))
    numbered = dealt.withColumn("part", part).join(F.broadcast(before), "part").withColumn("at", F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)))
    member = F.struct("node", "n", "comp", "shared", "runs", "short", "long")
    groups = numbered.groupBy("tree", "width", F.expr(f"at div {LEAF}").alias("place")).agg(F.collect_list(member).alias("sets"))  # LEAF sets at most
    levels = [stage(_leaf_rows(groups), "leaves")]
    below = F.collect_list(F.struct(*[c.split()[0] for c in SUMMARY.split(", ")])).alias("below")  # FAN nodes at most
    while inner and (levels[-1].groupBy("tree").count().agg(F.max("count").alias("n")).first()["n"] or 0) > FAN:
        levels.append(stage(_inner_rows(levels[-1].groupBy("tree", F.expr(f"place div {FAN}").alias("place")).agg(below)), "inner"))
    return levels


def _pairs_that_may(pairs: DataFrame, level: DataFrame) -> DataFrame:
    """The rows of ``pairs`` (tree, l, r: places on a level) whose summaries don't rule out a link between two components."""
    names = [c.split()[0] for c in SUMMARY.split(", ")]
    a, b = (level.select("tree", F.col("place").alias(x), *[F.col(c).alias(f"{x}_{c}") for c in names]) for x in "lr")
    met = (pairs.join(a, ["tree", "l"]).join(b, ["tree", "r"])
           .filter("not (l_first = l_last and r_first = r_last and l_first = r_first)")
           .filter("4 * l_most >= 3 * r_least and 4 * r_most >= 3 * l_least and 7 * least(l_shared, r_shared) >= 3 * (l_least + r_least)"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = {c: batch.column(c).to_pylist() for c in ("l_least", "r_least", "l_hidden", "r_hidden")}
            maps = {c: batch.column(c) for c in ("l_bits", "r_bits", "l_short", "r_short", "l_long", "r_long")}
            kept = []
            for i in range(batch.num_rows):
                x = {c: int.from_bytes(m[i].as_py(), "little") for c, m in maps.items()}
                common = (x["l_bits"] & x["r_bits"]).bit_count() + min(numbers["l_hidden"][i], numbers["r_hidden"][i])
                probe = x["l_short"] & x["r_long"] or x["l_long"] & x["r_short"]
                if probe and 7 * common >= 3 * (numbers["l_least"][i] + numbers["r_least"][i]):
                    kept.append(i)
            yield batch.select(["tree", "l", "r"]).take(pa.array(kept, type=pa.int64()))

    return stage(met.mapInArrow(run, "tree bigint, l bigint, r bigint"), "node-pairs")


def _leaf_pairs(levels: list[DataFrame]) -> DataFrame:
    """(tree, l, r), l <= r: leaf pairs that no pair of nodes above them rules out, found from the top level down."""
    place = [x.select("tree", "place") for x in levels]
    top = place[-1]
    pairs = top.select("tree", F.col("place").alias("l")).join(top.select("tree", F.col("place").alias("r")), "tree").filter("l <= r")  # FAN nodes a tree at most
    for k in range(len(levels) - 1, -1, -1):
        pairs = _pairs_that_may(pairs, levels[k])
        if k:
            a, b = (place[k - 1].select("tree", F.expr(f"place div {FAN}").alias(x), F.col("place").alias(f"{x}_below")) for x in "lr")
            pairs = pairs.join(a, ["tree", "l"]).join(b, ["tree", "r"]).select("tree", F.col("l_below").alias("l"), F.col("r_below").alias("r")).filter("l <= r")
    return pairs


def _links_of(met: DataFrame, leaves: DataFrame, near: DataFrame, info: DataFrame) -> DataFrame:
    """Links (a, b) between nodes of the leaf pairs ``met`` (tree, l, r) that join what no link joined before."""
    a, b = (leaves.select("tree", F.col("place").alias(x), F.col("members").alias(name)) for x, name in (("l", "left"), ("r", "right")))
    pairs = met.withColumns({"pair": F.monotonically_increasing_id(), "same": F.col("l") == F.col("r")})
    left_over = stage(_survivors(stage(pairs, "leaf-pairs").join(a, ["tree", "l"]).join(b, ["tree", "r"]).select("pair", "same", "left", "right")), "survivors")
    sets = near.join(left_over.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"]).select("node", "runs")
    members = left_over.join(_looked_up(info.select("node", "comp"), sets, "node"), "node")
    gathered = members.groupBy("pair").agg(F.collect_list(F.struct("side", "node", "comp", "runs")).alias("members"))  # two leaves at most
    return stage(_search(gathered.select("members")), "tree-links")


# ---- the join -------------------------------------------------------------------------------------------------------

def _looked_up(small: DataFrame, large: DataFrame, key: str) -> DataFrame:
    """``large`` joined with a staged table of a few numbers a row, broadcast only behind a count of its rows."""
    return large.join(F.broadcast(small) if small.count() <= BROADCAST_ROWS else small, key)


def _numbered(nodes: DataFrame, keyed: DataFrame) -> DataFrame:
    """``keyed`` with the node of its key from ``nodes``; rows of other keys go."""
    return _looked_up(nodes, keyed, "key")


def _candidates(sets: DataFrame, rows: DataFrame, hot: bytes) -> DataFrame:
    """(node, n, key, shared, runs) of the nodes that can link."""
    least = F.expr("(3 * n + 3) div 4")
    of_ids = _filter_bits(sets.select(F.xxhash64("id")))
    shared = _shared_runs(_with_runs(rows, "first", hot, of_ids).select("key", "runs", "hot"), "key")
    first = stage(sets.join(shared, "key").filter(F.col("shared") >= F.expr("((3 * n + 3) div 4) div 16 + 1"))
                  .select("key", "id", "text_hash", "n").withColumn("node", F.monotonically_increasing_id()), "may-link")
    whole = _with_runs(rows, "cold", hot, of_ids, _filter_bits(first.select("key"))).select("key", "runs", "hot")
    shared = _shared_runs(_numbered(first.select("key", "node"), whole).drop("key"), "node")
    near = stage(first.join(shared, "node").filter(F.col("shared") >= least).select("key", "id", "text_hash", "node", "shared"), "near")
    found = _with_runs(rows, "all", hot, of_ids, _filter_bits(near.select("key"))).drop("hot")
    # the set of one row for each node (rows equal in id and text give it again, which does no harm)
    chosen = near.select("key", "node", "shared", F.col("id").alias("own_id"), F.col("text_hash").alias("own_hash"))
    kept = _numbered(chosen, found).filter(F.col("id").eqNullSafe(F.col("own_id")) & (F.col("text_hash") == F.col("own_hash")))
    return stage(kept.select("node", "n", "key", "shared", "runs"), "near-sets")


def _probes(near: DataFrame, hot: bytes) -> DataFrame:
    """(run, node): the first shared runs of each node in order of rarity.

    Runs of no other node would come first; ``shared`` is at least the number of the rest.  Hot runs come last and
    needn't be counted; dense_rank, as rows may be there twice."""
    spark = near.sparkSession
    table = F.broadcast(spark.createDataFrame([(x,) for x in np.frombuffer(hot, dtype=np.int64).tolist()], "run bigint"))  # HOT_RUNS rows at most
    runs = near.select(F.explode("runs").alias("run"), "node", (F.col("shared") - F.expr("(3 * n + 3) div 4") + 1).alias("wanted"))
    cold = runs.join(table, "run", "left_anti").withColumn("nodes", F.count("*").over(W.partitionBy("run"))).filter("nodes > 1")
    ranked = cold.unionByName(runs.join(table, "run").withColumn("nodes", F.lit(2**62)))
    place = F.dense_rank().over(W.partitionBy("node").orderBy("nodes", "run"))
    return stage(ranked.withColumn("place", place).filter("place <= wanted").select("run", "node").distinct(), "probes")


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, text_hash, n_runs, component_id, class_key (the class, also where ids are null; null for empty sets)."""
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{id_col}`")).alias("id_hash"), text_hash(text).alias("text_hash"), text.alias("text"))
    keyed = stage(_keyed(rows.drop("id_hash")), "sets")
    every = keyed.drop("frequent")
    chosen = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("text_hash")))
    sets = stage(every.filter("n > 0").groupBy("key").agg(F.first("n").alias("n"), chosen.alias("c")).select("key", "n", "c.id", "c.text_hash"), "nodes")
    hot = _hot_runs(keyed)
    near = _candidates(sets, rows, hot)
    probes = _probes(near, hot)
    # first round: each node with the least node of those it shares its rarest run with
    hubs = probes.groupBy("run").agg(F.min("node").alias("hub"), F.count("*").alias("m")).filter("m > 1")
    star = stage(probes.join(hubs, "run").filter("node <> hub").groupBy("node").agg(F.min(F.struct("m", "run", "hub")).alias("s")).select("node", "s.hub"), "stars")
    mine = near.select("node", F.col("runs").alias("a"))
    its = near.join(star.select("hub").distinct(), F.col("node") == F.col("hub"), "left_semi").select(F.col("node").alias("hub"), F.col("runs").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    first = stage(_looked_up(star, mine, "node").join(its, "hub").withColumn("both", both)
                  .filter("100 * both >= 75 * (size(a) + size(b) - both)").select(F.col("node").alias("a"), F.col("hub").alias("b")), "first-links")
    nodes = stage(near.select("node", "n").distinct(), "sizes")

    def with_classes(links: DataFrame) -> DataFrame:
        return stage(nodes.join(components(links), "node", "left").select("node", "n", F.coalesce("component", "node").alias("comp")), "classes-so-far")

    # second round: leaves with themselves, which settles most; third round: all that is still open, from the top of the trees down
    info = with_classes(first)
    opened = _reopened(near.join(_open(probes, info), "node", "left_semi"), info)
    leaves = _levels(opened, inner=False)[0]
    own = leaves.filter("first <> last").select("tree", F.col("place").alias("l"), F.col("place").alias("r"))
    links = first.unionByName(_links_of(own, leaves, near, info))
    info = with_classes(links)
    levels = _levels(_reopened(near.join(opened, "node", "left_semi"), info))
    links = links.unionByName(_links_of(_leaf_pairs(levels), levels[0], near, info))
    classes = components(links).join(near.select("node", "key").distinct(), "node").join(sets.select("key", "id"), "key")
    least = classes.groupBy("component").agg(F.min("id").alias("class_id"), F.min("key").alias("class_key"))
    named = classes.join(least, "component").select("key", "class_id", "class_key")
    named = sets.select("key", F.col("id").alias("own_id")).join(named, "key", "left").select(
        "key", F.when(F.col("class_key").isNull(), F.col("own_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("class_key", "key").alias("class_key"))
    return every.join(named, "key", "left").select(
        "id", "text_hash", F.col("n").alias("n_runs"), F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("id")).alias("component_id"),
        F.when(F.col("n") > 0, F.col("class_key")).alias("class_key"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class: that of the least id (null last), of several such the one of the least text hash.

    Of rows equal in id and text one stays.  Rows with empty sets all stay."""
    rows = jaccard_classes(docs, id_col, text_col).filter("class_key is not null")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("text_hash")))
    distinct = stage(rows.groupBy("class_key", "id", "text_hash").agg(F.count("*").alias("copies")), "members")
    chosen = distinct.groupBy("class_key").agg(first.alias("first"))
    marked = distinct.join(chosen, "class_key").withColumn("stays", F.col("id").eqNullSafe(F.col("first.id")) & (F.col("text_hash") == F.col("first.text_hash")))
    # rows that go, and those of which one of several equal ones stays; all others aren't listed
    marked = marked.filter("not stays or copies > 1")
    own_id, own_hash, stays = fresh(docs, "_own_id"), fresh(docs, "_own_hash"), fresh(docs, "_stays")
    marked = marked.select(F.col("id").alias(own_id), F.col("text_hash").alias(own_hash), F.col("stays").alias(stays))
    joined = docs.join(marked, docs[id_col].eqNullSafe(marked[own_id]) & (text_hash(docs[text_col]) == marked[own_hash]), "left")
    single = joined.filter(F.col(stays).isNull()).select(*[F.col(f"`{c}`") for c in docs.columns])
    several = joined.filter(F.col(stays)).dropDuplicates([own_id, own_hash]).select(*[F.col(f"`{c}`") for c in docs.columns])
    return single.unionByName(several)
