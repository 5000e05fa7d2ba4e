"""Hard negatives, mined with a multiway hyperplane tree (GNAT).

Vectors are turned into integers, so that all scores (inner products) are
exact. For an anchor, its positives are the rows of its label with the highest
scores; for each positive, the hard negatives are the highest-scoring rows of
other labels whose score lies in a window below the positive's.

A node of the tree has split points; every row belongs to the nearest one, so
subtrees are bounded by hyperplanes. For each split point the node keeps the
range of its distances to the rows of every sibling subtree, and for each
subtree the range of its norms. As |a - x|^2 = |a|^2 + |x|^2 - 2 a.x, a window
of scores is an annulus of distances around the anchor (wider by the range of
norms): a subtree stays if, seen from every split point, its range of distances
can meet the annulus. Once an anchor has as many rows as it wants, the score of
the last one narrows its annulus. Leaves are compared exactly.

The top of the tree is fitted on a bounded sample (``SAMPLE`` rows, ``LEVELS``
levels of ``FAN`` split points); its subtrees are the shards, all rows are
dealt to them and the ranges are taken over all rows. A shard is dealt over
blocks of ``BLOCK_ROWS`` rows, each with a local tree, and the anchors that
visit a shard over slices of ``PROBE_ROWS``: a task holds one block and one
slice. An anchor first searches its own shard; the scores found there bound its
second search, which visits the other shards that the ranges can't exclude.
Vectors without structure exclude few: the work is then anchors times rows.

Of equal vectors of one label only those of smallest ids can be among the
first, so only as many as may be wanted enter the tree: this loses nothing, and
a vector that a third of the rows share is no hot leaf.

Defined results: rows whose id, label or vector is null, whose vector holds a
null or non-finite component, or one of 2^58 or more after scaling, take no part; of rows that repeat an id, the one of the smallest label and
vector stays; an empty vector scores 0; a shorter vector counts as filled up
with zeros; ties go to the smaller id; scores beyond the range of a long are
returned as its end (they are compared unbounded); an anchor without positives
or a positive without negatives has no rows; an empty table gives an empty
table; other columns of the input are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import key_slices, materialize, releasing, ship

FAN = 16                # split points of a node
LEVELS = 2              # of the tree, laid out over the cluster
SAMPLE = 4096           # rows that the laid-out split points are chosen among
LEAF = 64               # rows of a local leaf, at most
BLOCK_ROWS = 8192       # rows of a local tree
PROBE_ROWS = 1024       # anchors that search a block in one task
TOGETHER = 256          # anchors that descend together
EXACT = 2.0 ** 53       # products below are exact in double precision
LARGEST = 2.0 ** 58     # components stay below, so that a score fits SCORE
SCORE = "decimal(38,0)"
LONG = (1 << 63) - 1


# ---- the tree ------------------------------------------------------------------

def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))


def distances(a: np.ndarray, a_norms: np.ndarray, b: np.ndarray, b_norms: np.ndarray) -> np.ndarray:
    square = a_norms[:, None] ** 2 + b_norms[None, :] ** 2 - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def split_points(x: np.ndarray, fan: int) -> np.ndarray:
    """Places of rows far from one another: of three times as many rows, spread
    evenly, the first and then each time the farthest from all chosen."""
    among = np.unique(np.linspace(0, len(x) - 1, min(len(x), 3 * fan)).astype(np.int64))
    y, norms = x[among], _norms(x[among])
    chosen = [0]
    far = distances(y, norms, y[:1], norms[:1])[:, 0]
    while len(chosen) < fan and far.max() > 0:
        at = int(far.argmax())
        chosen.append(at)
        far = np.minimum(far, distances(y, norms, y[at:at + 1], norms[at:at + 1])[:, 0])
    return among[chosen]


@dataclass
class Node:
    splits: np.ndarray              # fan x dimension
    norms: np.ndarray               # of the split points
    low: np.ndarray                 # fan x fan: least distance of split i to the rows of subtree j
    high: np.ndarray
    least: np.ndarray               # norms of the rows of subtree j
    most: np.ndarray
    children: list                  # a node, or the number of a leaf

    @classmethod
    def of(cls, splits: np.ndarray) -> "Node":
        fan = len(splits)
        return cls(splits, _norms(splits), np.full((fan, fan), np.inf), np.full((fan, fan), -np.inf),
                   np.full(fan, np.inf), np.full(fan, -np.inf), [None] * fan)

    def widen(self, rows: np.ndarray, norms: np.ndarray, far: np.ndarray, child: np.ndarray) -> None:
        """Take rows, dealt to subtrees, into the ranges."""
        for j in np.unique(child).tolist():
            mine = child == j
            self.low[:, j] = np.minimum(self.low[:, j], far[mine].min(axis=0))
            self.high[:, j] = np.maximum(self.high[:, j], far[mine].max(axis=0))
            self.least[j] = min(self.least[j], norms[mine].min())
            self.most[j] = max(self.most[j], norms[mine].max())

    def reachable(self, a: np.ndarray, a_norms: np.ndarray, which: np.ndarray, lo: np.ndarray, hi: np.ndarray
                  ) -> np.ndarray:
        """Windows x subtrees: whether rows of a subtree can have a score from
        lo to hi. Window v belongs to vector ``which[v]``. Ranges are eased by
        far more than rounding can shift them."""
        full = self.high[0] >= 0
        least, most = np.where(full, self.least, 0), np.where(full, self.most, 0)
        far = distances(a, a_norms, self.splits, self.norms)
        ease = 1e-6 * (1 + a_norms[:, None] + np.maximum(most, self.norms.max()))
        nearest = np.zeros((len(a), len(self.children)))
        farthest = np.full((len(a), len(self.children)), np.inf)
        for i in range(len(self.splits)):
            d = far[:, i:i + 1]
            np.maximum(nearest, np.maximum(d - self.high[i], self.low[i] - d), out=nearest)
            np.minimum(farthest, d + self.high[i], out=farthest)
        square = a_norms[which, None] ** 2
        outer = square + most ** 2 - 2 * lo[:, None]
        inner = np.sqrt(np.maximum(square + least ** 2 - 2 * hi[:, None], 0))
        ease = ease[which]
        out = nearest[which] > np.sqrt(np.maximum(outer, 0)) + ease
        out |= outer < -(ease ** 2) - 1e-6 * square
        out |= farthest[which] < inner - ease
        return ~out & full


def grow(x: np.ndarray, leaf: int, fan: int = FAN, levels: int | None = None, fewest: int = 2
         ) -> tuple[Node | int, list[np.ndarray]]:
    """A tree over the rows of x, and the rows of its leaves. Rows that can't
    be told apart by the chosen split points stay in one leaf."""
    leaves: list[np.ndarray] = []
    norms = _norms(x)

    def build(rows: np.ndarray, level: int) -> Node | int:
        splits = split_points(x[rows], fan) if len(rows) > leaf and level != levels else rows[:0]
        if len(splits) < fewest:
            leaves.append(rows)
            return len(leaves) - 1
        node = Node.of(x[rows[splits]])
        far = distances(x[rows], norms[rows], node.splits, node.norms)
        child = far.argmin(axis=1)
        node.widen(x[rows], norms[rows], far, child)
        for j in range(len(splits)):
            node.children[j] = build(rows[child == j], level + 1)
        return node

    return build(np.arange(len(x)), 0), leaves


def route(tree: Node | int, x: np.ndarray) -> np.ndarray:
    """Leaf of every row: always towards the nearest split point."""
    out = np.zeros(len(x), dtype=np.int64)
    norms = _norms(x)

    def descend(node: Node | int, rows: np.ndarray) -> None:
        if not isinstance(node, Node):
            out[rows] = node
            return
        child = distances(x[rows], norms[rows], node.splits, node.norms).argmin(axis=1)
        for j in np.unique(child).tolist():
            descend(node.children[j], rows[child == j])

    descend(tree, np.arange(len(x)))
    return out


# ---- searching a block -----------------------------------------------------------

@dataclass
class Windows:
    """Score windows, each of one anchor: the first ``want`` rows from lo to hi."""
    which: np.ndarray       # anchor of the window
    lo: np.ndarray          # doubles, or unbounded integers (dtype object)
    hi: np.ndarray


class Block:
    """Rows of a block with their local tree."""

    def __init__(self, ids: np.ndarray, labels: list, x: np.ndarray) -> None:
        self.ids, self.x = ids, x
        self.codes = {}
        self.labels = np.array([self.codes.setdefault(v, len(self.codes)) for v in labels], dtype=np.int64)
        self.rows = x.astype(np.float64)
        self.norms = _norms(self.rows)
        self.tree, self.leaves = grow(self.rows, LEAF)

    def search(self, ids: np.ndarray, labels: list, a: np.ndarray, windows: Windows, want: int, same: bool
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, place of row, score) of all that can be among the first."""
        points = a.astype(np.float64)
        norms = _norms(points)
        codes = np.array([self.codes.get(v, -1) for v in labels], dtype=np.int64)
        exact = norms.max(initial=0) * self.norms.max(initial=0) < EXACT
        lo = windows.lo.astype(np.float64)
        hi = windows.hi.astype(np.float64)
        if exact:       # integers that doubles hold
            bounds = lo, hi
        else:
            bounds = windows.lo, windows.hi
        best = np.full((len(lo), want), -np.inf)
        home = route(self.tree, points)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def scan(leaf: int, some: np.ndarray) -> None:
            rows = self.leaves[leaf]
            anchors, back = np.unique(windows.which[some], return_inverse=True)
            if exact:
                scores = (points[anchors] @ self.rows[rows].T)[back]
            else:
                scores = (a[anchors].astype(object) @ self.x[rows].astype(object).T)[back]
            of = windows.which[some]
            fits = (codes[of][:, None] == self.labels[rows]) == same
            fits &= ids[of][:, None] != self.ids[rows]
            fits &= ((scores >= bounds[0][some][:, None]) & (scores <= bounds[1][some][:, None])).astype(bool)
            v, r = np.nonzero(fits)
            if not len(v):
                return
            found.append((some[v], rows[r], scores[v, r]))
            if exact:   # rows that score like the last wanted one may have a smaller id and stay
                seen = np.concatenate([best[some], np.where(fits, scores, -np.inf)], axis=1)
                best[some] = np.partition(seen, seen.shape[1] - want, axis=1)[:, -want:]
                lo[some] = np.maximum(lo[some], best[some].min(axis=1))

        def descend(node: Node | int, some: np.ndarray) -> None:
            if not len(some):
                return
            if not isinstance(node, Node):
                rest = some[home[windows.which[some]] != node]
                if len(rest):
                    scan(node, rest)
                return
            anchors, back = np.unique(windows.which[some], return_inverse=True)
            reach = node.reachable(points[anchors], norms[anchors], back, lo[some], hi[some])
            for j, child in enumerate(node.children):
                if reach[:, j].any():
                    descend(child, some[reach[:, j]])

        everything = np.flatnonzero(lo <= hi)
        homes = home[windows.which[everything]]
        for leaf in np.unique(homes).tolist():
            scan(leaf, everything[homes == leaf])
        descend(self.tree, everything)
        if not found:
            none = np.zeros(0, dtype=np.int64)
            return none, none, none
        v, r, s = (np.concatenate(c) for c in zip(*found))
        return self._first(v, r, s, want)

    def _first(self, v: np.ndarray, r: np.ndarray, s: np.ndarray, want: int):
        """The first ``want`` rows of every window, in order."""
        # Unbounded integers are ordered through their ranks.
        down = -s if s.dtype != object else np.unique(-s, return_inverse=True)[1]
        order = np.lexsort((self.ids[r], down, v))
        v, r, s = v[order], r[order], s[order]
        begins = np.flatnonzero(np.diff(v, prepend=-1))
        keep = np.arange(len(v)) - np.repeat(begins, np.diff(np.append(begins, len(v)))) < want
        return v[keep], r[keep], s[keep]


# ---- over the cluster --------------------------------------------------------------

def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    """Vectors as rows of integers, filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), dimension), dtype=np.int64)
    out[np.arange(dimension) < lengths[:, None]] = flat
    return out


def integer_rows(embeddings: DataFrame, label: Column, scale: float, id_col: str, vector_col: str) -> DataFrame:
    """Columns id, label and q of the rows that take part, each id once."""
    component = F.lit(float(scale))
    rows = embeddings.select(F.col(id_col).cast("bigint").alias("id"), label.cast("string").alias("label"),
                             F.col(vector_col).cast("array<double>").alias("x"))
    fits = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(component * v) < LARGEST))
    sound = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & fits)
    first = Window.partitionBy("id").orderBy("label", "x")
    return (sound.withColumn("r", F.row_number().over(first)).where("r = 1")
            .select("id", "label", F.transform("x", lambda v: F.floor(component * v)).alias("q")))


@dataclass
class Layout:
    """The laid-out tree, and over how many blocks each shard is dealt."""
    tree: Node | int
    dimension: int
    blocks: dict[int, int]


def _paths(tree: Node | int) -> dict[int, list[tuple[Node, int]]]:
    """Nodes and branches that lead to each shard."""
    out: dict[int, list[tuple[Node, int]]] = {}

    def walk(node: Node | int, path: list) -> None:
        if not isinstance(node, Node):
            out[node] = path
            return
        for j, child in enumerate(node.children):
            walk(child, [*path, (node, j)])

    walk(tree, [])
    return out


def _nodes(tree: Node | int) -> list[Node]:
    if not isinstance(tree, Node):
        return []
    return [tree] + [n for c in tree.children for n in _nodes(c)]


def _fit(rows: DataFrame, count: int, dimension: int) -> Node | int:
    """Split points, from a bounded sample in an order of the vectors' hashes."""
    levels = min(LEVELS, math.ceil(math.log(max(1.0, count / BLOCK_ROWS), FAN)))
    if not levels:
        return 0
    sample = rows.select("q").orderBy(F.xxhash64("q"), "q").limit(SAMPLE).toArrow().column("q").combine_chunks()
    x = np.unique(_matrix(sample, dimension).astype(np.float64), axis=0)
    x = x[np.random.default_rng(0).permutation(len(x))]
    return grow(x, leaf=4 * FAN, levels=levels)[0]


def _deal(rows: DataFrame, tree: Node | int, dimension: int) -> DataFrame:
    """Every row with its shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(2), dimension).astype(np.float64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(route(tree, x).astype(np.int32))],
                                             names=["id", "label", "q", "shard"])

    return rows.select("id", "label", "q").mapInArrow(
        releasing(run), "id bigint, label string, q array<bigint>, shard int")


def _take_ranges(sharded: DataFrame, tree: Node | int, dimension: int) -> None:
    """Set the ranges of the laid-out tree by all rows. Each task passes on its
    own ranges; a table of nodes x split points x subtrees reaches the driver."""
    nodes = _nodes(tree)
    if not nodes:
        return

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {id(n): i for i, n in enumerate(nodes)}
        mine = [Node.of(n.splits) for n in nodes]
        paths = {s: [(number[id(n)], j) for n, j in p] for s, p in _paths(tree).items()}
        for batch in batches:
            x = _matrix(batch.column(1), dimension).astype(np.float64)
            norms, shard = _norms(x), batch.column(0).to_numpy()
            taken = defaultdict(list)
            for s in np.unique(shard).tolist():
                rows = np.flatnonzero(shard == s)
                for n, j in paths[s]:
                    taken[n].append((rows, np.full(len(rows), j)))
            for n, parts in taken.items():
                rows, child = (np.concatenate(c) for c in zip(*parts))
                far = distances(x[rows], norms[rows], mine[n].splits, mine[n].norms)
                mine[n].widen(x[rows], norms[rows], far, child)
        for n, node in enumerate(mine):
            i, j = np.nonzero(node.high >= 0)
            columns = [np.full(len(i), n), i, j, node.low[i, j], node.high[i, j], node.least[j], node.most[j]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns],
                                             names=["node", "i", "j", "low", "high", "least", "most"])

    schema = "node bigint, i bigint, j bigint, low double, high double, least double, most double"
    ranges = (sharded.select("shard", "q").mapInArrow(releasing(run), schema).groupBy("node", "i", "j")
              .agg(F.min("low"), F.max("high"), F.min("least"), F.max("most"))).collect()
    for n in nodes:
        n.low[:], n.high[:], n.least[:], n.most[:] = np.inf, -np.inf, np.inf, -np.inf
    for n, i, j, low, high, least, most in ranges:
        nodes[n].low[i, j], nodes[n].high[i, j] = low, high
        nodes[n].least[j], nodes[n].most[j] = least, most


def _windows(scores: list | None, floors: list, low: int, high: int) -> list[tuple]:
    """(lo, hi) of an anchor: none at all without positives, else by their
    scores. ``floors``: what an earlier search found, per window."""
    if scores is None:
        bounds = [(-math.inf, math.inf)]
    else:
        bounds = [(-(-low * int(s) // 100), high * int(s) // 100) for s in scores]
    return [(lo if f is None else max(lo, int(f)), hi) for (lo, hi), f in zip(bounds, floors or [None] * len(bounds))]


def _gather(batch: pa.RecordBatch, low: int, high: int) -> Windows:
    which, lo, hi = [], [], []
    scores, floors = batch.column("scores").to_pylist(), batch.column("floors").to_pylist()
    for i, (s, f) in enumerate(zip(scores, floors)):
        for a, b in _windows(s, f, low, high):
            which.append(i)
            lo.append(a)
            hi.append(b)
    return Windows(np.array(which, dtype=np.int64), np.array(lo, dtype=object), np.array(hi, dtype=object))


@dataclass(frozen=True)
class Search:
    """One search: how many rows of a window, of the anchor's label or not."""
    want: int
    same: bool
    low: int
    high: int


def _visits(probes: DataFrame, layout: Layout, s: Search, others: bool) -> DataFrame:
    """Anchors with the shards they visit: their own, or all others that the
    ranges can't exclude."""
    tree, dimension = layout.tree, layout.dimension

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("q"), dimension).astype(np.float64)
            home = route(tree, x)
            if not others:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home.astype(np.int32))],
                                                 names=[*batch.schema.names, "shard"])
                continue
            w, norms = _gather(batch, s.low, s.high), _norms(x)
            lo, hi = w.lo.astype(np.float64), w.hi.astype(np.float64)
            visits = set()

            def descend(node: Node | int, some: np.ndarray) -> None:
                if not isinstance(node, Node):
                    visits.update((i, node) for i in np.unique(w.which[some]).tolist() if home[i] != node)
                elif len(some):
                    anchors, back = np.unique(w.which[some], return_inverse=True)
                    reach = node.reachable(x[anchors], norms[anchors], back, lo[some], hi[some])
                    for j, child in enumerate(node.children):
                        descend(child, some[reach[:, j]])

            descend(tree, np.flatnonzero(lo <= hi))
            if visits:
                i, shard = np.array(sorted(visits)).T
                yield pa.RecordBatch.from_arrays(
                    [*batch.take(pa.array(i)).columns, pa.array(shard.astype(np.int32))],
                    names=[*batch.schema.names, "shard"])

    return materialize(probes.mapInArrow(releasing(run), PROBE + ", shard int"), "visits")


PROBE = f"id bigint, label string, q array<bigint>, scores array<{SCORE}>, floors array<{SCORE}>"


def _search(visits: DataFrame, sharded: DataFrame, layout: Layout, s: Search) -> DataFrame:
    """Columns anchor, win (number of the window), id and score: of every
    block, the first rows of every window."""
    spark, dimension = sharded.sparkSession, layout.dimension
    slices = {r.shard: max(1, -(-r.n // PROBE_ROWS)) for r in visits.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    plan = spark.createDataFrame([(k, layout.blocks.get(k, 0), n) for k, n in slices.items()] or [(-1, 0, 1)],
                                 "shard int, blocks int, slices int").where("blocks > 0")
    plan = F.broadcast(plan)
    none = F.lit(None).cast(f"array<{SCORE}>")
    rows = sharded.join(plan, "shard").select(
        "shard", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), F.lit(0).alias("kind"),
        "id", "label", "q", none.alias("scores"), none.alias("floors"))
    probes = visits.join(plan, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("id"), F.col("slices")).cast("int").alias("slice"), F.lit(1).alias("kind"),
        "id", "label", "q", "scores", "floors")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key, block = None, None

        for (*at, kind), rows in key_slices(batches, 4):
            if at != key:
                key, block, held = at, None, []
            if kind == 0:
                held.append(rows)
                continue
            if block is None:
                home = pa.Table.from_batches(held).combine_chunks() if held else None
                if home is None:
                    continue
                block = Block(home.column("id").to_numpy(), home.column("label").to_pylist(),
                              _matrix(home.column("q").combine_chunks(), dimension))
                held = []
            for x in range(0, rows.num_rows, TOGETHER):
                some = rows.slice(x, TOGETHER)
                windows = _gather(some, s.low, s.high)
                ids = some.column("id").to_numpy()
                v, r, score = block.search(ids, some.column("label").to_pylist(),
                                           _matrix(some.column("q"), dimension), windows, s.want, s.same)
                if len(v):
                    of = windows.which[v]
                    first = np.searchsorted(windows.which, of)
                    whole = [Decimal(int(c)) for c in score]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[of]), pa.array((v - first).astype(np.int32)), pa.array(block.ids[r]),
                         pa.array(whole, pa.decimal128(38, 0))], names=["anchor", "win", "id", "score"])

    cells = ["shard", "block", "slice"]
    return (rows.union(probes).repartition(*cells).sortWithinPartitions(*cells, "kind")
            .mapInArrow(releasing(run), f"anchor bigint, win int, id bigint, score {SCORE}"))


def _first(found: DataFrame, want: int) -> DataFrame:
    order = Window.partitionBy("anchor", "win").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= want)


def _both(probes: DataFrame, sharded: DataFrame, layout: Layout, s: Search, name: str) -> DataFrame:
    """The first rows of every window: own shard, then what that can't rule out."""
    own = materialize(_first(_search(_visits(probes, layout, s, False), sharded, layout, s), s.want), name)
    last = (own.where(F.col("rank") == s.want).groupBy("anchor")
            .agg(F.map_from_entries(F.collect_list(F.struct("win", "score"))).alias("last"))
            .withColumnRenamed("anchor", "id"))
    windows = F.when(F.col("scores").isNull(), 1).otherwise(F.size("scores"))
    floors = F.transform(F.sequence(F.lit(0), F.greatest(windows, F.lit(1)) - 1), lambda i: F.col("last")[i])
    bounded = probes.join(last, "id", "left").select("id", "label", "q", "scores", floors.alias("floors"))
    rest = _search(_visits(bounded, layout, s, True), sharded, layout, s)
    return _first(own.drop("rank").union(rest), s.want)


def _long(score: str) -> Column:
    least, most = F.lit(-LONG - 1), F.lit(LONG)
    return F.greatest(least, F.least(most, F.col(score))).cast("bigint").alias(score)


def hard_negatives(embeddings: DataFrame, is_anchor: Column, label: Column | None = None, positives: int = 5,
                   negatives: int = 10, low: int = 30, high: int = 90, scale: float = 256.0,
                   id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """For the rows where ``is_anchor`` (over column ``id``) holds: anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score. Components
    become floor(scale * x). A negative's score is from ``low`` to ``high``
    hundredths of the positive's."""
    ship(embeddings.sparkSession)
    rows = materialize(integer_rows(embeddings, F.col("label") if label is None else label, scale, id_col,
                                    vector_col), "vectors")
    count, dimension = rows.agg(F.count(F.lit(1)), F.max(F.size("q"))).first()
    dimension = max(1, dimension or 1)
    tree = _fit(rows, count, dimension)
    like = Window.partitionBy("label", "q").orderBy("id")
    useful = rows.withColumn("r", F.row_number().over(like)).where(F.col("r") <= max(positives + 1, negatives))
    sharded = materialize(_deal(useful, tree, dimension), "shards")
    _take_ranges(sharded, tree, dimension)
    sizes = sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()
    layout = Layout(tree, dimension, {r.shard: -(-r.n // BLOCK_ROWS) for r in sizes})

    none = F.lit(None).cast(f"array<{SCORE}>")
    anchors = rows.where(is_anchor).select("id", "label", "q", none.alias("scores"), none.alias("floors"))
    near = materialize(_both(anchors, sharded, layout, Search(positives, True, low, high), "own_positives"),
                       "positives")
    by = near.groupBy(F.col("anchor").alias("id")).agg(F.transform(
        F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda p: p["score"]).alias("scores"))
    asking = anchors.drop("scores").join(by, "id").select("id", "label", "q", "scores", "floors")
    mined = _both(asking, sharded, layout, Search(negatives, False, low, high), "own_negatives")
    pairs = near.select("anchor", (F.col("rank") - 1).alias("win"), F.col("id").alias("positive_id"),
                        F.col("score").alias("positive_score"))
    return mined.join(pairs, ["anchor", "win"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", "rank", F.col("id").alias("negative_id"),
        _long("positive_score"), _long("score").alias("negative_score"))
