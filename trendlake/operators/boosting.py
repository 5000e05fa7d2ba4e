"""Gradient boosting of regression trees by histograms.

The settings are the reference booster's: rows sampled per tree, columns
sampled per tree, an L2 term, squared error. Features are cut into quantile
bins once. A level of a tree is one job: every task sums gradients and counts
by (node, feature, bin) over its blocks of rows, the sums of a feature are
merged on executors, and the driver reads the best split of each node and
feature: some kilobytes a job, whatever the data and the number of tasks. Five
levels are five jobs a round.

Sums are of whole numbers (gradients in fixed point), bins come from exact
counts, rows are sampled by a hash of their key: the same rows give the same
model on any number of cores, partitions and attempts. Rows are kept as packed
blocks; trees grown since the last pass over the blocks are applied on the way,
so the kept state is rewritten only every ``APPLY_EVERY`` rounds. The passes
are RDD jobs: at a thousand jobs a model, planning each as a query would take
longer than its work.

Several models grow at once: each takes the rows up to a date of its own.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import GBT_PARAMS
from ..session import shared_path, ship
from .features import FEATURE_COLS

APPLY_EVERY = 10
BLOCK_ROWS = 1 << 16
DISTINCT = 1 << 16      # values of a feature that quantiles are taken from, at most
LEAST_GAIN = 1e-6
EPOCH = dt.date(1970, 1, 1).toordinal()


@dataclass(frozen=True)
class Settings:
    rounds: int = GBT_PARAMS["maxIter"]
    depth: int = GBT_PARAMS["maxDepth"]
    rate: float = GBT_PARAMS["stepSize"]
    rows: float = GBT_PARAMS["subsamplingRate"]
    columns: float = float(GBT_PARAMS["featureSubsetStrategy"])
    seed: int = GBT_PARAMS["seed"]
    l2: float = 1.0
    bins: int = 256


@dataclass
class Tree:
    """A node's children are 2i + 1 and 2i + 2; feature -1 ends a path."""
    feature: np.ndarray
    bin: np.ndarray         # the left child takes bins up to this one
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> "Tree":
        size = (2 << depth) - 1
        return cls(np.full(size, -1, dtype=np.int64), np.zeros(size, dtype=np.int64), np.zeros(size))

    def nodes(self, bins: np.ndarray, levels: int) -> np.ndarray:
        node = np.zeros(len(bins), dtype=np.int64)
        rows = np.arange(len(bins))
        for _ in range(levels):
            f = self.feature[node]
            right = bins[rows, f] > self.bin[node]
            node = np.where(f >= 0, 2 * node + 1 + right, node)
        return node


@dataclass
class Booster:
    """A fitted model. ``cuts``: per feature the values that begin a bin."""
    cuts: list[np.ndarray]
    base: float
    depth: int
    trees: list[Tree] = field(default_factory=list)

    def predict(self, x: np.ndarray) -> np.ndarray:
        bins = to_bins(x, self.cuts)
        out = np.full(len(x), self.base)
        for t in self.trees:
            out += t.value[t.nodes(bins, self.depth)]
        return out

    def save(self, spark: SparkSession, path: str) -> None:
        """Cuts and nodes as a table: (kind, round, node, feature, bin, value)."""
        rows = [("base", self.depth, 0, 0, 0, self.base)]
        rows += [("cut", 0, i, f, 0, float(v)) for f, cuts in enumerate(self.cuts) for i, v in enumerate(cuts)]
        rows += [("node", r, i, int(t.feature[i]), int(t.bin[i]), float(t.value[i]))
                 for r, t in enumerate(self.trees) for i in range(len(t.feature))]
        spark.createDataFrame(rows, MODEL).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Booster":
        rows = spark.read.schema(MODEL).parquet(path).orderBy("kind", "round", "feature", "node").collect()
        base = next(r for r in rows if r.kind == "base")
        cuts: list[list[float]] = [[] for _ in FEATURE_COLS]
        for r in rows:
            if r.kind == "cut":
                cuts[r.feature].append(r.value)
        model = cls([np.array(c) for c in cuts], base.value, base.round)
        for r in rows:
            if r.kind == "node":
                while len(model.trees) <= r.round:
                    model.trees.append(Tree.empty(model.depth))
                t = model.trees[r.round]
                t.feature[r.node], t.bin[r.node], t.value[r.node] = r.feature, r.bin, r.value
        return model


MODEL = "kind string, round int, node int, feature int, bin int, value double"


# ---- bins --------------------------------------------------------------------

def to_bins(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    out = np.empty(x.shape, dtype=np.uint8)
    for f, c in enumerate(cuts):
        out[:, f] = np.searchsorted(c, x[:, f], side="right")
    return out


def quantile_cuts(values: np.ndarray, counts: np.ndarray, bins: int) -> np.ndarray:
    """Values that begin a bin: all but the first, or those at equal ranks."""
    order = np.argsort(values)
    values, upto = values[order], np.cumsum(counts[order])
    if len(values) <= bins:
        return values[1:].astype(np.float64)
    ranks = upto[-1] * np.arange(1, bins) // bins
    return np.unique(values[np.searchsorted(upto, ranks, side="right")]).astype(np.float64)


def feature_cuts(features: DataFrame, bins: int) -> list[np.ndarray]:
    """Cuts of all features from exact counts of their values. All features
    are whole numbers; one with too wide a range is counted in steps of a
    power of two."""
    wide = features.agg(*[F.max(F.abs(F.col(c))).alias(c) for c in FEATURE_COLS]).first()
    steps = [max(0, int(wide[c] or 0).bit_length() - DISTINCT.bit_length() + 2) for c in FEATURE_COLS]
    pairs = F.array(*[F.struct(F.lit(i).alias("f"), F.shiftright(F.col(c).cast("bigint"), s).alias("v"))
                      for i, (c, s) in enumerate(zip(FEATURE_COLS, steps))])
    rows = features.select(F.explode(pairs).alias("p")).groupBy("p.f", "p.v").agg(F.count(F.lit(1)).alias("n")).collect()
    out = []
    for i, s in enumerate(steps):
        mine = [(r.v << s, r.n) for r in rows if r.f == i]
        values, counts = (np.array(c, dtype=np.int64) for c in zip(*mine)) if mine else (np.zeros(0, np.int64),) * 2
        out.append(quantile_cuts(values, counts, bins))
    return out


# ---- blocks of rows ----------------------------------------------------------

@dataclass
class Block:
    key: np.ndarray         # hash of the row, for sampling
    bins: np.ndarray
    y: np.ndarray
    day: np.ndarray
    pred: np.ndarray        # models x rows


def _blocks(features: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                yield packed(batch.slice(at, BLOCK_ROWS))

    def packed(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.stack([batch.column(c).to_numpy() for c in range(3, 3 + len(cuts))], axis=1)
        columns = [batch.column(0).to_numpy(), to_bins(x, cuts), batch.column(1).to_numpy().astype(np.float64),
                   batch.column(2).to_numpy().astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in columns],
                                          names=["key", "bins", "y", "day"])

    rows = features.select(
        F.xxhash64("group_id", "published_date"), F.col("target").cast("double"),
        F.datediff("published_date", F.lit("1970-01-01").cast("date")), *[F.col(c).cast("double") for c in FEATURE_COLS])
    return rows.mapInArrow(run, "key binary, bins binary, y binary, day binary")


def _sampled(key: np.ndarray, share: float, seed: int, round_: int) -> np.ndarray:
    """Which rows a round takes: by a hash of key, seed and round."""
    x = key.view(np.uint64) + np.uint64((seed * 1_000_003 + round_ * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) >> np.uint64(11) < np.uint64(int(share * 2**53))


def _apply(block: Block, trees: list[list[Tree]], depth: int) -> np.ndarray:
    pred = block.pred.copy()
    for m, grown in enumerate(trees):
        for t in grown:
            pred[m] += t.value[t.nodes(block.bins, depth)]
    return pred


def histogram(blocks: Iterator[Block], trees: list[list[Tree]], growing: list[Tree], level: int, until: list[int],
              columns: np.ndarray, s: Settings, round_: int, scale: float, widths: list[int]) -> list[np.ndarray]:
    """Of each sampled column models x nodes of the level x bins x (gradient,
    rows). ``widths``: the bins of every feature."""
    width = 1 << level
    total = [np.zeros((len(until), width, widths[f], 2), dtype=np.int64) for f in columns]
    for block in blocks:
        pred = _apply(block, trees, s.depth)
        taken = _sampled(block.key, s.rows, s.seed, round_)
        for m, last in enumerate(until):
            node = growing[m].nodes(block.bins, level) - (width - 1)
            rows = np.flatnonzero(taken & (block.day <= last) & (node >= 0))
            gradient = np.rint((pred[m, rows] - block.y[rows]) * scale)
            for sums, f in zip(total, columns):
                code = node[rows] * widths[f] + block.bins[rows, f]
                for part, weights in enumerate((gradient, None)):
                    sums[m, ..., part] += np.bincount(code, weights, minlength=width * widths[f]).reshape(
                        width, widths[f]).astype(np.int64)
    return total


def best_splits(sums: np.ndarray, l2: float) -> np.ndarray:
    """Of one feature's nodes x bins x (gradient, rows) per node: bin and gain
    of the best split (ties: first bin), what goes left (gradient, rows), and
    all of the node (gradient, rows)."""
    left = np.cumsum(sums, axis=1)
    whole = left[:, -1:, :]
    right = whole - left

    def weight(x: np.ndarray) -> np.ndarray:
        return x[..., 0] ** 2 / (x[..., 1] + l2)

    gain = weight(left) + weight(right) - weight(whole)
    gain = np.where((left[..., 1] >= 1) & (right[..., 1] >= 1), gain, -np.inf)
    cut = gain.argmax(axis=1)
    nodes = np.arange(len(sums))
    return np.column_stack([cut, gain[nodes, cut], left[nodes, cut], sums.sum(axis=1)])


def _grow(tree: Tree, splits: np.ndarray, level: int, columns: np.ndarray, s: Settings) -> None:
    """Split the nodes of a level, or end them, and set the values below.
    ``splits``: columns x nodes x what ``best_splits`` says (ties: first
    column)."""
    first = (1 << level) - 1
    column = splits[:, :, 1].argmax(axis=0)
    best = splits[column, np.arange(1 << level)]
    cut, gain, left, whole = best[:, 0].astype(np.int64), best[:, 1], best[:, 2:4], splits[0, :, 4:]
    for i in range(1 << level):
        node = first + i
        if whole[i, 1] == 0:
            continue
        if not level:
            tree.value[0] = -s.rate * whole[i, 0] / (whole[i, 1] + s.l2)
        if gain[i] <= LEAST_GAIN:
            continue
        tree.feature[node], tree.bin[node] = columns[column[i]], cut[i]
        for child, (g, n) in ((2 * node + 1, left[i]), (2 * node + 2, whole[i] - left[i])):
            tree.value[child] = -s.rate * g / (n + s.l2)


def fit(features: DataFrame, settings: Settings = Settings(), until: Sequence[dt.date] | None = None) -> list[Booster]:
    """Models over ``features`` (as of ``lag_features``): one for all rows, or
    one for the rows up to each date of ``until``; bins then come from the rows
    up to the first date. No rows: the model says zero."""
    spark, s = features.sparkSession, settings
    ship(spark)
    days = [d.toordinal() - EPOCH for d in until] if until else [np.iinfo(np.int32).max]
    seen = features.where(F.col("published_date") <= max(until)) if until else features
    cuts = feature_cuts(seen.where(F.col("published_date") <= min(until)) if until else seen, s.bins)
    day = F.datediff("published_date", F.lit("1970-01-01").cast("date"))
    y = F.col("target").cast("double")
    told = seen.agg(F.min(y), F.max(y), F.count(F.lit(1)), *[F.avg(F.when(day <= d, F.col("target"))) for d in days]).first()
    low, high, count = told[0] or 0.0, told[1] or 0.0, told[2]
    models = [Booster(cuts, float(b or 0.0), s.depth) for b in told[3:]]
    if not count:
        return models
    # Fixed point: sums of a block stay below 2^53, all sums below 2^62.
    reach = math.ceil(math.log2(2 * (high - low) + 2))
    scale = 2.0 ** min(30, 52 - reach - BLOCK_ROWS.bit_length(), 61 - reach - count.bit_length())
    path = shared_path(spark, "boosting")
    _blocks(seen, cuts).write.parquet(path)
    width, bases = len(FEATURE_COLS), [m.base for m in models]

    def unpacked(r) -> Block:
        key, y = np.frombuffer(r.key, dtype=np.int64), np.frombuffer(r.y, dtype=np.float64)
        return Block(key, np.frombuffer(r.bins, dtype=np.uint8).reshape(-1, width), y,
                     np.frombuffer(r.day, dtype=np.int32), np.repeat(np.array(bases)[:, None], len(y), axis=1))

    table = spark.read.schema("key binary, bins binary, y binary, day binary").parquet(path)
    blocks = table.rdd.map(unpacked).persist(StorageLevel.MEMORY_AND_DISK)
    parts = blocks.getNumPartitions()
    widths = [len(c) + 1 for c in cuts]
    pending: list[list[Tree]] = [[] for _ in models]
    try:
        for r in range(s.rounds):
            rng = np.random.default_rng([s.seed, r])
            columns = np.sort(rng.choice(width, max(1, int(s.columns * width)), replace=False))
            growing = [Tree.empty(s.depth) for _ in models]
            for level in range(s.depth):
                splits = _splits(blocks, parts, (pending, growing, level, days, columns, s, r, scale, widths))
                for m, tree in enumerate(growing):
                    _grow(tree, splits[:, m], level, columns, s)
            for m, tree in enumerate(growing):
                models[m].trees.append(tree)
                pending[m].append(tree)
            if len(pending[0]) == APPLY_EVERY and r + 1 < s.rounds:
                blocks = _applied(blocks, pending, s.depth)
                pending = [[] for _ in models]
    finally:
        blocks.unpersist()
    return models


def _splits(blocks, parts: int, arguments: tuple) -> np.ndarray:
    """Columns x models x nodes x the best split of this column. The sums of a
    column are merged in one task of their own."""
    *_, columns, s, _, scale, _ = arguments

    def run(part: Iterator[Block]) -> Iterator[tuple[int, np.ndarray]]:
        yield from enumerate(histogram(part, *arguments))

    def best(column: tuple[int, np.ndarray]) -> tuple[int, np.ndarray]:
        at, sums = column
        return at, np.stack([best_splits(x / np.array([scale, 1.0]), s.l2) for x in sums])

    sums = blocks.mapPartitions(run)
    if parts > 1:
        sums = sums.reduceByKey(np.add, numPartitions=len(columns), partitionFunc=int)
    found = dict(sums.map(best).collect())
    return np.stack([found[at] for at in range(len(columns))])


def _applied(blocks, trees: list[list[Tree]], depth: int):
    """The blocks with the trees in their predictions, kept in place of the
    former ones (which a lost executor computes again)."""
    def run(block: Block) -> Block:
        return Block(block.key, block.bins, block.y, block.day, _apply(block, trees, depth))

    new = blocks.map(run).persist(StorageLevel.MEMORY_AND_DISK)
    new.count()
    blocks.unpersist()
    return new


def with_predictions(model: Booster, rows: DataFrame, column: str = "prediction") -> DataFrame:
    """``rows`` (with the feature columns) and the model's answer for each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(c).cast(pa.float64()).to_numpy() for c in FEATURE_COLS], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.predict(x))],
                                             names=[*batch.schema.names, column])

    ship(rows.sparkSession)
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(column, T.DoubleType())]))
