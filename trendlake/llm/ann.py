"""Nearest neighbours by multiprobe p-stable hashing.

Vectors are turned into unit vectors whose Euclidean order is the order by
inner product (norms above are scaled to one, the rest goes into an extra
component). Each table projects them on a few Gaussian directions, made
orthogonal, and cuts the projections into slots: a bucket is a cell of slots.
A first pass guesses from a bounded sample how near the last wanted neighbour
may be; the Gaussian model then gives every bucket the probability that such a
neighbour lies there. Buckets are visited in that order until the wanted
success is reached. The score of its k-th best row so far then bounds how far
the last wanted neighbour of this very query is: in a second pass a query
visits what it has not visited of the buckets that this needs, so that queries outside
of dense groups are not held to the nearness of those inside. The candidates of
all tables are merged; scores are inner products of the original vectors in
double precision.

A bucket of many rows is split into parts of ``PART_ROWS``; a query visits all
parts. Of equal vectors only the ``k`` + 1 of smallest ids can be among the
nearest, the rest is not indexed (it still queries): this loses nothing.

Recall follows the wanted success. Vectors without any structure have no near
buckets, and most buckets must then be visited.

Defined results: rows whose id or vector is null, or whose vector is empty,
zero or holds null or non-finite components, take no part; of vectors of
several lengths only the most frequent length takes part (ties: the shorter);
rows that repeat an id count once, with their best score; ties go to the
smaller id; a query that finds fewer than ``k`` visits all buckets, so that
fewer candidates than ``k`` are all returned; an empty table gives an empty table; other columns of the input are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, ship

PART_ROWS = 4096
SAMPLE = 2048           # rows that tell how near neighbours are
SAMPLE_QUERIES = 64
QUERY_CHUNK = 512
SPARE = 12              # beyond k, kept before the exact order


@dataclass(frozen=True)
class Tables:
    """Hash tables. Coordinates are scaled so that a projection of a random
    unit vector has variance one."""
    directions: np.ndarray     # tables x hashes x (dimension + 1)
    shifts: np.ndarray         # tables x hashes
    width: float
    reach: int                 # slots on either side of zero

    @property
    def slots(self) -> int:
        return 2 * self.reach

    def project(self, table: int, x: np.ndarray) -> np.ndarray:
        return x @ self.directions[table].T

    def buckets(self, table: int, x: np.ndarray) -> np.ndarray:
        cell = np.floor((self.project(table, x) + self.shifts[table]) / self.width)
        cell = np.clip(cell + self.reach, 0, self.slots - 1).astype(np.int64)
        return cell @ (self.slots ** np.arange(cell.shape[1]))


def make_tables(dimension: int, tables: int, hashes: int, width: float, seed: int) -> Tables:
    rng = np.random.default_rng(seed)
    d = dimension + 1
    hashes = min(hashes, d)
    directions = np.stack([np.linalg.qr(rng.normal(size=(d, hashes)))[0].T * math.sqrt(d)
                           for _ in range(tables)])
    shifts = rng.uniform(0, width, size=(tables, hashes))
    # beyond 6 deviations the outermost slot holds everything
    return Tables(directions, shifts, width, int(math.ceil(6 / width)) + 1)


_erf = np.vectorize(math.erf, otypes=[float])


def _below(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + _erf(x / math.sqrt(2)))


def probe_order(t: Tables, table: int, projected: np.ndarray, near: float, success: float
                ) -> np.ndarray:
    """Buckets of one query, by the probability that a neighbour of cosine
    ``near`` lies there, until their sum reaches ``success``."""
    edges = (np.arange(t.slots + 1) - t.reach) * t.width
    spread = math.sqrt(max(1 - near * near, 1e-6))
    total = np.ones(1)
    for k in range(len(projected) - 1, -1, -1):
        cuts = _below((edges - t.shifts[table][k] - near * projected[k]) / spread)
        cuts[0], cuts[-1] = 0.0, 1.0
        total = (total[:, None] * np.diff(cuts)[None, :]).reshape(-1)
    order = np.argsort(-total, kind="stable")
    return order[:int(np.searchsorted(np.cumsum(total[order]), success)) + 1]


def _unit(x: np.ndarray, norm: float) -> np.ndarray:
    """Data vectors in one more dimension, of length one."""
    y = x / norm
    rest = np.sqrt(np.maximum(0.0, 1.0 - (y * y).sum(axis=1)))
    return np.column_stack([y, rest])


def _unit_query(x: np.ndarray) -> np.ndarray:
    return np.column_stack([x / np.linalg.norm(x, axis=1, keepdims=True), np.zeros(len(x))])


def _sound(x: Column) -> Column:
    """No null or non-finite component, and not all zero."""
    limit = F.lit(float("inf"))
    return (F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < limit)),
                       F.lit(False))
            & F.exists(x, lambda v: v != 0))


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, dimension)


def _pack(x: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in np.ascontiguousarray(x, dtype="<f8")], pa.binary())


def nearness(vectors: DataFrame, rows: int, dimension: int, k: int, norm: float) -> float:
    """Cosine, in hashing space, that the last wanted neighbour reaches for
    three queries in four, from a bounded sample of rows."""
    sample = [r.x for r in vectors.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("x").collect()]
    x = np.array(sample, dtype=float).reshape(-1, dimension)
    if len(x) < 2:
        return 0.0
    data, queries = _unit(x, norm), _unit_query(x[:SAMPLE_QUERIES])
    cosines = queries @ data.T
    cosines[np.arange(len(queries)), np.arange(len(queries))] = -2
    place = min(max(1, math.ceil(k * len(x) / rows)), len(x) - 1)
    last = -np.sort(-cosines, axis=1)[:, place - 1]
    return float(np.clip(np.quantile(last, 0.25), 0.0, 0.99))


def _nearest(queries: np.ndarray, query_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int):
    """Best ``k`` of one part for each query, exactly ordered: scores are
    summed the same way for every pair, so equal vectors tie."""
    for at in range(0, len(queries), QUERY_CHUNK):
        q, qid = queries[at:at + QUERY_CHUNK], query_ids[at:at + QUERY_CHUNK]
        rough = q @ x.T
        rough[qid[:, None] == ids[None, :]] = -np.inf
        n = rough.shape[1]
        if n > k + SPARE:
            last = np.partition(rough, n - k, axis=1)[:, n - k]
            slack = 1e-9 * (1 + np.abs(last))
            keep = rough >= (last - slack)[:, None]
        else:
            keep = np.ones(rough.shape, dtype=bool)
        keep &= rough > -np.inf
        i, j = np.nonzero(keep)
        score = np.concatenate([(q[i[s:s + 65536]] * x[j[s:s + 65536]]).sum(axis=1)
                                for s in range(0, len(i), 65536)]) if len(i) else np.zeros(0)
        order = np.lexsort((ids[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        first = np.searchsorted(i, np.arange(len(q)))
        best = np.arange(len(i)) - first[i] < k
        yield qid[i[best]], ids[j[best]], score[best]


def _search(batches: Iterator[pa.RecordBatch], dimension: int, k: int) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by part, its data rows before its queries. The data
    rows of one part (bounded) are held, queries pass in chunks."""
    part, xs, ids = None, [], []
    x, known = np.zeros((0, dimension)), np.zeros(0, dtype=np.int64)
    for batch in batches:
        keys = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)])
        visit = batch.column(3).to_numpy(zero_copy_only=False)
        who = batch.column(4).to_numpy(zero_copy_only=False)
        values = np.frombuffer(b"".join(batch.column(5).to_pylist()), dtype="<f8").reshape(-1, dimension)
        change = (keys[1:] != keys[:-1]).any(axis=1) | (visit[1:] != visit[:-1])
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(keys)]
        out: list[tuple] = []
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if part != tuple(keys[a]):
                part, xs, ids = tuple(keys[a]), [], []
                x, known = np.zeros((0, dimension)), np.zeros(0, dtype=np.int64)
            if not visit[a]:
                xs.append(values[a:b])
                ids.append(who[a:b])
                continue
            if xs:
                x, known = np.concatenate([x, *xs]), np.concatenate([known, *ids])
                xs, ids = [], []
            if len(x):
                out += _nearest(values[a:b], who[a:b], x, known, k)
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([o[n] for o in out])) for n in range(3)],
                names=["query_id", "vec_id", "score"])


def nearest_neighbours(embeddings: DataFrame, is_query: Column, k: int = 20, tables: int = 2,
                       hashes: int = 3, width: float = 1.2, success: float = 0.95, seed: int = 11,
                       id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``is_query`` is a condition on the column ``id`` (a bigint). Columns:
    ``query_id``, ``rank``, ``vec_id``, ``score``."""
    spark = embeddings.sparkSession
    ship(spark)
    rows = (embeddings.select(F.col(id_col).cast("bigint").alias("id"),
                              F.col(vector_col).cast("array<double>").alias("x"))
            .where(F.col("id").isNotNull() & _sound(F.col("x"))))
    norm2 = F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v)
    kinds = (rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"),
                                                     F.max(norm2).alias("m"))
             .orderBy(F.desc("n"), "d").limit(1).collect())
    if not kinds:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    d, n, norm = kinds[0].d, kinds[0].n, math.sqrt(kinds[0].m)
    rows = rows.where(F.size("x") == d)
    near = nearness(rows, n, d, k, norm)
    hashed = make_tables(d, tables, hashes, width, seed)
    each = 1 - (1 - success) ** (1 / tables)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), d)
            unit, packed = _unit(x, norm), _pack(x)
            for t in range(tables):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), t, dtype=np.int32)), pa.array(hashed.buckets(t, unit)),
                     batch.column(0), packed], names=["t", "bucket", "id", "x"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``score``: of the k-th best row so far (NaN in the first pass, null
        if there were fewer, which visits all buckets of one table)."""
        for batch in batches:
            x = _matrix(batch.column(1), d)
            score = batch.column(2).to_numpy(zero_copy_only=False)
            missing = batch.column(2).is_null().to_numpy(zero_copy_only=False)
            own = np.clip(score / (norm * np.linalg.norm(x, axis=1)), 0.0, 0.99)
            for t in range(tables):
                projected = hashed.project(t, _unit_query(x))
                visits = []
                for i, p in enumerate(projected):
                    if missing[i]:
                        visits.append(np.arange(hashed.slots ** len(p) if t == 0 else 0))
                        continue
                    first = probe_order(hashed, t, p, near, each)
                    if not np.isnan(score[i]):
                        first = np.setdiff1d(probe_order(hashed, t, p, own[i], each), first)
                    visits.append(first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), t, dtype=np.int32)),
                     pa.array(visits, pa.list_(pa.int64())), batch.column(0), _pack(x)],
                    names=["t", "buckets", "id", "x"])

    same = Window.partitionBy("x").orderBy("id")
    able = rows.withColumn("r", F.dense_rank().over(same)).where(F.col("r") <= k + 1).select("id", "x")
    placed = able.mapInArrow(place, "t int, bucket bigint, id bigint, x binary")
    parts = (placed.groupBy("t", "bucket").agg(F.count(F.lit(1)).alias("n"))
             .select("t", "bucket", F.ceil(F.col("n") / PART_ROWS).cast("int").alias("parts")))
    # at most tables x slots ** hashes buckets: bounded by the settings
    parts = F.broadcast(parts)
    data = (placed.join(parts, ["t", "bucket"])
            .select("t", "bucket", F.pmod(F.xxhash64("id"), "parts").cast("int").alias("part"),
                    F.lit(False).alias("visit"), "id", "x"))

    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def best(found: DataFrame) -> DataFrame:
        merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        return (merged.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
                .select("query_id", "rank", "vec_id", "score"))

    def search(asked: DataFrame) -> DataFrame:
        queries = (asked.mapInArrow(probe, "t int, buckets array<bigint>, id bigint, x binary")
                   .select("t", F.explode("buckets").alias("bucket"), "id", "x")
                   .join(parts, ["t", "bucket"])
                   .select("t", "bucket", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                           F.lit(True).alias("visit"), "id", "x"))
        found = (data.unionByName(queries).repartition("t", "bucket", "part")
                 .sortWithinPartitions("t", "bucket", "part", "visit")
                 .mapInArrow(lambda it: _search(it, d, k), "query_id bigint, vec_id bigint, score double"))
        return best(found.repartition("query_id"))

    asked = rows.where(is_query)
    first = materialize(search(asked.withColumn("score", F.lit(float("nan")))), "neighbours")
    # A query whose buckets held too few rows has no score of place k.
    last = (first.where(F.col("rank") == k)
            .select(F.col("query_id").alias("id"), "score"))
    again = materialize(search(asked.join(last, "id", "left")), "further")
    columns = ["query_id", "vec_id", "score"]
    return best(first.select(*columns).unionByName(again.select(*columns)))
