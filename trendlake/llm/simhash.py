"""SimHash near-duplicates, found with vantage-point trees.

Fingerprints (64 bits) are made of XXH64 shingle hashes. Distinct fingerprints
are the points. The top of the tree is laid out over the cluster: at each of
its levels a vantage point and a set of bit positions of its own give a
Hamming distance, and every distance is a branch. A shard is a path of such
distances. Levels look at disjoint bits, so the triangle bounds of all levels
add up: two points within ``radius`` bits lie on paths whose distances differ
by ``radius`` in sum at most. A point therefore queries its own shard and the
shards over that boundary only, half of them, as the other half queries it.

Inside a shard a local vantage-point tree (median split, triangle bounds)
finds the exact pairs, which are merged into stars at once: a shard emits one
edge for each point at most, never all pairs of a dense group. Stars of
different shards are joined by connected components.

Near copies (``near_copies``) differ in 4 to 14 of 64 bits at a Jaccard
similarity of 0.8, where no such tree prunes. They are searched by a longer
fingerprint, cut into 24 half words of 32 bits with seeds of their own: a pair
is a candidate if one half word differs in two bits at most, and links if the
similarity of the shingle sets, computed exactly, reaches the threshold. Likely
candidates come first (a dense group makes a bounded number of them a row); all
others between sets that these have not linked follow, pruned by bounds that
lose no link: set sizes and a parity sketch.

Defined results: a null text counts as empty; a text without words has
fingerprint zero and links like any other; fewer words than a shingle: the
whole sequence is the one shingle; copies share a fingerprint and so a
component; a null id is never the smallest (a component of null ids only has a
null component id); repeated rows are returned each; an empty table gives an
empty table; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, releasing, ship
from .components import components

SEED = 42
LEVELS = 4              # levels laid out over the cluster, 16 bits each
SAMPLE = 512            # points among which vantage points are chosen
BLOCK = 1 << 16         # pairs compared at once in a leaf
WIDE = 12               # words of 64 bits of the fingerprint that near copies are searched by
NEAR = 2                # differing bits of a half word, at most
PARTS = (0x7FF, 0x3FF800, 0xFFC00000)   # of a half word: one more than NEAR
FAR = 20                # differing bits of 64 others of likely candidates: 9.7 expected at a similarity of 0.8
BESIDE = 4              # neighbours compared first among equal half words
SKETCH = 8              # words of 64 bits of the parity sketch of a set


def _hashes(parts: list[bytes], words: int) -> Iterator[np.ndarray]:
    """Hashes of the shingles of a text's words, in blocks."""
    joined = b" ".join(parts)
    digest = xxhash.xxh64_intdigest
    if len(parts) <= words:
        yield np.array([digest(joined, SEED)], dtype="<u8")
        return
    ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    total = len(parts) - words + 1
    for at in range(0, total, BLOCK):
        upto = min(at + BLOCK, total)
        spans = zip(starts[at:upto].tolist(), ends[at + words - 1:upto + words - 1].tolist())
        yield np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")


def fingerprint(text: str | None, words: int) -> int:
    """SimHash of the word shingles of one text."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(b" ".join(parts), SEED)
    counts = np.zeros(64, dtype=np.int64)
    for hashes in _hashes(parts, words):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    total = len(parts) - words + 1
    return int(sum(1 << i for i in np.flatnonzero(counts * 2 > total).tolist()))


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Columns ``doc`` and ``fp`` (the 64 bits as a signed long)."""
    ship(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((fingerprint(t.as_py(), words) for t in batch.column(1)),
                                 dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints.view(np.int64))], names=["doc", "fp"])

    return docs.select(id_col, text_col).mapInArrow(releasing(run), f"doc {id_type}, fp bigint")


def _masks(levels: int) -> list[int]:
    width = 64 // levels
    return [(((1 << width) - 1) << (i * width)) for i in range(levels)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def vantage_point(points: DataFrame, levels: int = LEVELS) -> int:
    """One 64-bit word that holds the vantage point of every level: of a
    bounded sample, the point whose distances spread most."""
    sample = [r.fp for r in points.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()]
    if not sample:
        return 0
    fps = np.array(sample, dtype=np.int64).view(np.uint64)
    word = 0
    for mask in _masks(levels):
        part = fps & np.uint64(mask)
        far = np.bitwise_count(part[:, None] ^ part[None, :])
        word |= int(part[int(far.var(axis=1).argmax())])
    return word


def _offsets(levels: int, radius: int) -> list[tuple[int, ...]]:
    """Path differences within the boundary, one of each opposite pair."""
    steps = range(-radius, radius + 1)
    near = [o for o in product(steps, repeat=levels) if sum(map(abs, o)) <= radius]
    return [o for o in near if o > (0,) * levels]


def _path(fp: Column, vantage: int, levels: int) -> Column:
    """Shard number: the distances of all levels as digits, with room at both
    ends for the boundary."""
    base = 128
    out = F.lit(0).cast("bigint")
    for mask in _masks(levels):
        far = F.bit_count(fp.bitwiseXOR(F.lit(_signed(vantage))).bitwiseAND(F.lit(_signed(mask))))
        out = out * F.lit(base) + (far + F.lit(base // 4)).cast("bigint")
    return out


def _find(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    while True:
        up = parent[x]
        if (up == x).all():
            return x
        x = up


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    while len(a):
        ra, rb = _find(parent, a), _find(parent, b)
        apart = ra != rb
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])


def near_pairs(points: np.ndarray, queries: np.ndarray, radius: int
               ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Exact pairs (point index, query index) within ``radius`` bits, by a
    vantage-point tree over the points that all queries descend together."""
    todo = [(np.arange(len(points)), np.arange(len(queries)))]
    while todo:
        p, q = todo.pop()
        if not len(p) or not len(q):
            continue
        if len(p) * len(q) > BLOCK and len(p) > 16:
            vantage = points[p[len(p) // 2]]
            far = np.bitwise_count(points[p] ^ vantage).astype(np.int16)
            split = int(np.median(far))
            inner = far <= split
            if inner.all():
                split -= 1
                inner = far <= split
            if inner.any() and not inner.all():
                query_far = np.bitwise_count(queries[q] ^ vantage).astype(np.int16)
                todo.append((p[inner], q[query_far <= split + radius]))
                todo.append((p[~inner], q[query_far > split - radius]))
                continue
        rows = max(1, BLOCK // len(p))
        for at in range(0, len(q), rows):
            some = q[at:at + rows]
            hit = np.bitwise_count(points[p][:, None] ^ queries[some][None, :]) <= radius
            i, j = np.nonzero(hit)
            if len(i):
                yield p[i], some[j]


def shard_stars(home: np.ndarray, visitors: np.ndarray, radius: int
                ) -> tuple[np.ndarray, np.ndarray]:
    """Edges (fingerprint, root) that join what one shard links."""
    points = np.concatenate([home, visitors])
    parent = np.arange(len(points))
    for i, j in near_pairs(home, points, radius):
        _unite(parent, i, j)
    root = _find(parent, parent.copy())
    linked = np.flatnonzero(root != np.arange(len(points)))
    return points[linked], points[root[linked]]


def _star_edges(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by shard; a shard is held until the next begins."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    held_path = None
    out_a: list[np.ndarray] = []
    out_b: list[np.ndarray] = []

    def close() -> None:
        fps = np.concatenate([h[0] for h in held])
        visits = np.concatenate([h[1] for h in held])
        home = np.unique(fps[~visits]).view(np.uint64)
        if len(home):
            a, b = shard_stars(home, fps[visits].view(np.uint64), radius)
            if len(a):
                out_a.append(a.view(np.int64))
                out_b.append(b.view(np.int64))

    for batch in batches:
        path = batch.column(0).to_numpy(zero_copy_only=False)
        fp = batch.column(1).to_numpy(zero_copy_only=False)
        visit = batch.column(2).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(path[1:] != path[:-1]) + 1
        for x, y in zip([0, *cuts.tolist()], [*cuts.tolist(), len(path)]):
            if x == y:
                continue
            if held and path[x] != held_path:
                close()
                held = []
            held_path = path[x]
            held.append((fp[x:y], visit[x:y]))
        if out_a:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["u", "v"])
            out_a, out_b = [], []
    if held:
        close()
    if out_a:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["u", "v"])


def link_edges(points: DataFrame, radius: int = 2, levels: int = LEVELS) -> DataFrame:
    """Edges u, v that join all distinct fingerprints ``fp`` within ``radius``."""
    vantage = vantage_point(points, levels)
    path = _path(F.col("fp"), vantage, levels)
    shifts = [sum(d * 128 ** (levels - 1 - i) for i, d in enumerate(o))
              for o in _offsets(levels, radius)]
    visits = F.array(*[F.lit(s).cast("bigint") for s in [0, *shifts]])
    rows = (points.select("fp", path.alias("path"), F.explode(visits).alias("shift"))
            .select((F.col("path") + F.col("shift")).alias("path"), "fp",
                    (F.col("shift") != 0).alias("visit")))
    dealt = rows.repartition("path").sortWithinPartitions("path")
    return dealt.mapInArrow(releasing(lambda it: _star_edges(it, radius)), "u bigint, v bigint")


def simhash_components(docs: DataFrame, words: int = 3, radius: int = 2,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits) and
    ``component_id``, the smallest id reachable over links."""
    prints = materialize(fingerprints(docs, words, id_col, text_col), "fingerprints")
    points = materialize(prints.groupBy("fp").agg(F.min("doc").alias("first")), "points")
    linked = materialize(components(link_edges(points.select("fp"), radius)), "linked")
    inside = linked.join(points, linked.node == points.fp).select("fp", "root", "first")
    lowest = inside.groupBy("root").agg(F.min("first").alias("component_id"))
    moved = inside.join(lowest, "root").select("fp", "component_id")
    # Written, so that the last join has two plain shuffles and can split a hot fingerprint.
    every = materialize(
        points.join(moved, "fp", "left")
        .select("fp", F.coalesce("component_id", "first").alias("component_id")), "by_fp")
    return (prints.join(every, "fp", "left")
            .select(F.col("doc").alias(id_col),
                    F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def shingles(text: str | None, words: int) -> np.ndarray:
    """Hashes of the distinct word shingles of one text, sorted."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    return np.unique(np.concatenate(list(_hashes(parts, words))))


def long_print(hashes: np.ndarray) -> np.ndarray:
    """SimHash of ``WIDE`` words of 64 bits of a set of shingle hashes; every
    word has a seed of its own."""
    counts = np.zeros(64 * WIDE, dtype=np.int64)
    seeds = np.arange(1, WIDE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for at in range(0, len(hashes), 255):       # counts of a block fit a byte
        x = hashes[at:at + 255, None] + seeds[None, :]
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        bits = np.unpackbits(x.astype("<u8", copy=False).view(np.uint8), axis=1, bitorder="little")
        counts += np.add.reduce(bits, axis=0, dtype=np.uint8)
    return np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8").astype(np.uint64)


def parity_sketch(hashes: np.ndarray) -> np.ndarray:
    """``SKETCH`` words of parities of a set of shingle hashes. Those of two
    sets differ in as many bits as the sets in elements, at most."""
    counts = np.bincount((hashes & np.uint64(64 * SKETCH - 1)).astype(np.int64), minlength=64 * SKETCH)
    return np.packbits(counts & 1, bitorder="little").view("<i8").astype(np.int64)


_SKETCHES = [f"s{i}" for i in range(SKETCH)]
_SKETCH_TYPES = ", ".join(f"{c} bigint" for c in _SKETCHES)


def _sets(docs: DataFrame, words: int, id_type: str) -> DataFrame:
    """Columns ``doc``, ``node`` (hash of the set), ``print`` (null for a text
    without words), ``size`` and the words of the parity sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, prints, sizes = [], [], []
            sketches = np.zeros((SKETCH, batch.num_rows), dtype=np.int64)
            for i, t in enumerate(batch.column(1)):
                found = shingles(t.as_py(), words)
                nodes.append(_signed(xxhash.xxh64_intdigest(found.astype("<u8").tobytes(), SEED)))
                prints.append(long_print(found).astype("<u8").tobytes() if len(found) else None)
                sizes.append(len(found))
                sketches[:, i] = parity_sketch(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(nodes, pa.int64()), pa.array(prints, pa.binary()),
                 pa.array(sizes, pa.int64()), *(pa.array(words_) for words_ in sketches)],
                names=["doc", "node", "print", "size", *_SKETCHES])

    return docs.mapInArrow(releasing(run), f"doc {id_type}, node bigint, print binary, size bigint, {_SKETCH_TYPES}")


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each set a row for each part of each half word. Halves within ``NEAR``
    bits have a part in common, which is their shard."""
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            some = batch.slice(at, 2000)
            raw = b"".join(some.column(1).to_pylist())
            prints = np.frombuffer(raw, dtype="<u8").reshape(-1, WIDE)
            node = some.column(0).to_numpy(zero_copy_only=False)
            for h in range(2 * WIDE):
                half = (prints[:, h // 2] >> np.uint64(32 * (h % 2))) & np.uint64(0xFFFFFFFF)
                # bits that have no part in the half
                other = prints[:, (h // 2 + 1) % WIDE]
                for part, mask in enumerate(PARTS):
                    shard = half & np.uint64(mask) | np.uint64((h * len(PARTS) + part) << 32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shard.view(np.int64)), pa.array(half.view(np.int64)),
                         pa.array(other.view(np.int64)), pa.array(node)],
                        names=["shard", "half", "other", "node"])


def shard_candidates(part: int, half: np.ndarray, other: np.ndarray, node: np.ndarray
                     ) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
    """Pairs (greater node, smaller node, differing bits) of one shard, and the
    rows (cluster, half, node) among which there are more. Of rows with equal
    halves the first stands for all against other halves; among them each meets
    the first and its ``BESIDE`` neighbours, so that a dense group makes a
    bounded number of pairs a row. Where this leaves a pair out, the rows of
    all halves that are chained by such pairs are a cluster."""
    order = np.lexsort((node, other, half))
    half, other, node = half[order], other[order], node[order]
    new = np.ones(len(half), dtype=bool)
    new[1:] = half[1:] != half[:-1]
    lead = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    count = np.bincount(group, minlength=len(lead))
    more = np.zeros(len(lead), dtype=bool)
    cluster = np.arange(len(lead))
    i, j = [], []
    if part == 0:               # equal halves meet in every part
        every = np.arange(len(half))
        i.append(every)
        j.append(lead[group])
        for k in range(1, BESIDE + 1):
            same = group[k:] == group[:-k]
            i.append(every[k:][same])
            j.append(every[:-k][same])
        more |= count > BESIDE + 1
    values = half[lead]
    if len(lead) > 1:
        earlier = np.uint64(sum(PARTS[:part]))
        lower = [np.uint64(m) for m in PARTS[:part]]
        for x, y in near_pairs(values, values, NEAR):
            apart = values[x] ^ values[y]
            once = (x > y) & (apart != 0)
            if earlier:         # a pair that an earlier part has is left to it
                for mask in lower:
                    once &= apart & mask != 0
            x, y = x[once], y[once]
            i.append(lead[x])
            j.append(lead[y])
            several = count[x] * count[y] > 1
            x, y = x[several], y[several]
            more[x] = more[y] = True
            _unite(cluster, x, y)
    rows = np.flatnonzero(more[group])
    rest = (_find(cluster, cluster.copy())[group[rows]], half[rows], node[rows])
    if not i:
        none = np.zeros(0, dtype=np.int64)
        return (none, none, none), rest
    i, j = np.concatenate(i), np.concatenate(j)
    far = np.bitwise_count(other[i] ^ other[j]).astype(np.int64)
    keep = node[i] != node[j]
    a, b, far = node[i[keep]], node[j[keep]], far[keep]
    return (np.maximum(a, b), np.minimum(a, b), far), rest


MEMBER = -1             # in place of differing bits: not a pair, but u is a member of the cluster v of a shard
_FOUND_NAMES = ["u", "v", "far", "shard", "half"]
_FOUND = ", ".join(f"{c} bigint" for c in _FOUND_NAMES)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by shard; a shard is held until the next begins."""
    held: list[list[np.ndarray]] = []
    shard = None
    out: list[tuple] = []

    def close() -> None:
        half, other, node = (np.concatenate([h[c] for h in held]) for c in range(3))
        if len(half) > 1:
            found, (cluster, halves, members) = shard_candidates(
                (shard >> 32) % len(PARTS), half.view(np.uint64), other.view(np.uint64), node)
            if len(found[0]):
                none = np.zeros(len(found[0]), dtype=np.int64)
                out.append((*found, none, none))
            if len(members):
                out.append((members, cluster, np.full(len(members), MEMBER), np.full(len(members), shard),
                            halves.view(np.int64)))

    for batch in batches:
        path, *rest = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(4)]
        cuts = np.flatnonzero(path[1:] != path[:-1]) + 1
        for x, y in zip([0, *cuts.tolist()], [*cuts.tolist(), len(path)]):
            if x == y:
                continue
            if held and int(path[x]) != shard:
                close()
                held = []
            shard = int(path[x])
            held.append([r[x:y] for r in rest])
        if out:
            yield _edge_batch(out)
            out = []
    if held:
        close()
    if out:
        yield _edge_batch(out)


def _edge_batch(found: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([f[c] for f in found])) for c in range(5)], names=_FOUND_NAMES)


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Of ``pairs`` (columns u, v) those whose sets are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                a, b = np.frombuffer(x, dtype="<u8"), np.frombuffer(y, dtype="<u8")
                both = len(np.intersect1d(a, b, assume_unique=True))
                good.append(both >= threshold * (len(a) + len(b) - both))
            kept = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(kept) for c in (0, 1)], names=["u", "v"])

    left = sets.select(F.col("node").alias("u"), F.col("hashes").alias("a"))
    right = sets.select(F.col("node").alias("v"), F.col("hashes").alias("b"))
    return (pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b")
            .mapInArrow(releasing(run), "u bigint, v bigint"))


def candidates(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of sets (columns node, print) the pairs ``u``, ``v``, ``far`` that were
    compared, and the members (shard, cluster, half, node) of the clusters in
    which further pairs of halves within ``NEAR`` bits were not."""
    rows = nodes.where("print IS NOT NULL").select("node", "print").mapInArrow(
        releasing(_dealt), "shard bigint, half bigint, other bigint, node bigint")
    found = materialize(rows.repartition("shard").sortWithinPartitions("shard")
                        .mapInArrow(releasing(_candidates), _FOUND), "candidates")
    pairs = found.where(F.col("far") != MEMBER).groupBy("u", "v").agg(F.min("far").alias("far"))
    members = found.where(F.col("far") == MEMBER).select("shard", F.col("v").alias("cluster"), "half",
                                                         F.col("u").alias("node"))
    return pairs, members


def _rooted(rows: DataFrame, linked: DataFrame, node: str, root: str) -> DataFrame:
    """``rows`` with the component of the column ``node``; itself if it has no link."""
    roots = linked.select(F.col("node").alias(node), F.col("root").alias(root))
    return rows.join(roots, node, "left").withColumn(root, F.coalesce(root, node))


def cluster_pairs(members: DataFrame, linked: DataFrame) -> DataFrame:
    """Pairs u, v (each once) of members of one cluster whose halves differ in
    ``NEAR`` bits at most and which ``linked`` (node, root) has not joined.
    Members of a cluster's commonest component are only compared with the
    others, so that a cluster that is one component costs nothing."""
    rows = _rooted(members, linked, "node", "root")
    common = (rows.groupBy("shard", "cluster", "root").agg(F.count(F.lit(1)).alias("n"))
              .groupBy("shard", "cluster").agg(F.max_by("root", "n").alias("common"), F.count(F.lit(1)).alias("roots"))
              .where("roots > 1").drop("roots"))
    rows = materialize(rows.join(common, ["shard", "cluster"]), "members")
    others = rows.where("root <> common").select(
        "shard", "cluster", F.col("half").alias("h"), F.col("node").alias("n"), F.col("root").alias("r"))
    return (rows.join(others, ["shard", "cluster"])
            .where((F.col("root") != F.col("r"))
                   & (F.bit_count(F.col("half").bitwiseXOR(F.col("h"))) <= NEAR))
            .select(F.greatest("node", "n").alias("u"), F.least("node", "n").alias("v")).distinct())


def _possible(pairs: DataFrame, sketches: DataFrame, threshold: float) -> DataFrame:
    """``pairs`` (columns u, v) without those whose sets are too unlike by
    their sizes or by the bits that their parity sketches differ in."""
    def side(node: str, mark: str) -> DataFrame:
        return sketches.select(F.col("node").alias(node), F.col("size").alias(f"{mark}size"),
                               *[F.col(c).alias(mark + c) for c in _SKETCHES])

    apart = sum((F.bit_count(F.col(f"a{c}").bitwiseXOR(F.col(f"b{c}"))) for c in _SKETCHES), F.lit(0))
    both = F.col("asize") + F.col("bsize")
    return (pairs.join(side("u", "a"), "u").join(side("v", "b"), "v")
            .where((F.least("asize", "bsize") >= threshold * F.greatest("asize", "bsize") - 1e-6)
                   & (apart * (1 + threshold) <= both * (1 - threshold) + 1e-6))
            .select("u", "v"))


def near_copies(docs: DataFrame, words: int = 5, threshold: float = 0.8, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Columns ``doc`` and ``component_id``: documents (those with an id) link
    if the Jaccard similarity of their distinct word shingles is ``threshold``
    or more. Candidates come from a fingerprint of ``WIDE`` words: pairs of
    which one half word at least differs in ``NEAR`` bits at most. Each is
    verified on the sets, except where both ends are linked already or the
    sets are too unlike by size or sketch."""
    ship(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    texts = (docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
             .where("doc IS NOT NULL"))
    found = materialize(_sets(texts, words, id_type), "shingle_sets")
    nodes = materialize(found.groupBy("node").agg(F.min("doc").alias("first"),
                                                  F.first("print").alias("print"), F.first("size").alias("size"),
                                                  *[F.first(c).alias(c) for c in _SKETCHES]), "nodes")
    pairs, members = candidates(nodes)
    pairs = materialize(pairs, "pairs")

    def hashed(some: DataFrame, name: str) -> DataFrame:
        """The sets of both ends of pairs: node, hashes."""
        ends = some.select(F.col("u").alias("node")).union(some.select(F.col("v").alias("node"))).distinct()
        wanted = nodes.join(ends, "node").select(F.col("first").alias("doc"), "node")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep, out = [], []
                for want, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                    raw = shingles(t.as_py(), words).astype("<u8").tobytes()
                    if _signed(xxhash.xxh64_intdigest(raw, SEED)) == want:     # ids may repeat
                        keep.append(want)
                        out.append(raw)
                yield pa.RecordBatch.from_arrays([pa.array(keep, pa.int64()), pa.array(out, pa.binary())],
                                                 names=["node", "hashes"])

        return materialize(texts.join(wanted, "doc").select("node", "text")
                           .mapInArrow(releasing(run), "node bigint, hashes binary")
                           .dropDuplicates(["node"]), name)

    likely = pairs.where(F.col("far") <= FAR)
    sets = hashed(likely, "sets")
    # First the nearest partner of each set: a dense group is one component by
    # these links, and pairs inside of a component need no look.
    nearest = likely.groupBy("u").agg(F.min(F.struct("far", "v")).alias("best")).select("u", F.col("best.v").alias("v"))
    good = materialize(_verified(nearest, sets, threshold), "good")
    joined = materialize(components(good), "joined")

    def apart(some: DataFrame, linked: DataFrame) -> DataFrame:
        return (_rooted(_rooted(some, linked, "u", "ru"), linked, "v", "rv")
                .where("ru <> rv").select("u", "v"))

    rest = apart(likely.select("u", "v").join(nearest, ["u", "v"], "left_anti"), joined)
    good = good.union(materialize(_verified(rest, sets, threshold), "more"))
    linked = materialize(components(good), "linked")
    # Then all candidates that were not likely or not compared.
    late = apart(pairs.where(F.col("far") > FAR), linked).union(
        cluster_pairs(members, linked).join(likely, ["u", "v"], "left_anti"))
    late = materialize(late.distinct(), "late")
    if not late.isEmpty():
        late = materialize(_possible(late, nodes, threshold), "possible")
        if not late.isEmpty():
            good = good.union(materialize(_verified(late, hashed(late, "late_sets"), threshold), "late_good"))
            linked = materialize(components(good), "linked")

    inside = nodes.select("node", "first").join(linked, "node")
    lowest = inside.groupBy("root").agg(F.min("first").alias("component_id"))
    moved = inside.join(lowest, "root").select("node", "component_id")
    every = materialize(nodes.select("node", "first").join(moved, "node", "left")
                        .select("node", F.coalesce("component_id", "first").alias("component_id")), "by_node")
    return found.select("doc", "node").join(every, "node").select("doc", "component_id")


def drop_near_copies(docs: DataFrame, words: int = 5, threshold: float = 0.8, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component of near copies: that of the
    smallest id. Rows that repeat this id stay; documents without an id stay."""
    found = near_copies(docs, words, threshold, id_col, text_col)
    gone = found.where(F.col("component_id") < F.col("doc")).select(F.col("doc").alias(id_col)).distinct()
    return docs.join(gone, id_col, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
