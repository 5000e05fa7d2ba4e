"""N-gram Jaccard join of whole documents: size-banded tiles with bitmaps.

A document's set is its distinct shingles of ``words`` words, as 64-bit hashes.
Two documents link if the Jaccard similarity of their sets is ``percent``
hundredths or more. All links between different sets are found:

1. *Counts.* Documents of equal sets are one class, of which one goes on. A link
   at similarity t needs the share t of both sets to be common, so a class stays
   only if that share of its shingles occurs in another class too. Map tasks
   send their shingles packed, each once per block of documents; one that
   already occurs twice in a block is sent as a mere marker, so a passage that a
   third of all documents share is one entry of each block.
2. *Cells.* The shingles of a set are ordered by how many classes hold them
   (rough classes for the frequent ones, all others equal, ties by hash). Of two
   sets that link, the first n - ceil(t n) + 1 shingles have one in common: such
   a prefix shingle is a cell, and pairs are sought within cells.
   Cells of the same sets are one.
3. *Stars.* In every cell each set is first compared with one set of its size
   band, ``ROUNDS`` times with another one. What links is joined to components,
   and cells that lie in one component need no further look: a large group of
   near copies costs few comparisons for a set and cell, not all pairs.
4. *Tiles.* In the other cells, sets meet in tiles: pairs of blocks of at most
   ``TILE`` sets, of one size band or of two neighbouring ones (beyond, sizes
   differ too much). A pair of two components stays if its sizes allow the
   similarity, and if its bitmaps do: a bitmap holds for each slot the parity
   of the number of shingles hashed there, so the count of differing bits is
   never above the count of differing shingles and bounds the overlap.
5. *Verification.* Pairs that stay are intersected exactly, as sorted arrays.

Hashes of two different shingles are equal with a chance of about 2^-64; classes
are told apart by 128 bits. Template lines that all but link (many sets in one
cell, neither alike nor ruled out by size) cost a comparison for each pair of
sets, in as many tasks as there are tiles.

Defined results: a null or empty text, or one of white space, has an empty set
and links with nothing; a text of fewer words has its whole sequence as its one
shingle; rows without an id get a null component and link with nothing; rows
that repeat an id are documents of their own; an empty table gives an empty
table; other columns of the input are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import key_slices, materialize, releasing, ship
from .components import components
from .line_dedup import hash_words

PART_BYTES = 8 << 20    # of text whose shingles make one part of the count
MOST_PARTS = 1 << 16
BLOCK_SHINGLES = 1 << 20    # of documents whose shingles a map task packs together
OFTEN = 64              # classes that hold a shingle before its frequency matters
FREQUENT = 1 << 20      # shingles whose frequency is broadcast, at most
TILE = 1024             # sets of a side of a tile
WIDEST = 1 << 16        # bits of a bitmap
PAIRS = 1 << 16         # pairs whose bitmaps are compared together
SALTS = 16              # of classes of many documents
ROUNDS = 3              # of stars, before tiles
PLACES = 16             # first cells of a set that tell where a pair meets

_FACTORS = np.random.default_rng(5).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


# ---- sets --------------------------------------------------------------------------

def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Distinct shingle hashes of a text, sorted."""
    found, _ = hash_words((text or "").encode("utf-8", "surrogatepass").lower())
    if not len(found):
        return found
    size = min(words, len(found))
    total = np.full(len(found) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        total += found[i:len(total) + i] * _FACTORS[i % 64] + np.uint64(i // 64)
    total = (total ^ (total >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    total = (total ^ (total >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return np.unique(total ^ (total >> np.uint64(32)))


def digest(found: np.ndarray) -> bytes:
    """Identifies a set (128 bits)."""
    return xxhash.xxh3_128_digest(found.astype("<u8").tobytes())


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def bitmap(found: np.ndarray) -> bytes:
    """Parity bitmap, a power of two of bits: four for a shingle or more, so
    that few of the differing shingles hide one another."""
    width = min(WIDEST, max(64, 4 << (len(found) - 1).bit_length()))
    slots = (found >> np.uint64(20)) & np.uint64(width - 1)
    counts = np.bincount(slots.astype(np.int64), minlength=width)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(bits: np.ndarray, width: int) -> np.ndarray:
    """Bitmaps (rows of 64-bit words) as they would be with fewer words."""
    while bits.shape[1] > width:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def band(n: Column, percent: int) -> Column:
    """Size band: sizes that may link lie in one band or in neighbouring ones."""
    if percent >= 100:
        return n.cast("int")
    return F.floor(F.log(n.cast("double")) / F.lit(math.log(100 / percent)) + 1e-9).cast("int")


# ---- counts ------------------------------------------------------------------------

PACKED = "part int, kind int, a binary, b binary, c binary"
ALONE, MARKED, SHARED, DOCS, FREQ = range(5)


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    part, kind, a, b, c = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array(kind, pa.int32()),
         *[pa.array([x.tobytes() for x in col], pa.binary()) for col in (a, b, c)]],
        names=["part", "kind", "a", "b", "c"])


_NONE = np.zeros(0, dtype="<u8")


def _runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and length of every run of equal values."""
    if not len(sorted_values):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    first = np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))
    return first, np.diff(np.append(first, len(sorted_values)))


def _by_class(keys: np.ndarray, count: np.ndarray, parts: int) -> list[tuple]:
    """Counts of common shingles, by part of the class."""
    part = (keys % np.uint64(parts)).astype(np.int64)
    by = np.argsort(part, kind="stable")
    return [(int(part[by[x]]), SHARED, keys[by[x:x + n]], count[by[x:x + n]].astype("<i8"), _NONE)
            for x, n in zip(*_runs(part[by]))]


def _pack(sets: dict[int, np.ndarray], parts: int) -> list[tuple]:
    """Shingles of a block of classes by part: those of one class with its key,
    those of several as markers; and how many of a class's are in several."""
    keys = np.fromiter(sets, dtype=np.uint64, count=len(sets))
    sizes = np.fromiter(map(len, sets.values()), dtype=np.int64, count=len(sets))
    shingles = np.concatenate([*sets.values(), _NONE])
    owner = np.repeat(np.arange(len(keys)), sizes)
    order = np.argsort(shingles, kind="stable")
    first, length = _runs(shingles[order])
    several = np.repeat(length > 1, length)
    count = np.bincount(owner[order[several]], minlength=len(keys))
    some = np.flatnonzero(count)
    out = _by_class(keys[some], count[some], parts)
    marked, times = shingles[order[first[length > 1]]], length[length > 1]
    part = (marked % np.uint64(parts)).astype(np.int64)
    by = np.argsort(part, kind="stable")
    for x, n in zip(*_runs(part[by])):
        rows = by[x:x + n]
        out.append((int(part[rows[0]]), MARKED, marked[rows], times[rows].astype("<u4"), _NONE))
    alone = order[~several]
    part = (shingles[alone] % np.uint64(parts)).astype(np.int64)
    by = np.lexsort((owner[alone], part))
    for x, n in zip(*_runs(part[by])):
        rows = alone[by[x:x + n]]
        at, runs = _runs(owner[rows])
        out.append((int(part[by[x]]), ALONE, shingles[rows], keys[owner[rows[at]]], runs.astype("<u4")))
    return out


def _emit(batches: Iterator[pa.RecordBatch], words: int, parts: int) -> Iterator[pa.RecordBatch]:
    sets: dict[int, np.ndarray] = {}
    docs: list[tuple[int, int, bytes]] = []
    held = 0

    def flush() -> pa.RecordBatch:
        rows = _pack(sets, parts) if sets else []
        ids, sizes, names = zip(*docs)
        rows.append((int.from_bytes(names[0][:4], "little") % parts, DOCS,
                     np.array(ids, dtype="<i8"), np.array(sizes, dtype="<i8"),
                     np.frombuffer(b"".join(names), dtype=np.uint8)))
        sets.clear()
        docs.clear()
        return _packed(rows)

    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = shingle_set(text.as_py(), words)
            name = digest(found)
            # Rows without an id: the size as -1 - size, and no class.
            docs.append((0, -1 - len(found), name) if key is None else (key, len(found), name))
            if key is not None and len(found):
                sets.setdefault(int.from_bytes(name[:8], "little"), found)
                held += len(found)
            if held >= BLOCK_SHINGLES:
                yield flush()
                held = 0
    if docs:
        yield flush()


def _count(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Which shingles of a part occur in several classes: for each class how
    many of its shingles, and the frequencies of frequent ones."""
    at, held = None, {ALONE: [], MARKED: []}

    def settle() -> Iterator[pa.RecordBatch]:
        if not held[ALONE] and not held[MARKED]:
            return
        shingles = np.concatenate([_NONE, *[h for h, _, _ in held[ALONE]]])
        owner = np.concatenate([_NONE, *[np.repeat(k, n) for _, k, n in held[ALONE]]])
        order = np.lexsort((owner, shingles))
        shingles, owner = shingles[order], owner[order]
        fresh = np.ones(len(shingles), dtype=bool)
        fresh[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
        shingles, owner = shingles[fresh], owner[fresh]
        marked = np.concatenate([_NONE, *[h for h, _, _ in held[MARKED]]])
        times = np.concatenate([_NONE, *[n for _, n, _ in held[MARKED]]])
        values, back = np.unique(np.concatenate([shingles, marked]), return_inverse=True)
        often = np.bincount(back, weights=np.concatenate([np.ones(len(shingles)), times]), minlength=len(values))
        common = often[back[:len(shingles)]] > 1
        keys, n = np.unique(owner[common], return_counts=True)
        many = often >= OFTEN
        rows = _by_class(keys, n, parts)
        if many.any():
            rows.append((at, FREQ, values[many], often[many].astype("<i8"), _NONE))
        held[ALONE], held[MARKED] = [], []
        if rows:
            yield _packed(rows)

    for (part,), rows in key_slices(batches, 1):
        if part != at:
            yield from settle()
            at = part
        kinds = rows.column(1).to_numpy()
        for i in np.flatnonzero(kinds < SHARED).tolist():
            a, b, c = (np.frombuffer(rows.column(k)[i].as_py(), dtype=np.uint8) for k in (2, 3, 4))
            if kinds[i] == ALONE:
                held[ALONE].append((a.view("<u8"), b.view("<u8"), c.view("<u4")))
            else:
                held[MARKED].append((a.view("<u8"), b.view("<u4"), None))
        through = pa.array(kinds >= SHARED)
        if through.true_count:
            yield rows.filter(through)
    yield from settle()


def _unpacked(counted: DataFrame, kind: int, schema: str) -> DataFrame:
    """Rows of one kind: two whole numbers and, for documents, the class and
    its key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, c in zip(*(batch.column(k).to_pylist() for k in range(3))):
                columns = [pa.array(np.frombuffer(a, dtype="<i8")), pa.array(np.frombuffer(b, dtype="<i8"))]
                if kind == DOCS:
                    n = np.frombuffer(b, dtype="<i8")
                    columns = [pa.array(np.frombuffer(a, dtype="<i8"), mask=n < 0),
                               pa.array(np.where(n < 0, -1 - n, n)),
                               pa.array([c[i:i + 16] for i in range(0, len(c), 16)], pa.binary()),
                               pa.array(np.frombuffer(c, dtype="<i8")[::2])]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [f.split()[0] for f in schema.split(", ")]
    return counted.where(F.col("kind") == kind).select("a", "b", "c").mapInArrow(releasing(run), schema)


def _counted(texts: DataFrame, words: int) -> DataFrame:
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = min(MOST_PARTS, max(16, size // PART_BYTES))
    packed = texts.mapInArrow(releasing(lambda batches: _emit(batches, words, parts)), PACKED)
    return materialize(packed.repartition("part").sortWithinPartitions("part")
                       .mapInArrow(releasing(lambda batches: _count(batches, parts)), PACKED), "counted")


def _common(counted: DataFrame) -> DataFrame:
    """Columns key and common: how many shingles of a class others hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, (_NONE, np.zeros(0, dtype=np.int64))

        def settle() -> Iterator[pa.RecordBatch]:
            if len(total[0]):
                yield pa.RecordBatch.from_arrays([pa.array(total[0].view(np.int64)), pa.array(total[1])],
                                                 names=["key", "common"])

        for (part,), rows in key_slices(batches, 1):
            if part != at:
                yield from settle()
                at, total = part, (_NONE, np.zeros(0, dtype=np.int64))
            keys = [np.frombuffer(k, dtype="<u8") for k in rows.column(1).to_pylist()]
            count = [np.frombuffer(n, dtype="<i8") for n in rows.column(2).to_pylist()]
            values, back = np.unique(np.concatenate([total[0], *keys]), return_inverse=True)
            sums = np.zeros(len(values), dtype=np.int64)
            np.add.at(sums, back, np.concatenate([total[1], *count]))
            total = values, sums
        yield from settle()

    return (counted.where(F.col("kind") == SHARED).select("part", "a", "b").repartition("part")
            .sortWithinPartitions("part").mapInArrow(releasing(run), "key bigint, common bigint"))


# ---- cells -------------------------------------------------------------------------

def _frequent(counted: DataFrame, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles so frequent that there are ``FREQUENT`` at most, sorted, and
    their frequencies."""
    least = max(OFTEN, -(-total // FREQUENT))
    rows = (_unpacked(counted, FREQ, "h bigint, n bigint").where(F.col("n") >= least)).toArrow()
    h = rows.column("h").to_numpy().view(np.uint64)
    order = np.argsort(h)
    return h[order], rows.column("n").to_numpy()[order]


def prefix(found: np.ndarray, frequent: tuple[np.ndarray, np.ndarray], percent: int) -> np.ndarray:
    """The shingles of a set that enter cells: rare ones first."""
    rank = np.zeros(len(found), dtype=np.int64)
    h, n = frequent
    if len(h):
        at = np.minimum(np.searchsorted(h, found), len(h) - 1)
        rank = np.where(h[at] == found, n[at], 0)
    return found[np.lexsort((found, rank))[:prefix_size(len(found), percent)]]


def _sets(texts: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """Columns node, n, hashes and bits of the wanted classes (node, doc)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = shingle_set(text.as_py(), words)
                if digest(found) == node:           # ids may repeat
                    rows.append((node, len(found), found.astype("<u8").tobytes(), bitmap(found)))
            if rows:
                node, n, hashes, bits = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node, pa.binary()), pa.array(n, pa.int64()), pa.array(hashes, pa.binary()),
                     pa.array(bits, pa.binary())], names=["node", "n", "hashes", "bits"])

    return (texts.join(wanted, "doc").select("node", "text")
            .mapInArrow(releasing(run), "node binary, n bigint, hashes binary, bits binary")
            .dropDuplicates(["node"]))


def _cells(sets: DataFrame, frequent: tuple[np.ndarray, np.ndarray], percent: int) -> DataFrame:
    """Columns token, band, node and n: every set under its prefix shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, n, raw in zip(*(batch.column(k).to_pylist() for k in range(3))):
                tokens = prefix(np.frombuffer(raw, dtype="<u8"), frequent, percent)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens.view(np.int64)), pa.array([node] * len(tokens), pa.binary()),
                     pa.array(np.full(len(tokens), n))], names=["token", "node", "n"])

    rows = sets.select("node", "n", "hashes").mapInArrow(releasing(run), "token bigint, node binary, n bigint")
    return rows.select("token", band(F.col("n"), percent).alias("band"), "node", "n")


# ---- pairs -------------------------------------------------------------------------

def needed(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Common shingles that sets of n and m shingles need."""
    return -(-percent * (n + m) // (100 + percent))


def _words(bits: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(bits), dtype="<u8").reshape(len(bits), -1)


def tile_pairs(left: tuple, right: tuple | None, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (in left, in right) of pairs of two components that sizes and
    bitmaps allow. A side: (sizes, components, bitmaps). Without ``right``, of
    each pair within ``left`` once."""
    n, of, bits = left
    m, to, other = right or left
    fits = np.minimum(n[:, None], m[None, :]) * 100 >= np.maximum(n[:, None], m[None, :]) * percent
    fits &= of[:, None] != to[None, :]
    if right is None:
        fits = np.triu(fits, 1)
    i, j = np.nonzero(fits)
    wide = np.array([len(b) for b in bits])
    broad = np.array([len(b) for b in other])
    for w in np.unique(wide[i]).tolist():
        for v in np.unique(broad[j]).tolist():
            some = np.flatnonzero((wide[i] == w) & (broad[j] == v))
            if not len(some):
                continue
            rows, columns = np.unique(i[some]), np.unique(j[some])
            words = min(w, v) // 8
            p = folded(_words([bits[r] for r in rows]), words)
            q = folded(_words([other[c] for c in columns]), words)
            step = max(1, PAIRS * 8 // words)
            for at in range(0, len(some), step):
                x, y = i[some[at:at + step]], j[some[at:at + step]]
                differ = np.bitwise_count(p[np.searchsorted(rows, x)] ^ q[np.searchsorted(columns, y)]).sum(
                    axis=1, dtype=np.int64)
                good = (n[x] + m[y] - differ) // 2 >= needed(n[x], m[y], percent)
                if good.any():
                    yield x[good], y[good]


def _tiles(cells: DataFrame) -> DataFrame:
    """Rows of cells (token, band, node, n, component, bits, places) dealt over tiles:
    columns lo, i, hi, j say which blocks of which bands meet, side 0 or 1."""
    sizes = cells.groupBy("token", "band").agg(F.count(F.lit(1)).alias("size"))
    blocks = sizes.groupBy("token").agg(F.map_from_entries(F.collect_list(F.struct(
        "band", F.ceil(F.col("size") / TILE).cast("int").alias("blocks")))).alias("blocks"))
    rows = cells.join(blocks, "token")
    here = F.col("blocks")[F.col("band")]
    own = F.pmod(F.xxhash64("node"), here).cast("int")

    def tile(lo, i, hi, j, side) -> Column:
        return F.struct(lo.alias("lo"), i.alias("i"), hi.alias("hi"), j.alias("j"), F.lit(side).alias("side"))

    b, none = F.col("band"), F.array().cast("array<struct<lo:int,i:int,hi:int,j:int,side:int>>")
    above, below = F.col("blocks")[b + 1], F.col("blocks")[b - 1]
    zero = F.lit(0)
    met = F.concat(
        F.transform(F.sequence(own, here - 1), lambda j: tile(b, F.col("own"), b, j, 0)),
        F.when(F.col("own") > 0, F.transform(F.sequence(zero, F.greatest(F.col("own") - 1, zero)),
                                             lambda i: tile(b, i, b, F.col("own"), 1))).otherwise(none),
        F.when(above.isNotNull(), F.transform(F.sequence(zero, F.coalesce(above, F.lit(1)) - 1),
                                              lambda j: tile(b, F.col("own"), b + 1, j, 0))).otherwise(none),
        F.when(below.isNotNull(), F.transform(F.sequence(zero, F.coalesce(below, F.lit(1)) - 1),
                                              lambda i: tile(b - 1, i, b, F.col("own"), 1))).otherwise(none))
    spread = rows.withColumn("own", own).select("token", F.explode(met).alias("t"), "node", "n", "component", "bits",
                                                "places")
    return spread.select("token", "t.lo", "t.i", "t.hi", "t.j", "t.side", "node", "n", "component", "bits", "places")


def _tile_candidates(cells: DataFrame, percent: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sides = None, ([], [])

        def side(parts: list[pa.RecordBatch]) -> tuple | None:
            if not parts:
                return None
            rows = pa.Table.from_batches(parts)
            return (rows.column("n").to_numpy(), np.array(rows.column("component").to_pylist(), dtype=object),
                    rows.column("bits").to_pylist(), rows.column("node").to_pylist(),
                    rows.column("places").to_pylist())

        def settle() -> Iterator[pa.RecordBatch]:
            if at is None:
                return
            left, right = side(sides[0]), side(sides[1])
            inner = at[1:3] == at[3:5]
            if left is None or (right is None and not inner):
                return
            pairs = tile_pairs(left[:3], None if inner else right[:3], percent)
            other = left if inner else right
            for x, y in pairs:
                # Two sets that share several of their first cells meet in the first one only.
                ends = [sorted((left[3][p], other[3][q])) for p, q in zip(x, y)
                        if min(set(left[4][p]).intersection(other[4][q]), default=at[0]) == at[0]]
                yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in ends], pa.binary()) for k in (0, 1)],
                                                 names=["u", "v"])

        for (*key, kind), rows in key_slices(batches, 6):
            if key != at:
                yield from settle()
                at, sides = key, ([], [])
            sides[kind].append(rows)
        yield from settle()

    tile = ["token", "lo", "i", "hi", "j"]
    return (_tiles(cells).repartition(*tile).sortWithinPartitions(*tile, "side")
            .mapInArrow(releasing(run), "u binary, v binary").distinct())


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (u, v) those that link: bitmaps first, then the arrays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for p, x, q, y in zip(*(batch.column(k).to_pylist() for k in range(2, 6))):
                a, b = np.frombuffer(x, dtype="<u8"), np.frombuffer(y, dtype="<u8")
                words = min(len(p), len(q)) // 8
                differ = int(np.bitwise_count(folded(_words([p]), words) ^ folded(_words([q]), words)).sum())
                least = int(needed(len(a), len(b), percent))
                good.append((len(a) + len(b) - differ) // 2 >= least and overlap(a, b) >= least)
            kept = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(kept) for k in (0, 1)], names=["u", "v"])

    a = sets.select(F.col("node").alias("u"), F.col("bits").alias("p"), F.col("hashes").alias("x"))
    b = sets.select(F.col("node").alias("v"), F.col("bits").alias("q"), F.col("hashes").alias("y"))
    return (pairs.join(a, "u").join(b, "v").select("u", "v", "p", "x", "q", "y")
            .mapInArrow(releasing(run), "u binary, v binary"))


def _distinct_cells(cells: DataFrame) -> DataFrame:
    """Of cells that hold the same sets (told by their number and 128 bits), one;
    cells of one set go."""
    alike = cells.groupBy("token").agg(
        F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("node")).alias("x"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")).where("size > 1")
    kept = alike.groupBy("size", "x", "y").agg(F.min("token").alias("token")).select("token")
    return cells.join(kept, "token")


def _star_pairs(cells: DataFrame, percent: int, seed: int) -> DataFrame:
    """Every set with one set of its cell and size band (another for each
    seed), where the two are not in one component yet."""
    centre = cells.groupBy("token", "band").agg(
        F.min(F.struct(F.xxhash64("node", F.lit(seed)).alias("h"), "node", "n", "component")).alias("c"),
        F.count(F.lit(1)).alias("size")).where("size > 1")
    met = cells.join(centre, ["token", "band"])
    fits = (F.least("n", F.col("c.n")) * 100) >= (F.greatest("n", F.col("c.n")) * percent)
    return met.where((F.col("component") != F.col("c.component")) & fits).select(
        F.least("node", F.col("c.node")).alias("u"), F.greatest("node", F.col("c.node")).alias("v")).distinct()


def _placed(cells: DataFrame, joined: DataFrame | None) -> DataFrame:
    """The cells that lie in several components, with these."""
    if joined is None:
        return cells.withColumn("component", F.col("node"))
    placed = cells.join(joined, "node", "left").withColumn("component", F.coalesce("root", "node")).drop("root")
    several = (placed.groupBy("token").agg(F.min("component").alias("a"), F.max("component").alias("b"))
               .where("a <> b").select("token"))
    return placed.join(several, "token")


def links(sets: DataFrame, frequent: tuple[np.ndarray, np.ndarray], percent: int) -> DataFrame:
    """Columns node and root: components of the sets (columns node, n, hashes,
    bits), for those that link with another."""
    cells = materialize(_distinct_cells(materialize(_cells(sets, frequent, percent), "prefixes")), "cells")
    tried, good, joined = None, None, None
    for seed in range(ROUNDS):
        pairs = _star_pairs(_placed(cells, joined), percent, seed)
        if tried is not None:
            pairs = pairs.join(tried, ["u", "v"], "left_anti")
        pairs = materialize(pairs, "star_pairs")
        tried = pairs if tried is None else tried.union(pairs)
        stars = materialize(_verified(pairs, sets, percent), "stars")
        good = stars if good is None else good.union(stars)
        joined = materialize(components(good), "joined")
    left = _placed(cells, joined)
    places = left.groupBy("node").agg(F.slice(F.array_sort(F.collect_list("token")), 1, PLACES).alias("places"))
    left = left.join(places, "node").join(sets.select("node", "bits"), "node")
    more = materialize(_tile_candidates(left, percent).join(tried, ["u", "v"], "left_anti"), "tile_pairs")
    return components(good.union(_verified(more, sets, percent)))


def ngram_components(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Per document: ``id_col``, n_shingles and component_id, the smallest id
    that links lead to."""
    ship(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).alias("text"))
    counted = _counted(texts, words)
    rows = materialize(_unpacked(counted, DOCS, "doc bigint, n bigint, node binary, key bigint"), "rows")
    classes = materialize(rows.where("doc IS NOT NULL AND n > 0").groupBy("node").agg(
        F.min("doc").alias("first"), F.max("n").alias("n"), F.min("key").alias("key"), F.count(F.lit(1)).alias("members")), "classes")

    staying = (classes.join(_common(counted), "key")
               .where(F.col("common") * 100 >= F.col("n") * percent)
               .select("node", F.col("first").alias("doc")))
    sets = materialize(_sets(texts, staying, words), "sets")
    total = rows.agg(F.sum("n")).first()[0] or 0
    linked = materialize(links(sets, _frequent(counted, total), percent), "linked")

    inside = classes.select("node", "first", "members").join(linked, "node", "left")
    lowest = inside.where("root IS NOT NULL").groupBy("root").agg(F.min("first").alias("lowest"))
    # A class of many documents is met in several places.
    many = inside.join(lowest, "root", "left").where("members > 1 OR root IS NOT NULL").select(
        "node", F.coalesce("lowest", "first").alias("component_id"),
        F.explode(F.sequence(F.lit(0), F.when(F.col("members") > SALTS, SALTS - 1).otherwise(0))).alias("salt"),
        (F.col("members") > SALTS).alias("wide"))
    many = materialize(many, "members")
    narrow, wide = (many.where(F.col("wide") == w).drop("wide") for w in (False, True))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(SALTS)).cast("int"))
    found = (salted.join(narrow.select("node", F.col("component_id").alias("c")), "node", "left")
             .join(wide.select("node", "salt", F.col("component_id").alias("d")), ["node", "salt"], "left"))
    own = F.when(F.col("n") == 0, F.col("doc")).otherwise(F.coalesce("c", "d", "doc"))
    return found.select(F.col("doc").alias(id_col), F.col("n").alias("n_shingles"),
                        F.when(F.col("doc").isNotNull(), own).alias("component_id"))
