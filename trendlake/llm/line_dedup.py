"""Near-duplicate lines by an exact set-similarity join.

A line (text between line feeds) is the set of its words, A-Z lower-cased. Two
lines match if the Jaccard similarity of their sets is ``threshold`` or more; a
line is removed if any earlier line of the corpus (by document id, then line
number) matches it.

Tokens are ordered by rarity. The counts of all tokens are summed; the
``FREQUENT`` most frequent get a class by their count (a broadcast of fixed
size), all others count as rarer; within a class the hash decides: one order
for the whole corpus.
Matching sets share a token among their first ``n - ceil(threshold * n) + 1``
(prefix filter), so each set is entered under these only, less those that occur
once in the corpus (a bit table of fixed size knows most of them). Within a token, rows
sorted by size are paired under the length filter, the positional filter and a
parity sketch of 64 or 128 bits, whose differing bits bound the set difference from
below. None of them loses a match. Pairs that remain are verified on the words
of the two lines.

A line needs one verified partner, not all: the ``TRIES`` partners nearest by
sketch are passed on per row and token, and the rows of a token of which one had
more are kept. A line none of whose tried partners is verified, and which had more,
is joined again with all its partners, among the kept rows.

Rows travel packed: those of a task that fall into one part of the codes are one
value, so that neither the shuffle nor its sort handles them one at a time, and a
number takes the bytes that its distance from the smallest of the value needs. The
number of parts grows with the words of the corpus, up to a limit. Token counts
travel in the same way.

A task enters equal sets once, and equal sets of several tasks meet under the
key of the set: a line that a third of all documents repeat is one set, of
which only the first line takes part in the join.

A pair is looked for at the first token that its sets share: what they share stands
there or after, so a token late in the order of a set finds only few sizes.

Defined results: a null text has no lines to remove and stays null; lines
without words (empty ones too) match nothing and stay; of lines with the same
document id and number (repeated rows, or a null id, which counts as the
smallest) none is earlier than the other; an empty table gives an empty table;
other columns are kept.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialize, releasing, ship

THRESHOLD = 0.8
FREQUENT = 65_536           # tokens that have a rarity class of their own
TRIES = 32
_SPREAD = 2654435761         # spreads line numbers over the bit table
HASH_BITS = 46              # of a token; 8 more bits of a code are its class
CODE_BITS = HASH_BITS + 8
ROW_BITS = 40               # of the code of a row, and of the key of its set
SLOT_BITS = 18              # slots of the table of classes
SMALL_SET = 64              # sets up to this size have a sketch of 64 bits
BLOCK_BYTES = 500_000       # text tokenised together
KNOWN_SETS = 60_000         # sets that a task remembers
GROUP_ROWS = 120_000        # rows paired together in a task
PACK_ROWS = 400_000         # rows that a task deals to parts of the codes together
PART_WORDS = 400_000        # words of the corpus for each part of the codes
PARTS = (64, 8192)          # of the codes, at least and at most
PAIR_ROWS = 400_000         # pairs held before they are reduced to the nearest
FILTER_BITS = 1 << 25       # of the filter for lines that are joined again
NULL_ID = -(1 << 63)

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_WHITE = re.compile(rb"[\x09-\x0D\x20]")
_IS_WHITE = np.zeros(256, dtype=bool)
_IS_WHITE[[9, 10, 11, 12, 13, 32]] = True


def _powers(n: int, cache: list = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]
            ) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, modulo 2**64."""
    if len(cache[0]) < n:
        size = max(n, 1 << 19)
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            cache[i] = np.multiply.accumulate(steps)
    return cache[0][:n], cache[1][:n]


def _mixed(x: np.ndarray, mix: np.uint64) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * mix
    x = (x ^ (x >> np.uint64(27))) * mix
    return x ^ (x >> np.uint64(31))


def hash_words(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash (``HASH_BITS`` bits) and start of every word of a text: a
    polynomial of its bytes, computed for all words at once. A long text is
    cut at white space."""
    hashes, starts = [], []
    at, n = 0, len(raw)
    while at < n:
        cut = n
        if n - at > BLOCK_BYTES:
            found = _WHITE.search(raw, at + BLOCK_BYTES)
            cut = found.end() if found else n
        data = np.frombuffer(raw, dtype=np.uint8, count=cut - at, offset=at)
        inside = np.empty(len(data) + 2, dtype=bool)
        inside[0] = inside[-1] = False
        inside[1:-1] = ~_IS_WHITE[data]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        first, end = edges[::2], edges[1::2]
        if len(first):
            power, inverse = _powers(len(data))
            total = np.zeros(len(data) + 1, dtype=np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power, out=total[1:])
            words = (total[end] - total[first]) * inverse[first] + (end - first).astype(np.uint64)
            hashes.append(_mixed(words, _MIX[0]) >> np.uint64(64 - HASH_BITS))
            starts.append(first + at)
        at = cut
    if not hashes:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def _blocks(batch: pa.RecordBatch, ids: int | None, texts: int) -> Iterator[tuple[list, list[bytes]]]:
    """Lower-cased texts of a batch, about ``BLOCK_BYTES`` together."""
    docs, block, size = [], [], 0
    given = batch.column(ids).to_pylist() if ids is not None else [None] * batch.num_rows
    for d, text in zip(given, batch.column(texts)):
        raw = (text.as_py() or "").encode("utf-8", "surrogatepass").lower()
        docs.append(NULL_ID if d is None else d)
        block.append(raw)
        size += len(raw)
        if size >= BLOCK_BYTES:
            yield docs, block
            docs, block, size = [], [], 0
    if block:
        yield docs, block


def _summed(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct tokens in order, and their counts summed."""
    order = np.argsort(h)
    h, n = h[order], n[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = h[1:] != h[:-1]
    return h[new], np.add.reduceat(n, np.flatnonzero(new))


def token_counts(docs: DataFrame, text_col: str, least: int = 1) -> DataFrame:
    """Columns ``h`` (token hash) and ``n``, over the whole corpus, of tokens
    that occur ``least`` times or more."""
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = min(max(4 * tasks, PARTS[0]), PARTS[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            return _summed(*(np.concatenate([x[i] for x in held]) for i in (0, 1)))

        def rows() -> Iterator[pa.RecordBatch]:
            h, n = held[0]
            yield from _values((h >> np.uint64(HASH_BITS - 20)).astype(np.int64) * parts >> 20, [h.view(np.int64), n])

        for batch in batches:
            for _, block in _blocks(batch, None, 0):
                h, n = np.unique(hash_words(b"\n".join(block))[0], return_counts=True)
                if len(h):
                    held.append((h, n))
                    size += len(h)
                if size > 1_000_000:
                    held = [merged()]
                    size = len(held[0][0])
                    if size > 500_000:
                        yield from rows()
                        held, size = [], 0
        if held:
            held = [merged()]
            yield from rows()

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, n in _by_part(batches, (np.int64, np.int64)):
            h, n = _summed(h, n)
            h, n = h[n >= least], n[n >= least]
            for at in range(0, len(h), GROUP_ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(h[at:at + GROUP_ROWS]), pa.array(n[at:at + GROUP_ROWS])],
                                                 names=["h", "n"])

    return (docs.select(text_col).mapInArrow(releasing(run), _PACK).repartition("part").sortWithinPartitions("part")
            .mapInArrow(releasing(total), "h bigint, n bigint"))


class Rarity:
    """Rarity class of a token: zero unless it is among the frequent ones, else
    an eighth of a doubling of its count a class. Held in a hash table of fixed
    size; of frequent tokens that share a slot the most frequent stays."""

    def __init__(self, frequent: list[tuple[int, int]], repeated: np.ndarray | None = None):
        self.repeated = repeated     # bit table of the tokens that occur more than once
        self.tokens = np.zeros(1 << SLOT_BITS, dtype=np.uint64)
        self.classes = np.zeros(1 << SLOT_BITS, dtype=np.uint64)
        for h, n in sorted(frequent, key=lambda x: (x[1], x[0])):
            self.tokens[h >> (HASH_BITS - SLOT_BITS)] = h
            self.classes[h >> (HASH_BITS - SLOT_BITS)] = min(255, 1 + int(8 * math.log2(n + 1)))

    def shared(self, codes: np.ndarray) -> np.ndarray:
        """False for tokens that no two lines can share."""
        if self.repeated is None:
            return np.ones(len(codes), dtype=bool)
        return _in_table(self.repeated, codes & np.uint64((1 << HASH_BITS) - 1))

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        slot = (hashes >> np.uint64(HASH_BITS - SLOT_BITS)).astype(np.int64)
        rank = np.where(self.tokens[slot] == hashes, self.classes[slot], np.uint64(0))
        return rank << np.uint64(HASH_BITS) | hashes


def _distinct(codes: np.ndarray, line: np.ndarray, lines: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes of each line, sorted, and the line of each."""
    out, of = [], []
    room = 64 - CODE_BITS
    for base in range(0, lines, 1 << room):
        a, b = np.searchsorted(line, (base, base + (1 << room)))
        key = (line[a:b] - base).astype(np.uint64) << np.uint64(CODE_BITS) | codes[a:b]
        key.sort()
        new = np.ones(len(key), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        key = key[new]
        out.append(key & np.uint64((1 << CODE_BITS) - 1))
        of.append((key >> np.uint64(CODE_BITS)).astype(np.int64) + base)
    return np.concatenate(out), np.concatenate(of)


def _signatures(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple:
    """A 128-bit key of each set, in two halves, and its parity sketch of 128
    bits, in two halves; of a small set these are folded into one."""
    a, b = (np.add.reduceat(_mixed(codes + np.uint64(i), mix), starts) for i, mix in enumerate(_MIX))
    bit = np.uint64(1) << (codes & np.uint64(63))
    upper = (codes >> np.uint64(6)) & np.uint64(1) == 1
    zero = np.uint64(0)
    low = np.bitwise_xor.reduceat(np.where(upper, zero, bit), starts)
    high = np.bitwise_xor.reduceat(np.where(upper, bit, zero), starts)
    small = sizes <= SMALL_SET
    return a, b, np.where(small, low ^ high, low).view(np.int64), np.where(small, zero, high).view(np.int64)


_KINDS = (np.int64, np.int64, np.int32, np.int32, np.int32, np.int64, np.int64, np.int64)


def _rows(columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(c, dtype=k)) for c, k in zip(columns, _KINDS)],
        names=["code", "doc", "pos", "size", "place", "low", "high", "key"])


_PACK = "part int, n int, rows binary"


def _values(part: np.ndarray, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part, those of a part as one value: of each column its
    smallest number and the bytes that the distances from it take, then, column
    after column, the first bytes of all distances, the second, and so on."""
    if not len(part):
        return
    new = np.ones(len(part), dtype=bool)
    new[1:] = part[1:] != part[:-1]
    starts = np.flatnonzero(new)
    cuts = [*starts.tolist(), len(part)]
    rows = np.diff(cuts)
    heads = np.empty((len(starts), 2 * len(columns)), dtype=np.int64)
    planes = []
    for c, column in enumerate(columns):
        column = column.astype(np.int64)
        least = np.minimum.reduceat(column, starts)
        # unsigned, as a distance may be beyond 2**63
        far = (np.maximum.reduceat(column, starts).view(np.uint64) - least.view(np.uint64))
        width = sum((far >> np.uint64(8 * w) > 0).astype(np.int64) for w in range(8))
        heads[:, 2 * c], heads[:, 2 * c + 1] = least, width
        apart = (column.view(np.uint64) - np.repeat(least, rows).view(np.uint64)).view(np.uint8).reshape(-1, 8)
        planes.append(np.ascontiguousarray(apart[:, :width.max()].T))
    widths = heads[:, 1::2].tolist()
    for at in range(0, len(starts), 128):
        ends = cuts[at:at + 129]
        values = [b"".join([head.tobytes(), *(p[:w, x:y].tobytes() for p, w in zip(planes, width) if w)])
                  for head, width, x, y in zip(heads[at:at + 128], widths[at:at + 128], ends, ends[1:])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part[ends[:-1]].astype(np.int32)), pa.array(np.diff(ends).astype(np.int32)),
             pa.array(values, pa.binary())], names=["part", "n", "rows"])


def _columns(value: pa.Scalar, n: int, kinds: tuple) -> list[np.ndarray]:
    """The ``n`` rows of a value, by column."""
    raw = np.frombuffer(value.as_buffer(), dtype=np.uint8)
    at = 16 * len(kinds)
    heads = raw[:at].view(np.int64).tolist()
    out = []
    for kind, least, width in zip(kinds, heads[::2], heads[1::2]):
        apart = np.zeros((n, 8), dtype=np.uint8)
        apart[:, :width] = raw[at:at + n * width].reshape(width, n).T
        out.append((apart.view(np.int64).ravel() + np.int64(least)).astype(kind))
        at += n * width
    return out


def _by_part(batches: Iterator[pa.RecordBatch], kinds: tuple) -> Iterator[list[np.ndarray]]:
    """The columns of each part; values arrive sorted by part."""
    held: list[list[np.ndarray]] = [[] for _ in kinds]
    now = None
    for batch in batches:
        for part, n, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if part != now and held[0]:
                yield [np.concatenate(h) for h in held]
                held = [[] for _ in kinds]
            now = part
            for h, column in zip(held, _columns(value, n, kinds)):
                h.append(column)
    if held[0]:
        yield [np.concatenate(h) for h in held]


def _part(codes: np.ndarray, parts: int) -> np.ndarray:
    """Part of each code, by its upper bits."""
    return (np.where(codes < 0, ~codes, codes) >> (ROW_BITS - 20)) * parts >> 20


def _packed(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Rows of a task, those of each part of the codes as one value."""
    held: list[list[np.ndarray]] = []
    count = 0

    def dealt() -> Iterator[pa.RecordBatch]:
        columns = [np.concatenate([h[c] for h in held]) for c in range(8)]
        held.clear()
        order = np.argsort(columns[0])      # codes of a part stand together, as do those of a sign
        columns = [c[order] for c in columns]
        cut = np.searchsorted(columns[0], 0)
        for some in ([c[:cut] for c in columns], [c[cut:] for c in columns]):
            yield from _values(_part(some[0], parts), some)

    for batch in batches:
        held.append([batch.column(c).to_numpy(zero_copy_only=False) for c in range(8)])
        count += batch.num_rows
        if count >= PACK_ROWS:
            yield from dealt()
            count = 0
    if count:
        yield from dealt()


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by part, a part sorted by code and size; values arrive sorted by part."""
    for columns in _by_part(batches, _KINDS):
        code, size = columns[0], columns[3]
        room = 63 - ROW_BITS
        if int(size.max()) < 1 << room:
            order = np.argsort((code << room) + size)
        else:
            order = np.lexsort((size, code))
        for at in range(0, len(order), GROUP_ROWS):
            some = order[at:at + GROUP_ROWS]
            yield _rows([c[some] for c in columns])


def _line_in_table(table: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> np.ndarray:
    slot = (doc ^ (pos.astype(np.int64) * np.int64(_SPREAD))) & np.int64(FILTER_BITS - 1)
    return (table[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def _row_codes(codes: np.ndarray) -> np.ndarray:
    """Upper bits of the hash: rows need no order among codes, and tokens that
    have them in common only make pairs that are verified."""
    return ((codes & np.uint64((1 << HASH_BITS) - 1)) >> np.uint64(HASH_BITS - ROW_BITS)).view(np.int64)


def _in_table(table: np.ndarray, codes: np.ndarray) -> np.ndarray:
    slot = (codes % np.uint64(FILTER_BITS)).astype(np.int64)
    return (table[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def _enter(batches: Iterator[pa.RecordBatch], rarity: Rarity, t: Fraction,
           known: int | None = None) -> Iterator[pa.RecordBatch]:
    """Rows of the prefix tokens of all lines, and of each set a row whose code
    is negative: by it equal sets meet, whatever task has read them. A line
    whose set the task has entered from an earlier line makes one row of this
    kind only, which says so (size 0). ``known`` is how many sets a task remembers."""
    seen: dict[int, tuple[int, int]] = {}
    for batch in batches:
        for docs, block in _blocks(batch, 0, 1):
            hashes, at = hash_words(b"\n".join(block))
            if not len(hashes):
                continue
            # Lines of all texts of the block, then those that have words.
            counts = np.array([raw.count(b"\n") + 1 for raw in block])
            breaks = np.flatnonzero(np.frombuffer(b"\n".join(block), dtype=np.uint8) == 10)
            line = np.searchsorted(breaks, at)
            codes = rarity.codes(hashes)
            codes, line = _distinct(codes, line, len(breaks) + 1)
            new = np.ones(len(line), dtype=bool)
            new[1:] = line[1:] != line[:-1]
            starts = np.flatnonzero(new)
            number = line[starts]
            sizes = np.diff(np.append(starts, len(codes)))
            doc = np.repeat(np.array(docs, dtype=np.int64), counts)[number]
            pos = (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts))[number]
            one, two, low, high = _signatures(codes, starts, sizes)
            upper = (one >> np.uint64(64 - ROW_BITS)).view(np.int64)
            entered = np.ones(len(starts), dtype=bool)
            both = zip(one.tolist(), two.tolist(), doc.tolist(), pos.tolist())
            for i, (x, y, d, p) in enumerate(both):
                whole = x << 64 | y
                first = seen.get(whole)
                if first is None or (d, p) < first:
                    if len(seen) > (known or KNOWN_SETS):
                        seen.clear()
                    seen[whole] = (d, p)
                elif first < (d, p):
                    entered[i] = False
                # the same id and number again: entered, as neither is earlier
            rest = one & np.uint64((1 << (64 - ROW_BITS)) - 1)
            yield _rows([-1 - upper, doc, pos, np.where(entered, sizes, 0), np.zeros(len(doc)),
                         two.view(np.int64), np.zeros(len(doc)), rest.view(np.int64)])
            prefix = sizes - -(-t.numerator * sizes // t.denominator) + 1
            of = np.repeat(np.arange(len(starts)), sizes)
            place = np.arange(len(codes)) - starts[of]
            take = (place < prefix[of]) & entered[of]
            take[take] = rarity.shared(codes[take])
            of, place, code = of[take], place[take], _row_codes(codes[take])
            if len(of):
                yield _rows([code, doc[of], pos[of], sizes[of], place, low[of], high[of], upper[of]])


_PAIR = "doc bigint, pos int, mdoc bigint, mpos int, sure boolean, more boolean, n int, rows binary"


def _pairs(columns: list, sure: bool, more: np.ndarray) -> pa.RecordBatch:
    kinds = (np.int64, np.int32, np.int64, np.int32)
    n = len(columns[0])
    return pa.RecordBatch.from_arrays(
        [*(pa.array(np.asarray(c, dtype=k)) for c, k in zip(columns, kinds)),
         pa.array(np.full(n, sure)), pa.array(more), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
        names=["doc", "pos", "mdoc", "mpos", "sure", "more", "n", "rows"])


def _kept(columns: list) -> pa.RecordBatch:
    """Rows that may be paired again, as one value in a row without a pair."""
    (packed,) = _values(np.zeros(len(columns[0])), columns)
    nothing = [pa.nulls(1, kind) for kind in (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_())]
    return pa.RecordBatch.from_arrays([*nothing, packed.column(1), packed.column(2)],
                                      names=["doc", "pos", "mdoc", "mpos", "sure", "more", "n", "rows"])


def _pair_up(rows: list[np.ndarray], t: Fraction, tries: int | None, asked: np.ndarray | None
             ) -> Iterator[pa.RecordBatch]:
    """Partners within each code. Rows are sorted by code and size; step k
    compares every row with the k-th after it, while the code is the same and
    the sizes are near enough. The rows of a code of which one has more than
    ``tries`` partners are given too. With ``asked`` (a bit table of lines) these
    lines alone are compared with the rows of their codes."""
    a, b, c = t.numerator, t.denominator, t.numerator + t.denominator
    # A row whose neighbours are of another code, or of sizes too far, has no partner.
    near = (rows[0][1:] == rows[0][:-1]) & (b * rows[3][:-1].astype(np.int64) >= a * rows[3][1:].astype(np.int64))
    some = np.zeros(len(rows[0]), dtype=bool)
    some[1:] = near
    some[:-1] |= near
    code, doc, pos, size, place, low, high, key = (r[some] for r in rows)
    if not len(code):
        return
    # Of equal sets only the first line can be needed, the others are decided.
    # Rows of one id and number stay, as neither is earlier.
    order = np.lexsort((pos, doc, key, size, code))
    code, doc, pos, size, place, low, high, key = (r[order] for r in (code, doc, pos, size, place, low, high, key))
    first = np.ones(len(code), dtype=bool)
    first[1:] = (code[1:] != code[:-1]) | (key[1:] != key[:-1]) | (size[1:] != size[:-1])
    group = np.cumsum(first) - 1
    lead = np.flatnonzero(first)[group]
    keep = (doc == doc[lead]) & (pos == pos[lead])
    rows = [r[keep] for r in (code, doc, pos, size, place, low, high, key)]
    code, doc, pos, size, place, low, high, _ = rows
    n = len(code)
    size, place = size.astype(np.int64), place.astype(np.int64)
    # unsigned: bitwise_count takes the absolute value of signed numbers
    low, high = low.astype(np.int64).view(np.uint64), high.astype(np.int64).view(np.uint64)
    order = np.lexsort((pos, doc))
    same = np.ones(n, dtype=bool)
    same[1:] = (doc[order][1:] != doc[order][:-1]) | (pos[order][1:] != pos[order][:-1])
    when = np.empty(n, dtype=np.int64)
    when[order] = np.cumsum(same)       # equal for rows of one id and number
    folded = low ^ high
    left = size - place                 # tokens from the row's own on
    largest = np.minimum(b * size // a, c * left // a - size)    # size of a partner
    tried = np.zeros(n, dtype=np.int64)
    found: list[tuple] = []
    held, limit = 0, PAIR_ROWS

    def nearest() -> tuple:
        """Of each row the ``tries`` partners that are nearest by sketch."""
        y, x, apart = (np.concatenate([f[c] for f in found]) for c in range(3))
        if tries is None:
            return y, x, apart
        many = tried[y] > tries
        few, of = [v[~many] for v in (y, x, apart)], [v[many] for v in (y, x, apart)]
        order = np.lexsort((of[1], of[2], of[0]))
        of = [v[order] for v in of]
        rank = np.arange(len(order)) - np.searchsorted(of[0], of[0])
        return tuple(np.concatenate([v, w[rank < tries]]) for v, w in zip(few, of))

    def compare(i: np.ndarray, j: np.ndarray) -> tuple:
        """Of rows i and j (not smaller) those that pass the filters, as the
        later row, the earlier row and the bits their sketches differ by. A pair
        need pass at the first token only that its sets share; from there on it
        has no more in common than either set has left."""
        si, sj = size[i], size[j]
        least = -(-a * (si + sj) // c)          # overlap that the threshold needs
        hit = (b * si >= a * sj) & (np.minimum(left[i], left[j]) >= least) & (when[i] != when[j])
        i, j, si, sj, least = i[hit], j[hit], si[hit], sj[hit], least[hit]
        apart = np.where(si <= SMALL_SET, np.bitwise_count(folded[i] ^ folded[j]),
                         np.bitwise_count(low[i] ^ low[j]) + np.bitwise_count(high[i] ^ high[j])).astype(np.int64)
        hit = apart <= si + sj - 2 * least
        i, j, apart = i[hit], j[hit], apart[hit]
        swap = when[i] > when[j]
        return np.where(swap, i, j), np.where(swap, j, i), apart

    if asked is not None:
        for r in np.flatnonzero(_line_in_table(asked, doc, pos)).tolist():
            others = np.arange(np.searchsorted(code, code[r]), np.searchsorted(code, code[r], "right"))
            y, x, apart = compare(np.minimum(others, r), np.maximum(others, r))
            found.append((y[y == r], x[y == r], apart[y == r]))
    else:
        i = np.flatnonzero(largest >= size)
        k = 1
        while len(i):
            i = i[:np.searchsorted(i, n - k)]
            i = i[(code[i] == code[i + k]) & (size[i + k] <= largest[i])]
            y, x, apart = compare(i, i + k)
            if len(x):
                found.append((y, x, apart))
                np.add.at(tried, y, 1)
                held += len(x)
                if tries is not None and held > limit:
                    found = [nearest()]
                    held = len(found[0][0])
                    limit = max(PAIR_ROWS, 2 * held)
            k += 1
    if found:
        y, x, _ = nearest()
        more = tried[y] > tries if tries is not None else np.zeros(len(y), dtype=bool)
        yield _pairs([doc[y], pos[y], doc[x], pos[x]], False, more)
    if tries is not None and (tried > tries).any():
        some = np.isin(code, code[tried > tries])
        yield _kept([r[some] for r in rows])


def _equal_sets(rows: list[np.ndarray]) -> list[np.ndarray]:
    """Of rows with a negative code: those whose set an earlier line has. Rows
    of size 0 are known to be such."""
    same = rows[0][1:] == rows[0][:-1]
    some = rows[3] == 0
    some[1:] |= same
    some[:-1] |= same
    code, doc, pos, size, _, two, _, key = (r[some] for r in rows)
    order = np.lexsort((pos, doc, two, key, code))
    code, doc, pos, size, two, key = (r[order] for r in (code, doc, pos, size, two, key))
    first = np.ones(len(key), dtype=bool)
    first[1:] = (key[1:] != key[:-1]) | (two[1:] != two[:-1]) | (code[1:] != code[:-1])
    lead = np.flatnonzero(first)[np.cumsum(first) - 1]
    gone = (size == 0) | (doc != doc[lead]) | (pos != pos[lead])
    return [doc[gone], pos[gone], doc[lead][gone], pos[lead][gone]]


def _partners(batches: Iterator[pa.RecordBatch], t: Fraction, tries: int | None) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by code and size. A code is held until the next
    begins; of a code with very many rows, equal sets are reduced to their
    first line, and sizes that no later row can match go."""
    held: list[list[np.ndarray]] = []
    count = 0

    def finish(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        sets = rows[0] < 0
        if sets.any():
            gone = _equal_sets([r[sets] for r in rows])
            if len(gone[0]):
                yield _pairs(gone, True, np.zeros(len(gone[0]), dtype=bool))
            rows = [r[~sets] for r in rows]
        if len(rows[0]):
            yield from _pair_up(rows, t, tries, None)

    for batch in batches:
        held.append([batch.column(c).to_numpy(zero_copy_only=False) for c in range(8)])
        count += batch.num_rows
        if count >= GROUP_ROWS:
            rows = [np.concatenate([h[c] for h in held]) for c in range(8)]
            yield from finish(rows)
            last = rows[0] == rows[0][-1]
            if rows[0][-1] < 0:
                # the first line of each set of this code
                tail = [r[last] for r in rows]
                order = np.lexsort((tail[2], tail[1], tail[5], tail[7]))
                tail = [r[order] for r in tail]
                new = np.ones(len(order), dtype=bool)
                new[1:] = (tail[7][1:] != tail[7][:-1]) | (tail[5][1:] != tail[5][:-1])
                held = [[r[new] for r in tail]]
            else:
                # rows that a longer line may still match
                near = last & (t.denominator * rows[3].astype(np.int64) >= t.numerator * int(rows[3][-1]))
                held = [[r[near] for r in rows]]
            count = 0
    if held:
        yield from finish([np.concatenate([h[c] for h in held]) for c in range(8)])


def _similar(left: str | None, right: str | None, t: Fraction) -> bool:
    a = set((left or "").encode("utf-8", "surrogatepass").lower().split())
    b = set((right or "").encode("utf-8", "surrogatepass").lower().split())
    both = len(a & b)
    return both > 0 and t.denominator * both >= t.numerator * (len(a) + len(b) - both)


def _slot(doc: Column, pos: Column) -> Column:
    return (doc.bitwiseXOR(pos.cast("bigint") * F.lit(_SPREAD))).bitwiseAND(F.lit(FILTER_BITS - 1))


def bit_table(slots: DataFrame) -> np.ndarray:
    """A table of ``FILTER_BITS`` bits with those of the column ``slot`` set:
    summed up by Spark in pages; what reaches the driver is of fixed size."""
    pages = (slots.groupBy(F.shiftright("slot", 15).alias("page"))
             .agg(F.bitmap_construct_agg(F.col("slot") % 32768).alias("bits")).collect())
    table = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for r in pages:
        table[r.page * 4096:(r.page + 1) * 4096] = np.frombuffer(bytes(r.bits), dtype=np.uint8)
    return table


def _lines_at(wanted: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns doc, pos, line of the wanted lines (columns doc, pos), and of
    few others: a bit table of fixed size is asked for every line, so that
    only these lines are shuffled later, not the texts."""
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(bit_table(wanted.select(_slot(F.col("doc"), F.col("pos")).alias("slot"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = table.value
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            ids = pc.fill_null(batch.column(0), NULL_ID).to_numpy(zero_copy_only=False)
            counts = pc.fill_null(pc.count_substring(batch.column(1), "\n"), 0).to_numpy(zero_copy_only=False) + 1
            of = np.repeat(np.arange(len(counts)), counts)
            pos = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
            hit = np.flatnonzero(_line_in_table(bits, ids[of], pos))
            now, lines = -1, []
            for r, p in zip(of[hit].tolist(), pos[hit].tolist()):
                if r != now:
                    now, lines = r, (batch.column(1)[r].as_py() or "").split("\n")
                out[0].append(ids[r])
                out[1].append(p)
                out[2].append(lines[p])
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.string())],
                names=["doc", "pos", "line"])

    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col)).mapInArrow(
        releasing(run), "doc bigint, pos int, line string")


def _verified(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, t: Fraction) -> DataFrame:
    """``pairs`` with a column ``good``, from the words of both lines. Of rows
    that repeat an id each gives a line; a pair is good if any of them is."""
    ends = pairs.select("doc", "pos").union(pairs.select("mdoc", "mpos")).distinct()
    lines = materialize(_lines_at(ends, docs, id_col, text_col), "lines")
    left = pairs.join(lines.withColumnRenamed("line", "a"), ["doc", "pos"])
    right = lines.select(F.col("doc").alias("mdoc"), F.col("pos").alias("mpos"), F.col("line").alias("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [_similar(x, y, t) for x, y in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc", "pos", "more")] + [pa.array(good, pa.bool_())],
                names=["doc", "pos", "more", "good"])

    return left.join(right, ["mdoc", "mpos"]).select("doc", "pos", "more", "a", "b").mapInArrow(
        releasing(run), "doc bigint, pos int, more boolean, good boolean")


def removed_lines(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
                  text_col: str = "text", tries: int = TRIES) -> DataFrame:
    """Columns ``doc`` and ``pos``: the lines (numbered from 0) that go."""
    spark = docs.sparkSession
    ship(spark)
    t = Fraction(threshold).limit_denominator(1000)
    counts = materialize(token_counts(docs, text_col, 2), "tokens")
    top = counts.orderBy(F.desc("n"), "h").limit(FREQUENT).collect()
    repeated = bit_table(counts.select((F.col("h") % FILTER_BITS).alias("slot")))
    rarity = spark.sparkContext.broadcast(Rarity([(r.h, r.n) for r in top], repeated))
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).alias("text"))
    words = counts.agg(F.sum("n")).first()[0] or 0
    parts = min(max(words // PART_WORDS, PARTS[0]), PARTS[1])

    rows = texts.mapInArrow(releasing(lambda it: _packed(_enter(it, rarity.value, t), parts)), _PACK)
    found = materialize(rows.repartition("part").sortWithinPartitions("part")
                        .mapInArrow(releasing(lambda it: _partners(_unpacked(it), t, tries)), _PAIR), "partners")
    unsure = materialize(found.where(~F.col("sure")).groupBy("doc", "pos", "mdoc", "mpos")
                         .agg(F.max("more").alias("more")), "pairs")
    tested = materialize(_verified(unsure, docs, id_col, text_col, t)
                         .groupBy("doc", "pos").agg(F.max("good").alias("good"), F.max("more").alias("more")),
                         "tested")
    gone = found.where("sure").select("doc", "pos").union(tested.where("good").select("doc", "pos"))
    again = tested.where("more AND NOT good").select("doc", "pos")
    if not again.isEmpty():
        gone = gone.union(_tried_again(again, found, docs, t, id_col, text_col))
    return gone.distinct()


def _tried_again(again: DataFrame, found: DataFrame, docs: DataFrame, t: Fraction, id_col: str,
                 text_col: str) -> DataFrame:
    """Lines of ``again`` that match any earlier line: joined with all partners,
    among the rows that were kept of their codes."""
    asked = docs.sparkSession.sparkContext.broadcast(
        bit_table(again.select(_slot(F.col("doc"), F.col("pos")).alias("slot"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                yield from _pair_up(_columns(value, n, _KINDS), t, None, asked.value)

    every = found.where("rows IS NOT NULL").select("n", "rows").mapInArrow(releasing(run), _PAIR)
    pairs = materialize(every.join(again, ["doc", "pos"], "left_semi")
                        .groupBy("doc", "pos", "mdoc", "mpos").agg(F.max("more").alias("more")), "again")
    return _verified(pairs, docs, id_col, text_col, t).where("good").select("doc", "pos")


def line_report(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_lines``, ``n_removed``, ``removed_lines``."""
    gone = removed_lines(docs, threshold, id_col, text_col)
    lists = materialize(gone.groupBy("doc").agg(F.sort_array(F.collect_list("pos")).alias("gone")), "gone")
    given = docs.select(F.col(id_col).alias("id"),
                        F.coalesce(F.col(id_col).cast("bigint"), F.lit(NULL_ID)).alias("doc"),
                        F.coalesce(F.size(F.split(text_col, "\n", -1)), F.lit(0)).alias("n"))
    empty = F.array().cast("array<int>")
    return (given.join(lists, "doc", "left").withColumn("gone", F.coalesce("gone", empty))
            .select(F.col("id").alias(id_col), F.when(F.col("n") < 0, 0).otherwise(F.col("n")).cast("bigint").alias("n_lines"),
                    F.size("gone").cast("bigint").alias("n_removed"), F.col("gone").alias("removed_lines")))


def drop_lines(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
               text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``docs`` without the removed lines; a character count, if there is such
    a column, is that of the new text."""
    gone = removed_lines(docs, threshold, id_col, text_col)
    doc, lists_col = fresh(docs, "line_doc"), fresh(docs, "line_gone")
    lists = materialize(gone.groupBy("doc").agg(F.collect_list("pos").alias("gone"))
                        .select(F.col("doc").alias(doc), F.col("gone").alias(lists_col)), "gone")
    keep = F.filter(F.split(F.col(text_col), "\n", -1), lambda x, i: ~F.array_contains(lists_col, i))
    text = F.when(F.col(lists_col).isNull(), F.col(text_col)).otherwise(F.array_join(keep, "\n"))
    out = (docs.withColumn(doc, F.coalesce(F.col(id_col).cast("bigint"), F.lit(NULL_ID)))
           .join(lists, doc, "left").withColumn(text_col, text))
    if chars_col in docs.columns:
        kind = docs.schema[chars_col].dataType
        out = out.withColumn(chars_col, F.when(F.col(lists_col).isNull(), F.col(chars_col))
                             .otherwise(F.length(text_col).cast(kind)))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
