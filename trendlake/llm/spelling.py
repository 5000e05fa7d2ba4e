"""Spelling variants: words one edit apart, found with a trie of letter counts.

Every word has a vector: how often the letters of each letter group occur in
it. One inserted, deleted or replaced code point changes the vector by a
surplus of one in one group at most and a deficit of one in one group at most.
The vectors make a trie whose levels are the groups and whose branches are the
counts. The search for a word descends depth first, along its own counts and,
while the budget of one surplus and one deficit lasts, along the neighbouring
ones; the words of the leaves it reaches are verified code point by code point.

The top of the trie is laid out over the cluster: a shard is the counts of the
first few groups and of all others together. A word looks into its own shard
and into those that one surplus and one deficit lead to, half of them, as the
other half looks into its own. The number of groups so used grows with the
number of words, and a shard with more than ``SHARD_WORDS`` words is dealt over
blocks that are searched one by one, so no task holds more words than that.

Words are counted before: occurrences are aggregated on the map side, so a word
that makes up a third of the corpus is one row of each map task.

Defined results: a null text has no words; a null id counts as an empty one;
repeated rows count each; words of any length are compared whole; a word
without a near word has a null form, a null form_n and itself as root; an
empty table gives an empty table; other columns of the input are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import key_slices, materialize, releasing, ship

LETTERS = r"A-Za-z\u00C0-\u00FF"
HELD = 1 << 18          # distinct words a task counts before it passes them on
MISSPELT = 97           # one occurrence in so many loses a code point
SHORTEST = 5            # code points of a word
LEAST = 3               # occurrences of a word
HEAVIER = 2             # times as many occurrences as the word a form must have

# Letter groups, frequent letters first. All other code points go to the groups
# in turn.
GROUPS = ("e", "a", "i", "n", "r", "s", "t", "o", "l", "h", "d", "u", "c", "m", "p", "g", "f", "b", "vk",
          "wyz", "jqx")
SHARD_WORDS = 1 << 16   # words of a block, whose trie one task holds
CHUNK = 1 << 12         # words that descend together
STATES = 1 << 16        # search states expanded together
PAIRS = 1 << 18         # candidate pairs verified together
DENSE = 1 << 22         # numbers of branches of a level that are held in an array


def _group_table() -> np.ndarray:
    table = (np.arange(0x110000) % len(GROUPS)).astype(np.uint8)
    for i, letters in enumerate(GROUPS):
        for c in letters:
            table[ord(c)] = i
    return table


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", misspelt: int = MISSPELT,
                shortest: int = SHORTEST) -> DataFrame:
    """Columns ``word`` and ``n``, words of at least ``shortest`` code points,
    counted per task (a word may come several times). Words are runs of
    letters, lower-cased (A-Z only); if ``misspelt`` divides h, the CRC-32 of
    '<id>:<run>', code point h % length is left out."""
    ship(docs.sparkSession)
    # Shorter runs end before this many letters, wherever they begin.
    find = re.compile(f"[{LETTERS}]{{{max(1, shortest)},}}").findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: defaultdict[str, int] = defaultdict(int)

        def flush() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays(
                [pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])
            total.clear()
            return rows

        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                # bytes.lower() changes A-Z only
                lowered = (text.as_py() or "").encode("utf-8", "surrogatepass").lower()
                base = crc32(f"{key.as_py() or ''}:".encode("utf-8", "surrogatepass"))
                for word, n in Counter(find(lowered.decode("utf-8", "surrogatepass"))).items():
                    h = crc32(word.encode(), base)
                    if not h % misspelt:
                        cut = h % len(word)
                        word = word[:cut] + word[cut + 1:]
                        if len(word) < shortest:
                            continue
                    total[word] += n
            if len(total) > HELD:
                yield flush()
        yield flush()

    return docs.select(F.col(id_col).cast("string"), text_col).mapInArrow(
        releasing(run), "word string, n bigint")


def vocabulary(counts: DataFrame, least: int = LEAST) -> DataFrame:
    """Columns ``word`` and ``n``: words of at least ``least`` occurrences."""
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# ---- the trie ----------------------------------------------------------------

def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points, and where each word begins (one more than words)."""
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    return points, np.concatenate([[0], np.cumsum(lengths)])


@dataclass
class Words:
    """Words with their code points and letter-group counts."""
    texts: pa.Array
    n: np.ndarray
    points: np.ndarray
    starts: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array, n: np.ndarray, groups: np.ndarray) -> "Words":
        points, starts = code_points(texts.to_pylist())
        lengths = np.diff(starts)
        which = np.repeat(np.arange(len(lengths)), lengths)
        flat = np.bincount(which * len(GROUPS) + groups[points], minlength=len(lengths) * len(GROUPS))
        return cls(texts, n, points, starts, flat.reshape(-1, len(GROUPS)))

    def matrix(self, rows: np.ndarray, length: int) -> np.ndarray:
        """Code points of words that all have ``length`` of them."""
        return self.points[self.starts[rows][:, None] + np.arange(length)]


def leaves(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct vectors in order, all words vector by vector, and where each
    vector's words begin (one more than vectors)."""
    packed = np.ascontiguousarray(counts.astype(">u4")).view(np.dtype((np.void, counts.shape[1] * 4))).ravel()
    order = np.argsort(packed, kind="stable")
    rows = counts[order]
    fresh = np.ones(len(rows), dtype=bool)
    fresh[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    return rows[fresh], order, np.append(np.flatnonzero(fresh), len(rows))


class CountTrie:
    """Level by level, the branches as sorted keys (node, count): the place of
    a branch is the number of the node it leads to. Levels whose keys are few
    numbers also hold the places in an array."""

    def __init__(self, counts: np.ndarray) -> None:
        rows, self.members, self.leaf_starts = leaves(counts)
        self.room = int(rows.max(initial=0)) + 3              # counts of a branch, with margins
        self.branches: list[np.ndarray] = []
        self.places: list[np.ndarray | None] = []
        node = np.zeros(len(rows), dtype=np.int64)
        for level in range(rows.shape[1]):
            keys = node * self.room + rows[:, level] + 1
            begins = np.ones(len(rows), dtype=bool)
            begins[1:] = keys[1:] != keys[:-1]
            keys = keys[begins]
            self.branches.append(keys)
            place = None
            if keys[-1] < DENSE:
                place = np.full(int(keys[-1]) + self.room + 1, -1, dtype=np.int32)
                place[keys] = np.arange(len(keys))
            self.places.append(place)
            node = np.cumsum(begins) - 1

    def _branch(self, level: int, key: np.ndarray) -> np.ndarray:
        """Node that a branch leads to; -1 where there is none."""
        if self.places[level] is not None:
            place = self.places[level]
            return np.where(key < len(place), place[np.minimum(key, len(place) - 1)], -1)
        keys = self.branches[level]
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where(keys[at] == key, at, -1)

    def search(self, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, leaf) within a surplus of one and a deficit of one. The
        deepest states are expanded first, many at a time."""
        zero = np.zeros(len(counts), dtype=np.int64)
        stack = [(0, np.arange(len(counts)), zero, zero)]
        while stack:
            level, query, node, spent = stack.pop()
            if len(query) > STATES:
                half = len(query) // 2
                stack.append((level, query[half:], node[half:], spent[half:]))
                stack.append((level, query[:half], node[:half], spent[:half]))
                continue
            if level == len(self.branches):
                yield query, node
                continue
            own = counts[query, level]
            found = []
            # spent: bit 0 for the surplus, bit 1 for the deficit
            for step, bit in ((0, 0), (1, 1), (-1, 2)):
                able = np.flatnonzero((spent & bit == 0) & (own + step >= 0) & (own + step < self.room - 1))
                at = self._branch(level, node[able] * self.room + own[able] + step + 1)
                hit = able[at >= 0]
                found.append((query[hit], at[at >= 0].astype(np.int64), spent[hit] | bit))
            merged = tuple(np.concatenate(x) for x in zip(*found))
            if len(merged[0]):
                stack.append((level + 1, *merged))


def one_edit(a: Words, i: np.ndarray, b: Words, j: np.ndarray) -> np.ndarray:
    """Which of the pairs differ by exactly one inserted, deleted or replaced
    code point: the shorter word is a common beginning and a common end, up to
    one code point of the longer."""
    la, lb = np.diff(a.starts)[i], np.diff(b.starts)[j]
    right = np.zeros(len(i), dtype=bool)
    near = np.abs(la - lb) <= 1
    lengths = np.where(near, la * 4 + (lb - la + 1), -1)
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order], prepend=-2))
    for x, y in zip(cuts, np.append(cuts[1:], len(order))):
        rows = order[x:y]
        if lengths[rows[0]] < 0:
            continue
        na, nb = int(la[rows[0]]), int(lb[rows[0]])
        short = min(na, nb)
        step = max(1, (1 << 22) // max(1, max(na, nb)))
        for at in range(0, len(rows), step):
            some = rows[at:at + step]
            p, q = a.matrix(i[some], na), b.matrix(j[some], nb)
            front = np.logical_and.accumulate(p[:, :short] == q[:, :short], axis=1).sum(axis=1)
            back = np.logical_and.accumulate(p[:, na - short:][:, ::-1] == q[:, nb - short:][:, ::-1],
                                             axis=1).sum(axis=1)
            if na == nb:
                right[some] = (front < na) & (front + back == na - 1)
            else:
                right[some] = front + back >= short
    return right


def _products(i: np.ndarray, i_sizes: np.ndarray, j: np.ndarray, j_sizes: np.ndarray
              ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All members of run k of ``i`` with all of run k of ``j``, for each k, in
    pieces of about ``PAIRS``. Runs are given by first place and size."""
    # A run of i is cut to members first, so that a piece never holds more than one run of j beyond its room.
    which = np.repeat(np.arange(len(i)), i_sizes)
    member = i[which] + np.arange(len(which)) - np.repeat(np.cumsum(i_sizes) - i_sizes, i_sizes)
    sizes = j_sizes[which]
    ends = np.cumsum(sizes)
    x = 0
    while x < len(which):
        y = max(x + 1, int(np.searchsorted(ends, (ends[x - 1] if x else 0) + PAIRS, side="right")))
        some = sizes[x:y]
        inside = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
        yield np.repeat(member[x:y], some), np.repeat(j[which[x:y]], some) + inside
        x = y


def near_pairs(trie: CountTrie, home: Words, asking: Words, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Verified pairs (place in ``asking``, place in ``home``). ``same``: both
    are the same words, and each pair comes once. Words of one vector descend
    as one."""
    vectors, words, starts = leaves(asking.counts)
    sizes, leaf_sizes = np.diff(starts), np.diff(trie.leaf_starts)
    for at in range(0, len(vectors), CHUNK):
        for query, leaf in trie.search(vectors[at:at + CHUNK]):
            query = query + at
            if same:        # both sides have the same leaves, in the same order
                query, leaf = query[query <= leaf], leaf[query <= leaf]
            for p, q in _products(starts[query], sizes[query], trie.leaf_starts[leaf], leaf_sizes[leaf]):
                i, j = words[p], trie.members[q]
                if same:
                    once = p < q
                    i, j = i[once], j[once]
                good = one_edit(asking, i, home, j)
                if good.any():
                    yield i[good], j[good]


# ---- over the cluster --------------------------------------------------------

def _moves(size: int) -> list[list[int]]:
    """Differences of shard counts by one surplus and one deficit at most, of
    each opposite pair the greater one."""
    steps = {tuple((i == p) - (i == m) for i in range(size)) for p in range(-1, size) for m in range(-1, size)}
    return [list(s) for s in sorted(steps) if s > (0,) * size]


def _shard_counts(word: Column, depth: int) -> Column:
    own = [F.length(word) - F.length(F.translate(word, letters, "")) for letters in GROUPS[:depth]]
    rest = F.length(word)
    for c in own:
        rest = rest - c
    return F.array(*own, rest)


def depth_for(words: int) -> int:
    """Groups laid out over the cluster. A shard of one group holds about a
    twelfth of all words, and each further group cuts it to two fifths."""
    return min(len(GROUPS), max(1, math.ceil(math.log(max(1, words / (12 * SHARD_WORDS)), 2.5)) + 1))


def _name(counts: Column) -> Column:
    return F.array_join(counts.cast("array<string>"), ",")


def _visits(words: DataFrame, depth: int) -> DataFrame:
    """Every word at home (kind 0) and in the shards it looks into (kind 1)."""
    shards = words.select("word", "n", _shard_counts(F.col("word"), depth).alias("own"))
    home = shards.select(_name(F.col("own")).alias("shard"), F.lit(0).alias("kind"), "word", "n")
    moves = F.array(*[F.array(*map(F.lit, m)) for m in _moves(depth + 1)])
    moved = F.transform(moves, lambda m: F.zip_with(F.col("own"), m, lambda x, y: x + y))
    real = F.filter(moved, lambda c: F.forall(c, lambda x: x >= 0))
    away = shards.select(F.explode(real).alias("there"), "word", "n").select(
        _name(F.col("there")).alias("shard"), F.lit(1).alias("kind"), "word", "n")
    return home.union(away)


def _dealt(visits: DataFrame) -> DataFrame:
    """Shards of too many words are dealt over blocks by the hash of the word;
    a word of such a shard looks into its own block and those after it, words
    from elsewhere into all."""
    sizes = (visits.where("kind = 0").groupBy("shard").agg(F.count(F.lit(1)).alias("size"))
             .select("shard", F.ceil(F.col("size") / SHARD_WORDS).cast("int").alias("blocks")))
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    joined = visits.join(sizes, "shard").withColumn("own", own)
    blocks = F.when(F.col("kind") == 1, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(
        F.sequence(F.col("own"), F.col("blocks") - 1))
    spread = joined.select("shard", F.explode(blocks).alias("block"), "kind", "own", "word", "n")
    kind = F.when((F.col("kind") == 0) & (F.col("block") != F.col("own")), 1).otherwise(F.col("kind"))
    return spread.select("shard", "block", kind.alias("kind"), "word", "n")


def near_words(words: DataFrame) -> DataFrame:
    """``words``: columns word and n, each word once. Returns ``word``,
    ``near`` and ``near_n``: both directions of every pair of words that are
    one edit apart."""
    ship(words.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = _group_table()
        held: list[pa.RecordBatch] = []
        key, trie, home = None, None, None

        def emit(asking: Words, same: bool) -> Iterator[pa.RecordBatch]:
            for i, j in near_pairs(trie, home, asking, same):
                a, b = asking.texts.take(pa.array(i)), home.texts.take(pa.array(j))
                yield pa.RecordBatch.from_arrays([a, b, pa.array(home.n[j])], names=["word", "near", "near_n"])
                yield pa.RecordBatch.from_arrays([b, a, pa.array(asking.n[i])], names=["word", "near", "near_n"])

        def words_of(parts: list[pa.RecordBatch]) -> Words:
            rows = pa.Table.from_batches(parts).combine_chunks()
            return Words.of(rows.column("word").combine_chunks(), rows.column("n").to_numpy(), groups)

        def settle() -> Iterator[pa.RecordBatch]:
            nonlocal trie, home, held
            if held:
                home = words_of(held)
                held = []
                trie = CountTrie(home.counts)
                yield from emit(home, True)

        for (shard, block, kind), rows in key_slices(batches, 3):
            if (shard, block) != key:
                yield from settle()
                key, trie, home = (shard, block), None, None
            if kind == 0:
                held.append(rows)
                continue
            yield from settle()
            if trie is not None:
                yield from emit(words_of([rows]), False)
        yield from settle()

    count = words.count()
    rows = _dealt(_visits(words, depth_for(count)))
    near = (rows.repartition("shard", "block").sortWithinPartitions("shard", "block", "kind")
            .mapInArrow(releasing(run), "word string, near string, near_n bigint"))
    return near


def forms(words: DataFrame, near: DataFrame, heavier: int = HEAVIER) -> DataFrame:
    """Columns word, form, n, n_near and form_n of every word: its form is the
    near word of most occurrences (ties: the smallest), if that has at least
    ``heavier`` times its own."""
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    joined = words.join(best, "word", "left").withColumn("near_n", -F.col("best.less"))
    fits = F.col("near_n") >= heavier * F.col("n")
    return joined.select("word", F.when(fits, F.col("best.near")).alias("form"), "n",
                         F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                         F.when(fits, F.col("near_n")).alias("form_n"))


def with_roots(table: DataFrame) -> DataFrame:
    """The last form that forms lead to, by pointer jumping. A form has more
    occurrences than its word, so there are no rings and a round halves what
    is left of every chain."""
    steps = materialize(table.where("form is not null").select("word", F.col("form").alias("root")), "forms")
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ahead = steps.join(further, "root", "left")
        steps = materialize(ahead.select("word", F.coalesce("further", "root").alias("root"),
                                         F.col("further").isNotNull().alias("moved")), "forms")
        if steps.where("moved").isEmpty():
            break
        steps = steps.drop("moved")
    return table.join(steps.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_forms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", misspelt: int = MISSPELT,
                   shortest: int = SHORTEST, least: int = LEAST, heavier: int = HEAVIER) -> DataFrame:
    """Words of the documents with their forms: word, form, root, n, n_near,
    form_n."""
    words = materialize(vocabulary(word_counts(docs, id_col, text_col, misspelt, shortest), least), "words")
    table = materialize(forms(words, near_words(words), heavier), "word_forms")
    return with_roots(table)
