"""Byte-level BPE encoding and decoding by corpus-level merge replay.

A task treats the distinct pieces of its texts as one corpus: their bytes lie
end to end in one array, an inverted index maps each mergeable token pair to
the positions where it stands, and the merges are replayed in rank order over
all positions at once. A merge touches only its two neighbours. Pieces never
share a merge, so replaying a block of pieces gives exactly the ids that
merging each piece alone (lowest rank first, leftmost first) gives.

Defined results: a null text counts as empty; an empty text has no ids; a
text of any length is encoded whole; repeated rows are encoded each; an empty
table gives an empty table; other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import releasing, ship

# Distinct pieces a task remembers between batches; beyond it the memory
# starts anew (the ids of a piece never depend on what is remembered).
MEMORY_PIECES = 150_000
BLOCK_CHARS = 1_000_000    # text that stands in memory as pieces and ids
REPLAY_BYTES = 500_000     # bytes of new pieces replayed together
MEMORY_PAIRS = 300_000     # ranks of token pairs remembered

_NONE = -1


def _lower(ranks: np.ndarray, than: int) -> bool:
    return bool(((ranks >= 0) & (ranks < than)).any())


class MergeReplay:
    """Ranks of one vocabulary and the replay over blocks of pieces."""

    def __init__(self, rank_lines: bytes, pattern: str):
        self.ranks: dict[bytes, int] = {}
        for line in rank_lines.splitlines():
            if line:
                token, rank = line.split()
                self.ranks[base64.b64decode(token)] = int(rank)
        self.tokens = {r: t for t, r in self.ranks.items()}
        self._byte_ids = np.array([self.ranks.get(bytes([b]), _NONE) for b in range(256)])
        if (self._byte_ids < 0).any():
            raise ValueError("the vocabulary must hold all 256 single bytes")
        self._byte_pairs = np.array([[self.ranks.get(bytes([a, b]), _NONE) for b in range(256)]
                                     for a in range(256)])
        self.split = regex.compile(pattern).findall
        self._pair_rank: dict[int, int] = {}
        self._memory: dict[str, bytes] = {}

    def _pair_rank_slow(self, key: int) -> int:
        r = self.ranks.get(self.tokens[key >> 32] + self.tokens[key & 0xFFFFFFFF], _NONE)
        if len(self._pair_rank) >= MEMORY_PAIRS:
            self._pair_rank.clear()
        self._pair_rank[key] = r
        return r

    def replay(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of every piece (little-endian unsigned 32-bit), by one replay."""
        raw = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        ends = np.cumsum(lengths)
        starts = ends - lengths
        n = len(raw)
        nxt = np.arange(1, n + 1)
        prv = np.arange(-1, n - 1)
        pair = np.full(n, _NONE)
        if n > 1:
            pair[:-1] = self._byte_pairs[raw[:-1], raw[1:]]
        filled = lengths > 0
        nxt[ends[filled] - 1] = _NONE
        prv[starts[filled]] = _NONE
        pair[ends[filled] - 1] = _NONE
        state = (self._byte_ids[raw], nxt, prv, pair)
        merged = self._merge_together(*(x.copy() for x in state))
        if merged is None:
            merged = self._merge_stepwise(*(x.tolist() for x in state))
        ids, alive = merged
        # A merge keeps the left position, so order and pieces stay in place.
        cut = np.concatenate([[0], np.cumsum(alive)])
        out = ids[alive].astype("<u4").tobytes()
        return [out[4 * x:4 * y] for x, y in zip(cut[starts].tolist(), cut[ends].tolist())]

    def _ranks_of(self, keys: np.ndarray) -> np.ndarray:
        """Ranks of pairs, each given as left << 32 | right."""
        values, where = np.unique(keys, return_inverse=True)
        known, slow = self._pair_rank, self._pair_rank_slow
        found = [r if (r := known.get(k)) is not None else slow(k) for k in values.tolist()]
        return np.array(found, dtype=np.int64)[where]

    def _merge_together(self, ids, nxt, prv, pair):
        """Apply each merge at all its positions at once.

        That equals one merge at a time as long as no merge makes a pair of a
        lower rank than its own, which holds for trained vocabularies. If it
        ever happens the block is given up (None) and merged stepwise.
        """
        alive = np.ones(len(ids), dtype=bool)
        marked = np.zeros(len(ids), dtype=bool)
        index: dict[int, list[np.ndarray]] = {}

        def enter(ranks, places):
            order = np.argsort(ranks, kind="stable")
            ranks, places = ranks[order], places[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            lows = [0, *cuts.tolist()]
            for r, x, y in zip(ranks[lows].tolist(), lows, [*lows[1:], len(ranks)]):
                if r in index:
                    index[r].append(places[x:y])
                else:
                    index[r] = [places[x:y]]
                    heapq.heappush(queue, r)

        queue: list[int] = []
        at = np.flatnonzero(pair >= 0)
        if len(at):
            enter(pair[at], at)
        while queue:
            rank = heapq.heappop(queue)
            places = np.concatenate(index.pop(rank))
            places = np.unique(places[pair[places] == rank])
            if not len(places):
                continue
            q = nxt[places]
            marked[places] = True
            if marked[q].any():          # runs such as "aaa": leftmost first
                kept, taken = [], _NONE
                for x, y in zip(places.tolist(), q.tolist()):
                    if x != taken:
                        kept.append(x)
                        taken = y
                marked[places] = False
                places = np.array(kept)
                q = nxt[places]
                marked[places] = True
            after = nxt[q]
            has = after >= 0
            near, behind = places[has], after[has]
            beside = marked[behind]      # the next token is being merged too
            marked[places] = False
            base = rank << 32
            if beside.any() and _lower(self._ranks_of(base | ids[behind[beside]]), rank):
                return None
            ids[places] = rank
            nxt[places] = after
            alive[q] = False
            pair[q] = _NONE
            pair[places] = _NONE
            prv[behind] = near
            before = prv[places]
            before = before[before >= 0]
            places = np.concatenate([near, before])
            ranks = self._ranks_of(np.concatenate([base | ids[behind], ids[before] << 32 | rank]))
            pair[places] = ranks
            if _lower(ranks, rank):
                return None
            real = ranks >= 0
            if real.any():
                enter(ranks[real], places[real])
        return ids, alive

    def _merge_stepwise(self, ids, nxt, prv, pair):
        """One merge at a time, for any vocabulary."""
        alive = [True] * len(ids)
        index: dict[int, list[int]] = {}
        for p, r in enumerate(pair):
            if r >= 0:
                index.setdefault(r, []).append(p)
        known, slow = self._pair_rank, self._pair_rank_slow
        queue = sorted(index)
        pop, push = heapq.heappop, heapq.heappush
        while queue:
            rank = pop(queue)
            places = index.pop(rank, None)
            if places is None:
                continue
            places.sort()
            later: list[int] = []     # same rank, but a lower one now stands in the piece
            held_to = -1              # pieces are contiguous: hold until the piece ends
            for p in places:
                if pair[p] != rank:
                    continue
                if p <= held_to:
                    later.append(p)
                    continue
                q = nxt[p]
                after = nxt[q]
                ids[p] = rank
                nxt[p] = after
                pair[q] = _NONE
                alive[q] = False
                if after >= 0:
                    prv[after] = p
                    key = rank << 32 | ids[after]
                    r = known.get(key)
                    if r is None:
                        r = slow(key)
                    pair[p] = r
                    if r >= 0:
                        if r in index:
                            index[r].append(p)
                        else:
                            index[r] = [p]
                            push(queue, r)
                        if r < rank:
                            held_to = self._end(nxt, p)
                else:
                    pair[p] = _NONE
                before = prv[p]
                if before >= 0:
                    key = ids[before] << 32 | rank
                    r = known.get(key)
                    if r is None:
                        r = slow(key)
                    pair[before] = r
                    if r >= 0:
                        if r in index:
                            index[r].append(before)
                        else:
                            index[r] = [before]
                            push(queue, r)
                        if r < rank:
                            held_to = self._end(nxt, p)
            if later:
                if rank in index:
                    index[rank] += later
                else:
                    index[rank] = later
                    push(queue, rank)
        return np.array(ids, dtype=np.int64), np.array(alive, dtype=bool)

    @staticmethod
    def _end(nxt: list[int], p: int) -> int:
        while nxt[p] >= 0:
            p = nxt[p]
        return p

    def _learn(self, pieces: set[str]) -> None:
        if len(self._memory) + len(pieces) > MEMORY_PIECES:
            self._memory = {}
        block: list[tuple[str, bytes]] = []
        size = 0
        for piece in pieces:
            raw = piece.encode("utf-8", "surrogatepass")
            known = self.ranks.get(raw)
            if known is not None:       # a whole piece in the vocabulary is one token
                self._memory[piece] = known.to_bytes(4, "little")
                continue
            block.append((piece, raw))
            size += len(raw)
            if size >= REPLAY_BYTES:
                self._replay_block(block)
                block, size = [], 0
        self._replay_block(block)

    def _replay_block(self, block: list[tuple[str, bytes]]) -> None:
        for (piece, _), ids in zip(block, self.replay([raw for _, raw in block])):
            self._memory[piece] = ids

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.split(t) for t in texts]
        distinct = set().union(*split) if split else set()
        new = distinct.difference(self._memory)
        if new:
            if len(self._memory) + len(new) > MEMORY_PIECES:
                self._memory = {}
                new = distinct
            self._learn(new)
        memory = self._memory
        for pieces in split:
            yield b"".join([memory[p] for p in pieces])

    def decode(self, ids: bytes) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])


def _blocks(texts: pa.Array, limit: int = BLOCK_CHARS) -> Iterator[list[str]]:
    block, size = [], 0
    for value in texts:
        block.append(value.as_py() or "")
        size += len(block[-1])
        if size >= limit:
            yield block
            block, size = [], 0
    if block:
        yield block


def encode_documents(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Ids of every whole text and the digests of ids and decoded bytes.

    ``rank_file`` names a vocabulary file of token and rank lines on the
    driver; it is of fixed size (under 1 MB) and is broadcast. Columns:
    ``id_col``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, with
    ``with_ids``, ``ids`` (array of int).
    """
    spark = docs.sparkSession
    ship(spark)
    with open(rank_file, "rb") as f:
        ranks = spark.sparkContext.broadcast((f.read(), pattern))
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        schema += ", ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A replay lives as long as its task: a worker lives on idle after it, and
        # what it keeps counts against the executor in all later stages.
        replay = MergeReplay(*ranks.value)
        for batch in batches:
            # a block of texts at a time, so that a batch never stands in memory
            # as text, pieces and ids together
            at = 0
            for block in _blocks(batch.column(1)):
                n, a, b, lists = [], [], [], []
                for ids in replay.encode(block):
                    n.append(len(ids) // 4)
                    a.append(hashlib.sha256(ids).hexdigest())
                    b.append(hashlib.sha256(replay.decode(ids)).hexdigest())
                    if with_ids:
                        lists.append(ids)
                out = [batch.column(0).slice(at, len(block)), pa.array(n, pa.int64()),
                       pa.array(a, pa.string()), pa.array(b, pa.string())]
                names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                    flat = np.frombuffer(b"".join(lists), dtype="<i4")
                    out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
                    names.append("ids")
                at += len(block)
                yield pa.RecordBatch.from_arrays(out, names=names)

    return docs.select(id_col, text_col).mapInArrow(releasing(run), schema)
