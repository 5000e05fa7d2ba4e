"""Toxicity by compression distance with two zstandard dictionaries.

One dictionary is trained on ordinary text, one on toxic text. A document is
cut into short overlapping windows; every window is compressed with either
dictionary, and the difference of the two lengths says to which text it is
closer. The document's score is a logistic function, fitted on labelled rows,
of its largest difference and of the sum of differences above a threshold.

Labels mark whole documents, of which few words may be toxic, so the toxic
dictionary is trained on those stretches of toxic documents whose byte strings
are over-represented there (likelihood ratio) against ordinary documents. It
is put in front of the ordinary dictionary's content, so that windows without
anything toxic compress alike. These byte strings are cut out of the text that
the ordinary dictionary is trained on: many occur in ordinary text too, only
more rarely, and would else compress alike with either dictionary.

Training reads a bounded sample of labelled rows (``Training``): the rows of
smallest id hash per class, of at most ``max_bytes`` each. Scores read every
document whole.

Defined results: a null text counts as empty; an empty text has no window and
differences of zero; labels other than 0 and 1, or null, are not learned from;
without both classes in the sample every score is zero if there is no toxic
row, else one half; repeated rows are scored each; an empty table gives an
empty table; other columns of the input are ignored or kept as they are.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, fresh, releasing, ship

CHUNK = 1 << 16             # windows compressed in one call
BLOCK_BYTES = 4_000_000     # text handled together in a task


@dataclass(frozen=True)
class Training:
    """Bounds of the sample and settings of the dictionaries."""
    toxic_docs: int = 1500
    ordinary_docs: int = 5000
    max_bytes: int = 16_384      # longer documents are not sampled
    window: int = 32
    stride: int = 16
    dictionary: int = 16_384     # bytes of the ordinary dictionary
    toxic_dictionary: int = 2_048
    ordinary_windows: int = 100_000
    grams: tuple[int, ...] = (7, 8, 9)    # lengths of the byte strings that are compared
    ratio: float = 4.0           # over-representation in toxic documents, at least
    evidence: float = 60.0       # likelihood ratio statistic, at least
    floor: float = 2.0           # differences up to this many bytes say nothing


@dataclass(frozen=True)
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]   # of the features, then the constant
    settings: Training
    constant: float | None = None

    def features(self, texts: list[bytes]) -> np.ndarray:
        return features(texts, self.ordinary, self.toxic, self.settings)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        x = np.column_stack([self.features(texts), np.ones(len(texts))])
        return 1.0 / (1.0 + np.exp(-np.clip(x @ np.array(self.weights), -700, 700)))


_compressors: dict[bytes, zstd.ZstdCompressor] = {}


def _compressor(content: bytes) -> zstd.ZstdCompressor:
    if content not in _compressors:
        parameters = zstd.ZstdCompressionParameters(
            strategy=zstd.STRATEGY_LAZY2, window_log=16, hash_log=16, chain_log=16, search_log=3,
            min_match=5, write_content_size=0, write_checksum=0, write_dict_id=0)
        dictionary = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(compression_params=parameters)
        _compressors[content] = zstd.ZstdCompressor(
            dict_data=dictionary, compression_params=parameters)
    return _compressors[content]


def windows(texts: list[bytes], window: int, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """(offset, length) in the joined texts of all windows, and their text."""
    spans, owner, at = [], [], 0
    for i, t in enumerate(texts):
        if t:
            start = np.arange(0, max(len(t) - (window - stride), 1), stride)
            spans.append(np.column_stack([at + start, np.minimum(window, len(t) - start)]))
            owner.append(np.full(len(start), i))
            at += len(t)
    if not spans:
        return np.zeros((0, 2), dtype=np.uint64), np.zeros(0, dtype=np.int64)
    return np.concatenate(spans).astype(np.uint64), np.concatenate(owner)


def _lengths(content: bytes, joined: bytes, spans: np.ndarray) -> np.ndarray:
    compress = _compressor(content).multi_compress_to_buffer
    out = np.empty(len(spans), dtype=np.int64)
    for at in range(0, len(spans), CHUNK):
        some = spans[at:at + CHUNK]
        frames = compress(zstd.BufferWithSegments(joined, some.tobytes()))
        out[at:at + len(some)] = np.fromiter(map(len, frames), dtype=np.int64, count=len(some))
    return out


def differences(texts: list[bytes], ordinary: bytes, toxic: bytes, s: Training
                ) -> tuple[np.ndarray, np.ndarray]:
    """Bytes that the toxic dictionary saves on each window, and its text."""
    spans, owner = windows(texts, s.window, s.stride)
    joined = b"".join(texts)
    if not len(spans):
        return np.zeros(0), owner
    return (_lengths(ordinary, joined, spans) - _lengths(toxic, joined, spans)).astype(float), owner


def features(texts: list[bytes], ordinary: bytes, toxic: bytes, s: Training) -> np.ndarray:
    """Largest difference, log of the sum above the floor, that sum a window,
    log of the number of windows."""
    saved, owner = differences(texts, ordinary, toxic, s)
    n = len(texts)
    largest = np.zeros(n)
    np.maximum.at(largest, owner, saved)
    above = np.bincount(owner, np.maximum(saved - s.floor, 0), minlength=n)
    count = np.maximum(np.bincount(owner, minlength=n), 1)
    return np.column_stack([largest, np.log1p(above), above / count, np.log1p(count)])


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """Trained dictionary; too few samples are themselves the dictionary."""
    try:
        return zstd.train_dictionary(size, samples, k=16, d=6, level=3).as_bytes()
    except zstd.ZstdError:
        return b"".join(samples)[-size:]


def _blocks(texts: list[bytes], limit: int) -> Iterator[list[bytes]]:
    block, size = [], 0
    for t in texts:
        block.append(t)
        size += len(t)
        if size >= limit:
            yield block
            block, size = [], 0
    if block:
        yield block


def _gram_codes(data: bytes, gram: int) -> np.ndarray:
    raw = np.frombuffer(data, dtype=np.uint8).astype(np.uint64)
    if len(raw) < gram:
        return np.zeros(0, dtype=np.uint64)
    codes = np.zeros(len(raw) - gram + 1, dtype=np.uint64)
    for i in range(gram):
        codes = codes << np.uint64(8) | raw[i:len(raw) - gram + 1 + i]
    return codes


CONTEXT = 8     # bytes before a byte string that make up its context


def _with_context(texts: list[bytes], gram: int, among: np.ndarray | None = None
                  ) -> tuple[np.ndarray, np.ndarray, int]:
    """Byte strings, in how many contexts each stands, and all positions.

    Contexts are counted, not documents: a toxic word stands behind many other
    words, a stretch that near copies repeat behind one.
    """
    gap = bytes(CONTEXT)
    kept, total = [], 0
    for block in _blocks(texts, 1_000_000):
        data = gap + gap.join(block)
        codes = _gram_codes(data, gram)[CONTEXT:]
        before = _gram_codes(data, CONTEXT)[:len(codes)]
        total += len(codes)
        if among is not None:
            at = np.minimum(np.searchsorted(among, codes), max(len(among) - 1, 0))
            here = among[at] == codes if len(among) else np.zeros(len(codes), dtype=bool)
            codes, before = codes[here], before[here]
        kept.append((codes, before[:len(codes)]))
    codes = np.concatenate([k[0] for k in kept])
    before = np.concatenate([k[1] for k in kept])
    order = np.lexsort((before, codes))
    codes, before = codes[order], before[order]
    new = np.ones(len(codes), dtype=bool)
    new[1:] = (codes[1:] != codes[:-1]) | (before[1:] != before[:-1])
    values, counts = np.unique(codes[new], return_counts=True)
    return values, counts.astype(float), total


def _telling_grams(toxic: list[bytes], ordinary: list[bytes], gram: int, s: Training) -> np.ndarray:
    """Byte strings of one length that are over-represented in toxic texts."""
    codes, a, na = _with_context(toxic, gram)
    nb = sum(map(len, ordinary)) + 1
    # the statistic of a string that no ordinary text holds bounds it from above
    able = 2 * a * np.log((na + nb) / na) >= s.evidence
    codes, a = codes[able], a[able]
    others, count, nb = _with_context(ordinary, gram, codes)
    b = np.zeros(len(codes))
    b[np.searchsorted(codes, others)] = count
    share = (a + b) / (na + nb)
    with np.errstate(divide="ignore", invalid="ignore"):
        statistic = 2 * (a * np.log(a / (na * share)) + np.where(b > 0, b * np.log(b / (nb * share)), 0))
    keep = (statistic >= s.evidence) & ((a + 0.5) / na > s.ratio * (b + 0.5) / nb)
    return codes[keep]


Known = list[tuple[int, np.ndarray]]     # lengths, and the byte strings of each


def _known(toxic: list[bytes], ordinary: list[bytes], s: Training) -> Known:
    """Over-represented byte strings of all lengths."""
    return [(g, _telling_grams(toxic, ordinary, g, s)) for g in s.grams]


def _stretches(text: bytes, known: Known, inside: bool = True) -> list[bytes]:
    """Stretches of a text that known byte strings cover, or those between."""
    mask = np.zeros(len(text), dtype=bool)
    for gram, codes in known:
        for i in np.flatnonzero(np.isin(_gram_codes(text, gram), codes)):
            mask[i:i + gram] = True
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask == inside, [0]])))
    return [text[x:y] for x, y in zip(edges[::2].tolist(), edges[1::2].tolist())]


def _cover(stretches: list[list[bytes]], gram: int, size: int) -> bytes:
    """The most frequent stretches, of whose byte strings half at least are new."""
    counts = Counter(x for text in stretches for x in set(text))
    held: set[bytes] = set()
    out: list[bytes] = []
    for stretch, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0])):
        mine = {stretch[i:i + gram] for i in range(len(stretch) - gram + 1)}
        if 2 * len(mine - held) >= len(mine) > 0 and size >= len(stretch):
            held |= mine
            out.append(stretch)
            size -= len(stretch)
    return b"".join(out)


def _dictionaries(toxic: list[bytes], ordinary: list[bytes], s: Training) -> tuple[bytes, bytes]:
    known = _known(toxic, ordinary, s)
    samples: dict[bytes, None] = {}
    for t in sorted(ordinary, key=zlib.crc32):     # an order that content decides
        for rest in _stretches(t, known, inside=False):
            for at in range(0, len(rest), s.window):
                samples[rest[at:at + s.window]] = None
        if len(samples) >= s.ordinary_windows:
            break
    plain = _dictionary([x for x in samples if len(x) >= min(s.grams)] or list(samples), s.dictionary)
    telling = _cover([_stretches(t, known) for t in toxic], min(s.grams), s.toxic_dictionary)
    return plain, telling + plain


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        gradient = x.T @ (y - p) - ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(toxic: list[bytes], ordinary: list[bytes], settings: Training = Training(),
          share: float | None = None) -> ToxicityModel:
    """Dictionaries from all sampled texts; the logistic function from texts
    that had no part in the dictionaries they are compressed with (two folds).
    ``share`` is the share of toxic rows where the sample was drawn."""
    toxic, ordinary = (sorted({t for t in texts if t}) for texts in (toxic, ordinary))
    if not toxic or not ordinary:
        return ToxicityModel(b"", b"", (), settings, 0.5 if toxic else 0.0)
    side = lambda texts, k: [t for t in texts if zlib.crc32(t) % 2 == k]
    xs, ys = [], []
    for k in (0, 1):
        learn = side(toxic, k), side(ordinary, k)
        if not all(learn):
            learn = toxic, ordinary
        pair = _dictionaries(*learn, settings)
        for label, texts in ((1, side(toxic, 1 - k)), (0, side(ordinary, 1 - k))):
            if texts:
                xs.append(features(texts, *pair, settings))
                ys.append(np.full(len(texts), float(label)))
    weights = _logistic(np.concatenate(xs), np.concatenate(ys))
    if share is not None and 0 < share < 1:
        weights[-1] += np.log(share / (1 - share)) - np.log(len(toxic) / len(ordinary))
    return ToxicityModel(*_dictionaries(toxic, ordinary, settings),
                         tuple(weights.tolist()), settings)


def sample_and_train(docs: DataFrame, labels: DataFrame, settings: Training = Training(),
                     label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text"
                     ) -> ToxicityModel:
    """Train on the sampled labelled rows: at most ``toxic_docs`` and
    ``ordinary_docs`` of at most ``max_bytes`` bytes reach the driver."""
    ship(docs.sparkSession)
    chosen = None
    for label, most in ((1, settings.toxic_docs), (0, settings.ordinary_docs)):
        some = (labels.where(F.col(label_col) == label).select(F.col(id_col).alias("id"))
                .where("id IS NOT NULL").distinct()
                .orderBy(F.xxhash64("id"), "id").limit(most).withColumn("y", F.lit(label)))
        chosen = some if chosen is None else chosen.union(some)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    # the ids are bounded by the settings, so they may be broadcast
    rows = (texts.join(F.broadcast(chosen), "id").where(F.octet_length("t") <= settings.max_bytes)
            .select("y", "t").dropDuplicates(["y", "t"]).collect())
    by = {k: [r.t.encode("utf-8", "surrogatepass") for r in rows if r.y == k] for k in (0, 1)}
    share = labels.where(F.col(label_col).isin(0, 1)).agg(F.avg(label_col)).first()[0]
    return train(by[1], by[0], settings, share)


def with_scores(docs: DataFrame, model: ToxicityModel, text_col: str = "text",
                score_col: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score of each whole text."""
    ship(docs.sparkSession)
    kept = model
    at = docs.columns.index(text_col)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[np.ndarray] = []
            block: list[bytes] = []
            size = 0
            for value in batch.column(at):
                text = (value.as_py() or "").encode("utf-8", "surrogatepass")
                block.append(text)
                size += len(text)
                if size >= BLOCK_BYTES:
                    out.append(kept.scores(block))
                    block, size = [], 0
            if block:
                out.append(kept.scores(block))
            scores = np.concatenate(out) if out else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores)], names=[*batch.schema.names, score_col])

    return docs.mapInArrow(releasing(run), f"{fields}, `{score_col}` double")


def classify(docs: DataFrame, labels: DataFrame, settings: Training = Training(),
             modulus: int = 4, held_out: int = 2, threshold: float = 0.3, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Train on the labelled rows of the other folds, score every document.
    Columns: id, ``held_out``, ``score``, ``predicted``."""
    model = sample_and_train(docs, labels.where(fold(id_col, modulus) != held_out), settings,
                             id_col=id_col, text_col=text_col)
    scored = with_scores(docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")), model)
    return scored.select(F.col("doc").alias(id_col),
                         (fold("doc", modulus) == held_out).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, settings: Training = Training(),
               threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that score ``threshold`` or more."""
    model = sample_and_train(docs, labels.where(fold(id_col, 4) != 2), settings,
                             id_col=id_col, text_col=text_col)
    score_col = fresh(docs, "score")
    return with_scores(docs, model, text_col, score_col).where(F.col(score_col) < threshold).drop(score_col)
