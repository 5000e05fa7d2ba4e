"""Registered queries of the corpus operators, and their DuckDB SQL.

Each query applies its operator, with production parameters, to its whole
table. ``SQL`` holds an entry where SQL can express the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann, byte_bpe, chat, exact_dedup, hard_negatives, line_dedup, mixing, ngram_join, quality,
               sharding, simhash, spelling, toxicity)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


@_query("op1_toxicity")
def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query("op2_exact_dedup", r"""
WITH n AS (SELECT doc_id,
  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id,
  count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n""")
def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).drop("n_chunks")


# Bytes of a text as a list: two hex digits each, looked up in a list of all
# 256; CRC-32 by the bitwise definition of its table.
_SHARD_SQL = """
WITH RECURSIVE bits AS (
  SELECT range AS b, range::UBIGINT AS v, 0 AS i FROM range(256)
  UNION ALL
  SELECT b, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::UBIGINT) ELSE v // 2 END, i + 1
  FROM bits WHERE i < 8),
crc AS (SELECT list(v ORDER BY b) AS t FROM bits WHERE i = 8),
hexes AS (SELECT map_from_entries(list({'k': printf('%02X', range::INT), 'v': range::UBIGINT})) AS h
  FROM range(256)),
docs AS (SELECT doc_id, coalesce(text, '') AS x, md5(doc_id::VARCHAR) AS m FROM documents),
keyed AS (SELECT doc_id, strlen(x) + 16 AS size,
  CASE WHEN x = '' THEN 0 ELSE xor(4294967295::UBIGINT, list_reduce(
    list_prepend(4294967295::UBIGINT, list_transform(
      regexp_extract_all(hex(encode(x)), '..'), lambda d: h[d])),
    lambda a, y: xor(a // 256, t[(xor(a, y) % 256)::INT + 1]))) END AS text_crc32,
  ('0x' || m[1:15])::BIGINT::HUGEINT AS k, (('0x' || m[16:19])::BIGINT % 256) AS part
  FROM docs, crc, hexes),
steps AS (
  SELECT doc_id, k, (-1)::HUGEINT AS b, 0::HUGEINT AS j FROM keyed
  UNION ALL
  SELECT doc_id, k2, j, floor((j + 1)::DOUBLE * (2147483648.0::DOUBLE / ((k2 // 8589934592) + 1)::DOUBLE))::HUGEINT
  FROM (SELECT doc_id, j, (k * 2862933555777941757::HUGEINT + 1) % 18446744073709551616::HUGEINT AS k2
        FROM steps WHERE j < 40)),
placed AS (SELECT doc_id, max(b)::INT AS shard, max(j)::INT AS nxt FROM steps GROUP BY doc_id)
SELECT doc_id, size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY part, doc_id) - 1 AS slot,
  CASE WHEN nxt = 40 THEN 40 ELSE shard END AS grown_shard
FROM keyed JOIN placed USING (doc_id)"""


@_query("op3_sharding", _SHARD_SQL)
def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"), shards=40)


@_query("op4_line_dedup")
def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


@_query("op5_byte_bpe")
def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return byte_bpe.encode_documents(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@_query("op6_mixing", r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(source, '') AS src, coalesce(doc_id::VARCHAR, '') AS key,
  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n FROM documents),
s AS (SELECT src, sum(n)::BIGINT AS total, sum(n) / (SELECT sum(n) FROM d)::DOUBLE AS p FROM d GROUP BY src),
e AS (SELECT min(p) AS a, max(p) AS b FROM s WHERE p > 0),
h AS (SELECT 0 AS i, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi
  UNION ALL SELECT i + 1,
    CASE WHEN pow(a, (lo + hi) / 2) / a / (pow(b, (lo + hi) / 2) / b) <= 2 THEN lo ELSE (lo + hi) / 2 END,
    CASE WHEN pow(a, (lo + hi) / 2) / a / (pow(b, (lo + hi) / 2) / b) <= 2 THEN (lo + hi) / 2 ELSE hi END
  FROM h, e WHERE i < 40),
x AS (SELECT CASE WHEN b / a <= 2 THEN 0.0 ELSE hi END AS x FROM h, e WHERE i = 40),
w AS (SELECT src, total, floor((pow(p, x) / p) / (SELECT min(pow(p, x) / p) FROM s, x WHERE p > 0) * total + 1e-6)::BIGINT AS budget,
  least(greatest(ceil(total / 65536.0)::BIGINT, 1), 4096) AS blocks FROM s, x WHERE p > 0),
b AS (SELECT src, total, blocks, budget // total AS whole, budget % total AS rest FROM w),
k AS (SELECT d.*, whole, rest, ('0x' || md5(key)[1:15])::BIGINT % blocks AS block FROM d JOIN b USING (src)),
z AS (SELECT src, block, whole, rest, sum(n)::BIGINT AS size FROM k GROUP BY ALL),
t AS (SELECT z.*, unnest(range(0, whole + 1)) AS epoch FROM z),
o AS (SELECT *, row_number() OVER q - 1 AS place,
  coalesce(sum(size) OVER (q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM t
  WINDOW q AS (PARTITION BY src, epoch ORDER BY md5('17:' || src || ':' || epoch || ':' || block), block)),
r AS (SELECT k.doc_id, k.src, k.n, k.key, k.block, o.epoch, o.place, o.start, k.rest, k.whole, o.size,
  sum(k.n) OVER (PARTITION BY k.src, k.block, o.epoch ORDER BY md5('17:' || o.epoch || ':' || k.key), k.key, k.n
    ROWS UNBOUNDED PRECEDING) AS upto
  FROM k JOIN o ON k.src = o.src AND k.block = o.block)
SELECT doc_id, src AS source, n AS n_tokens, epoch::INT AS epoch, block, place::INT AS block_rank FROM r
WHERE epoch < whole OR (rest > 0 AND start + size <= rest) OR (start < rest AND upto <= rest - start)""")
def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix(docs, mixing.Mixture(repetition_limit=2.0, seed=17))
    return mixed.select("doc_id", "mix.*")


@_query("op7_simhash")
def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"), words=3, radius=2)


@_query("op8_quality")
def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query("op9_nearest_neighbours")
def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


def _escaped_sql(x: str) -> str:
    out = f"replace({x}, chr(92), chr(92) || chr(92))"
    for control in ("<s>", "</s>", "[INST]", "[/INST]", "<|image|>", "<|audio|>", "<|document|>"):
        out = f"replace({out}, '{control}', '{control[0]}' || chr(92) || '{control[1:]}')"
    return out


@_query("op10_chat_format", f"""
WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length({_escaped_sql('role')}) + 1 + length({_escaped_sql('text')})
    + CASE WHEN role = 'assistant' THEN 8 ELSE 14 END)::BIGINT AS formatted_chars
FROM c GROUP BY conv_id""")
def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], given.schema)
    return chat.read_back(chat.format_turns(given.unionByName(extra)))


# CRC-32 as for op3; the near words by what is left when one code point is
# deleted: at the same place of two words (replaced), or the other word itself.
_SPELLING_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT range AS b, range::UBIGINT AS v, 0 AS i FROM range(256)
  UNION ALL
  SELECT b, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::UBIGINT) ELSE v // 2 END, i + 1
  FROM bits WHERE i < 8),
crc AS (SELECT list(v ORDER BY b) AS t FROM bits WHERE i = 8),
hexes AS (SELECT map_from_entries(list({'k': printf('%02X', range::INT), 'v': range::UBIGINT})) AS h
  FROM range(256)),
runs AS (SELECT doc_id, unnest(regexp_extract_all(
  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run
  FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 5 GROUP BY ALL),
keyed AS (SELECT run, n, xor(4294967295::UBIGINT, list_reduce(
    list_prepend(4294967295::UBIGINT, list_transform(
      regexp_extract_all(hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)), '..'), lambda d: h[d])),
    lambda a, y: xor(a // 256, t[(xor(a, y) % 256)::INT + 1]))) AS h
  FROM counted, crc, hexes),
spelt AS (SELECT CASE WHEN h % 97 = 0
    THEN run[1:(h % length(run))::INT] || run[(h % length(run))::INT + 2:] ELSE run END AS word, n FROM keyed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM spelt WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cuts AS (SELECT word, n, p, length(word) AS size, word[1:p - 1] || word[p + 1:] AS rest
  FROM words, unnest(range(1, length(word) + 1)) AS u(p)),
near AS (SELECT DISTINCT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b
    ON a.rest = b.rest AND a.p = b.p AND a.size = b.size AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word),
best AS (SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near,
  row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS r FROM near),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
  CASE WHEN near_n >= 2 * w.n THEN near END AS form, CASE WHEN near_n >= 2 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word AND r = 1),
chain AS (SELECT word, word AS root, form AS onward FROM forms
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON c.onward = f.word)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain c ON f.word = c.word AND c.onward IS NULL"""


@_query("op11_spelling_forms", _SPELLING_SQL)
def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_forms(table(spark, sf_dir, "documents"))


@_query("op12_ngram_join", r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS g
  FROM w),
u AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
links AS (SELECT a.doc_id AS u, b.doc_id AS v FROM u a JOIN u b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u),
lowest AS (SELECT u, min(v) AS low FROM reach GROUP BY u)
SELECT doc_id, len(g) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id
FROM s LEFT JOIN lowest ON doc_id = u""")
def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"), words=5, percent=80)


@_query("op13_hard_negatives", """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), true)),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT * FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT s.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score,
    s.score AS negative_score, row_number() OVER (PARTITION BY s.anchor_id, p.vec_id
      ORDER BY s.score DESC, s.vec_id) AS r
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, r::INT AS rank, negative_id, positive_score, negative_score FROM n WHERE r <= 10""")
def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label)
