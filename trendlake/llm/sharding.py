"""Jump consistent hashing of stable keys to shards, in SQL functions.

Law ``key``: the key and the shard count alone decide the shard, without a
ring table; one more shard takes rows only into itself. The generator is the
published one (64-bit linear congruential, Lamping and Veach 2014), seeded
with the first 60 bits of the key's MD5.

Slots number the rows of a shard without gaps. Rows are spread over
``SUB_BUCKETS`` parts of a shard, counted, and numbered inside their part from
the part's first slot on; no task holds a whole shard.

Defined results: a null key counts as the empty key; a null text has size 16
and the CRC-32 of the empty text; repeated rows get slots of their own; rows
of one part are ordered by key, then CRC and size; an empty table gives an
empty table; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SUB_BUCKETS = 256
ROW_BYTES = 16

# Fixed values of the published generator.
MULTIPLIER = 2862933555777941757
_L, _M22, _M20 = 22, (1 << 22) - 1, (1 << 20) - 1


def _next_key(k: Column) -> Column:
    """k * MULTIPLIER + 1 modulo 2**64, in 22-bit limbs: no step overflows,
    so it also holds under ANSI arithmetic."""
    c0, c1, c2 = MULTIPLIER & _M22, (MULTIPLIER >> 22) & _M22, MULTIPLIER >> 44
    k0 = k.bitwiseAND(F.lit(_M22))
    k1 = F.shiftrightunsigned(k, _L).bitwiseAND(F.lit(_M22))
    k2 = F.shiftrightunsigned(k, 2 * _L)
    p0 = k0 * F.lit(c0) + F.lit(1)
    p1 = k0 * F.lit(c1) + k1 * F.lit(c0) + F.shiftright(p0, _L)
    p2 = k0 * F.lit(c2) + k1 * F.lit(c1) + k2 * F.lit(c0) + F.shiftright(p1, _L)
    return (p0.bitwiseAND(F.lit(_M22))
            .bitwiseOR(F.shiftleft(p1.bitwiseAND(F.lit(_M22)), _L))
            .bitwiseOR(F.shiftleft(p2.bitwiseAND(F.lit(_M20)), 2 * _L)))


def key_hash(key: Column) -> Column:
    """First 60 bits of the MD5 of the key as text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def jumps(key: Column, shards: int) -> Column:
    """Struct (b, j): the last jump below ``shards`` and the next one. ``b`` is
    the shard of ``shards``; with one shard more it is ``shards`` if j says so.
    At most ``shards`` jumps can be needed, so the fold is that long."""
    def step(acc: Column, _: Column) -> Column:
        k = _next_key(acc["k"])
        drawn = (F.shiftrightunsigned(k, 33) + F.lit(1)).cast("double")
        j = F.floor((acc["j"] + F.lit(1)).cast("double") * (F.lit(2.0 ** 31) / drawn))
        return F.when(acc["j"] < F.lit(shards),
                      F.struct(k.alias("k"), acc["j"].alias("b"), j.cast("bigint").alias("j"))
                      ).otherwise(acc)
    start = F.struct(key.alias("k"), F.lit(-1).cast("bigint").alias("b"),
                     F.lit(0).cast("bigint").alias("j"))
    # j starts at 0 with no jump drawn: the first step sets b = 0
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step)


def shard_rows(docs: DataFrame, shards: int = 40, id_col: str = "doc_id",
               text_col: str = "text", sub_buckets: int = SUB_BUCKETS) -> DataFrame:
    """Columns: id, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``,
    ``grown_shard``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    keyed = (docs.select(F.col(id_col).alias("key"),
                         (F.octet_length(text) + F.lit(ROW_BYTES)).cast("bigint").alias("size"),
                         F.crc32(text.cast("binary")).alias("crc"),
                         jumps(key_hash(F.col(id_col)), shards).alias("jump"),
                         (F.conv(F.substring(digest, 16, 4), 16, 10).cast("int")
                          % F.lit(sub_buckets)).alias("part")))
    placed = keyed.select("key", "size", "crc", "part", F.col("jump.b").cast("int").alias("shard"),
                          F.when(F.col("jump.j") == shards, F.lit(shards))
                          .otherwise(F.col("jump.b")).cast("int").alias("grown"))
    # The counts need keys only: texts are not read for them.
    counts = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    firsts = counts.select("shard", "part",
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "part").orderBy("key", "crc", "size")
    numbered = placed.withColumn("i", F.row_number().over(inside) - F.lit(1))
    # at most shards x sub_buckets rows: bounded by two parameters
    return (numbered.join(F.broadcast(firsts), ["shard", "part"])
            .select(F.col("key").alias(id_col), "size", F.col("crc").alias("text_crc32"),
                    F.lit("key").alias("law"), "shard",
                    (F.col("first") + F.col("i")).cast("bigint").alias("slot"),
                    F.col("grown").alias("grown_shard")))
