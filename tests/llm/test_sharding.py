import hashlib
import zlib

from pyspark.sql import functions as F

from trendlake.llm import sharding


def jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & (2 ** 64 - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def key_of(i):
    return int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:15], 16)


def test_shards_sizes_and_slots(make_docs):
    rows = [(i, "wört " * (i % 7)) for i in range(3000)] + [(None, None), (3, "again"), (3, "again")]
    got = sharding.shard_rows(make_docs(rows), 40).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.shard, r.grown_shard) == (jump(key_of(r.doc_id), 40), jump(key_of(r.doc_id), 41))
        assert r.grown_shard in (r.shard, 40)
    for s in range(40):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    by = {r.doc_id: r for r in got if r.doc_id != 3}
    text = "wört " * 5
    assert by[5].size == len(text.encode()) + 16 and by[5].text_crc32 == zlib.crc32(text.encode())
    assert (by[None].size, by[None].text_crc32) == (16, 0)


def test_large_keys_and_other_counts(spark):
    df = spark.createDataFrame([(k,) for k in (0, 1, 2 ** 59, 2 ** 60 - 1)], "k bigint")
    for n in (1, 2, 1000):
        got = df.select("k", sharding.jumps(F.col("k"), n)["b"].alias("b")).collect()
        assert all(r.b == jump(r.k, n) for r in got)


def test_empty_table(make_docs):
    assert sharding.shard_rows(make_docs([])).count() == 0
