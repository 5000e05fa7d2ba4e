import hashlib
import random
import re

from trendlake.llm import exact_dedup


def brute(rows):
    norm = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for i, t in rows}
    out = {}
    for i, t in norm.items():
        same = [j for j, u in norm.items() if u == t]
        out[i] = (min(same), len(same), min(same) == i, hashlib.sha256(t.encode()).hexdigest())
    return out


def result(df):
    return {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256)
            for r in exact_dedup.exact_dedup(df).collect()}


def test_against_brute_force(make_docs):
    long = "The tale of a long text and its chunks. " * 4000
    rows = [(5, "a b"), (3, "a \n\t b"), (9, "a  b "), (1, None), (2, ""), (8, long), (7, long + "x"),
            (6, long), (10, "ünï 日本 😀" * 2000), (11, "ünï 日本 😀" * 2000), (12, "A b"), (13, "\x85a b")]
    assert result(make_docs(rows)) == brute(rows)


def test_chunks_tile_the_text_and_follow_content(spark):
    from pyspark.sql import functions as F
    rng = random.Random(5)
    body = " ".join("".join(rng.choices("abcdefghinorst", k=rng.randrange(3, 9))) for _ in range(6000))
    rows = spark.createDataFrame([(body,), ("shifted! " + body,)], "t string")
    a, b = [r[0] for r in rows.select(exact_dedup.chunks(F.col("t"))).collect()]
    assert "".join(a) == body and "".join(b) == "shifted! " + body
    assert len(set(a) & set(b)) > len(a) // 2
    assert len(a) > 20 and max(map(len, a)) <= exact_dedup.MAX_CHUNK


def test_repeated_rows_null_ids_and_empty_table(make_docs):
    got = exact_dedup.exact_dedup(make_docs([(4, "x"), (4, "x"), (None, "x"), (None, "y")])).collect()
    by = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got), key=str)
    assert by == sorted([(4, 4, 3, True), (4, 4, 3, True), (None, 4, 3, False), (None, None, 1, True)], key=str)
    assert exact_dedup.exact_dedup(make_docs([])).count() == 0


def test_an_unverified_identifier_is_seen(spark):
    parts = "array<struct<id:bigint,sha:binary,len:int>>"
    table = spark.createDataFrame([([(1, b"a", 3), (2, b"b", 3)],), ([(1, b"c", 3), (2, b"b", 3)],)],
                                  f"parts {parts}")
    assert [r.id for r in exact_dedup.unverified(table).collect()] == [1]
