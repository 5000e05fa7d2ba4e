"""Batches become visible whole, and a recount reads touched dates only."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from trendlake.operators.grid import entity_date_cells, merge_cells
from trendlake.plans.q_stream import write_article_log
from trendlake.plans.recount import new_batches, read_totals, recount
from trendlake.session import shared_path
from trendlake.sinks import tables
from trendlake.sinks.manifest import commit, is_committed, read_manifest
from trendlake.sources.log import stream_log_files
from trendlake.streaming import mention_stream

from .conftest import SF001

D = dt.date


class Crash(Exception):
    pass


def ingest(spark, log, out):
    q = mention_stream.start_mention_stream(stream_log_files(spark, log, 1), out + "/m", out + "/d", out + "/ck",
                                            cells_path=out + "/c", manifest=out + "/x")
    q.awaitTermination()


def shown(spark, out):
    return (tables.read_mentions(spark, out + "/m", out + "/x").count(),
            tables.read_dates(spark, out + "/d", manifest=out + "/x").count(),
            tables.read_cells(spark, out + "/c", out + "/x").count())


@pytest.mark.parametrize("step", ["write_dates", "write_cells", "commit"])
def test_a_crash_between_two_writes_shows_nothing_of_the_batch(spark, monkeypatch, step):
    log, out = write_article_log(spark, SF001), shared_path(spark, "t-crash")
    whole = getattr(mention_stream, step)
    seen = []

    def crash_in_second_batch(*args):
        seen.append(1)
        if len(seen) == 2:
            if step != "commit":
                whole(*args)                # the write itself ends, its batch does not
            raise Crash(step)
        whole(*args)

    monkeypatch.setattr(mention_stream, step, crash_in_second_batch)
    with pytest.raises(Exception, match="Crash"):
        ingest(spark, log, out)
    first = tables.read_mentions(spark, out + "/m").count()
    one = spark.read.parquet(out + "/m").where("batch_id = 0").count()
    assert shown(spark, out)[0] == one < first
    assert [r.batch_id for r in read_manifest(spark, out + "/x").collect()] == [0]
    monkeypatch.undo()
    ingest(spark, log, out)
    clean = shared_path(spark, "t-clean")
    ingest(spark, log, clean)
    assert shown(spark, out) == shown(spark, clean)
    assert shown(spark, out)[0] == spark.read.parquet(out + "/m").count()


def test_a_committed_batch_is_not_written_again(spark):
    out = shared_path(spark, "t-again")
    assert not is_committed(spark, out + "/x", "r", 0)
    rows = spark.createDataFrame([(D(2025, 8, 10),), (None,), (D(2025, 8, 10),)], "published_date date")
    commit(rows, out + "/x", "r", 0)
    commit(rows.limit(0), out + "/x", "r", 1)
    assert is_committed(spark, out + "/x", "r", 0) and not is_committed(spark, out + "/x", "other", 0)
    got = {r.batch_id: r.dates for r in read_manifest(spark, out + "/x").collect()}
    assert sorted(got[0], key=str) == ["2025-08-10", None] and got[1] == []


def mentions(spark, rows):
    return spark.createDataFrame(rows, "entity_text string, entity_type string, published_date date")


def test_recount_reads_touched_dates_and_equals_a_full_one(spark):
    out = shared_path(spark, "t-recount")
    paths = [out + p for p in ("/c", "/t", "/x", "/r")]
    batches = [
        [("a", "ORG", D(2025, 8, 10)), ("a", "ORG", D(2025, 8, 10)), ("b", "X", D(2025, 8, 11)), ("c", "GPE", None)],
        [("a", "X", D(2025, 8, 11)), ("d", "ORG", D(2025, 8, 12))],
        [("c", "GPE", None), ("a", "ORG", D(2025, 8, 10))],
    ]
    want = [["2025-08-10", "2025-08-11", None], ["2025-08-11", "2025-08-12"], ["2025-08-10", None]]
    for i, rows in enumerate(batches):
        m = mentions(spark, rows)
        tables.write_cells(entity_date_cells(m), paths[0], i, "r")
        assert recount(spark, *paths) == []                     # not committed yet
        commit(m, paths[2], "r", i)
        dates = recount(spark, *paths)
        assert dates == want[i] and new_batches(spark, paths[2], paths[3]).isEmpty()
        plan = tables.read_cells(spark, paths[0], paths[2], dates)._jdf.queryExecution().executedPlan().toString()
        pruned = next(line for line in plan.splitlines() if "PartitionFilters" in line and "/c]" in line)
        assert all(d in pruned.split("PushedFilters")[0] for d in dates if d) and ("isnull" in pruned) == (None in dates)
        folders = spark.read.parquet(paths[0]).select("published_date", F.col("_metadata.file_path").alias("f"))
        assert folders.where("f NOT LIKE '%published_date=%'").isEmpty()
        full = merge_cells(tables.read_cells(spark, paths[0], paths[2]))
        got = read_totals(spark, paths[1])
        assert got.count() == full.count() and got.exceptAll(full).count() == 0


def test_a_crashed_recount_is_repeated(spark, monkeypatch):
    from trendlake.plans import recount as r
    out = shared_path(spark, "t-recrash")
    paths = [out + p for p in ("/c", "/t", "/x", "/r")]
    m = mentions(spark, [("a", "ORG", D(2025, 8, 10))] * 3)
    tables.write_cells(entity_date_cells(m), paths[0], 0, "r")
    commit(m, paths[2], "r", 0)
    write = r.write_partitioned

    def crash(df, path, *rest):
        if path == paths[3]:
            raise Crash
        write(df, path, *rest)

    monkeypatch.setattr(r, "write_partitioned", crash)
    with pytest.raises(Crash):
        recount(spark, *paths)
    monkeypatch.undo()
    assert recount(spark, *paths) == ["2025-08-10"]
    assert [(t.entity_text, t.n) for t in read_totals(spark, paths[1]).collect()] == [("a", 3)]


def test_a_date_gets_few_files(spark):
    out = shared_path(spark, "t-files")
    rows = spark.range(0, 20000, 1, 16).select(
        F.concat(F.lit("e"), (F.col("id") % 50).cast("string")).alias("entity_text"), F.lit("ORG").alias("entity_type"),
        F.date_add(F.lit("2025-08-01").cast("date"), (F.col("id") % 40).cast("int")).alias("published_date"))
    tables.write_mentions(rows, out, 0)
    assert len(spark.read.parquet(out).inputFiles()) <= 48 and tables.read_mentions(spark, out).count() == 20000
