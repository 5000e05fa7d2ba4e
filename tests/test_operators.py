"""Operator-level tests: sources, sinks, encoder, reports, forecast, stream."""

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from trendlake.operators import features, forecast, grid, progress, reports
from trendlake.operators.mentions import merge_dates
from trendlake.plans import fixtures as fx
from trendlake.plans.q_stream import write_article_log
from trendlake.session import shared_path
from trendlake.sinks.tables import read_dates, write_mentions
from trendlake.sources.files import read_news_responses, read_post_files, read_sources
from trendlake.sources.log import stream_log_files
from trendlake.streaming.mention_stream import start_mention_stream

from .conftest import SF001

D = dt.date


def test_ordinal_encode_matches_dense_rank(spark):
    df = spark.range(0, 500).select((F.col("id") * 7919 % 97).cast("string").alias("k"))
    enc = features.ordinal_encode(df, "k", "code", n_ranges=5)
    ref = df.distinct().select("k", (F.dense_rank().over(Window.orderBy("k")) - 1).alias("ref"))
    bad = enc.join(ref, "k").where(F.col("code") != F.col("ref")).count()
    assert bad == 0 and enc.select("code").distinct().count() == 97


def test_top_entities_tie_break_and_window(spark):
    m = spark.createDataFrame(
        [("b", "ORG", D(2025, 8, 20)), ("a", "ORG", D(2025, 8, 20)), ("c", "ORG", D(2025, 8, 1))],
        "entity_text string, entity_type string, published_date date")
    got = [r.entity_text for r in reports.top_entities(m, "2025-08-21", 7, 10).collect()]
    assert got == ["a", "b"]


def test_merge_dates_modes(spark):
    old = spark.createDataFrame([(D(2025, 1, 1),)], "the_date date")
    new = spark.createDataFrame([(D(2025, 1, 2),), (D(2025, 1, 2),)], "the_date date")
    assert merge_dates(old, new).count() == 2
    assert merge_dates(old, new, mode="replace").count() == 1


def test_news_response_reader(spark):
    d = tempfile.mkdtemp(prefix="resp-")
    with open(os.path.join(d, "a.json"), "w") as f:
        json.dump({"status": "ok", "articles": [{"title": "T", "publishedAt": "2025-08-10T01:00:00Z",
                                                 "author": "x"}]}, f, indent=4)
    with open(os.path.join(d, "b.json"), "w") as f:
        json.dump({"status": "error"}, f, indent=4)
    rows = read_news_responses(spark, d).collect()
    assert len(rows) == 1 and rows[0].title == "T" and "author" not in rows[0].asDict()


def test_post_files_glob_exclude_and_empty(spark):
    d = tempfile.mkdtemp(prefix="posts-")
    for name, posts in [("AP.json", [{"tweet_content": "a", "tweet_date": "x"}]),
                        ("WSJ.json", [{"tweet_content": "b", "tweet_date": "y", "quoted_content": "q"}]),
                        ("tweets.json", [{"tweet_content": "old", "tweet_date": "z"}])]:
        with open(os.path.join(d, name), "w") as f:
            json.dump(posts, f, indent=2)
    open(os.path.join(d, "empty.json"), "w").close()
    with open(os.path.join(d, "blank.json"), "w") as f:
        f.write("  \n")
    df = read_post_files(spark, d, exclude=["tweets.json"])
    got = sorted((r.tweet_content, r.quoted_content) for r in df.collect())
    assert got == [("a", None), ("b", "q")]


def test_source_list(spark):
    d = tempfile.mkdtemp(prefix="src-")
    with open(os.path.join(d, "s.txt"), "w") as f:
        f.write("AP\n\nWSJ \n")
    assert [r.username for r in read_sources(spark, d).collect()] == ["AP", "WSJ"]


def test_offsets_json(spark):
    p = spark.createDataFrame([("news-topic", 0, 12), ("news-topic", 1, 7)],
                              "topic string, partition int, next_offset long")
    js = json.loads(progress.offsets_json(p).first().json)
    assert js == {"news-topic": {"0": 12, "1": 7}}
    parts = spark.createDataFrame([("news-topic", 0), ("tweets-topic", 0)], "topic string, partition int")
    start = {(r.topic, r.partition): r.next_offset for r in progress.starting_offsets(p, parts).collect()}
    assert start == {("news-topic", 0): 12, ("tweets-topic", 0): 0}


def test_forecast_one_row_per_entity_nonnegative(spark):
    ev = fx.table(spark, SF001, "events")
    g = grid.dense_daily_counts(fx.event_mentions(ev), fx.event_dates(ev), fx.GRID_LO, fx.GRID_HI,
                                fx.EVENT_ALLOWED_TYPES)
    out = forecast.forecast(g, maxIter=5)
    rows = out.collect()
    assert len(rows) == g.select("entity_text").distinct().count()
    assert all(r.predicted_count >= 0 for r in rows)
    assert len({r.date for r in rows}) == 1
    again = {(r.group_id, r.predicted_count) for r in forecast.forecast(g, maxIter=5).collect()}
    assert again == {(r.group_id, r.predicted_count) for r in rows}


def test_stream_equals_batch_and_restart_adds_nothing(spark):
    log_path = write_article_log(spark, SF001)
    out = shared_path(spark, "t-stream")
    args = (out + "/m", out + "/d", out + "/ck")
    q = start_mention_stream(stream_log_files(spark, log_path, 1), *args)
    q.awaitTermination()
    fact = lambda: spark.read.parquet(out + "/m")
    first = fact().count()
    assert fact().select("batch_id").distinct().count() == len(os.listdir(log_path)) // 2 - 1 >= 2
    q = start_mention_stream(stream_log_files(spark, log_path, 1), *args)
    q.awaitTermination()
    assert fact().count() == first
    # a replayed batch replaces its own rows instead of adding them
    one = fact().where("batch_id = 0")
    run = one.first().run
    copy = shared_path(spark, "t-copy")
    one.drop("batch_id", "run").write.parquet(copy)
    write_mentions(spark.read.parquet(copy), out + "/m", 0, run)
    assert fact().count() == first
    assert read_dates(spark, out + "/d").count() >= read_dates(spark, out + "/d", "replace").count()


def test_new_checkpoint_leaves_old_facts(spark):
    log_path = write_article_log(spark, SF001)
    out = shared_path(spark, "t-lost")
    for checkpoint in ("/ck1", "/ck2"):       # the first one is lost, batches count from 0 again
        start_mention_stream(stream_log_files(spark, log_path), out + "/m", out + "/d",
                             out + checkpoint).awaitTermination()
    counts = {r.run: r["count"] for r in spark.read.parquet(out + "/m").groupBy("run").count().collect()}
    assert len(counts) == 2 and len(set(counts.values())) == 1


def test_fast_pattern_path_equals_entity_array_path(spark):
    from trendlake.operators.extract import flatten_mentions, pattern_entities, pattern_mentions
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select(
        "doc_id", "text", F.lit("2024-01-02T00:00:00Z").alias("d"))
    a = pattern_mentions(docs, "text", "d", extra=("doc_id",))
    b = flatten_mentions(docs.withColumn("entities", pattern_entities("text")), "d", extra=("doc_id",))
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_daily_job_end_to_end_and_rerun(spark):
    from trendlake.operators.progress import read_progress
    from trendlake.plans.daily_job import DailyJob
    log_path = write_article_log(spark, SF001)
    job = DailyJob(root=shared_path(spark, "t-daily"), grid_range=("2024-01-01", "2024-01-31"),
                   export_csv=True, model_params={"maxIter": 3})
    out = job.run(spark, stream_log_files(spark, log_path, 1))
    n = out.count()
    assert n > 0 and out.select("date").distinct().count() == 1
    assert job.run(spark, stream_log_files(spark, log_path, 1)).count() == n   # re-run: same day replaced
    assert spark.read.option("header", True).csv(job.paths["csv"]).count() == \
        spark.read.parquet(job.paths["counts"]).count()
    assert read_progress(spark, shared_path(spark, "none")) is None


def test_model_beats_repeat_yesterday_on_weekly_cycle(spark):
    from trendlake.operators.features import lag_features
    from trendlake.operators.forecast import fit_model
    base = D(2025, 8, 4)  # a Monday
    rows = [(f"e{i}", base + dt.timedelta(days=d), (i % 3 + 1) * (10 if (d % 7) in (0, 3) else 1))
            for i in range(12) for d in range(56)]
    g = spark.createDataFrame(rows, "entity_text string, published_date date, count_mentions long")
    feats = lag_features(g).persist()
    model = fit_model(feats, maxIter=30)
    scored = model.transform(feats.select("*", F.col("target").cast("double").alias("y")))
    err = scored.agg(F.avg(F.abs(F.col("prediction") - F.col("y"))).alias("m"),
                     F.avg(F.abs(F.col("lag_1") - F.col("y"))).alias("b")).first()
    assert err.m < 0.5 * err.b, err


def test_batch_job_resumes_from_saved_offsets(spark, monkeypatch):
    from trendlake.plans import batch_job
    from trendlake.sources.log import read_log_files
    root = shared_path(spark, "t-batch")
    log = read_log_files(spark, write_article_log(spark, SF001))
    total = log.count()
    facts = lambda: spark.read.parquet(root + "/trending_entities").count()

    # a crash between the data commit and the progress write
    with monkeypatch.context() as m:
        m.setattr(batch_job, "write_progress", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            batch_job.run_batch(spark, log, root)
    once = facts()
    assert batch_job.run_batch(spark, log, root) == total and facts() == once
    assert batch_job.run_batch(spark, log, root) == 0 and facts() == once      # nothing new
    # a new partition of a known topic is read from 0
    more = log.where("topic = 'news-topic' AND partition = 0").withColumn("partition", F.lit(7))
    assert batch_job.run_batch(spark, log.unionByName(more), root) == more.count() > 0
    saved = progress.read_progress(spark, root + "/progress")
    assert saved.first().run_id == 1
    ends = {(r.topic, r.partition): r.m + 1 for r in log.unionByName(more).groupBy("topic", "partition")
            .agg(F.max("offset").alias("m")).collect()}
    assert {(r.topic, r.partition): r.next_offset for r in saved.collect()} == ends


def test_unreadable_progress_is_an_error(spark):
    path = shared_path(spark, "t-broken")
    os.makedirs(path + "/run_id=0")
    with open(path + "/run_id=0/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception, match="(?i)parquet|read"):
        progress.read_progress(spark, path)


def test_mention_job_with_gazetteer_extractor(spark):
    from trendlake.operators.mentions import mention_job
    news = spark.createDataFrame(
        [('{"title": "Trade in Middle East", "content": "asia and ASIA", "publishedAt": "2025-08-10T01:00:00Z"}',)],
        "value string")
    posts = spark.createDataFrame([('{"tweet_content": "Asia rising", "tweet_date": "Unknown"}',)], "value string")
    terms = spark.createDataFrame([("asia", "LOC"), ("middle east", "LOC")], "term string, label string")
    m, dates = mention_job(news, posts, extractor="gazetteer", terms=terms)
    got = sorted(((r.entity_text, r.entity_type, r.published_date) for r in m.collect()),
                 key=lambda t: (t[0], t[2] or D(1, 1, 1)))
    assert got == [("asia", "LOC", None), ("asia", "LOC", D(2025, 8, 10)), ("asia", "LOC", D(2025, 8, 10)),
                   ("middle east", "LOC", D(2025, 8, 10))]
    assert dates.count() == 2   # 2025-08-10 and NULL
