"""Plan tests: the physical plans keep the properties the design relies on
at scale (no grid shuffle or cartesian product, map-side group limits, one
extractor evaluation, no Python in JVM-expressible paths, pushdown)."""

import pytest
from pyspark.sql import functions as F

from trendlake.operators.extract import model_entities
from trendlake.operators.mentions import mention_job
from trendlake.plans.catalog import REGISTRY
from trendlake.plans.q_stream import write_article_log
from trendlake.schemas import NEWS_TOPIC, POSTS_TOPIC
from trendlake.sources.log import read_log_files

from .conftest import SF001


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def run(spark, name):
    return REGISTRY[name].run(spark, SF001)


def test_grid_has_no_cartesian_and_two_reduced_shuffles(spark):
    p = plan(run(spark, "dense_daily_counts"))
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p
    assert p.count("Exchange hashpartitioning") == 2
    assert "Generate explode" in p


def test_features_reuse_grid_partitioning(spark):
    p = plan(run(spark, "lag_features"))
    # grid: cells + per-entity; encoder: distinct keys + range partitioning;
    # the lag window itself adds nothing on top of the entity partitioning
    assert "Window [lag(" in p or "Window" in p
    assert "CartesianProduct" not in p


def test_feed_caps_are_limited_before_the_shuffle(spark):
    p = plan(run(spark, "feed_rules"))
    assert p.count("WindowGroupLimit") >= 4
    assert "Partial" in p


def test_pattern_extraction_runs_once_and_stays_in_the_jvm(spark):
    p = plan(run(spark, "extract_entities_regex"))
    assert p.count("regexp_extract_all") == 1
    assert "Python" not in p


def test_dates_branch_skips_extraction(spark):
    log = read_log_files(spark, write_article_log(spark, SF001))
    _, dates = mention_job(log.where(F.col("topic") == NEWS_TOPIC),
                           log.where(F.col("topic") == POSTS_TOPIC))
    p = plan(dates)
    assert "regexp_extract_all" not in p and "Python" not in p


def test_model_extractor_is_one_python_stage(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    df = model_entities(docs, "text", lambda: lambda texts: [[(t[:3], "X")] for t in texts])
    assert plan(df).count("MapInPandas") == 1
    got = df.select(F.size("entities").alias("n")).agg(F.sum("n")).first()[0]
    assert got == docs.count()

    def broken():
        raise OSError("no such model")
    with pytest.raises(Exception, match="no such model"):
        model_entities(docs, "text", broken).collect()


def test_filters_and_columns_reach_the_scan(spark):
    p = plan(run(spark, "top_headlines"))
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in p
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in p


def test_joins_are_left_to_the_planner(spark):
    from trendlake.functions.dates import stop_flag
    from trendlake.operators import feeds
    from trendlake.plans import fixtures as fx
    feed = fx.event_feed(fx.table(spark, SF001, "events"))
    p = feeds.take_while(feed, stop_flag(F.col("date_text"), fx.FEED_STOP_DATE, fx.AS_OF_YEAR))
    assert "hint" not in p._jdf.queryExecution().logical().toString().lower()
    assert "hint" not in run(spark, "extract_entities_gazetteer")._jdf.queryExecution().logical().toString().lower()


def test_page_edges_need_no_shuffle(spark):
    assert "Exchange" not in plan(run(spark, "page_edges"))


def test_content_dedupe_does_not_shuffle_markup(spark):
    from trendlake.operators.feeds import dedupe_by_content
    pages = spark.read.parquet(f"{SF001}/pages.parquet").select("page_id", "html")
    p = dedupe_by_content(pages, pos="page_id")._jdf.queryExecution().executedPlan().toString()
    assert "sha2" in p and "Window" not in p
