"""Golden micro-tests on hand-made rows for the edge cases the pipeline's
numbers depend on (one test per case)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from trendlake.functions.dates import (parse_post_date, round_half_even_nonneg,
                                       to_date_text, weekday_monday0)
from trendlake.functions.text import space_trim
from trendlake.operators import feeds, grid, progress
from trendlake.operators.clean import clean_news, parse_json_column
from trendlake.operators.extract import flatten_mentions, pattern_entities
from trendlake.operators.features import lag_features, scoring_rows
from trendlake.operators.pages import post_id, status_id
from trendlake.schemas import NEWS_SCHEMA

D = dt.date


def one(spark, expr, value, typ="string"):
    return spark.createDataFrame([(value,)], f"v {typ}").select(expr(F.col("v")).alias("r")).first()["r"]


def test_iso_late_evening_in_tokyo_keeps_the_day(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert one(spark, to_date_text, "2025-08-10T23:30:00Z") == D(2025, 8, 10)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("v", ["Unknown", "", None])
def test_sentinel_empty_null_dates_are_null(spark, v):
    assert one(spark, to_date_text, v) is None
    assert one(spark, lambda c: parse_post_date(c, 2025), v) is None


@pytest.mark.parametrize("v", ["Aug 10, 2025", "August 10, 2025", "10 Aug 2025", "8/10/2025",
                               "2025-08-10 23:30:00", "2025-08-10T23:30:00Z",
                               "2025-08-10T23:30:00.5Z", "2025-08-10"])
def test_feed_parser_formats(spark, v):
    assert one(spark, lambda c: parse_post_date(c, 1999), v) == D(2025, 8, 10)


@pytest.mark.parametrize("v", ["Aug 10, 2025", "August 10, 2025", "10 Aug 2025", "8/10/2025"])
def test_plain_cast_does_not_read_other_formats(spark, v):
    assert one(spark, to_date_text, v) is None


def test_yearless_uses_as_of_year(spark):
    assert one(spark, lambda c: parse_post_date(c, 2025), "Aug 10") == D(2025, 8, 10)


def test_partial_date(spark):
    assert one(spark, lambda c: parse_post_date(c, 2025), "2025-08") is None
    assert one(spark, to_date_text, "2025-08") == D(2025, 8, 1)


def test_impossible_date_falls_through(spark):
    assert one(spark, lambda c: parse_post_date(c, 2025), "Feb 30, 2025") is None


def test_malformed_json_is_all_null_and_counted(spark):
    df = spark.createDataFrame([("not json",)], "value string")
    p = parse_json_column(df, NEWS_SCHEMA).first()
    assert all(p[c] is None for c in NEWS_SCHEMA.fieldNames())
    assert p["_corrupt_record"] == "not json"
    ents = clean_news(parse_json_column(df, NEWS_SCHEMA)).withColumn("entities", pattern_entities("full_text"))
    assert flatten_mentions(ents, "publishedAt").count() == 0


def test_wrong_json_type_reads_as_text(spark):
    df = spark.createDataFrame([('{"title":5,"x":1}',)], "value string")
    p = parse_json_column(df, NEWS_SCHEMA).first()
    assert p["title"] == "5" and "x" not in p.asDict()


def test_null_parts_of_full_text(spark):
    df = spark.createDataFrame([(None, "a", None), (None, None, None)],
                               "title string, description string, content string")
    assert [r.full_text for r in clean_news(df).collect()] == ["a", ""]


def test_trim_keeps_tabs(spark):
    assert one(spark, space_trim, "\tx ") == "\tx"


def _mentions(spark, rows):
    return spark.createDataFrame(rows, "entity_text string, entity_type string, published_date date")


def test_grid_entity_under_two_types_and_empty_days(spark):
    m = _mentions(spark, [("a", "ORG", D(2025, 8, 10)), ("a", "DATE", D(2025, 8, 10)),
                          ("b", "CARDINAL", D(2025, 8, 10))])
    dates = spark.createDataFrame([(D(2025, 8, 10),), (D(2025, 8, 11),), (None,)], "the_date date")
    g = {(r[0], r[1]): r[2] for r in grid.dense_daily_counts(m, dates, "2025-08-10", "2025-12-07").collect()}
    assert g == {("a", D(2025, 8, 10)): 2, ("a", D(2025, 8, 11)): 0}
    g2 = {(r[0], r[1]): r[2] for r in grid.dense_daily_counts(
        m, dates, "2025-08-10", "2025-12-07", count_only_allowed=True).collect()}
    assert g2[("a", D(2025, 8, 10))] == 1


@pytest.mark.parametrize("x,out", [(2.5, 2), (0.5, 0), (-1.2, 0), (3.5, 4), (7.49, 7)])
def test_round_half_even_clamped(spark, x, out):
    assert one(spark, round_half_even_nonneg, x, "double") == out


def test_weekday_monday_is_zero(spark):
    assert one(spark, weekday_monday0, D(2025, 12, 8), "date") == 0


def _series(spark, n):
    rows = [("e", D(2025, 8, 1) + dt.timedelta(days=i), i) for i in range(n)]
    return spark.createDataFrame(rows, "entity_text string, published_date date, count_mentions long")


def test_short_series(spark):
    assert lag_features(_series(spark, 5)).count() == 0
    f = lag_features(_series(spark, 6)).collect()
    assert len(f) == 1 and f[0]["lag_1"] == 4 and f[0]["lag_5"] == 0 and f[0]["group_id_enc"] == 0


def test_scoring_row_shifts_lags(spark):
    s = scoring_rows(lag_features(_series(spark, 12))).first()
    assert [s[f"lag_{i}"] for i in range(1, 6)] == [11, 10, 9, 8, 7]
    assert s["date"] == D(2025, 8, 13)


def _feed(spark, rows):
    return spark.createDataFrame(
        [("u", i, *r) for i, r in enumerate(rows)],
        "source string, pos int, post_id string, is_repost boolean, content string, date_text string")


def _emitted(df):
    return sorted((r["pos"], r["kind"]) for r in df.collect())


def test_take_while_with_old_pinned_post_first(spark):
    f = _feed(spark, [("1", False, "x", "2025-08-01"), ("2", False, "x", "2025-08-20"),
                      ("3", False, "x", "2025-08-19")])
    out = feeds.apply_feed_rules(f, max_posts=5, max_reposts=0, stop_date="2025-08-01")
    assert out.count() == 0


def test_cap_before_stop(spark):
    f = _feed(spark, [("1", False, "x", "2025-08-20"), ("2", False, "x", "2025-08-20"),
                      ("3", False, "x", "2025-08-01"), ("4", True, "", "2025-08-20")])
    out = feeds.apply_feed_rules(f, max_posts=2, max_reposts=3, stop_date="2025-08-05")
    assert _emitted(out) == [(0, "post"), (1, "post"), (3, "repost")]


def test_stop_before_cap(spark):
    f = _feed(spark, [("1", False, "x", "2025-08-20"), ("2", False, "x", "2025-08-20"),
                      ("3", False, "x", "2025-08-01"), ("4", True, "", "2025-08-20")])
    out = feeds.apply_feed_rules(f, max_posts=5, max_reposts=3, stop_date="2025-08-05")
    assert _emitted(out) == [(0, "post"), (1, "post")]


def test_empty_first_copy_uses_up_its_id(spark):
    f = _feed(spark, [("7", False, "", "2025-08-20"), ("7", False, "text", "2025-08-20")])
    assert feeds.apply_feed_rules(f, max_posts=5, max_reposts=0, stop_date=None).count() == 0


def test_reposts_off_count_as_posts(spark):
    f = _feed(spark, [("1", True, "x", "2025-08-20"), ("2", True, "x", "2025-08-20")])
    out = feeds.apply_feed_rules(f, max_posts=5, max_reposts=0, stop_date=None)
    assert _emitted(out) == [(0, "post"), (1, "post")]


def test_status_id_rules(spark):
    hrefs = ["/u/status/12345678901?x=1", "/u/status/12345678901/photo/1", "/u/status/123"]
    got = [one(spark, lambda c: status_id(F.array(c)), h) for h in hrefs]
    assert got == ["12345678901", None, None]
    el = '<a href="/u/status/123">x</a><time datetime="2025-08-10T00:00:00Z"></time>'
    assert one(spark, lambda c: post_id(c, F.lit("")), el) == "time_2025-08-10T00:00:00Z"


def test_offsets_unordered(spark):
    log = spark.createDataFrame([("t", 0, 5), ("t", 0, 3), ("t", 0, 4)], "topic string, partition int, offset long")
    assert progress.next_offsets(log).first()["next_offset"] == 6


def test_partition_without_new_rows_keeps_offset(spark):
    old = spark.createDataFrame([("t", 0, 10), ("t", 1, 7)], "topic string, partition int, next_offset long")
    new = spark.createDataFrame([("t", 0, 12)], "topic string, partition int, next_offset long")
    got = sorted((r.partition, r.next_offset) for r in progress.merge_offsets(old, new).collect())
    assert got == [(0, 12), (1, 7)]


def test_dense_calendar_fills_missing_days(spark):
    m = _mentions(spark, [("a", "ORG", D(2025, 8, 10)), ("a", "ORG", D(2025, 8, 12))])
    dates = spark.createDataFrame([(D(2025, 8, 10),), (D(2025, 8, 12),)], "the_date date")
    obs = grid.dense_daily_counts(m, dates, "2025-08-10", "2025-08-12")
    cal = grid.dense_daily_counts(m, None, "2025-08-10", "2025-08-12", calendar="dense")
    assert obs.count() == 2
    assert sorted((r[1], r[2]) for r in cal.collect()) == [
        (D(2025, 8, 10), 1), (D(2025, 8, 11), 0), (D(2025, 8, 12), 1)]


def test_short_series_are_reported(spark):
    from trendlake.operators.features import short_series
    g = _series(spark, 5).unionByName(_series(spark, 8).replace("e", "f", "entity_text"))
    assert [r.entity_text for r in short_series(g).collect()] == ["e"]


@pytest.mark.parametrize("v", ["2025-08-10T23:30:60Z", "0000-01-01", "2025-13-01", "Aug 32, 2025"])
def test_feed_parser_rejects_what_datetime_rejects(spark, v):
    assert one(spark, lambda c: parse_post_date(c, 2025), v) is None
