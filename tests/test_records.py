"""Scrape-result flattening, text helpers, sinks and sources round trips."""

import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F

from trendlake.functions.text import (clean_bio, clean_display_name, clean_username,
                                      content_key, handle_from_href, handle_from_text,
                                      is_handle_href, py_strip)
from trendlake.operators import feeds, reports, scrape
from trendlake.schemas import LOG_SCHEMA, TRENDS_SCHEMA
from trendlake.session import shared_path
from trendlake.sinks.log import publish_files
from trendlake.sinks.tables import append_archive, write_counts_csv, write_per_account, write_trends
from trendlake.sources.files import read_counts_csv, read_or_empty
from trendlake.sources.log import read_log_files

D = dt.date


def col1(spark, fn, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_text_helpers(spark):
    assert col1(spark, py_strip, ["  x\t\n", None]) == ["x", None]
    assert col1(spark, handle_from_href, ["/AP/", "https://x.com/a/b", ""]) == ["AP", "b", ""]
    assert col1(spark, is_handle_href, ["/AP", "/u/status/1", "http", "x"]) == [True, False, False, False]
    assert col1(spark, handle_from_text, ["@AP news", "no at", "@@  "]) == ["AP", None, None]
    assert col1(spark, clean_username, ["@Al Jazeera/EN\\x!é"]) == ["Al_Jazeera_EN_xé"]
    assert col1(spark, clean_bio, [" News. Follow "]) == ["News."]
    assert col1(spark, clean_display_name, [" AP · "]) == ["AP"]


def test_content_key_is_deterministic(spark):
    df = spark.createDataFrame([("<b>x</b>", "x")], "h string, t string")
    a = df.select(content_key("h", "t")).first()[0]
    assert a == df.select(content_key("h", "t")).first()[0] and len(a) == 16


def _results(spark):
    doc = {"username": "AP",
           "user_profile": {"username": "", "bio": " Wire. Follow "},
           "tweets": [{"tweet_content": "a", "tweet_date": "2025-08-19",
                       "quoted_content": "q", "quoted_username": "B"},
                      {"tweet_content": "b", "tweet_date": "Unknown"}],
           "followers": [{"follower_name": "x", "follower_bio": ""}]}
    empty = {"username": "WSJ", "user_profile": {"username": "", "bio": ""}}
    d = tempfile.mkdtemp(prefix="scr-")
    with open(os.path.join(d, "r.json"), "w") as f:
        f.write(json.dumps(doc) + "\n" + json.dumps(empty) + "\n")
    return spark.read.schema(scrape.SCRAPE_RESULT_SCHEMA).json(d)


def test_scrape_result_tables(spark):
    r = _results(spark)
    posts = scrape.posts_of(r).collect()
    assert [(p.username, p.tweet_content, p.quoted_username) for p in posts] == [("AP", "a", "B"), ("AP", "b", None)]
    assert scrape.reposts_of(r).count() == 0
    assert [(e.direction, e.name) for e in scrape.edges_of(r).collect()] == [("followers", "x")]
    prof = {p.username: (p.display_name, p.bio) for p in scrape.profiles_of(r).collect()}
    assert prof == {"AP": ("AP", "Wire."), "WSJ": ("WSJ", "")}
    blank = r.select("username", F.lit("").alias("display_name"), F.col("user_profile.bio").alias("bio"))
    assert [p.username for p in scrape.usable_profiles(blank).collect()] == ["AP"]


def test_edge_bio_fallback(spark):
    df = spark.createDataFrame([("", ["@x", "Follow me", "long enough text"]), (" Bio ", [])],
                               "b string, t array<string>")
    assert [r[0] for r in df.select(scrape.edge_bio(F.col("b"), F.col("t"))).collect()] == \
        ["long enough text", "Bio"]


def test_dedupe_by_content(spark):
    df = spark.createDataFrame([(0, "<a>"), (1, "<b>"), (2, "<a>")], "pos int, html string")
    assert sorted(r.pos for r in feeds.dedupe_by_content(df).collect()) == [0, 1]


def test_archive_trends_and_per_account_sinks(spark):
    base = shared_path(spark, "t-sinks")
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    append_archive(df, base + "/arch", "2025-08-10")
    append_archive(df, base + "/arch", "2025-08-10")     # re-run replaces the day
    append_archive(df, base + "/arch", "2025-08-11")
    assert spark.read.json(base + "/arch").count() == 2
    t = spark.createDataFrame([("e", D(2025, 8, 12), 3)], TRENDS_SCHEMA)
    write_trends(t, base + "/trends")
    write_trends(t, base + "/trends")
    assert spark.read.parquet(base + "/trends").count() == 1
    assert reports.recent_predictions(spark.read.parquet(base + "/trends")).count() == 1
    posts = spark.createDataFrame([("AP", "x"), ("WSJ", "y")], "username string, tweet_content string")
    write_per_account(posts, base + "/acc")
    assert {d for d in os.listdir(base + "/acc") if d.startswith("username=")} == {"username=AP", "username=WSJ"}


def test_publish_files_and_missing_archive(spark):
    base = shared_path(spark, "t-log")
    arts = spark.createDataFrame([("t1", "2025-08-10"), ("t2", "2025-08-11")], "title string, publishedAt string")
    publish_files(arts, base + "/log", "news-topic")
    log = read_log_files(spark, base + "/log").collect()
    assert {json.loads(bytes(r.value))["title"] for r in log} == {"t1", "t2"}
    assert len({(r.partition, r.offset) for r in log}) == 2
    assert read_or_empty(spark, base + "/nothing", LOG_SCHEMA).count() == 0


def test_sorted_csv_export(spark):
    base = shared_path(spark, "t-csv")
    c = spark.createDataFrame([("b", D(2025, 8, 2), 1), ("a", D(2025, 8, 3), 0), ("a", D(2025, 8, 1), 2)],
                              "entity_text string, published_date date, count_mentions long")
    write_counts_csv(c.repartition(3), base, sort=True)
    back = read_counts_csv(spark, base).collect()
    assert sorted(back) == sorted(c.collect())


# Inputs and what the helpers must give: strip, clean_username, handle_from_href,
# handle_from_text, clean_bio.
HELPER_TABLE = [
    ("", "", "", "", None, ""),
    (" a b ", "a b", "_a_b_", " a b ", None, "a b"),
    ("@AP", "@AP", "AP", "@AP", "AP", "@AP"),
    ("@AP news@", "@AP news@", "AP_news", "@AP news@", "AP", "@AP news@"),
    ("/a/b/", "/a/b/", "_a_b_", "b", None, "/a/b/"),
    ("//", "//", "__", "", None, "//"),
    ("x\\y", "x\\y", "x_y", "x\\y", None, "x\\y"),
    ("é²ß-_!", "é²ß-_!", "é²ß-_", "é²ß-_!", None, "é²ß-_!"),
    ("\t@\x0bme\x1c too\n", "@\x0bme\x1c too", "me_too", "\t@\x0bme\x1c too\n", "@", "@\x0bme\x1c too"),
    ("@\xa0me", "@\xa0me", "me", "@\xa0me", "me", "@\xa0me"),
    ("\x85 x \u3000", "x", "_x_", "\x85 x \u3000", None, "x"),
    ("Follow me Follow", "Follow me Follow", "Follow_me_Follow", "Follow me Follow", None, "me"),
    ("FoFollowllow", "FoFollowllow", "FoFollowllow", "FoFollowllow", None, "Follow"),
    ("@@", "@@", "", "@@", None, "@@"),
    ("a@b", "a@b", "ab", "a@b", "a@b", "a@b"),
    ("Ⅻ\u0301😀", "Ⅻ\u0301😀", "Ⅻ", "Ⅻ\u0301😀", None, "Ⅻ\u0301😀"),
    ("http://x.com/u?a=/b", "http://x.com/u?a=/b", "http__xcom_ua_b", "b", None, "http://x.com/u?a=/b"),
]


def test_text_helpers_by_table(spark):
    df = spark.createDataFrame([(r[0],) for r in HELPER_TABLE], "t string")
    c = F.col("t")
    rows = df.select("t", py_strip(c), clean_username(c), handle_from_href(c), handle_from_text(c),
                     clean_bio(c)).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(HELPER_TABLE, key=str)


def test_every_element_of_a_page_is_a_post(spark):
    from trendlake.operators.pages import page_posts
    html = ('<title>T</title><article data-item-id="7"><p>Hello <b>big</b> world of text</p><p>two</p><p>3</p><p>4</p>'
            '</article>x<article><time datetime="2025-08-10"></time><p> </p>Plain text of it</article><article></article>')
    rows = page_posts(spark.createDataFrame([(1, html), (2, "<p>none</p>"), (3, None)], "page_id int, html string")).collect()
    got = {(r.page_id, r.element): (r.content, r.post_id) for r in rows}
    assert got == {(1, 0): ("Hello big world of text two 3 4", "data-item-id_7"),
                   (1, 1): ("Plain text of it", "time_2025-08-10"), (1, 2): ("", None),
                   (2, None): ("", None), (3, None): ("", None)}


def test_limits_of_the_collector_are_parameters(spark):
    from trendlake.operators.pages import content_text, post_id
    long = "".join(f"<p>{i}</p>" for i in range(5))
    a, b = "x" * 1000 + "a", "x" * 1000 + "b"
    df = spark.createDataFrame([(long, a, b)], "l string, a string, b string")
    none = F.lit("")
    r = df.select(content_text("l"), content_text("l", max_parts=3), content_text("a", max_fallback=500),
                  post_id("a", none) == post_id("b", none),
                  post_id("a", none, html_prefix=1000) == post_id("b", none, html_prefix=1000)).first()
    assert (r[0], r[1], len(r[2]), r[3], r[4]) == ("0 1 2 3 4", "0 1 2", 500, False, True)


def test_first_row_of_every_content_stays(spark):
    from trendlake.operators.feeds import dedupe_by_content
    rows = [(1, "A", 1), (2, "A", 1), (2, "B", 1), (3, "C", 1), (3, "C", 1), (4, "D", 7), (4, "D", 8), (5, None, 1), (None, "E", 1)]
    df = spark.createDataFrame(rows, "pos int, html string, n int")
    got = sorted(map(tuple, dedupe_by_content(df).collect()), key=str)
    assert [r[:2] for r in got] == [(1, "A"), (2, "B"), (3, "C"), (4, "D"), (None, "E")] and set(got) <= set(rows)
    both = df.union(df.select("pos", "html", (F.col("n") + 1).alias("n")))
    assert dedupe_by_content(both, keys=["n"]).count() == 11
