"""The closed-form feed rules against a literal, row-by-row simulation of the
collector's loop on random feeds (brute force on a small fixture)."""

import datetime as dt
import random

from pyspark.sql import functions as F

from trendlake.functions.dates import parse_post_date
from trendlake.operators.feeds import apply_feed_rules
from trendlake.schemas import POST_DATE_FORMATS

AS_OF_YEAR = 2025


def simulate(rows, max_posts, max_reposts, stop):
    posts, reposts, seen = [], [], set()
    for r in rows:
        pid = r["post_id"]
        if pid is None or pid in seen:
            continue
        seen.add(pid)
        if max_reposts > 0 and r["is_repost"]:
            if len(reposts) >= max_reposts:
                continue
            reposts.append(r["pos"])
            continue
        if len(posts) >= max_posts:
            continue
        if r["content"]:
            d = r["date"]
            if stop is not None and d is not None and d <= stop:
                return posts, reposts
            posts.append(r["pos"])
    return posts, reposts


def random_date_text(rng):
    """A text and the date it was rendered from (None where it shows none)."""
    d = dt.date(2025, 8, 1) + dt.timedelta(days=rng.randint(0, 30))
    pick = rng.randint(0, 11)
    if pick < 8:
        return dt.datetime(d.year, d.month, d.day, rng.randint(0, 23), 5, 9, 123000).strftime(POST_DATE_FORMATS[pick]), d
    return {8: (d.strftime("%b %d"), d), 9: ("Unknown", None), 10: ("", None), 11: ("junk 12", None)}[pick]


def test_closed_form_equals_loop(spark):
    rng = random.Random(7)
    stop = dt.date(2025, 8, 12)
    for max_posts, max_reposts in [(3, 2), (5, 0), (2, 4)]:
        rows, expected = [], set()
        for f in range(120):
            feed = []
            for pos in range(rng.randint(0, 14)):
                shown, date = random_date_text(rng)
                feed.append(dict(source=f"s{f}", pos=pos,
                                 post_id=None if rng.random() < 0.1 else str(rng.randint(0, 8)),
                                 is_repost=rng.random() < 0.3,
                                 content="" if rng.random() < 0.2 else "text",
                                 date_text=shown, date=date))
            p, r = simulate(feed, max_posts, max_reposts, stop)
            expected |= {(f"s{f}", x, "post") for x in p} | {(f"s{f}", x, "repost") for x in r}
            rows += feed
        df = spark.createDataFrame(
            [(r["source"], r["pos"], r["post_id"], r["is_repost"], r["content"], r["date_text"]) for r in rows],
            "source string, pos int, post_id string, is_repost boolean, content string, date_text string")
        out = apply_feed_rules(df, max_posts=max_posts, max_reposts=max_reposts,
                               stop_date=stop.isoformat(), as_of_year=AS_OF_YEAR)
        got = {(r.source, r.pos, r.kind) for r in out.collect()}
        assert got == expected, (max_posts, max_reposts, sorted(got ^ expected)[:10])


def rendered(rng):
    """Texts of one date in every admitted form, with what they must give."""
    d = dt.date(rng.choice([1999, 2024, 2025]), rng.randint(1, 12), rng.randint(1, 28))
    full, short = d.strftime("%B"), d.strftime("%b")
    case = rng.choice([str.lower, str.upper, str.title])
    gap = rng.choice([" ", "  ", "\t"])
    clock = f"{rng.randint(0, 23)}:{rng.randint(0, 59)}:{rng.randint(0, 59)}"
    return [(f"{d:%Y-%m-%d}T{clock}.{rng.choice(['0', '123', '123456'])}Z", d), (f"{d:%Y-%m-%d}T{clock}Z", d),
            (f"{d.year}-{d.month}-{d.day}{gap}{clock}", d), (f"{d.year}-{d.month}-{d.day}", d),
            (f"{case(short)}{gap}{d.day},{gap}{d.year}", d), (f"{case(full)} {d.day:02d}, {d.year}", d),
            (f"{d.day}{gap}{case(short)}{gap}{d.year}", d), (f"{d.month}/{d.day:02d}/{d.year}", d),
            (f"{case(short)}{gap}{d.day}", d.replace(year=AS_OF_YEAR)), (f"{case(short)} {d.day} ", d.replace(year=AS_OF_YEAR))]


# Texts that show no date, one reason each.
NO_DATE = ["", "Unknown", "junk", "2025-02-30", "2025-13-01", "2025-00-10", "2025-01-00", "2025-01-32", "0000-01-01",
           "12345-01-01", "2025-01", " 2025-01-01", "2025-01-01 ", "2025-01-01\n", "2025-01-01T24:00:00Z",
           "2025-01-01T10:60:00Z", "2025-01-01T10:00:60Z", "2025-01-01T10:00:00", "2025-01-01T10:00:00.1234567Z",
           "2025-01-01 10:00", "Feb 30, 2025", "Sept 1, 2025", "Jan 1 2025", "Jan 1,2025", "1 January 2025",
           "31 Feb 2025", "13/01/2025", "2/30/2025", "1/1/25", "Feb 30", "January 5", "Jan", "5 Jan"]


def test_post_dates(spark):
    rng = random.Random(11)
    want = dict(x for _ in range(200) for x in rendered(rng))
    want.update({t: None for t in NO_DATE})
    df = spark.createDataFrame([(t,) for t in want], "t string")
    got = {r.t: r.d for r in df.select("t", parse_post_date(F.col("t"), AS_OF_YEAR).alias("d")).collect()}
    bad = [(t, got[t], want[t]) for t in want if got[t] != want[t]]
    assert not bad, bad[:10]
