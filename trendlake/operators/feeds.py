"""Feed rules of the post collector, as distributed DataFrame operators.

A feed is one account's timeline: rows ``(source, pos, post_id, is_repost,
content, date_text, ...)`` where ``pos`` orders the timeline (smaller = seen
first). The collector's loop is replaced by a closed form:

1. rows without a derivable id are dropped;
2. first copy of each (source, post_id) wins - even an empty one;
3. kind = repost when reposts are collected (max_reposts > 0) and the row is
   a repost, else post;
4. empty posts are dropped (they take no cap slot); reposts are kept;
5. ``rn`` numbers each (source, kind) in feed order; rows past the cap go;
6. a post within the cap dated on/before the stop date ends the feed: it and
   every later row of either kind are dropped (reposts never trigger it).

Scale: a single account may hold a large share of all rows, so no step runs
an account's whole timeline through one task. Steps 2 and 5 are
``row_number() <= k`` filters, which Spark plans with a partial
WindowGroupLimit before the shuffle (each map task ships at most k rows per
group). Step 6 then only sees the capped candidates (at most max_posts +
max_reposts per account). The stand-alone take-while uses a per-account
``min(pos)`` aggregate joined back instead of a whole-timeline window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import stop_flag
from ..schemas import DEFAULT_MAX_POSTS, DEFAULT_MAX_REPOSTS, DEFAULT_STOP_DATE


def dedupe_first(feed: DataFrame, keys, pos: str = "pos") -> DataFrame:
    """First row (lowest ``pos``) of each key group; NULL keys dropped."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(pos)
    nn = F.lit(True)
    for k in keys:
        nn = nn & F.col(k).isNotNull()
    return (feed.where(nn).withColumn("_rn", F.row_number().over(w))
            .where("_rn = 1").drop("_rn"))


def number_within(feed: DataFrame, keys, pos: str = "pos", out: str = "rn") -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return feed.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(pos)))


def cap_within(feed: DataFrame, keys, cap, pos: str = "pos", out: str = "rn",
               bound: int | None = None) -> DataFrame:
    """First ``cap`` rows of each key group in ``pos`` order. ``cap`` may be
    a column (e.g. a per-kind limit); then ``bound`` (its largest value) is
    added as a literal conjunct so Spark can still plan a partial
    WindowGroupLimit before the shuffle."""
    if isinstance(cap, F.Column):
        cond = F.col(out) <= cap
        if bound is not None:
            cond = (F.col(out) <= F.lit(int(bound))) & cond
    else:
        cond = F.col(out) <= F.lit(int(cap))
    return number_within(feed, keys, pos, out).where(cond)


def take_while(feed: DataFrame, stop, source: str = "source", pos: str = "pos") -> DataFrame:
    """Rows of each feed before its first stop row (``stop`` a boolean
    column); the stop row itself is dropped. The join is left to the planner,
    which knows the size of the per-source table when it is there."""
    stops = (feed.where(stop).groupBy(F.col(source).alias("_source"))
             .agg(F.min(pos).alias("_stop_pos")))
    return (feed.join(stops, F.col(source).eqNullSafe(F.col("_source")), "left")
            .where(F.col("_stop_pos").isNull() | (F.col(pos) < F.col("_stop_pos")))
            .drop("_source", "_stop_pos"))


def apply_feed_rules(feed: DataFrame, *, max_posts: int = DEFAULT_MAX_POSTS,
                     max_reposts: int = DEFAULT_MAX_REPOSTS,
                     stop_date: str | None = DEFAULT_STOP_DATE,
                     as_of_year: int = 2025, source: str = "source", pos: str = "pos",
                     post_id: str = "post_id", is_repost: str = "is_repost",
                     content: str = "content", date_text: str = "date_text") -> DataFrame:
    """Emitted rows of every feed with their ``kind`` and ``rn``."""
    df = dedupe_first(feed, [source, post_id], pos)
    repost = F.coalesce(F.col(is_repost), F.lit(False)) & F.lit(max_reposts > 0)
    df = df.withColumn("kind", F.when(repost, F.lit("repost")).otherwise(F.lit("post")))
    keep = (F.col("kind") == "repost") | (F.coalesce(F.col(content), F.lit("")) != "")
    df = df.where(keep)
    cap = F.when(F.col("kind") == "repost", F.lit(max_reposts)).otherwise(F.lit(max_posts))
    cand = cap_within(df, [source, "kind"], cap, pos, bound=max(max_posts, max_reposts))
    # candidates are bounded per source: the stop scan is small
    flag = (F.col("kind") == "post") & stop_flag(F.col(date_text), stop_date, as_of_year)
    w = Window.partitionBy(source).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    return (cand.withColumn("_stopped", F.max(flag.cast("int")).over(w))
            .where("_stopped = 0").drop("_stopped"))


def split_kinds(emitted: DataFrame):
    """(posts, reposts) of the emitted rows."""
    return (emitted.where(F.col("kind") == "post"), emitted.where(F.col("kind") == "repost"))


def dedupe_by_content(df: DataFrame, html: str = "html", pos: str = "pos",
                      keys=()) -> DataFrame:
    """First row per (keys..., element HTML): the repost-page variant of
    dedupe. Markup is identified by SHA-256 and length; only these, the
    position and a hash of the row are shuffled to find the winners, which are
    then kept by a join on content and position. Of rows that share both, the
    one with the smallest hash stays; of wholly equal rows, one."""
    names = [f"_c{i}" for i in range(2)]
    marked = (df.where(F.col(html).isNotNull()).withColumn("_c0", F.sha2(F.col(html), 256))
              .withColumn("_c1", F.length(html)).withColumn("_row", F.xxhash64(*[F.col(c) for c in df.columns])))
    content = [*keys, *names]
    first = (marked.groupBy(*content, pos, "_row").agg(F.count(F.lit(1)).alias("_same"))
             .groupBy(*content).agg(F.min(F.struct(F.col(pos).alias("p"), "_row", "_same")).alias("w")))
    winners = first.select(*[F.col(c).alias(f"w{i}") for i, c in enumerate(content)], F.col("w.p").alias("wp"),
                           F.col("w._row").alias("wr"), F.col("w._same").alias("ws"))
    same = marked[pos].eqNullSafe(winners["wp"]) & (marked["_row"] == winners["wr"])
    for i, c in enumerate(content):
        same = same & marked[c].eqNullSafe(winners[f"w{i}"])

    def won(which) -> DataFrame:
        return marked.join(winners.where(which), same, "left_semi").select(*[marked[c] for c in df.columns])

    return won("ws = 1").union(won("ws > 1").dropDuplicates())
