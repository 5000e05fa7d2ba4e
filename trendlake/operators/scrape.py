"""Nested scrape results -> flat record tables.

A scrape result is one document per account: a profile struct plus arrays of
posts, reposts, followers and following (keys present only when non-empty).
Each array becomes its own table with ``inline`` - a narrow, per-row
operation, so an account with a huge array is split across output rows
without any shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import clean_bio, descriptive_text_or_null, first_nonempty
from ..schemas import POST_SCHEMA_QUOTED, PROFILE_SCHEMA, REPOST_SCHEMA

FOLLOWER_SCHEMA = T.StructType([T.StructField("follower_name", T.StringType()),
                                T.StructField("follower_bio", T.StringType())])
FOLLOWING_SCHEMA = T.StructType([T.StructField("following_name", T.StringType()),
                                 T.StructField("following_bio", T.StringType())])

SCRAPE_RESULT_SCHEMA = T.StructType([
    T.StructField("username", T.StringType()),
    T.StructField("user_profile", PROFILE_SCHEMA),
    T.StructField("tweets", T.ArrayType(POST_SCHEMA_QUOTED)),
    T.StructField("retweets", T.ArrayType(REPOST_SCHEMA)),
    T.StructField("followers", T.ArrayType(FOLLOWER_SCHEMA)),
    T.StructField("following", T.ArrayType(FOLLOWING_SCHEMA)),
])


def posts_of(results: DataFrame) -> DataFrame:
    """(username, tweet_content, tweet_date, quoted_content, quoted_username)."""
    return results.select("username", F.inline(F.coalesce(
        "tweets", F.array().cast(results.schema["tweets"].dataType))))


def reposts_of(results: DataFrame) -> DataFrame:
    return results.select("username", F.inline(F.coalesce(
        "retweets", F.array().cast(results.schema["retweets"].dataType))))


def edges_of(results: DataFrame) -> DataFrame:
    """Followers and following as one edge table
    (username, direction, name, bio)."""
    fo = results.select("username", F.inline(F.coalesce(
        "followers", F.array().cast(results.schema["followers"].dataType))))
    fi = results.select("username", F.inline(F.coalesce(
        "following", F.array().cast(results.schema["following"].dataType))))
    return (fo.select("username", F.lit("followers").alias("direction"),
                      F.col("follower_name").alias("name"), F.col("follower_bio").alias("bio"))
            .unionByName(fi.select("username", F.lit("following").alias("direction"),
                                   F.col("following_name").alias("name"),
                                   F.col("following_bio").alias("bio"))))


def profiles_of(results: DataFrame) -> DataFrame:
    """Profile per account: display name falls back to the account name,
    bio is stripped (empty when missing)."""
    p = F.col("user_profile")
    return results.select(
        "username",
        F.coalesce(first_nonempty(p["username"]), F.col("username")).alias("display_name"),
        F.coalesce(clean_bio(p["bio"]), F.lit("")).alias("bio"))


def usable_profiles(profiles: DataFrame, name_col: str = "display_name",
                    bio_col: str = "bio") -> DataFrame:
    """Profiles with a bio or a name (the rest are failed profile loads)."""
    return profiles.where((F.coalesce(F.col(bio_col), F.lit("")) != "")
                          | (F.coalesce(F.col(name_col), F.lit("")) != ""))


def edge_bio(bio_text, fallback_texts) -> "F.Column":
    """Edge bio: cleaned bio element text, else the first descriptive text
    (longer than 5, not '@...', no 'Follow') of the candidates, else ''."""
    cands = F.filter(F.transform(fallback_texts, lambda t: descriptive_text_or_null(t)),
                     lambda t: t.isNotNull())
    return F.coalesce(first_nonempty(clean_bio(bio_text)), F.try_element_at(cands, F.lit(1)), F.lit(""))
