"""Record schemas and fixed values of the trend pipeline.

Everything here is data, not logic: the schemas the message payloads are read
with, and the constant lists whose values must stay as they are for results to
match (label set, date formats, repost words).
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Payload schemas (fixed projection on read; extra JSON keys are dropped).
# --------------------------------------------------------------------------
NEWS_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("publishedAt", T.StringType()),
    T.StructField("content", T.StringType()),
])

POST_SCHEMA = T.StructType([
    T.StructField("tweet_content", T.StringType()),
    T.StructField("tweet_date", T.StringType()),
])

# Optional quoted fields that a post record may carry.
POST_SCHEMA_QUOTED = T.StructType(POST_SCHEMA.fields + [
    T.StructField("quoted_content", T.StringType()),
    T.StructField("quoted_username", T.StringType()),
])

NEWS_RESPONSE_SCHEMA = T.StructType([
    T.StructField("articles", T.ArrayType(NEWS_SCHEMA)),
])

REPOST_SCHEMA = T.StructType([
    T.StructField("retweet_content", T.StringType()),
    T.StructField("retweet_username", T.StringType()),
    T.StructField("retweet_profile_bio", T.StringType()),
    T.StructField("retweet_main_content", T.StringType()),
    T.StructField("retweet_date", T.StringType()),
])

PROFILE_SCHEMA = T.StructType([
    T.StructField("username", T.StringType()),
    T.StructField("bio", T.StringType()),
])

ENTITY_STRUCT = T.StructType([
    T.StructField("entity", T.StringType()),
    T.StructField("type", T.StringType()),
])
ENTITY_ARRAY = T.ArrayType(ENTITY_STRUCT)

# Mention fact and derived tables.
MENTION_SCHEMA = T.StructType([
    T.StructField("entity_text", T.StringType()),
    T.StructField("entity_type", T.StringType()),
    T.StructField("published_date", T.DateType()),
])

DATES_SCHEMA = T.StructType([T.StructField("the_date", T.DateType())])

LOG_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("value", T.BinaryType()),
])

OFFSETS_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("next_offset", T.LongType()),
])

TRENDS_SCHEMA = T.StructType([
    T.StructField("group_id", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("predicted_count", T.IntegerType()),
])

# --------------------------------------------------------------------------
# Fixed values (must stay exactly as they are for matching results).
# --------------------------------------------------------------------------

# Entity labels kept when the dense grid is built.
ALLOWED_ENTITY_TYPES = ("EVENT", "FAC", "GPE", "LOC", "ORG", "PERSON", "PRODUCT", "WORK_OF_ART")

# Topic names of the two feeds.
NEWS_TOPIC = "news-topic"
POSTS_TOPIC = "tweets-topic"

# Post-date formats tried in this order (strptime notation), then a year-less
# "%b %d" completed with the as-of year.
POST_DATE_FORMATS = (
    "%Y-%m-%dT%H:%M:%S.%fZ",
    "%Y-%m-%dT%H:%M:%SZ",
    "%Y-%m-%d %H:%M:%S",
    "%Y-%m-%d",
    "%b %d, %Y",
    "%B %d, %Y",
    "%d %b %Y",
    "%m/%d/%Y",
)
POST_DATE_SENTINEL = "Unknown"

# English month names, January first (strptime %B / %b match them
# case-insensitively; %b is the first three letters).
MONTH_NAMES = ("january", "february", "march", "april", "may", "june", "july",
               "august", "september", "october", "november", "december")

# Repost classifier: words looked for in the social-context line, phrases in
# the whole element text, and marker elements / nested posts in its HTML.
REPOST_CONTEXT_WORDS = ("reposted", "retweeted", "retweet", "shared")
REPOST_TEXT_PHRASES = ("retweeted", "reposted", "retweet", "shared this",
                       "reposted this", "retweeted this", "shared a")
REPOST_MARKER_TESTIDS = ("retweetIcon", "retweet", "icon-retweet")
REPOST_MARKER_ARIA = ("retweet", "repost")

# Post-id cascade: element attributes tried in this order.
# ("data-testid" is the same on all posts of a page, so it is left out; callers
# that want the collector's ids pass it, with its prefixes 1000 and 100)
POST_ID_ATTRS = ("data-tweet-id", "data-item-id")
POST_ID_TEXT_HASH_LEN = 12
POST_ID_MIN_TEXT = 5
STATUS_ID_MIN_DIGITS = 11

# Content fallback: the whole element text is used only when it is longer than
# 10 characters (the collector's limits of 3 texts and 500 characters are
# parameters of the reader).
CONTENT_MIN_FALLBACK = 10

# Live-run feed defaults: 5 posts, reposts/followers/following off, stop date.
DEFAULT_MAX_POSTS = 5
DEFAULT_MAX_REPOSTS = 0
DEFAULT_MAX_EDGES = 0
DEFAULT_STOP_DATE = "2025-08-18"

# The six source accounts of the live run.
DEFAULT_SOURCES = ("BBCWorld", "ansa_english", "nytimes", "AJEnglish", "AP", "WSJ")

# Forecast model: five lags, boosted trees with 200 rounds of depth 5.
N_LAGS = 5
GBT_PARAMS = dict(maxIter=200, maxDepth=5, stepSize=0.1, subsamplingRate=0.8,
                  featureSubsetStrategy="0.8", seed=42)

# Export date range of the dense grid in the live pipeline (inclusive).
DEFAULT_GRID_RANGE = ("2025-08-10", "2025-12-07")
