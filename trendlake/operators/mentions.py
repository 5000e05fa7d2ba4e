"""The mention job: parsed articles and posts -> mention fact + dates table."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame

from ..functions.dates import to_date_text
from ..schemas import NEWS_SCHEMA, POST_SCHEMA
from .clean import clean_news, parse_json_column
from .extract import (flatten_mentions, gazetteer_mentions, model_entities, pattern_mentions)


Extractor = str | Callable[[], Callable]     # 'pattern', 'gazetteer' or a maker of a model


def _mentions(df: DataFrame, text_col: str, date_col: str, extractor: Extractor, extra,
              terms: DataFrame | None) -> DataFrame:
    if extractor == "pattern":
        return pattern_mentions(df, text_col, date_col, extra)
    if extractor == "gazetteer":
        if terms is None:
            raise ValueError("the gazetteer extractor needs a terms table (term, label)")
        dated = df.select(*extra, to_date_text(date_col).alias("published_date"), text_col)
        found = gazetteer_mentions(dated, terms, text_col, keep=(*extra, "published_date"))
        return found.select(*extra, "entity_text", "entity_type", "published_date")
    if not callable(extractor):
        raise ValueError(f"unknown extractor {extractor!r}")
    return flatten_mentions(model_entities(df, text_col, extractor), date_col, extra=extra)


def news_mentions(news: DataFrame, extractor: Extractor = "pattern", extra=(),
                  terms: DataFrame | None = None) -> DataFrame:
    """Parsed articles -> mentions (entities of title + description + content,
    dated by publishedAt). ``extractor``: 'pattern', 'gazetteer' (with
    ``terms``) or a maker of a model for the mapInPandas seam."""
    return _mentions(clean_news(news), "full_text", "publishedAt", extractor, extra, terms)


def post_mentions(posts: DataFrame, extractor: Extractor = "pattern", extra=(),
                  terms: DataFrame | None = None) -> DataFrame:
    """Parsed posts -> mentions (entities of the post text, dated by its date)."""
    return _mentions(posts, "tweet_content", "tweet_date", extractor, extra, terms)


def union_mentions(*parts: DataFrame) -> DataFrame:
    """UNION ALL of mention frames (by name)."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def batch_dates(news: DataFrame, posts: DataFrame) -> DataFrame:
    """Distinct dates of every record of the batch, with or without entities
    (NULL for unparsable dates is kept, as in the reference)."""
    return union_dates(news.select(to_date_text("publishedAt").alias("the_date")),
                       posts.select(to_date_text("tweet_date").alias("the_date")))


def union_dates(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts).distinct()


def merge_dates(existing: DataFrame | None, new: DataFrame, mode: str = "cumulative") -> DataFrame:
    """Next state of the ``dates`` table.

    'cumulative' (default): distinct union of old and new dates.
    'replace': only this batch's dates (what the reference's overwrite does).
    """
    if mode == "replace" or existing is None:
        return new.distinct()
    if mode != "cumulative":
        raise ValueError(mode)
    return union_dates(existing.select("the_date"), new.select("the_date"))


def mention_job(news_log: DataFrame, posts_log: DataFrame, extractor: Extractor = "pattern",
                terms: DataFrame | None = None):
    """Message-log frames of both topics -> (mentions, dates).

    Both results derive from the same parsed frames; the dates branch needs
    only the date field, and column pruning keeps the extractor out of it.
    """
    news = parse_json_column(news_log, NEWS_SCHEMA)
    posts = parse_json_column(posts_log, POST_SCHEMA)
    mentions = union_mentions(news_mentions(news, extractor, terms=terms),
                              post_mentions(posts, extractor, terms=terms))
    return mentions, batch_dates(news, posts)
