"""Parsing, cleaning and extraction queries over events, documents and
conversations."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import extract
from ..operators.clean import parse_json_column
from ..operators.mentions import news_mentions, post_mentions, union_mentions
from ..operators.extract import TOKEN_PATTERN
from . import fixtures as fx
from .registry import register

PROPS_SCHEMA = T.StructType([T.StructField("k", T.LongType()),
                             T.StructField("label", T.StringType())])


def news_from_documents(docs):
    """Articles stand-in: first line is the title, non-English language code
    the description, the whole text the content."""
    return docs.select(
        "doc_id",
        F.split(F.col("text"), "\n").getItem(0).alias("title"),
        F.when(F.col("lang") != "en", F.col("lang")).alias("description"),
        F.concat(F.lit("doc://"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string")).alias("url"),
        fx.doc_published_at("doc_id").alias("publishedAt"),
        F.col("text").alias("content"),
    )


def posts_from_conversations(conv):
    """Posts stand-in: each turn is a post; even conversations carry an ISO
    date, odd ones a 'Mon d, yyyy' date that a plain cast cannot read."""
    day = (F.col("conv_id") % 30 + 1).cast("int")
    date_txt = F.when(F.col("conv_id") % 2 == 0, F.format_string("2024-01-%02d", day)) \
                .otherwise(F.format_string("Jan %d, 2024", day))
    return conv.select("conv_id", "turn", F.col("text").alias("tweet_content"),
                       date_txt.alias("tweet_date"))


NEWS_SQL = (
    "news AS (SELECT doc_id, trim(split_part(text, chr(10), 1)) AS title, "
    "trim(CASE WHEN lang <> 'en' THEN lang END) AS description, trim(text) AS content, "
    "printf('2024-01-%02dT%02d:30:00Z', doc_id % 30 + 1, doc_id % 24) AS publishedAt "
    "FROM documents)"
)
FULLTEXT_SQL = (
    "ft AS (SELECT doc_id, concat_ws(' ', title, description, content) AS full_text, "
    "publishedAt FROM news)"
)
POSTS_SQL = (
    "posts AS (SELECT conv_id, turn, text AS tweet_content, CASE WHEN conv_id % 2 = 0 "
    "THEN printf('2024-01-%02d', conv_id % 30 + 1) ELSE printf('Jan %d, 2024', conv_id % 30 + 1) "
    "END AS tweet_date FROM conversations)"
)
# The extractor's rule in other words, for an engine without look-behind: words
# that do not begin with a capital are read too (so that none is cut) and dropped.
_WORDS_SQL = (r"[\p{Ll}\p{Lt}\p{Lm}\p{Lo}]\p{L}*|\p{Lu}\p{L}*\p{Ll}\p{L}*(?: \p{Lu}\p{L}*\p{Ll}\p{L}*)*"
              r"|\p{Lu}{2,}|[0-9]+")


def found_sql(text: str) -> str:
    return (f"list_filter(regexp_extract_all({text}, '{_WORDS_SQL}'), "
            r"lambda w: regexp_matches(w, '^[\p{Lu}0-9]'))")


LABEL_SQL = (
    "CASE WHEN regexp_full_match(e, '[0-9]+') THEN 'CARDINAL' "
    r"WHEN regexp_full_match(e, '\p{Lu}{2,}') THEN 'ORG' "
    "WHEN strpos(e, ' ') > 0 THEN 'PERSON' ELSE 'NORP' END"
)


@register("parse_json_payload", """
SELECT event_id, TRY_CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       json_extract_string(props, '$.label') AS label,
       CASE WHEN json_valid(props) THEN NULL ELSE props END AS _corrupt_record
FROM events
""", "PRJ1 PRJ2 PRJ3 FN7 Q18")
def parse_json_payload(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events")
    return parse_json_column(ev, PROPS_SCHEMA, value_col="props", keep=("event_id",))


@register("clean_full_text", f"""
WITH {NEWS_SQL}
SELECT doc_id, title, description, length(concat_ws(' ', title, description, content)) AS n_chars,
       md5(concat_ws(' ', title, description, content)) AS full_text_md5
FROM news
""", "PRJ4 PRJ5 FN1 FN3")
def clean_full_text(spark, sf_dir):
    from ..operators.clean import clean_news
    df = clean_news(news_from_documents(fx.table(spark, sf_dir, "documents")))
    return df.select("doc_id", "title", "description",
                     F.length("full_text").cast("bigint").alias("n_chars"),
                     F.md5(F.col("full_text")).alias("full_text_md5"))


@register("extract_entities_regex", f"""
WITH {NEWS_SQL}, {FULLTEXT_SQL},
ents AS (SELECT doc_id, publishedAt, unnest({found_sql('full_text')}) AS e FROM ft)
SELECT doc_id, lower(e) AS entity_text, {LABEL_SQL} AS entity_type,
       TRY_CAST(publishedAt AS DATE) AS published_date
FROM ents
""", "UDF1 PRJ6 PRJ7 PRJ8 FN4 FN5 FN9")
def extract_entities_regex(spark, sf_dir):
    news = news_from_documents(fx.table(spark, sf_dir, "documents"))
    return news_mentions(news, extra=("doc_id",))


@register("mentions_union", f"""
WITH {NEWS_SQL}, {FULLTEXT_SQL}, {POSTS_SQL},
a AS (SELECT publishedAt AS d, unnest({found_sql('full_text')}) AS e FROM ft),
b AS (SELECT tweet_date AS d, unnest({found_sql("coalesce(tweet_content, '')")}) AS e FROM posts),
u AS (SELECT * FROM a UNION ALL SELECT * FROM b)
SELECT lower(e) AS entity_text, {LABEL_SQL} AS entity_type, TRY_CAST(d AS DATE) AS published_date FROM u
""", "SET1 Q4 Q5")
def mentions_union(spark, sf_dir):
    news = news_from_documents(fx.table(spark, sf_dir, "documents"))
    posts = posts_from_conversations(fx.table(spark, sf_dir, "conversations"))
    return union_mentions(news_mentions(news), post_mentions(posts))


def _terms(spark, sf_dir):
    """Gazetteer: region names (LOC), nation names (GPE), part names
    (PRODUCT), whole benchmark passages
    (WORK_OF_ART), which the documents quote, and their first sentences (EVENT)."""
    tok = lambda c: F.array_join(F.transform(
        F.regexp_extract_all(c, F.lit(TOKEN_PATTERN), 0), lambda t: F.lower(t)), " ")
    region = fx.table(spark, sf_dir, "region").select(tok(F.col("r_name")).alias("term"), F.lit("LOC").alias("label"))
    nation = fx.table(spark, sf_dir, "nation").select(tok(F.col("n_name")).alias("term"), F.lit("GPE").alias("label"))
    part = fx.table(spark, sf_dir, "part").select(tok(F.col("p_name")).alias("term"), F.lit("PRODUCT").alias("label"))
    bench = fx.table(spark, sf_dir, "benchmark").select(tok(F.col("text")).alias("term"), F.lit("WORK_OF_ART").alias("label"))
    first = fx.table(spark, sf_dir, "benchmark").select(
        tok(F.regexp_extract("text", r"(?s)^[^.]*", 0)).alias("term"), F.lit("EVENT").alias("label"))
    return (region.unionByName(nation).unionByName(part).unionByName(bench).unionByName(first)
            .where("term <> ''").distinct())


TERMS_SQL = f"""
terms AS (SELECT DISTINCT term, label FROM (
  SELECT array_to_string(list_transform(regexp_extract_all(r_name, '{TOKEN_PATTERN}'), lambda x: lower(x)), ' ') AS term, 'LOC' AS label FROM region
  UNION ALL SELECT array_to_string(list_transform(regexp_extract_all(n_name, '{TOKEN_PATTERN}'), lambda x: lower(x)), ' '), 'GPE' FROM nation
  UNION ALL SELECT array_to_string(list_transform(regexp_extract_all(p_name, '{TOKEN_PATTERN}'), lambda x: lower(x)), ' '), 'PRODUCT' FROM part
  UNION ALL SELECT array_to_string(list_transform(regexp_extract_all(text, '{TOKEN_PATTERN}'), lambda x: lower(x)), ' '), 'WORK_OF_ART' FROM benchmark
  UNION ALL SELECT array_to_string(list_transform(regexp_extract_all(split_part(text, '.', 1), '{TOKEN_PATTERN}'), lambda x: lower(x)), ' '), 'EVENT' FROM benchmark
) WHERE term <> '')"""


@register("extract_entities_gazetteer", f"""
WITH {TERMS_SQL},
toks AS (SELECT doc_id, ' ' || array_to_string(list_transform(regexp_extract_all(text, '{TOKEN_PATTERN}'), lambda x: lower(x)), ' ') || ' ' AS t FROM documents),
hit AS (SELECT doc_id, term, label, len(string_split(replace(t, ' ', '  '), ' ' || replace(term, ' ', '  ') || ' ')) - 1 AS n
  FROM toks JOIN terms ON strpos(t, ' ' || term || ' ') > 0)
SELECT doc_id, term AS entity_text, label AS entity_type FROM (SELECT *, unnest(range(n)) FROM hit)
""", "UDF1 gazetteer")
def extract_entities_gazetteer(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents")
    return extract.gazetteer_mentions(docs, _terms(spark, sf_dir), "text", keep=("doc_id",))
