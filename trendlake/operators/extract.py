"""Entity extraction: text -> array<struct<entity, type>>.

Three interchangeable extractors share the same output contract:

* ``pattern_entities`` (default): one regex alternation evaluated JVM-side
  with ``regexp_extract_all``; the label follows from the shape of the match.
* ``gazetteer_mentions``: whole-token match of a term table. The first tokens
  of every place are joined with the openings of terms; the windows of the few
  places that remain are read out and compared with the terms.
* ``model_entities``: a seam for a statistical model: any callable
  ``list[str] -> list[list[(text, label)]]`` plugs in behind ``mapInPandas``
  and is fed Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrays import running_sums
from ..functions.dates import to_date_text

# ---- rules of the pattern extractor ----------------------------------------
# A word is a whole run of letters. Tried left to right at each position: runs
# of capitalised words, words of capitals only, digit runs.
_CAPITALISED = r"\p{Lu}\p{L}*\p{Ll}\p{L}*"
ENTITY_PATTERN = (rf"(?<!\p{{L}})(?:{_CAPITALISED}(?: {_CAPITALISED})*|\p{{Lu}}{{2,}}(?!\p{{L}}))"
                  r"|[0-9]+")
# Labels by shape of the match.
LABEL_CARDINAL = "CARDINAL"    # digits only
LABEL_ACRONYM = "ORG"          # two or more capitals
LABEL_MULTIWORD = "PERSON"     # several capitalised words
LABEL_SINGLE = "NORP"          # one capitalised word
# Tokens of the gazetteer matcher.
TOKEN_PATTERN = r"[A-Za-z0-9_]+"

OPENING = 3                 # first tokens of a term that places are looked up by
MODULUS = (1 << 31) - 1     # of token and window hashes


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _label(e: Column) -> Column:
    return (F.when(e.rlike(r"^[0-9]+\z"), F.lit(LABEL_CARDINAL))
            .when(e.rlike(r"^\p{Lu}{2,}\z"), F.lit(LABEL_ACRONYM))
            .when(F.instr(e, " ") > 0, F.lit(LABEL_MULTIWORD))
            .otherwise(F.lit(LABEL_SINGLE)))


def pattern_entities(text) -> Column:
    """array<struct<entity, type>> of every match, in text order; NULL text
    gives an empty array (no entities)."""
    text = _c(text)
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(ENTITY_PATTERN), 0)
    return F.transform(found, lambda e: F.struct(e.alias("entity"), _label(e).alias("type")))


def flatten_mentions(df: DataFrame, date_col: str, entities_col: str = "entities",
                     extra=()) -> DataFrame:
    """One row per entity occurrence: (entity_text lower-cased, entity_type,
    published_date). The date text is cut to a DATE, NULL when unparsable.

    ``explode_outer`` + a NULL filter keeps the extraction expression single:
    a plain ``explode`` makes Catalyst infer ``size(entities) > 0`` and, with
    the projection collapsed, evaluate the extractor twice per row.
    """
    e = df.select(*extra, to_date_text(date_col).alias("published_date"),
                  F.explode_outer(entities_col).alias("_e"))
    return e.where(F.col("_e").isNotNull()).select(
        *extra,
        F.lower(F.col("_e.entity")).alias("entity_text"),
        F.col("_e.type").alias("entity_type"),
        "published_date",
    )


def pattern_mentions(df: DataFrame, text_col: str, date_col: str, extra=()) -> DataFrame:
    """Fast path of ``pattern_entities`` + ``flatten_mentions``: the matches
    are exploded as plain strings and labelled afterwards, so no lambda
    (interpreted) and no per-row struct array is built. Same rows."""
    found = F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(ENTITY_PATTERN), 0)
    e = df.select(*extra, to_date_text(date_col).alias("published_date"),
                  F.explode_outer(found).alias("_m"))
    m = F.col("_m")
    return e.where(m.isNotNull()).select(
        *extra, F.lower(m).alias("entity_text"), _label(m).alias("entity_type"), "published_date")


# ---- gazetteer -------------------------------------------------------------
# Tokens are ASCII word runs, so lower-casing the space-joined tokens equals
# lower-casing each token.

def token_text(text) -> Column:
    """The text's ASCII word tokens, lower-cased, joined by single spaces
    (every run of non-token characters becomes one space; one regex pass)."""
    sep = F.regexp_replace(F.coalesce(_c(text), F.lit("")), "[^A-Za-z0-9_]+", " ")
    return F.lower(F.trim(sep))


def _token_hash(token: Column) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(MODULUS))


def _weighed(h: Column, place: Column) -> Column:
    """h * 2^place modulo 2^31 - 1, where powers of two repeat after 31."""
    return h * F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % 31).cast("int")) % MODULUS


def prefix_hashes(tokens: Column) -> Column:
    """Entry i is the hash of the first i tokens: the sum of token hashes, each
    weighed by its place. The difference of two entries is the hash of the
    tokens between, times the weight of the first one's place."""
    return F.concat(F.array(F.lit(0).cast("bigint")), running_sums(F.transform(
        tokens, lambda t, i: _weighed(_token_hash(t), i))))


def window_matches(prefixes: Column, at: Column, n: Column, h: Column) -> Column:
    """Whether the ``n`` tokens from ``at`` on may have hash ``h``."""
    end = F.get(prefixes, (at + n).cast("int"))
    return F.coalesce(F.pmod(end - F.get(prefixes, at), F.lit(MODULUS)) == _weighed(h, at), F.lit(False))


def _opening(tokens: list[Column]) -> Column:
    """Hash of some tokens in order; null if one is missing."""
    whole = tokens[0].isNotNull()
    for t in tokens[1:]:
        whole = whole & t.isNotNull()
    return F.when(whole, F.xxhash64(F.lit(len(tokens)), *tokens))


def gazetteer_mentions(docs: DataFrame, terms: DataFrame, text_col: str, keep=()) -> DataFrame:
    """Every occurrence of every term: (keep..., entity_text, entity_type).

    ``terms`` has (term, label) with terms already lower-cased and single-
    spaced, of any length. The opening of a term is its first ``OPENING``
    tokens (all, if it is shorter). A join of the openings of every place of a
    text with those of terms says where which lengths may match; a common first
    word alone says nothing. The places of a text come together with it again,
    each window of a possible length is read out and compared with the terms.
    Texts are told by a hash (two texts of one hash only test each other's
    places in vain); the planner decides from sizes whether terms or places are
    broadcast. Terms that share an opening cost a window for each of their
    lengths, not one each.
    """
    words = F.split("term", " ")
    n = F.size(words)
    opening = F.coalesce(*[F.when(n >= k, _opening([F.get(words, F.lit(i)) for i in range(k)]))
                           for k in range(OPENING, 0, -1)])
    wanted = (terms.where("term <> ''").select(opening.alias("_opening"), n.alias("n"))
              .groupBy("_opening").agg(F.collect_set("n").alias("_lengths")))
    # A filter for texts without words would tokenise twice; no term is empty.
    texts = docs.select(*keep, token_text(text_col).alias("_joined")).select(
        *keep, "_joined", F.xxhash64("_joined").alias("_text"))
    cut = F.split("_joined", " ").alias("_tokens")
    # Each token beside those that follow it; past the end they are null.
    size = F.size("_tokens")
    beside = F.arrays_zip(*[F.slice("_tokens", F.lit(k + 1), size).alias(f"t{k}") for k in range(OPENING)])
    near = [F.col(f"_near.t{k}") for k in range(OPENING)]
    places = (texts.select("_text", cut).select("_text", F.posexplode(beside).alias("at", "_near"))
              .select("_text", "at", F.explode(F.array(*[_opening(near[:k]) for k in range(1, OPENING + 1)])).alias("_opening"))
              .join(wanted, "_opening")
              .groupBy("_text").agg(F.collect_set(F.struct("at", "_lengths")).alias("_places")))

    def said(place: Column) -> Column:
        fits = F.filter(place["_lengths"], lambda k: place["at"] + k <= size)
        return F.transform(fits, lambda k: F.array_join(F.slice("_tokens", place["at"] + 1, k), " "))

    found = F.flatten(F.transform("_places", said))
    spoken = texts.join(places, "_text").select(*keep, cut, "_places").select(*keep, F.explode(found).alias("_said"))
    return spoken.join(terms, F.col("_said") == F.col("term")).select(
        *keep, F.col("term").alias("entity_text"), F.col("label").alias("entity_type"))


# ---- model seam -------------------------------------------------------------

def model_entities(df: DataFrame, text_col: str, model: Callable[[], Callable],
                   out_col: str = "entities") -> DataFrame:
    """Append ``out_col`` (array<struct<entity,type>>) using a Python model,
    one Arrow batch at a time. ``model`` makes the callable (it is called once
    per task); what it raises is raised."""
    from ..schemas import ENTITY_ARRAY
    schema = T.StructType(df.schema.fields + [T.StructField(out_col, ENTITY_ARRAY)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = model()
        for pdf in batches:
            res = fn(pdf[text_col].tolist())
            pdf[out_col] = [[{"entity": e, "type": t} for e, t in r] for r in res]
            yield pdf

    return df.mapInPandas(run, schema)
