"""Exact duplicates by recipes of content-defined chunks, in SQL functions.

Each normalised text is cut where its content says so: a chunk ends after at
least ``MIN_CHUNK`` characters at the first place that the cut rule names, or
after ``MAX_CHUNK``. Equal stretches of text give equal chunks wherever they
stand. A chunk gets a 64-bit identifier, verified over the whole chunk table:
one identifier must belong to one SHA-256 and one length. Documents are then
compared by their ordered identifier lists; texts are read once and never
shuffled.

Defined results: a null text counts as empty, empty texts are equal to one
another; white space is normalised, nothing else; the smallest id stays (a
null id counts as larger than any other; if a group has only null ids, all of
its rows stay); repeated rows with the id that stays are all marked kept; an
empty table gives an empty table; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

MIN_CHUNK, MAX_CHUNK = 128, 4096
# Cut rule: where certain letters end one word and begin the next, about once in
# 300 characters of prose. It looks at the text alone, never at offsets, and is
# rare against MIN_CHUNK, so that cuts fall in step again soon after a change.
CUT = r"(?<=[a-eA-E][n-sN-S][a-hA-H][ .,;][a-mA-M])"
WHITE = r"[\x20\x09-\x0D]+"


def normalized(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def chunks(text: Column, shortest: int = MIN_CHUNK, longest: int = MAX_CHUNK) -> Column:
    """The content-defined chunks of a text, in order (an empty text: none)."""
    rule = rf"(?s).{{{shortest},{longest}}}?{CUT}|.{{1,{longest}}}"
    return F.regexp_extract_all(text, F.lit(rule), F.lit(0))


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: digest of the whole text and the ordered parts
    (identifier, SHA-256, length)."""
    part = lambda c: F.struct(
        F.xxhash64(c).alias("id"), F.unhex(F.sha2(c, 256)).alias("sha"),
        F.length(c).alias("len"))
    return (docs.select(F.col(id_col).alias("doc"), normalized(F.col(text_col)).alias("norm"))
            .select("doc", F.sha2("norm", 256).alias("text_sha256"),
                    F.transform(chunks(F.col("norm")), part).alias("parts")))


def unverified(recipe_table: DataFrame) -> DataFrame:
    """Identifiers that belong to more than one chunk content."""
    return (recipe_table.select(F.explode("parts").alias("p")).select("p.*")
            .groupBy("id").agg(F.min("sha").alias("a"), F.max("sha").alias("b"),
                               F.min("len").alias("c"), F.max("len").alias("d"))
            .where("a <> b OR c <> d").select("id"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``keep_id``, ``group_size``, ``kept``,
    ``text_sha256``, ``n_chunks``."""
    table = materialize(recipes(docs, id_col, text_col), "recipes")
    # A 64-bit identifier that fails verification is replaced, with all others,
    # by the SHA-256 of its chunk: slower, but as exact.
    field = "id" if unverified(table).isEmpty() else "sha"
    listed = table.select("doc", "text_sha256", F.col(f"parts.{field}").alias("recipe"),
                          F.size("parts").alias("n_chunks"))
    groups = (listed.groupBy("recipe")
              .agg(F.min("doc").alias("keep"), F.count(F.lit(1)).alias("n"))
              .where("n > 1"))
    # Written, so that the join sees two plain shuffles and can split a hot group.
    groups = materialize(groups, "groups")
    keep = F.when(F.col("n").isNull(), F.col("doc")).otherwise(F.col("keep"))
    return (listed.join(groups, "recipe", "left")
            .select(F.col("doc").alias(id_col), keep.alias("keep_id"),
                    F.coalesce("n", F.lit(1).cast("bigint")).alias("group_size"),
                    F.col("doc").eqNullSafe(keep).alias("kept"), "text_sha256",
                    F.col("n_chunks").cast("bigint").alias("n_chunks")))
