"""Mixing sources to target weights: temperature mixing with budgeted block
permutations, in SQL functions.

The token share of each source is raised to an exponent and normalised. The
exponent is bisected to the flattest mixture that keeps a repetition limit
(no source is repeated more often than ``repetition_limit`` times the least
repeated one, or its own size if a budget is given), or to a target entropy.
Each source gets a budget of tokens: its weight times the mixture's. Without
``budget_tokens`` the mixture is as large as it must be for every document to
come at least once.

A budget is spent in epochs. A source is cut into blocks by the hash of the
document id; each epoch is a permutation of the blocks. Whole epochs take every
document; the last one takes blocks in its order while they fit, and of the
block that no longer fits, documents in a permutation of their own. Only blocks
are ordered within a source (at most ``MAX_BLOCKS``); no window holds a source.

Defined results: a null source counts as the empty source, a null text as
empty; documents without words cost nothing and come in every epoch their
block comes in (once, if the whole source has no words); repeated rows are
mixed each; an empty table gives an empty table; other columns are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, materialize

WORDS = r"[^\x20\x09-\x0D]+"
LEVELS = 40             # halvings of the exponent's range
PER_JOB = 4             # of which one job evaluates as many at once
BLOCK_TOKENS = 65_536
MAX_BLOCKS = 4096


@dataclass(frozen=True)
class Mixture:
    """Wanted mixture: a repetition limit or a target entropy (nats)."""
    repetition_limit: float | None = 2.0
    target_entropy: float | None = None
    budget_tokens: int | None = None
    seed: int = 17


def _hash60(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def _permuted(seed: int, *parts: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]).cast("binary"))


def source_totals(tokens: DataFrame) -> DataFrame:
    """``tokens``: columns src, n. Per source: total, share."""
    totals = materialize(tokens.groupBy("src").agg(F.sum("n").alias("total")), "sources")
    everything = totals.agg(F.sum("total")).first()[0] or 0
    return totals.withColumn("share", F.col("total") / F.lit(float(max(everything, 1)))), everything


def _flat_enough(shares: DataFrame, exponents: list[float], everything: int, mixture: Mixture
                 ) -> list[bool]:
    """For each exponent whether the mixture keeps its limit, in one pass."""
    columns = []
    p = F.col("share")
    for i, a in enumerate(exponents):
        power = F.pow(p, F.lit(a))
        if mixture.target_entropy is not None:
            # entropy of p**a / z: log z - a * sum(p**a * log p) / z
            columns.append((F.log(F.sum(power)) - F.lit(a) * F.sum(power * F.log(p)) / F.sum(power)
                            >= F.lit(float(mixture.target_entropy))).alias(f"c{i}"))
        elif mixture.budget_tokens is not None:
            columns.append((F.max(power / p) / F.sum(power) * F.lit(mixture.budget_tokens / everything)
                            <= F.lit(float(mixture.repetition_limit))).alias(f"c{i}"))
        else:
            columns.append((F.max(power / p) / F.min(power / p)
                            <= F.lit(float(mixture.repetition_limit))).alias(f"c{i}"))
    return [bool(x) for x in shares.where("share > 0").agg(*columns).first()]


def bisect_exponent(shares: DataFrame, everything: int, mixture: Mixture) -> float:
    """Smallest exponent in [0, 1] that keeps the repetition limit, or the
    largest that keeps the entropy. A few numbers a job reach the driver."""
    if not everything:
        return 1.0
    upward = mixture.target_entropy is None      # the limit is kept from some exponent on
    ends = _flat_enough(shares, [0.0, 1.0], everything, mixture)
    if upward and ends[0] or not upward and not ends[0]:
        return 0.0
    if upward and not ends[1] or not upward and ends[1]:
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(0, LEVELS, PER_JOB):
        step = (high - low) / 2 ** PER_JOB
        inner = [low + step * i for i in range(1, 2 ** PER_JOB)]
        kept = _flat_enough(shares, inner, everything, mixture)
        known = {low: not upward, **dict(zip(inner, kept)), high: upward}
        points = sorted(known)
        for _ in range(PER_JOB):     # halvings among the evaluated points
            middle = points[len(points) // 2]
            at = points.index(middle)
            points = points[:at + 1] if known[middle] == upward else points[at:]
        low, high = points[0], points[-1]
    return high if upward else low


def source_budgets(tokens: DataFrame, mixture: Mixture) -> DataFrame:
    """Per source: total, weight, whole epochs, rest of the last epoch, blocks."""
    shares, everything = source_totals(tokens)
    exponent = bisect_exponent(shares, everything, mixture)
    power = F.pow("share", F.lit(exponent))
    norm, least = shares.where("share > 0").agg(
        F.sum(power), F.min(power / F.col("share"))).first()
    norm, least = norm or 1.0, least or 1.0
    weight = F.when(F.col("share") > 0, power / F.lit(norm)).otherwise(F.lit(0.0))
    if mixture.budget_tokens is None:
        epochs = power / F.col("share") / F.lit(least)
    else:
        epochs = power / F.col("share") / F.lit(norm) * F.lit(mixture.budget_tokens / max(everything, 1))
    epochs = F.when(F.col("share") > 0, epochs).otherwise(F.lit(1.0))
    budget = F.floor(epochs * F.col("total") + F.lit(1e-6))
    whole = F.when(F.col("total") > 0, F.floor(budget / F.greatest("total", F.lit(1)))).otherwise(F.lit(1))
    return (shares.withColumn("weight", weight).withColumn("budget", budget).withColumn("whole", whole.cast("int"))
            .select("src", "total", "weight", "whole",
                    (F.col("budget") - F.col("whole") * F.col("total")).cast("bigint").alias("rest"),
                    F.least(F.greatest(F.ceil(F.col("total") / BLOCK_TOKENS), F.lit(1)),
                            F.lit(MAX_BLOCKS)).cast("bigint").alias("blocks")))


def mix(docs: DataFrame, mixture: Mixture = Mixture(), id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row for each time a document comes. Columns of ``docs`` and, under
    names that do not clash, the struct ``mix``: source, n_tokens, epoch,
    block, block_rank (place of the block in the epoch's permutation)."""
    out = fresh(docs, "mix")
    words = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORDS)).cast("bigint")
    src = F.coalesce(F.col(source_col).cast("string"), F.lit(""))
    held = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    base = docs.select(F.struct(src.alias("src"), words.alias("n"),
                                F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("key")).alias("k"),
                       held.alias("row"))
    tokens = materialize(base.select("k.src", "k.n", "k.key"), "tokens")
    budgets = materialize(source_budgets(tokens.select("src", "n"), mixture), "budgets")
    seed = mixture.seed

    def in_block(df: DataFrame, *keep: str) -> DataFrame:
        return (df.join(budgets.select("src", "whole", "rest", "blocks"), "src")
                .select("src", "n", "key", "whole", "rest",
                        F.pmod(_hash60(F.col("key")), "blocks").alias("block"), *keep))

    sizes = in_block(tokens).groupBy("src", "block", "whole", "rest").agg(F.sum("n").alias("size"))
    # Every epoch of every block: its place, and the tokens before it.
    turns = sizes.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("whole"))))
    order = Window.partitionBy("src", "epoch").orderBy(_permuted(seed, F.col("src"), F.col("epoch"), F.col("block")), "block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    turns = (turns.withColumn("place", F.row_number().over(order) - 1)
             .withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)))
             .withColumn("part", F.when(F.col("epoch") < F.col("whole"), F.lit("all"))
                         .when((F.col("start") + F.col("size") <= F.col("rest")) & (F.col("rest") > 0), F.lit("all"))
                         .when(F.col("start") < F.col("rest"), F.lit("some")))
             .where("part IS NOT NULL")
             .select("src", "block", F.struct("epoch", "place", "part",
                                              (F.col("rest") - F.col("start")).alias("room")).alias("turn")))
    turns = materialize(turns.groupBy("src", "block").agg(F.collect_list("turn").alias("turns")), "turns")
    rows = in_block(base.select("k.*", "row"), "row").join(turns, ["src", "block"])
    taken = rows.select("src", "n", "key", "block", "row", F.explode("turns").alias("turn"))
    inside = Window.partitionBy("src", "block").orderBy(
        _permuted(seed, F.col("turn.epoch"), F.col("key")), "key", "n").rowsBetween(Window.unboundedPreceding, 0)
    # At most one block of a source is taken in part; its documents are few.
    some = (taken.where("turn.part = 'some'").withColumn("upto", F.sum("n").over(inside))
            .where(F.col("upto") <= F.col("turn.room")).drop("upto"))
    every = taken.where("turn.part = 'all'").unionByName(some)
    return every.select("row.*", F.struct(
        F.col("src").alias("source"), F.col("n").alias("n_tokens"), F.col("turn.epoch").alias("epoch"),
        "block", F.col("turn.place").alias("block_rank")).alias(out))
