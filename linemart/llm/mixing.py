"""Mixing sources to target weights by temperature, in built-in functions only.

A source with a share p of all tokens gets a weight in proportion to p^a. The exponent a between 0 (all sources
alike) and 1 (shares as they are) is bisected: it is the smallest with which no source repeats more than
`max_repeats` times within the budget, or whose entropy is at most `target_entropy`. Repetition and entropy fall as a
rises, so bisection finds it; each round tries 31 points between the bounds, which is five halvings in one small job.

The weights are realised as block permutations: within its source each document has a place by a seeded hash, counted
in tokens; a source passes through its documents until its part of the budget is used, so each source has whole
passes and one that ends within; each pass of a source is spread evenly over all blocks, and a block's rows are
permuted by a second hash. A place is a sum over slices of a hash range, and slices of slices: no task gets a whole source.

Null sources are a source of their own. Null and empty texts have no tokens; they follow their source's passes. A
source without any token has no share of the mixture: each of its rows is there once, in a block by its hash. Rows that
repeat are placed one by one. Columns of docs that are named as those added here are left out; any other column passes
unchanged. An empty table gives an empty result. If no exponent from 0 to 1 meets the limits, that is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linemart.llm.shared import checkpointed, renamed, restored

ROUNDS, POINTS = 6, 32
ADDED = ["n_tokens", "epoch", "block", "slot"]
#: Slices that are summed together before their sums are.
TOGETHER = 1024


def token_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def order_key(seed: int, *parts: Column) -> Column:
    """A pseudo-random order of rows: the MD5 of seed and parts."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"))


def exponent(sources: DataFrame, budget: int, max_repeats: float | None, target_entropy: float | None) -> float:
    """The smallest acceptable exponent for sources (source, tokens), to 2^-30; an error if not even 1 is."""
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    if not total:
        return 1.0
    share = sources.filter("tokens > 0").select((F.col("tokens") / F.lit(float(total))).alias("p"), "tokens")

    def lowest(low: float, step: float, first: int, last: int) -> int | None:
        """The least k with which low + k * step meets all limits."""
        tried = share.withColumn("k", F.explode(F.sequence(F.lit(first), F.lit(last)))).withColumn("a", F.lit(low) + F.col("k") * F.lit(step))
        sums = tried.withColumn("u", F.pow("p", "a")).groupBy("k").agg(
            F.sum("u").alias("z"), F.sum(F.col("u") * F.log("u")).alias("ulogu"), F.max(F.col("u") / F.col("tokens")).alias("most")
        )
        ok = F.lit(True)
        if max_repeats is not None:
            ok = ok & (F.col("most") / F.col("z") * F.lit(float(budget)) <= F.lit(float(max_repeats)))
        if target_entropy is not None:
            ok = ok & (F.log("z") - F.col("ulogu") / F.col("z") <= F.lit(float(target_entropy)))
        return sums.filter(ok).agg(F.min("k")).first()[0]

    if lowest(1.0, 0.0, 0, 0) is None:
        raise ValueError(f"no exponent up to 1 keeps repeats within {max_repeats} and entropy within {target_entropy} for a budget of {budget} of {total} tokens")
    low, high = 0.0, 1.0
    for k in range(ROUNDS):
        step = (high - low) / POINTS
        best = lowest(low, step, 0 if k == 0 else 1, POINTS - 1)
        if best == 0:
            return low
        best = POINTS if best is None else best
        low, high = low + (best - 1) * step, low + best * step
    return high


def weights(sources: DataFrame, a: float, budget: int) -> DataFrame:
    """sources (source, tokens) with weight and quota (tokens of the budget)."""
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    raised = sources.withColumn("u", F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(float(max(total, 1))), F.lit(a))).otherwise(0.0))
    z = raised.agg(F.sum("u")).first()[0] or 1.0
    return raised.withColumn("weight", F.col("u") / F.lit(z)).withColumn("quota", F.floor(F.col("weight") * F.lit(float(budget)))).drop("u")


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", budget: int | None = None,
    max_repeats: float | None = 1.25, target_entropy: float | None = None, block_tokens: int = 1 << 20, slice_rows: int = 256, seed: int = 7,
) -> DataFrame:
    """docs, each row as often as the mixture takes it, with n_tokens, epoch, block and slot; the order is (block, slot).

    The budget is all tokens of docs unless given.
    """
    n = docs.count()
    slices = max(1, -(-n // slice_rows))
    own, name = renamed(docs.drop(*ADDED))
    digest = F.md5(F.coalesce(F.col(name[text_col]).cast("string"), F.lit("")).cast("binary"))
    measured = (
        own.withColumn("source", F.col(name[source_col])).withColumn("n_tokens", token_count(F.col(name[text_col]))).withColumn("key", order_key(seed, F.col(name[id_col]), digest))
        .withColumn("spread", F.conv(F.substring("key", 1, 12), 16, 10).cast("long")).withColumn("slice", F.pmod("spread", F.lit(slices)))
    )
    parts = checkpointed(measured.groupBy("source", "slice").agg(F.sum("n_tokens").alias("tokens")).withColumn("group", F.floor(F.col("slice") / TOGETHER)))
    sources = checkpointed(parts.groupBy("source").agg(F.sum("tokens").alias("tokens")))
    budget = (sources.agg(F.sum("tokens")).first()[0] or 0) if budget is None else budget
    quotas = weights(sources, exponent(sources, budget, max_repeats, target_entropy), budget)
    before = lambda keys, order: Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sum_before = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    groups = parts.groupBy("source", "group").agg(F.sum("tokens").alias("tokens")).select("source", "group", sum_before("tokens", before(["source"], ["group"])).alias("base"))
    inner = parts.withColumn("inner", sum_before("tokens", before(["source", "group"], ["slice"]))).alias("p")
    offsets = inner.join(groups.alias("g"), F.col("p.source").eqNullSafe(F.col("g.source")) & (F.col("p.group") == F.col("g.group"))).select(
        F.col("p.source").alias("source"), "slice", (F.col("inner") + F.col("base")).alias("offset")
    )
    known = quotas.select(
        F.col("source").alias("s"), F.col("tokens").alias("all"), "quota",
        F.when(F.col("tokens") > 0, F.floor(F.col("quota") / F.col("tokens"))).otherwise(1).alias("passes"),
    )
    offsets = offsets.join(known, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumnsRenamed({"source": "s", "slice": "l"})
    placed = measured.join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("slice") == F.col("l")))
    at = placed.withColumn("at", F.col("offset") + sum_before("n_tokens", before(["source", "slice"], ["key", "n_tokens"])))
    times = F.col("passes") + F.when(F.col("at") < F.col("quota") - F.col("passes") * F.col("all"), 1).otherwise(0)
    copies = at.withColumn("times", times).filter("times > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("times").cast("int") - 1)))
    blocks = max(1, -(-budget // block_tokens))
    spot = (F.col("epoch") * F.col("all") + F.col("at")) * F.lit(blocks) / F.greatest("quota", F.lit(1))
    block = F.when(F.col("all") == 0, F.pmod("spread", F.lit(blocks))).otherwise(F.least(F.floor(spot), F.lit(blocks - 1))).cast("long")
    blocked = copies.withColumn("block", block).withColumn("mixed", order_key(seed + 1, F.col("key"), F.col("epoch")))
    slots = Window.partitionBy("block").orderBy("mixed", "key")
    return blocked.withColumn("slot", F.row_number().over(slots)).select(*restored(name), *ADDED)
