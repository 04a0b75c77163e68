"""Mixing sources to target weights, by hash thresholds.

Method: hash-threshold histograms, DataFrame functions only.  A source's target is
met by whole rounds over all its documents plus a budget of words from the
documents whose hash lies under a threshold.  The threshold is found by
nested histograms: words are summed by source and the first bits of the hash,
the bucket in which the running sum passes the budget is the boundary, and
only the boundary bucket's documents are summed again by the next bits, until
the bits are used up.  Documents are then filtered by comparison with the
threshold; nothing is sorted and no document list is gathered.  A histogram
has at most sources x 2**BITS rows whatever the number of documents, and
its partial sums are taken before the shuffle, so a hot source is no hot task.

Sizes are words ``[^\\x20\\x09-\\x0D]+``.  Sources by code point, null last, weigh
3, 1, 2, repeating; together they share ``SHARE`` of all words; a target
stops at ``MOST`` times its source's words and the excess is shared again by
weight (water filling, solved by one ordered window over the sources).

Defined results: a null text has size 0; a null doc_id is left out; rows that
repeat a doc_id share its hash and are taken together or not; sources without
words have target 0; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.llm.common import documents, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BITS = 15
LEVELS = 4
WORD = r"[^\x20\x09-\x0D]+"


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source) of every document."""
    sized, cut = plan_mix(docs, weights, share, most)
    return sized.join(cut, "key").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * times()).alias("taken"), "source")


def mixed(docs: DataFrame, carry: tuple[str, ...] = (), weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
          most: int = MOST) -> DataFrame:
    """(doc_id, text, source, *carry): the rows of the mix, each as often as the mix takes it."""
    _, cut = plan_mix(docs, weights, share, most)
    rows = keyed(documents(docs, "source", *carry)).join(cut, "key")
    again = F.explode(F.array_repeat(F.lit(0), times().cast("int")))
    return rows.withColumn("h", again).select("doc_id", "text", "source", *carry)


def times():
    """How often a document is taken: whole rounds, and once more under the threshold."""
    return F.col("rounds") + (F.col("h") < F.col("threshold")).cast("long")


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the 60 bits that decide, in any engine the first digits of md5,
    and a source key that is never null."""
    return docs.withColumns({
        "h": F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 15), 16, 10).cast("long"),
        "key": F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))})


def plan_mix(docs: DataFrame, weights: tuple[int, ...], share: float, most: int) -> tuple[DataFrame, DataFrame]:
    """(every document's size, hash and key; every source's target, rounds and threshold)."""
    sized = keyed(documents(docs, "source")).select(
        "doc_id", F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), "h", "key")
    sized = written(sized, "mix-sizes")
    plan = written(targets(sized, weights, share, most), "mix-targets")
    return sized, written(thresholds(sized, plan), "mix-thresholds")


def targets(sized: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """(key, source_size, target, rounds, budget): one row a source."""
    per = sized.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    # By rising cap for each unit of weight, the first sources are full.  For the
    # others the level is what is left of the total over their weight; it rises
    # up to the first source that is not full and falls after it.
    order = Window.orderBy(F.col("cap") / F.col("weight"), "key")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everywhere = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = share * F.sum("source_size").over(everywhere) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    per = per.withColumn("level", left / F.sum("weight").over(after))
    fits = F.col("cap") >= F.col("level") * F.col("weight")
    per = per.withColumn("water", F.max(F.when(fits, F.col("level"))).over(everywhere))
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("water") * F.col("weight"), F.col("cap").cast("double")))
    per = per.withColumn("target", target)
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    return per.withColumn("rounds", rounds).select(
        "key", "source_size", "target", "rounds", (F.col("target") - F.col("rounds") * F.col("source_size")).alias("budget"))


def thresholds(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """``plan`` with the hash under which a source's documents are taken once more."""
    state = plan.select("*", F.lit(0).cast("long").alias("threshold"), F.col("budget").alias("left"))
    for level in range(LEVELS):
        step = 1 << BITS * (LEVELS - 1 - level)
        inside = sized if level == 0 else sized.join(state.select("key", "threshold"), "key") \
            .filter((F.col("h") >= F.col("threshold")) & (F.col("h") < F.col("threshold") + step * (1 << BITS))) \
            .drop("threshold")
        buckets = inside.groupBy("key", F.expr(f"h div {step}").alias("bucket")).agg(F.sum("size").alias("words"))
        running = F.sum("words").over(Window.partitionBy("key").orderBy("bucket"))
        budget = state.select("key", F.col("left").alias("budget"))
        buckets = buckets.withColumn("upto", running).join(budget, "key")
        # The boundary is the first bucket that passes the budget; at the last
        # level it is taken whole if that comes nearer.
        over = F.col("upto") > F.col("budget")
        if level == LEVELS - 1:
            over = F.col("upto") - F.col("budget") > F.col("budget") - (F.col("upto") - F.col("words"))
        edge = buckets.groupBy("key").agg(
            F.min(F.when(over, F.col("bucket"))).alias("edge"), F.max("bucket").alias("top"),
            F.max(F.when(~over, F.col("upto"))).alias("below"))
        state = state.join(edge, "key", "left") \
            .withColumn("left", F.col("left") - F.coalesce("below", F.lit(0))) \
            .withColumn("threshold", F.coalesce(F.col("edge"), F.col("top") + 1, F.lit(0)) * step).drop("edge", "top", "below")
        state = written(state, "mix-level")
    return state.select("key", "source_size", "target", "rounds", "threshold")
