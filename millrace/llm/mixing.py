"""Mixing sources to token targets: entropy balancing by Newton's method, then copies."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import renamed, whole
from millrace.llm.ranks import ranked
from millrace.staging import stage

#: Weights of the sources in order, repeating.
WEIGHTS = (3, 1, 2)
#: Newton's method ends when no constraint is off by more than this share of its target.
TOLERANCE = 1e-12
MOST_STEPS = 100

#: A word is a run of other bytes than these.
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``sources`` (source, source_size) with target: ``share`` of all sizes, dealt by weight
    in the order of the sources, null last. No target is above ``most`` times its source's
    size; the excess goes to the others by weight, round by round until none is above."""
    order = ranked(sources, F.col("source").isNull(), F.col("source"), name="place")
    table = F.array(*[F.lit(float(w)) for w in weights])
    held = stage(
        order.withColumn("weight", F.element_at(table, (F.pmod("place", F.lit(len(weights))) + 1).cast("int")))
        .withColumn("most", most * F.col("source_size")),
        "sources",
    )
    budget = share * float(held.agg(F.sum("source_size")).first()[0] or 0)
    # A source is held at its most when its weight's share would exceed that. Each round
    # is three sums; the level can only rise, so rounds end.
    level = 0.0
    while True:
        full = F.col("most") <= F.col("weight") * level
        taken, free, number = held.agg(
            F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
            F.count(F.when(~full, 1)),
        ).first()
        after = (budget - taken) / free if number else level
        if after <= level:
            break
        level = after
    return held.select("source", "source_size", F.least("most", F.col("weight") * level).alias("target"))


def balance(constraints: DataFrame, steps: int = MOST_STEPS) -> DataFrame:
    """``constraints`` (source, source_size, target) with dual, the multiplier whose
    exponential is the rate of the source's documents.

    Of all rates that meet the token targets, these diverge least from taking every token
    once (in relative entropy over tokens). The dual is convex: the sum of size *
    exp(dual) - target * dual. Its gradient and curvature are sums over sources'
    tokens, one Newton step is one pass over the distributed constraints, and only the
    largest relative gap comes to the driver. A source without tokens keeps a rate of 1.
    """
    some = F.col("source_size") > 0
    state = constraints.withColumn("dual", F.lit(0.0))
    for step in range(steps):
        held = F.col("source_size") * F.exp("dual")
        gradient = held - F.col("target")
        # The first steps towards small targets are long ones back: a step is at most 1.
        move = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), -gradient / held))
        state = stage(state.withColumn("dual", F.when(some, F.col("dual") + move).otherwise(F.lit(0.0))), f"newton-{step}")
        gap = state.where(some).agg(
            F.max(F.abs(F.col("source_size") * F.exp("dual") - F.col("target")) / F.greatest("target", F.lit(1e-300)))
        ).first()[0]
        if gap is None or math.isnan(gap) or gap <= TOLERANCE:
            break
    return state


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.5,
    most: float = 2.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """(id, size, source_size, target, rate, copies, taken) for every row; docs' other
    columns are not needed and may be called anything.

    A document's rate is rounded down or up to copies by systematic sampling: its source's
    documents stand in the order of size, then of a hash, and a copy more falls on each
    whole number that the running sum of the rates' fractions passes. So what a source takes
    misses its target by less than its largest document, and reruns agree. Null texts have
    size 0; null sources are one source, last; repeated rows are rows of their own.
    """
    rows = renamed(docs, id=id_col, text=text_col, source=source_col).select(
        "id", "source", F.regexp_count(whole("text"), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(F.col("id").cast("string"), "text").alias("tie"),
    )
    order = [F.col("source").isNull(), F.col("source"), F.col("size"), F.col("tie"), F.col("id")]
    # Ranks run through the sources one after another; each has its own first.
    placed = ranked(rows, *order)
    totals = placed.groupBy("source").agg(F.sum("size").alias("source_size"), F.min("rank").alias("first"))
    totals = stage(totals, "source-sizes")
    rates = balance(source_targets(totals.select("source", "source_size"), weights, share, most))
    rates = rates.withColumn("rate", F.least(F.exp("dual"), F.lit(float(most))))
    rates = rates.join(totals.select(F.col("source").alias("of"), "first"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    rates = stage(rates, "source-rates").withColumnRenamed("source", "of")
    fraction = F.col("rate") - F.floor("rate")
    place = F.col("rank") - F.col("first")
    # The first copy more falls on the middle of the first stretch that is worth one.
    more = F.floor((place + 1) * fraction + 0.5) - F.floor(place * fraction + 0.5)
    return (
        placed.join(rates, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("copies", F.least(F.floor("rate") + more, F.lit(int(most))).cast("int"))
        .select(
            F.col("id").alias(id_col), "size", "source_size", "target", "rate", "copies",
            (F.col("size") * F.col("copies")).alias("taken"),
        )
    )
