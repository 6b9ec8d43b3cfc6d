"""Mixing sources to target weights by entropy balancing.

The copies of a document have a binomial base measure over 0 to ``cap``. Among all measures that meet a source's token
target, the one closest to it in entropy tilts the odds by exp(multiplier * size / mean size of the source), and the
mean number of copies, the document's rate, is cap / (1 + exp(-tilt)). The multipliers are the solution of the convex
dual. Newton steps find them: every step is one distributed sum over the histogram of sizes per source, exact in
decimals, so that reruns agree to the last bit. Rates are rounded into copies in blocks of bounded size, large documents
first, each document making good what the ones before it left over.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetlens.llm.text import stored, word_count

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
CAP = 2
BLOCK_ROWS = 4_000
MAX_STEPS = 60
TOLERANCE = 0.5


def source_targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                   cap: int = CAP) -> DataFrame:
    """(rank, source, rows, source_size, target) from (source, rows, source_size).

    Sources in order of code point, null last, take the weights in turn and share ``share`` times all sizes. A target
    stops at ``cap`` times the source's size; what is above goes to the others by weight until none is above. That is
    one level per unit of weight; the level rises from round to round, each of which needs two sums.
    """
    ranked = stored(sources.select(
        "*", (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1).alias("rank"),
    ).withColumns({
        "weight": F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")),
        "most": (F.col("source_size") * cap).cast("double"),
    }), "mix-sources")
    total = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, before = 0.0, -1.0
    full = lambda at: F.col("most") <= F.lit(at) * F.col("weight")
    while level > before:
        before = level
        spent, free = ranked.agg(
            F.sum(F.when(full(level), F.col("most")).otherwise(0.0)),
            F.sum(F.when(~full(level), F.col("weight")).otherwise(0.0))).first()
        level = (total - (spent or 0.0)) / free if free else level
    target = F.when(full(level), F.col("most")).otherwise(F.lit(level) * F.col("weight"))
    return ranked.select("rank", "source", "rows", "source_size", target.alias("target"), "most")


def solve_tilts(histogram: DataFrame, targets: DataFrame, cap: int = CAP) -> DataFrame:
    """``targets`` with the multiplier of each source, by Newton steps kept inside a bracket.

    ``histogram`` has (rank, size, n). A source whose target is its cap has a null multiplier and the rate ``cap``.
    """
    mean = F.greatest(F.col("source_size") / F.col("rows"), F.lit(1e-9))
    state = targets.withColumns({
        "mean": mean, "tilt": F.when((F.col("target") < F.col("most")) & (F.col("target") > 0), F.lit(0.0)),
        "low": F.lit(-1e9), "high": F.lit(1e9),
    })
    for _ in range(MAX_STEPS):
        z = F.col("size") / F.col("mean")
        p = 1.0 / (1.0 + F.exp(-F.col("tilt") * z))
        words = F.col("n") * F.col("size") * float(cap) * p
        sums = histogram.join(state.where("tilt IS NOT NULL").select("rank", "mean", "tilt"), "rank").groupBy("rank").agg(
            F.sum(words.cast("decimal(38,9)")).cast("double").alias("got"),
            F.sum((words * z * (1.0 - p)).cast("decimal(38,9)")).cast("double").alias("slope"))
        gap = F.col("got") - F.col("target")
        low = F.when(gap <= 0, F.greatest("low", "tilt")).otherwise(F.col("low"))
        high = F.when(gap >= 0, F.least("high", "tilt")).otherwise(F.col("high"))
        reach = F.greatest(F.lit(1.0), F.abs("tilt"))
        newton = F.col("tilt") - F.greatest(-reach, F.least(reach, gap / F.greatest("slope", F.lit(1e-300))))
        inside = (newton > low) & (newton < high)
        step = F.when(F.abs(gap) <= TOLERANCE, F.col("tilt")).when(inside, newton).otherwise((low + high) / 2)
        state = stored(state.join(sums, "rank", "left").select(
            "rank", "source", "rows", "source_size", "target", "most", "mean",
            F.when(F.col("got").isNotNull(), step).otherwise(F.col("tilt")).alias("tilt"),
            F.coalesce(low, "low").alias("low"), F.coalesce(high, "high").alias("high"), gap.alias("gap")), "mix-step")
        worst = state.agg(F.max(F.abs("gap"))).first()[0]
        state = state.drop("gap")
        if worst is None or worst <= TOLERANCE:
            break
    return state


def round_block(rows: pd.DataFrame, cap: int = CAP) -> pd.DataFrame:
    """Copies of the documents of one block: large ones first, each with what is left over so far."""
    rows = rows.sort_values(["size", "doc_id"], ascending=[False, True], kind="stable")
    copies, owed = np.zeros(len(rows), dtype=np.int64), 0.0
    for at, (size, rate) in enumerate(zip(rows["size"].tolist(), rows["rate"].tolist())):
        if size == 0:
            copies[at] = round(rate)
            continue
        owed += rate * size
        copies[at] = min(cap, max(0, int(owed / size + 0.5)))
        owed -= float(copies[at] * size)
    return rows.assign(copies=copies)[["doc_id", "size", "source_size", "target", "rate", "copies"]]


def mix_sources(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: int = CAP,
                block_rows: int = BLOCK_ROWS, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source") -> DataFrame:
    """(doc_id, size, source_size, target, rate, copies, taken), one row per document.

    A size is a number of words; null text has none. Null is a source of its own, after the others. A source without
    words has target 0. A source with a third of all rows is split into blocks like any other; the row tables are
    narrow and one row per source is all that is ordered as a whole. Equal rows are told apart only by who comes
    first. An empty table gives an empty result.
    """
    sizes = stored(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size")), "mix-sizes")
    counted = stored(sizes.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-histogram")
    sources = counted.groupBy("source").agg(
        F.sum("n").alias("rows"), F.sum(F.col("n") * F.col("size")).alias("source_size"))
    targets = source_targets(sources, weights, share, cap)
    ranks = targets.select("rank", "source")
    histogram = stored(
        counted.alias("c").join(ranks.alias("r"), F.col("c.source").eqNullSafe(F.col("r.source")))
        .select("rank", "size", "n"), "mix-ranked")
    tilts = solve_tilts(histogram, targets, cap)
    rate = F.when(F.col("tilt").isNotNull(), float(cap) / (1.0 + F.exp(-F.col("tilt") * F.col("size") / F.col("mean")))) \
        .when(F.col("target") > 0, F.lit(float(cap))).otherwise(F.lit(0.0))
    blocks = F.ceil(F.col("rows") / F.lit(block_rows))
    rated = sizes.alias("d").join(tilts.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source"))).select(
        "doc_id", "size", "source_size", "target", rate.alias("rate"), "rank",
        F.pmod(F.xxhash64("doc_id", "size"), blocks).alias("block"))
    rounded = rated.groupBy("rank", "block").applyInPandas(
        lambda rows: round_block(rows, cap),
        "doc_id long, size long, source_size long, target double, rate double, copies long")
    return rounded.withColumn("taken", F.col("copies") * F.col("size"))
