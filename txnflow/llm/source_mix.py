"""Mixing sources to target weights: documents taken so often that each source reaches its budget of words.

Sources in code-point order weigh 5, 2, 1 and so on, and share all words by
weight; no target is above three times its source's words, and what that leaves
is shared by the others. A source's target is so many whole rounds of all its
documents, and a rest. The rest is a subset sum over documents of one length
each, so that only their number for each exact length counts:

1. Documents are counted by (source, length).
2. Most of the rest is filled in proportion, length by length. A reserve of a few
   times the greatest length is left, and documents of every length with it.
3. A bounded knapsack over the remaining counts fits the reserve: sums reachable
   with one more length are found for all residues at once, and the length that
   reached a sum first leads back.
4. Of each length, the documents that come first by a seeded hash are taken.

A histogram has at most the root of twice its source's words as rows, so a task
takes one source's; documents themselves are never gathered by source.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txnflow.llm.common import column, fresh, prepare, ranked, written

#: Weights of sources in their order, from the first again after the last.
WEIGHTS = (5, 2, 1)
#: How often a document is taken at most.
MOST = 3
WORD = r"[^\x20\x09-\x0D]+"


def fitted(sizes: np.ndarray, counts: np.ndarray, budget: int, upper: bool = False) -> np.ndarray:
    """How many documents of each size to take, at most `counts`, so that their words are near `budget`.

    `sizes` are distinct, positive and ascending. Budgets within some times the greatest size of nothing or of all
    are met as nearly as can be; others leave documents of every length to the knapsack. Of two sums equally near
    the lower is taken, or the `upper`.
    """
    taken = np.zeros(len(sizes), np.int64)
    whole = int((sizes * counts).sum())
    if budget <= 0 or not whole:
        return taken
    if budget >= whole:
        return counts.copy()
    if 2 * budget > whole:  # what is left out is the smaller sum
        return counts - fitted(sizes, counts, whole - budget, not upper)
    longest = int(sizes[-1])
    share = max(0, budget - 4 * longest - 4096)
    left, words, spent = share, 0, 0
    for k in range(len(sizes) - 1, -1, -1):
        size, count = int(sizes[k]), int(counts[k])
        words += size * count
        left = share * words // whole - spent
        taken[k] = min(count, left // size)
        spent += int(taken[k]) * size
    return taken + _knapsack(sizes, counts - taken, budget - spent, longest, upper)


def _knapsack(sizes: np.ndarray, counts: np.ndarray, budget: int, beyond: int, upper: bool) -> np.ndarray:
    """As near to `budget` as can be, by dynamic programming over all sums up to `budget` + `beyond`."""
    room = budget + beyond + 1
    first = np.full(room, -1, np.int32)  # the length that reached a sum first
    first[0] = len(sizes)
    for k in range(len(sizes) - 1, -1, -1):
        size, count = int(sizes[k]), int(counts[k])
        if not count or size >= room:
            continue
        rows = -(-room // size)
        reached = np.zeros(rows * size, bool)
        reached[:room] = first >= 0
        reached = reached.reshape(rows, size)
        row = np.arange(rows, dtype=np.int32)[:, None]
        last = np.maximum.accumulate(np.where(reached, row, np.int32(-(1 << 30))), axis=0)
        more = (~reached & (row - last <= count)).ravel()[:room]
        first[more] = k
        if first[budget] >= 0:
            break
    sums = np.nonzero(first >= 0)[0]
    off = 2 * np.abs(sums - budget) - ((sums > budget) & upper)
    at = int(sums[np.argmin(off)])
    taken = np.zeros(len(sizes), np.int64)
    while at:
        k = int(first[at])
        taken[k] += 1
        at -= int(sizes[k])
    return taken


def _placed(sources: DataFrame) -> DataFrame:
    """`sources` with `place`, a source's rank from 0 in code-point order, null last."""
    order = [F.col("source").asc_nulls_last()]
    sliced = sources.repartitionByRange(*order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()
    sliced = written(sliced.withColumn("slice", F.shiftright(at, 33)).withColumn("row", at.bitwiseAND(F.lit((1 << 33) - 1))), "sources")
    sizes = sliced.groupBy("slice").agg(F.count(F.lit(1)).alias("rows"))
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)  # one row for each slice
    before = sizes.select("slice", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    return sliced.join(before, "slice").select("source", "source_size", (F.col("before") + F.col("row")).alias("place"))


def _targets(sources: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """`sources` with their targets: weight times a common level, but not above `most` times their size.

    The level rises until what the sources at their bound leave is shared by the others; each round is one sum.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    sources = written(_placed(sources).withColumn("weight", weight).withColumn("bound", F.col("source_size") * most), "targets")
    rest, shared, full = 0, 1, -1
    while True:
        above = F.col("bound") * F.lit(float(shared)) < F.col("weight") * F.lit(float(rest))
        if full < 0:
            above = F.lit(False)
        found = sources.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(above, F.col("bound"))).alias("given"),
            F.sum(F.when(~above, F.col("weight"))).alias("shared"),
            F.count(F.when(above, 1)).alias("full"),
        ).first()
        if found["full"] == full or not found["shared"]:
            level = F.col("weight") * F.lit(float(rest)) / F.lit(float(shared))
            return sources.withColumn("target", F.least(F.col("bound").cast("double"), level))
        rest, shared, full = int(found["all"]) - int(found["given"] or 0), int(found["shared"]), found["full"]


def _plan(histogram: DataFrame, most: int) -> DataFrame:
    """(place, size, rounds, extra, docs): how often all documents of a length are taken, and how many once more."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size")
        size, target = int(rows["source_size"].iloc[0]), float(rows["target"].iloc[0])
        rounds = min(most, int(target // size)) if size else 0
        budget = round(target - rounds * size) if rounds < most else 0
        words = rows["size"].to_numpy(np.int64) > 0
        extra = np.zeros(len(rows), np.int64)
        extra[words] = fitted(rows["size"].to_numpy(np.int64)[words], rows["docs"].to_numpy(np.int64)[words], budget)
        return rows[["place", "size", "docs"]].assign(rounds=rounds, extra=extra)

    return histogram.groupBy("place").applyInPandas(run, "place long, size long, docs long, rounds long, extra long")


def mix_sources(
    docs: DataFrame,
    keep: Sequence[str] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST,
    seed: int = 11,
) -> DataFrame:
    """Columns `keep` (default: all) of each row, and a struct `mix`: size, source_size, target, copies, taken.

    `size` is the words of the text, `target` the words its source is to give,
    `copies` how often the mix takes the row, `taken` the words of these copies.
    `repeated` gives the mix itself. Only columns in `keep` are written and
    shuffled; without the text a row is small.

    A null or empty text has no words and is taken as often as its source is in
    whole. A null source is the last one. A null doc_id is an id as any other.
    Repeated rows are rows of their own; which of rows equal in id, text and
    source is taken is open, and makes no difference to them. A source without
    words has target 0; an empty table gives an empty table. Columns may have
    any name or type; if one is called `mix`, the struct's name is longer.
    """
    prepare(docs.sparkSession)
    keep = list(docs.columns if keep is None else keep)
    own, words = column(source), F.coalesce(F.regexp_count(column(text), F.lit(WORD)), F.lit(0)).cast("long")
    order = F.xxhash64(F.lit(seed), column(doc_id), column(text), own)
    rows = F.struct(*map(column, keep)) if keep else F.struct(F.lit(0))
    sized = written(docs.select(rows.alias("row"), own.alias("source"), words.alias("size"), order.alias("order")), "sized")
    counts = written(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("docs")), "lengths")
    sources = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size"))
    sources = _targets(sources, weights, most).select(F.col("source").alias("of"), "place", "source_size", "target")
    histogram = counts.join(sources, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    plan = _plan(histogram.drop("source"), most).withColumnRenamed("size", "length")
    plan = written(plan.join(sources, "place"), "plan")
    found = sized.join(plan, F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("length")))
    some = (F.col("extra") > 0) & (F.col("extra") < F.col("docs"))
    picked = ranked(found.where(some), ["place", "size"], ["order"], "rank")
    picked = picked.withColumn("copies", F.col("rounds") + (F.col("rank") < F.col("extra")).cast("long")).drop("rank")
    whole = found.where(~some).withColumn("copies", F.col("rounds") + (F.col("extra") > 0).cast("long"))
    mixed = picked.unionByName(whole)
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixed.select(*(["row.*"] if keep else []), F.struct("size", "source_size", "target", "copies", taken).alias(fresh(keep, "mix")))


def repeated(mixed: DataFrame, mix: str = "mix") -> DataFrame:
    """The mix itself: each row of `mix_sources` as often as it is taken, without the struct."""
    times = fresh(mixed.columns, "time")
    copies = F.expr(f"explode(array_repeat(0, cast(`{mix}`.copies as int)))").alias(times)
    return mixed.select("*", copies).drop(mix, times)
