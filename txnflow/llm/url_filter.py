"""URL filters: rules first, and a character language-model ratio where no rule fits.

URLs that rules accept and reject train one Markov model each, of variable
order: the distribution of a context that was seen is interpolated with that of
the shorter one (Witten-Bell). A URL passes if the difference of the two
log-likelihoods, per byte, reaches a threshold calibrated on URLs that were held
back from training.

The models are tables of all n-grams seen, however many. They are joined, one
length of context after the other, to the distinct windows of bytes that the
URLs hold, which gives what each window adds to the difference. The most frequent
windows, a bounded number, are broadcast to the URLs, the others joined to them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnflow.llm.common import Counts, column, fresh, gram_keys, least_of_most, map_texts, prepare, signed, written

#: Bytes of a context and the byte after it.
WIDTH = 6
PAD, END = 0, b"\x03"
#: Windows, at most, whose gains are broadcast, at 16 bytes each.
BROADCAST_WINDOWS = 1 << 19
#: One in so many labelled URLs calibrates the threshold instead of training.
HELD_BACK = 5
#: Steps of the calibrated threshold, per natural-log unit.
STEPS = 200
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the production query.
RULES = (
    UrlRule("allow", "org", "/"),
    UrlRule("block", "example.org", "/es/"),
    UrlRule("block", "example.org", "/en/1"),
    UrlRule("allow", "com", "/fr/"),
    UrlRule("block", "com", "/de/"),
)


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty where there is none."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    start = F.instr(url, "://")
    return F.when(start > 0, F.substring(url, start + 3, F.length(url)))


def rule_of(host: Column, path: Column, rules: tuple[UrlRule, ...], value) -> Column:
    """`value` of the longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(value(rule))).otherwise(found)
    return found


def _gram_counts(urls: DataFrame, label: str, address: str) -> DataFrame:
    """Counts (label, key, n) of all windows of `WIDTH` bytes, summed in each task before the shuffle."""
    prepare(urls.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counts] = {}
        for batch in batches:
            by_label: dict[str, list[bytes]] = {}
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_label.setdefault(name, []).append(value.encode() + END)
            for name, texts in by_label.items():
                own = counts.setdefault(name, Counts())
                own.add(gram_keys(texts, WIDTH, PAD))
                if own.full():
                    yield _rows(name, *own.take())
        for name, own in counts.items():
            yield _rows(name, *own.take())

    def _rows(name, keys, n):
        return pa.RecordBatch.from_arrays([pa.array([name] * len(keys), pa.string()), pa.array(signed(keys)), pa.array(n)], names=["label", "key", "n"])

    grams = urls.select(F.col(label).alias("label"), F.col(address).alias("address")).mapInArrow(run, "label string, key long, n long")
    return grams.groupBy("label", "key").agg(F.sum("n").alias("n"))


def _mask(size: int) -> Column:
    return F.lit((1 << 8 * (size + 1)) - 1).cast("long")


def gains_of(grams: DataFrame, windows: DataFrame) -> DataFrame:
    """(key, n, allow, block, gain) of `windows` (key, n): the natural log-probabilities of the last byte of each window
    after the bytes before it, in the models of both labels, and their difference.

    `grams` are the training counts (label, key, n). A context that a label has
    not seen leaves the distribution of the shorter one; before all stands an
    even one.
    """
    labels = ("allow", "block")
    pairs = grams.groupBy(F.col("key").alias("pair")).agg(*(F.sum(F.when(F.col("label") == x, F.col("n")).otherwise(0)).alias(x) for x in labels))
    seen = windows.select(F.col("key").alias("pair"))
    tables = []  # counts of pairs, and the pairs asked for, from the longest context to none
    for size in range(WIDTH - 1, -1, -1):
        shorter = F.col("pair").bitwiseAND(_mask(size)).alias("pair")
        pairs = written(pairs.groupBy(shorter).agg(*(F.sum(x).alias(x) for x in labels)), "pairs")
        seen = written(seen.select(shorter).distinct(), "windows")
        tables.append((pairs, seen))
    known = None
    for size, (pairs, seen) in enumerate(reversed(tables)):
        context = F.shiftright("pair", 8).alias("context")
        about = pairs.groupBy(context).agg(
            *(F.sum(x).alias(f"{x}_total") for x in labels), *(F.count_if(F.col(x) > 0).alias(f"{x}_kinds") for x in labels)
        )
        own = seen.withColumn("context", F.shiftright("pair", 8)).join(pairs, "pair", "left").join(about, "context", "left")
        if known is None:
            own = own.withColumns({f"{x}_below": F.lit(1 / 256) for x in labels})
        else:
            below = known.select(F.col("pair").alias("rest"), *(F.col(f"p_{x}").alias(f"{x}_below") for x in labels))
            own = own.withColumn("rest", F.col("pair").bitwiseAND(_mask(size - 1))).join(below, "rest")
        chances = []
        for x in labels:
            total, kinds, low = (F.col(f"{x}_{c}") for c in ("total", "kinds", "below"))
            chance = (F.coalesce(x, F.lit(0)) + kinds * low) / (total + kinds)
            chances.append(F.when(total > 0, chance).otherwise(low).alias(f"p_{x}"))
        known = written(own.select("pair", *chances), "chances")
    found = windows.join(known.withColumnRenamed("pair", "key"), "key")
    allow, block = F.log("p_allow"), F.log("p_block")
    return written(found.select("key", "n", allow.alias("allow"), block.alias("block"), (allow - block).alias("gain")), "gains")


def _sums(texts: list[str | None], names: np.ndarray, values: np.ndarray) -> tuple[list, list, list, list]:
    """For each text the sum of the gains of its windows in `names`, its bytes, and its other windows with their counts."""
    if not texts:
        return [], [], [], []
    raw = [(t or "").encode() + END for t in texts]
    keys = gram_keys(raw, WIDTH, PAD)
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    at = np.minimum(np.searchsorted(names, keys), max(0, len(names) - 1))
    known = names[at] == keys if len(names) else np.zeros(len(keys), bool)
    gain = np.where(known, values[at], 0.0) if len(names) else np.zeros(len(keys))
    others = [np.unique(keys[a : a + n][~known[a : a + n]], return_counts=True) for a, n in zip(starts, sizes)]
    return np.add.reduceat(gain, starts).tolist(), sizes.tolist(), [signed(k) for k, _ in others], [n for _, n in others]


def _scored(frame: DataFrame, text: str, keep: list[str], name: str, gains: DataFrame) -> DataFrame:
    """Columns `keep`, and in `name` the log-likelihood difference of the text, per byte."""
    often = F.col("n") >= least_of_most(gains, BROADCAST_WINDOWS)
    few = gains.where(often).select("key", "gain").toArrow()
    keys = few.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    shared = frame.sparkSession.sparkContext.broadcast((keys[order], few.column("gain").to_numpy()[order]))
    rest = gains.where(~often).select("key", "gain")
    total, size, codes, times, row = (fresh([*keep, name], n) for n in ("total", "size", "codes", "times", "row"))
    outputs = {total: "double", size: "long", codes: "longs", times: "ints"}
    scored = map_texts(frame, text, keep, outputs, lambda: lambda texts: _sums(texts, *shared.value))
    if rest.isEmpty():
        return scored.select(*map(column, keep), (F.col(total) / F.col(size)).alias(name))
    scored = written(scored.withColumn(row, F.monotonically_increasing_id()), "scored")
    each = scored.select(F.col(row).alias("row"), F.explode(F.arrays_zip(F.col(codes).alias("key"), F.col(times).alias("times"))).alias("w"))
    sums = each.select("row", "w.key", "w.times").join(rest, "key").groupBy("row").agg(F.sum(F.col("times") * F.col("gain")).alias("more"))
    sums = sums.select(F.col("row").alias(f"{row}_"), F.col("more").alias(f"{total}_"))
    whole = scored.join(sums, F.col(row) == F.col(f"{row}_"), "left")
    return whole.select(*map(column, keep), ((F.col(total) + F.coalesce(f"{total}_", F.lit(0.0))) / F.col(size)).alias(name))


def calibrate(scored: DataFrame, label: str, ratio: str) -> float:
    """The threshold with the best mean of both labels' rates of right verdicts; ties go to the one nearest to 0."""
    step = F.round(F.greatest(F.lit(-10.0), F.least(F.lit(10.0), F.col(ratio))) * STEPS).cast("int")
    bins = scored.groupBy(F.col(label).alias("label"), step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()
    total = {name: sum(r["n"] for r in bins if r["label"] == name) for name in ("allow", "block")}
    if not all(total.values()):
        return 0.0
    best = (-1.0, 0.0, 0.0)
    for cut in sorted({0, *(r["step"] for r in bins)}):
        right = sum(r["n"] for r in bins if r["label"] == "allow" and r["step"] >= cut) / total["allow"]
        right += sum(r["n"] for r in bins if r["label"] == "block" and r["step"] < cut) / total["block"]
        best = max(best, (right, -abs(cut), -cut / STEPS))
    return -best[2]


def filter_urls(pages: DataFrame, url: str = "url", rules: tuple[UrlRule, ...] = RULES) -> DataFrame:
    """`pages` and a struct `url_check` (in place of a column so named): host, path, rule, verdict, ratio.

    Rows are not shuffled unless the windows are too many to broadcast; counts
    of n-grams are. A null URL and one without
    `://` have an empty host and path; the model then judges the empty text.
    Where the rules accept or reject no URL at all, the models know nothing
    and the threshold is 0, so every other URL passes. Repeated rows are judged
    alike; an empty table gives an empty table.
    """
    keep = [c for c in pages.columns if c.lower() != "url_check"]
    host, path, rule, verdict, address = (fresh(keep, n) for n in ("host", "path", "rule", "verdict", "address"))
    parsed = pages.select(*map(column, keep), host_of(column(url)).alias(host), path_of(column(url)).alias(path))
    ruled = parsed.select(
        *map(column, keep),
        host,
        path,
        rule_of(F.col(host), F.col(path), rules, lambda r: r.text).alias(rule),
        rule_of(F.col(host), F.col(path), rules, lambda r: r.verdict).alias(verdict),
        F.concat(host, path).alias(address),
    )
    labelled = ruled.where(F.col(rule).isNotNull()).select(F.col(verdict).alias("label"), F.col(address).alias("address"))
    held = F.pmod(F.xxhash64("address"), F.lit(HELD_BACK)) == 0
    grams = written(_gram_counts(labelled.where(~held), "label", "address"), "url-grams")
    every = _gram_counts(ruled.select(F.lit("any").alias("label"), F.col(address).alias("address")), "label", "address")
    gains = gains_of(grams, written(every.select("key", "n"), "windows"))
    threshold = calibrate(_scored(labelled.where(held), "address", ["label"], "ratio", gains), "label", "ratio")
    ratio = fresh([*ruled.columns], "ratio")
    judged = _scored(ruled, address, [*keep, host, path, rule, verdict], ratio, gains)
    by_model = F.when(F.round(F.col(ratio) * STEPS) >= round(threshold * STEPS), F.lit("allow")).otherwise(F.lit("block"))
    check = F.struct(
        F.col(host).alias("host"),
        F.col(path).alias("path"),
        F.col(rule).alias("rule"),
        F.coalesce(F.col(verdict), by_model).alias("verdict"),
        F.col(ratio).alias("ratio"),
    )
    return judged.select(*map(column, keep), check.alias("url_check"))
