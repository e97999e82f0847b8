"""Benchmark decontamination: a broadcast set of hashed item windows, and texts scanned against it.

Words are digits, letters and everything beyond ASCII, with A-Z lower-cased. A
window is `size` consecutive words of an item; a shorter item, but not an empty
one, is one window of its own length. A task codes the words of a text by the
item words, hashes all its windows of coded words at once, looks them up, and
verifies each hit word by word.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnflow.llm.common import alnum_words, column, fresh, map_texts, mixed, written

#: Windows in one broadcast block. A larger benchmark is scanned in several blocks.
BLOCK_WINDOWS = 500_000

_STEP = np.uint64(0x9E3779B97F4A7C15)


def item_windows(text: str | None, size: int) -> list[tuple[bytes, ...]]:
    words = alnum_words(text)
    if not words:
        return []
    if len(words) < size:
        return [tuple(words)]
    return [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]


class WindowSet:
    """Windows of some items by the hash of their word codes."""

    def __init__(self, windows: dict[tuple[bytes, ...], list[str]]):
        self.windows = windows
        names = {w for window in windows for w in window}
        self.code = {w: i + 1 for i, w in enumerate(sorted(names))}
        self.by_size: dict[int, tuple[np.ndarray, list[list[tuple[bytes, ...]]]]] = {}
        for size in sorted({len(w) for w in windows}):
            found: dict[int, list[tuple[bytes, ...]]] = {}
            for window in (w for w in windows if len(w) == size):
                codes = np.array([self.code[w] for w in window], np.uint64)
                found.setdefault(int(self._hashes(codes, size)[0]), []).append(window)
            order = sorted(found)
            self.by_size[size] = np.array(order, np.uint64), [found[h] for h in order]

    @staticmethod
    def _hashes(codes: np.ndarray, size: int) -> np.ndarray:
        n = len(codes) - size + 1
        total = np.zeros(n, np.uint64)
        for k in range(size):
            total = total * _STEP + mixed(codes[k : k + n])
        return mixed(total)

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Marks of the words inside a window, and the items whose windows occur."""
        hit, items = np.zeros(len(words), bool), set()
        codes = np.fromiter(map(self.code.get, words, _zeros()), np.uint64, len(words))
        for size, (hashes, windows) in self.by_size.items():
            if len(words) < size:
                continue
            unknown = np.concatenate([[0], np.cumsum(codes == 0)])
            at = np.nonzero(unknown[size:] == unknown[:-size])[0]
            if not len(at):
                continue
            total = np.zeros(len(at), np.uint64)
            for k in range(size):
                total = total * _STEP + mixed(codes[at + k])
            total = mixed(total)
            place = np.minimum(np.searchsorted(hashes, total), len(hashes) - 1)
            for i in np.nonzero(hashes[place] == total)[0]:
                start = int(at[i])
                window = tuple(words[start : start + size])
                if window in windows[int(place[i])]:
                    hit[start : start + size] = True
                    items.update(self.windows[window])
        return hit, items


def _zeros() -> Iterator[int]:
    while True:
        yield 0


def _blocks(benchmark: DataFrame, item: str, text: str, size: int) -> Iterator[dict[tuple[bytes, ...], list[str]]]:
    """The benchmark's windows, a bounded block at a time."""
    block: dict[tuple[bytes, ...], list[str]] = {}
    rows = benchmark.select(column(item).cast("string").alias("item"), column(text).alias("text"))
    for row in rows.toLocalIterator():
        for window in item_windows(row["text"], size):
            block.setdefault(window, []).append(row["item"] if row["item"] is not None else "")
            if len(block) >= BLOCK_WINDOWS:
                yield block
                block = {}
    yield block


def scan_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    size: int = 10,
) -> DataFrame:
    """`docs` with n_words, hits (array of word numbers inside a window) and items (array of item ids as text).

    Columns of `docs` with these names are replaced. One pass without shuffle
    for each block of `BLOCK_WINDOWS` windows; only a benchmark of several
    blocks has its passes written in between. A null or empty text has no words
    and no hits; null or empty items have no windows; a null item id is the
    empty text; repeated items count once.
    """
    made = {"n_words", "hits", "items"}
    found = None
    for block in _blocks(benchmark, item, item_text, size):
        frame = docs if found is None else written(found, "scanned")
        found = _scan_block(frame, text, block, first=found is None, made=made)
    return found


def _scan_block(docs: DataFrame, text: str, block: dict, first: bool, made: set[str]) -> DataFrame:
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(pickle.dumps(WindowSet(block)))
    keep = [c for c in docs.columns if c.lower() not in made]
    names = [fresh(keep, n) for n in ("n_words", "hits", "items")]

    def build():
        windows = pickle.loads(shared.value)

        def work(texts):
            counts, hits, items = [], [], []
            for value in texts:
                words = alnum_words(value)
                hit, own = windows.scan(words) if words else (np.zeros(0, bool), set())
                counts.append(len(words))
                hits.append(np.nonzero(hit)[0].tolist())
                items.append(sorted(own))
            return counts, hits, items

        return work

    outputs = dict(zip(names, ("long", "ints", "strings")))
    if first:
        return map_texts(docs, text, keep, outputs, build)
    old = docs.select(*map(column, keep), F.struct("hits", "items").alias(fresh([*keep, *names], "earlier")))
    earlier = old.columns[-1]
    new = map_texts(old, text, [*keep, earlier], outputs, build)
    merge = lambda name: F.array_sort(F.array_union(F.col(f"{earlier}.{name}"), F.col(name)))
    return new.select(*map(column, keep), "n_words", merge("hits").alias("hits"), merge("items").alias("items"))


def items_digest(items: str = "items"):
    """SHA-256 of the sorted item ids, comma-joined."""
    return F.sha2(F.concat_ws(",", F.array_sort(F.col(items))).cast("binary"), 256)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **how) -> DataFrame:
    """The rows of `docs` whose text holds no window of `benchmark`, with their columns as they were."""
    name = fresh(docs.columns, "scanned_text")
    marked = scan_benchmark(docs.select(F.struct(*map(column, docs.columns)).alias("row"), column(text).alias(name)), benchmark, name, **how)
    return marked.where(F.size("hits") == 0).select("row.*")


def cut_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", size: int = 10) -> DataFrame:
    """`docs` with the words inside a window, and the marks between them, cut out of the text.

    Null texts stay null. The other columns stay as they were.
    """
    import re

    word = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    name = fresh(docs.columns, "scanned_text")
    frame = docs.select(F.struct(*map(column, docs.columns)).alias("row"), column(text).alias(name))
    marked = scan_benchmark(frame, benchmark, name, size=size)
    joined = marked.select("row", F.to_json(F.struct("hits", F.col(name).alias("value"))).alias(name))
    out = fresh(["row"], "cut")

    def build():
        import json

        def cut(packed):
            found = json.loads(packed)
            value = found.get("value")
            if value is None or not found["hits"]:
                return value
            raw, hit = value.encode(), set(found["hits"])
            spans = [m.span() for m in word.finditer(raw.lower())]
            parts, start = [], 0
            for number, (begin, end) in enumerate(spans):
                if number in hit:
                    if number - 1 not in hit:
                        parts.append(raw[start:begin])
                    start = end
            return b"".join([*parts, raw[start:]]).decode()

        return lambda values: ([cut(v) for v in values],)

    cut_rows = map_texts(joined, name, ["row"], {out: "string"}, build)
    return cut_rows.select(*(F.col(out).alias(text) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns))


