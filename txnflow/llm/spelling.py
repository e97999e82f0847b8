"""Spelling variant grouping: words one edit apart, found by dense tiles of padded code-point matrices.

Two words are near if one inserted, deleted or replaced code point turns one
into the other: then their common prefix and suffix together reach the longer
length less one. Such a pair agrees outside of some stretch of the longer word,
so words meet in groups that leave one stretch open: for each length of the
longer word, and each of at most `PIECES` stretches of it, words are grouped by
what stands before and after the stretch. The stretch that holds the end of the
common prefix owns the pair, so that it is counted once.

Within a group all words are compared as matrices of code points, one padded on
the right for prefixes, one reversed for suffixes. Groups of equal size are
stacked into one comparison; large groups are cut into tiles, and groups of more
than `TILE_ROWS` words are dealt out over tasks by pairs of blocks. A task gives
for each word how many near words it has met and the best of them, never pairs.

A word's form is its near word of largest count, if that is `RATIO` times its
own or more. Forms of forms are followed by doubling.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnflow.llm.common import column, prepare, written

#: Code points of a word, its occurrences, and how often as frequent its form is, at least.
LEAST_LENGTH, LEAST_TIMES, RATIO = 7, 2, 10
#: Code points of a stretch, about, and stretches of a word at most.
STRETCH, PIECES = 3, 8
#: Words of a group that one task compares with one another.
TILE_ROWS = 4096
#: Words of one side of a tile, and cells of one comparison.
TILE, CELLS = 128, 1 << 21
#: Words that a task counts before it passes the counts on.
COUNTED = 1 << 19
#: Rows and code points that a task gathers before it compares them.
GATHERED_ROWS, GATHERED_POINTS = 1 << 16, 1 << 21


def count_words(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH, least_times: int = LEAST_TIMES, spoil: int = 0
) -> DataFrame:
    """(word, n) of the words of all whole texts: runs of Latin letters, A-Z lower-cased, with how often they occur.

    Shorter and rarer words are left out. To plant errors, with `spoil` a run
    whose crc32 after its document's id is divided by that number loses one
    code point, before lengths and counts are looked at. Null and empty texts
    have no words; a null id stands as empty. Repeated rows count again.
    """
    prepare(docs.sparkSession)
    run = re.compile(f"[a-zÀ-ÿ]{{{least_length},}}")

    def batch_of(counts: Counter) -> pa.RecordBatch:
        columns = [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for key, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = run.findall((own or "").encode().lower().decode())
                if spoil:
                    begun, spoiled = zlib.crc32(f"{'' if key is None else key}:".encode()), []
                    for word, n in Counter(words).items():
                        code = zlib.crc32(word.encode(), begun)
                        if code % spoil == 0:
                            at = code % len(word)
                            counts[word] -= n
                            spoiled.append((word[:at] + word[at + 1 :], n))
                    for word, n in spoiled:
                        if len(word) >= least_length:
                            counts[word] += n
                counts.update(words)
            if len(counts) > COUNTED:
                yield batch_of(counts)
                counts = Counter()
        yield batch_of(counts)

    rows = docs.select(column(doc_id).alias("doc_id"), column(text).alias("text")).mapInArrow(count, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= max(1, least_times))


def _grouped(words: DataFrame) -> DataFrame:
    """Each word in each group it belongs to: (key, longer, piece, i, j, side, word, n).

    `longer` is the length of the longer word of the group's pairs, the word's
    own or one more; (i, j) is the pair of blocks where the group is large, and
    `side` the block that the word is of.
    """
    size, pieces = F.char_length("word"), F.least(F.lit(PIECES), F.ceil(F.col("longer") / STRETCH)).cast("int")
    rows = words.select("word", "n", F.explode(F.array(size, size + 1)).alias("longer"))
    rows = rows.withColumn("pieces", pieces).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    start = F.floor(F.col("piece") * F.col("longer") / F.col("pieces")).cast("int")
    after = (F.col("longer") - F.floor((F.col("piece") + 1) * F.col("longer") / F.col("pieces"))).cast("int")
    before, behind = F.substr("word", F.lit(1), start), F.substr("word", size - after + 1, after)
    rows = rows.select(F.xxhash64("longer", "piece", before, behind).alias("key"), "longer", "piece", "word", "n")
    keys = ["key", "longer", "piece"]
    large = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > TILE_ROWS)
    large = large.select(*keys, F.ceil(F.col("rows") / (TILE_ROWS // 2)).cast("int").alias("blocks"))
    rows = rows.join(written(large, "large"), keys, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    side = F.pmod(F.xxhash64(F.lit(12), "word"), F.col("blocks")).cast("int")
    rows = rows.withColumn("side", side).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select(*keys, F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "word", "n")


def _stretch(longer: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the open stretch of a group begins and ends."""
    pieces = np.minimum(PIECES, -(-longer // STRETCH))
    return piece * longer // pieces, (piece + 1) * longer // pieces


class Tiles:
    """The words of some groups of one range of lengths, as padded matrices."""

    def __init__(self, words: list[str], longer: np.ndarray, piece: np.ndarray, side: np.ndarray, across: np.ndarray):
        width = max(map(len, words))
        self.ahead, self.back = (
            np.array(own, dtype=f"U{width}").view(np.uint32).reshape(len(words), width) for own in (words, [w[::-1] for w in words])
        )
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        self.longer, self.side, self.across = longer, side, across
        self.start, self.end = _stretch(longer, piece)

    def near(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """For rows `x` against rows `y` of the same groups (stacks by rows): which pairs this group owns."""
        prefix, suffix = ((m[x][:, :, None, :] == m[y][:, None, :, :]).argmin(-1) for m in (self.ahead, self.back))
        longest = np.maximum(self.size[x][:, :, None], self.size[y][:, None, :])
        group = x[:, :1, None]
        found = (longest == self.longer[group]) & (prefix + suffix >= longest - 1)
        found &= (self.start[group] <= prefix) & (prefix < self.end[group])
        return found & (~self.across[group] | (self.side[x][:, :, None] != self.side[y][:, None, :]))

    def pairs(self, first: np.ndarray, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows of near words, each pair once, of the groups that begin at `first` and have `rows` rows."""
        width = self.ahead.shape[1]
        for m in np.unique(rows[rows > 1]):
            begin = first[rows == m]
            tiles = [(a, min(TILE, int(m) - a)) for a in range(0, int(m), TILE)]
            for k, (a, wide) in enumerate(tiles):
                for b, high in tiles[k:]:
                    stack = max(1, CELLS // (wide * high * width))
                    for at in range(0, len(begin), stack):
                        x = begin[at : at + stack, None] + a + np.arange(wide)
                        y = begin[at : at + stack, None] + b + np.arange(high)
                        found = self.near(x, y) & (x[:, :, None] < y[:, None, :])
                        which, left, right = np.nonzero(found)
                        yield x[which, left], y[which, right]


def near_words(words: list[str], n: np.ndarray, keys: np.ndarray, longer: np.ndarray, piece: np.ndarray, side: np.ndarray, across: np.ndarray):
    """For rows in groups of equal `keys`, in a row: how many near words each has, and the row of the best (or -1).

    The best has the largest `n`, then comes first in code-point order.
    """
    total = len(words)
    times = np.zeros(total, np.int64)
    order = np.array(sorted(range(total), key=lambda r: (-n[r], words[r])), np.int64)
    rank = np.empty(total, np.int64)
    rank[order] = np.arange(total)
    best = np.full(total, total, np.int64)
    first = np.nonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[0] if total else np.zeros(0, np.int64)
    rows = np.diff(np.append(first, total))
    classes = np.ceil(np.log2(longer[first])).astype(np.int64)  # words of a class are padded to one width
    for own in np.unique(classes[rows > 1]):
        begin, held = first[(classes == own) & (rows > 1)], rows[(classes == own) & (rows > 1)]
        place = np.concatenate([np.arange(b, b + r) for b, r in zip(begin, held)])
        tiles = Tiles([words[r] for r in place], longer[place], piece[place], side[place], across[place])
        for x, y in tiles.pairs(np.cumsum(held) - held, held):
            x, y = place[x], place[y]
            for here, there in ((x, y), (y, x)):
                np.add.at(times, here, 1)
                np.minimum.at(best, here, rank[there])
    return times, np.where(times > 0, order[np.minimum(best, max(0, total - 1))] if total else best, -1)


def _compared(grouped: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best): what each group has for each of its words that is near another."""
    keys = ["key", "longer", "piece", "i", "j"]
    names = ["word", "n_near", "best_n", "best"]

    def found(rows: pa.Table) -> pa.RecordBatch:
        words, n = rows.column("word").to_pylist(), rows.column("n").to_numpy()
        columns = [rows.column(c).to_numpy() for c in keys]
        change = np.zeros(len(words), np.int64)
        for own in columns:
            change[1:] |= own[1:] != own[:-1]
        _, longer, piece, i, j = columns
        times, best = near_words(words, n, np.cumsum(change), longer.astype(np.int64), piece.astype(np.int64), rows.column("side").to_numpy(), i != j)
        hit = np.nonzero(times)[0]
        made = [pa.array([words[r] for r in hit], pa.string()), pa.array(times[hit]), pa.array(n[best[hit]], pa.int64())]
        made.append(pa.array([words[r] for r in best[hit]], pa.string()))
        return pa.RecordBatch.from_arrays(made, names=names)

    def whole(rows: pa.Table) -> int:
        """Rows before the last group."""
        last = rows.num_rows
        same = np.ones(last, bool)
        for c in keys:
            own = rows.column(c).to_numpy()
            same &= own == own[-1]
        return last - int(same[::-1].argmin()) if not same.all() else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, rows, points = [], 0, 0
        for batch in batches:
            waiting.append(batch)
            rows += batch.num_rows
            points += batch.column("word").nbytes
            if rows > GATHERED_ROWS or points > GATHERED_POINTS:
                table = pa.Table.from_batches(waiting)
                cut = whole(table)
                if cut:
                    yield found(table.slice(0, cut))
                rest = table.slice(cut).combine_chunks()
                waiting, rows, points = rest.to_batches(), rest.num_rows, rest.column("word").nbytes if cut else 0
        if rows:
            yield found(pa.Table.from_batches(waiting))

    dealt = grouped.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, "word string, n_near long, best_n long, best string")


def group_spellings(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """One row for each row of `words` (word string, n long): word, form, root, n, n_near, form_n.

    `n_near` is how many other words are one edit away, `form` the one of them
    with the largest n (ties: first in code-point order) if that is `ratio`
    times the word's own at least, `form_n` its n, and `root` where forms of
    forms end (the word itself without a form). Words are distinct and not
    null, with n above 0, as `count_words` gives them; an empty word is near
    those of one code point. An empty table gives an empty table.
    """
    prepare(words.sparkSession)
    words = written(words.select("word", "n"), "words")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    near = _compared(_grouped(words)).groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    found = words.join(near, "word", "left")
    has = -F.col("best.less") >= ratio * F.col("n")
    found = written(
        found.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has, F.col("best.best")).alias("form"), F.when(has, -F.col("best.less")).alias("form_n")
        ),
        "forms",
    )
    links = found.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:  # a form is ten times as frequent, so a handful of doublings reach every end
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = written(links.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if links.where("moved").isEmpty():
            break
        links = links.drop("moved")
    rooted = found.join(links.select("word", "root"), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
