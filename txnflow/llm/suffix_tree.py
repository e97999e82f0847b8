"""Language-model scoring by a probabilistic suffix tree over tokens.

A text's tokens are its lower-cased words and an end. The tree's root is the
distribution of single tokens. A context of up to `DEPTH` tokens is a candidate
if it was seen `LEAST_TIMES` times, however large the corpus, so that the tree
grows with it; it is kept if its next-token distribution diverges enough from
that of its longest kept suffix. Each distribution is smoothed with that of the
suffix, and the root keeps the share of words seen once for unknown ones. A
token is scored in the longest kept suffix of what stands before it.

Counting takes three passes over the training texts: words and pairs; those
longer sequences whose pairs are all listed; and, for listed sequences, which
context they continue. A task sorts the codes of some million tokens and sends
for each range of codes one row with the steps between them and their counts, so
that a distinct code takes some seven bytes on its way; whoever gets a range adds
up and drops what was seen too seldom.

The tree is built level by level in joins and is a table of additive weights: a
kept context adds the log of the share it leaves to its suffix, and a listed
sequence what its last token gains over that. A text's score is the sum over the
sequences in it. The most frequent codes, a bounded number, meet their weights in
a broadcast table, the others in a join; this decides how a weight is found,
never which.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnflow.llm.common import Counts, discard, from_planes, least_of_most, mixed, planes, prepare, release_shuffles, signed, space_words, unmixed, word_codes, written

#: Tokens of the longest context.
DEPTH = 3
#: A sequence is listed, and a context a candidate, if it occurs so often at least, however large the corpus.
LEAST_TIMES = 4
#: A context is kept if it gains so many nats over its suffix for each time it was seen, and in all.
LEAST_DIVERGENCE, LEAST_GAIN = 0.02, 10.0
#: Pseudo-counts that a context borrows from its suffix.
BORROWED = 1.0
#: Codes, at most, that meet their weights in a broadcast table of 24 bytes each, and how often they occur at least, to be
#: worth a place there; the others meet them in a join.
BROADCAST_CODES, BROADCAST_TIMES = 1 << 21, 16
#: Bits of a table of marks for each code in it; the least and the greatest table and the bits of one row on their way to
#: the driver, as powers of two. A table that has to hold more codes tells fewer others from them, which costs only time.
MARK_BITS, LEAST_MARKS, MOST_MARKS, MARK_BLOCK = 24, 20, 30, 15
#: Tokens, at most, whose sequences a task counts before it passes them on.
COUNTED = 1 << 21
#: Bytes of text, about, whose codes fall into one range; ranges at most, as a power of two.
RANGE_BYTES, MOST_RANGES = 1 << 22, 18
#: Rows of one Arrow batch of counts.
COUNT_ROWS = 1 << 16
#: The code of the end; no word has it but by the chance that two words share one.
END = np.uint64(1)

NAMES = ["row", "doc_id", "training", "n_tokens", "known", "base", "score", "codes", "times"]
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _joined(context: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """Codes of sequences from those without their last and without their first token."""
    return mixed(context * _STEP + tail)


@dataclass
class Tokens:
    """The tokens of some texts in one row: their codes, their places in their texts, and whose they are."""

    codes: np.ndarray
    place: np.ndarray
    owner: np.ndarray

    @classmethod
    def of(cls, texts: list[str | None]) -> Tokens:
        spoken = [space_words(t) for t in texts]
        sizes = np.fromiter(map(len, spoken), np.int64, len(spoken)) + 1
        codes = np.full(sizes.sum(), END)
        ends = np.cumsum(sizes) - 1
        is_word = np.ones(len(codes), bool)
        is_word[ends] = False
        codes[is_word] = word_codes([w for own in spoken for w in own])
        place = np.arange(len(codes)) - np.repeat(ends + 1 - sizes, sizes)
        return cls(mixed(codes), place, np.repeat(np.arange(len(spoken)), sizes))

    def sequences(self, marks: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each length from 1 to DEPTH + 1 the codes of the sequences that end at each token, and which of them
        stand within one text; with `marks` only those whose pairs are marked."""
        found = [(self.codes, np.ones(len(self.codes), bool))]
        for size in range(2, DEPTH + 2):
            before, real = found[-1]
            longer, inside = np.zeros_like(before), np.zeros_like(real)
            longer[1:] = _joined(before[:-1], before[1:])
            inside[1:] = real[:-1] & real[1:] & (self.place[1:] >= size - 1)
            if marks is not None and size == 2:
                inside[inside] = _marked(marks, longer[inside])
            found.append((longer, inside))
        return found


Marks = tuple[int, np.ndarray]


def _marked(marks: Marks, codes: np.ndarray) -> np.ndarray:
    """Whether codes may be in the table that was marked."""
    at = codes >> np.uint64(64 - marks[0])
    return (marks[1][(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _marks_of(keys: DataFrame) -> Marks:
    """One bit for each code in column `key`, at the place its first bits name. Codes that are not in the column may
    have a bit, those in it always do. The table grows with their number."""
    size = min(MOST_MARKS, max(LEAST_MARKS, math.ceil(math.log2(MARK_BITS * keys.count() + 1))))
    at = F.shiftrightunsigned("key", 64 - size)
    bits = keys.groupBy(F.shiftright(at, MARK_BLOCK).alias("block")).agg(
        F.bitmap_construct_agg(at.bitwiseAND(F.lit((1 << MARK_BLOCK) - 1))).alias("bits")
    )
    table = np.zeros((1 << (size - MARK_BLOCK), 1 << (MARK_BLOCK - 3)), np.uint8)
    for block, own in bits.toLocalIterator():
        table[block] = np.frombuffer(own, np.uint8)
    return size, table.ravel()


def _passed(docs: DataFrame, ranges: int, found, marks: Marks | None) -> DataFrame:
    """(size, range, keys, extra): what tasks find in some million tokens each, dealt by ranges of keys.

    `found(tokens, sequences)` gives for each size of sequence keys and numbers
    that go with them; `packed` below says what becomes of them.
    """
    shared = None if marks is None else docs.sparkSession.sparkContext.broadcast(marks)
    names = ["size", "range", "keys", "extra"]

    def packed(waiting: list[dict]) -> Iterator[pa.RecordBatch]:
        for size in [*waiting[0]]:
            own = [w.pop(size) for w in waiting]
            keys, extra = (np.concatenate([x[k] for x in own]) for k in (0, 1))
            del own
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            first = np.nonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[0] if len(keys) else order
            # Counts of single words are added up; contexts are the same wherever a key is the same.
            extra = extra[order[first]] if extra.dtype == np.uint64 else np.diff(np.append(first, len(keys))).astype(np.uint32)
            keys = keys[first]
            of = (keys >> np.uint64(64 - ranges)).astype(np.int64)
            cuts = np.nonzero(np.concatenate([[True], of[1:] != of[:-1]]))[0] if len(keys) else of
            parts = [slice(a, b) for a, b in zip(cuts, [*cuts[1:], len(keys)])]
            columns = [
                pa.array(np.full(len(parts), size, np.int32)),
                pa.array(of[cuts].astype(np.int32)),
                pa.array([planes(np.diff(keys[p], prepend=np.uint64(0))) for p in parts], pa.binary()),
                pa.array([planes(extra[p]) for p in parts], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, tokens = [], 0
        for batch in batches:
            own = Tokens.of(batch.column(0).to_pylist())
            waiting.append(found(own, None if shared is None else shared.value))
            tokens += len(own.codes)
            if tokens > COUNTED:
                yield from packed(waiting)
                waiting, tokens = [], 0
        if waiting:
            yield from packed(waiting)

    rows = docs.select("text").mapInArrow(run, "size int, range int, keys binary, extra binary")
    return rows.repartition("size", "range").sortWithinPartitions("size", "range")


def _merged(rows: DataFrame, schema: str, start, add, end) -> DataFrame:
    """What `end` makes of all rows of each (size, range), which come one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held, waiting, rows = None, None, [], 0
        for batch in batches:
            for size, own, keys, extra in zip(*(c.to_pylist() for c in batch.columns)):
                if (size, own) != here:
                    if here is not None:
                        waiting.append(end(here[0], held))
                        rows += waiting[-1].num_rows
                    here, held = (size, own), start()
                add(held, np.cumsum(from_planes(keys, np.uint64), dtype=np.uint64), extra)
            if rows > COUNT_ROWS:
                yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()
                waiting, rows = [], 0
        if here is not None:
            waiting.append(end(here[0], held))
        yield from waiting

    return rows.mapInArrow(run, schema)


def _counted(docs: DataFrame, sizes: tuple[int, ...], ranges: int, marks: Marks | None = None) -> DataFrame:
    """(size, key, n) of the sequences of some lengths that occur often enough; words all do.

    With `marks` only sequences are counted whose pairs are all marked.
    """

    def found(tokens: Tokens, marks: Marks | None) -> dict:
        of = tokens.sequences(marks)
        return {size: (codes[real], np.zeros(0, np.uint32)) for size in sizes for codes, real in [of[size - 1]]}

    def end(size: int, held: Counts) -> pa.RecordBatch:
        keys, n = held.take()
        often = n >= (LEAST_TIMES if size > 1 else 1)
        columns = [pa.array(np.full(int(often.sum()), size, np.int32)), pa.array(signed(keys[often])), pa.array(n[often])]
        return pa.RecordBatch.from_arrays(columns, names=["size", "key", "n"])

    add = lambda held, keys, n: held.add(keys, from_planes(n, np.uint32).astype(np.int64))
    return _merged(_passed(docs, ranges, found, marks), "size int, key long, n long", Counts, add, end)


def _continued(docs: DataFrame, ranges: int, marks: Marks) -> DataFrame:
    """(key, context, tail) of the sequences of two and more tokens that are marked: the codes without the last and
    without the first token."""

    def found(tokens: Tokens, marks: Marks | None) -> dict:
        of, rows = tokens.sequences(), {}
        for size in range(2, DEPTH + 2):
            at = np.nonzero(of[size - 1][1])[0]
            at = at[_marked(marks, of[size - 1][0][at])]
            rows[size] = of[size - 1][0][at], of[size - 2][0][at - 1]
        return rows

    def end(size: int, held: list) -> pa.RecordBatch:
        keys, first = np.unique(np.concatenate([k for k, _ in held]), return_index=True)
        context = np.concatenate([c for _, c in held])[first]
        columns = [pa.array(signed(x)) for x in (keys, context, unmixed(keys) - context * _STEP)]
        return pa.RecordBatch.from_arrays(columns, names=["key", "context", "tail"])

    def add(held: list, keys: np.ndarray, contexts: bytes) -> None:
        held.append((keys, from_planes(contexts, np.uint64)))
        if len(held) >= 64:
            keys, first = np.unique(np.concatenate([k for k, _ in held]), return_index=True)
            held[:] = [(keys, np.concatenate([c for _, c in held])[first])]

    return _merged(_passed(docs, ranges, found, marks), "key long, context long, tail long", list, add, end)


def _level(sequences: DataFrame, shorter: DataFrame) -> DataFrame:
    """The listed sequences of one length: key, n, p (of the last token in the longest kept suffix of the context),
    and where the context is kept also context, total, left and delta, the log of what the last token gains.

    `shorter` has key, n and p of those one token shorter.
    """
    below = shorter.select(F.col("key").alias("tail"), F.col("p").alias("below"))
    own = written(sequences.join(below, "tail").select("key", "context", "n", "below"), "level")
    totals = shorter.where(F.col("n") >= LEAST_TIMES).select(F.col("key").alias("context"), F.col("n").alias("total"))
    sums = own.groupBy("context").agg(F.sum("n").alias("follow")).join(totals, "context")
    sums = sums.withColumn("left", (F.col("total") - F.col("follow") + BORROWED) / (F.col("total") + BORROWED))
    chance = F.col("n") / (F.col("total") + BORROWED) + F.col("left") * F.col("below")
    rest = F.max(F.col("total") - F.col("follow"))
    gains = own.join(sums, "context").groupBy("context").agg(
        (F.sum(F.col("n") * F.log(chance / F.col("below"))) + rest * F.log(F.max("left"))).alias("gain"),
        F.max("total").alias("total"),
        F.max("left").alias("left"),
    )
    kept = gains.where((F.col("gain") >= LEAST_GAIN) & (F.col("gain") >= LEAST_DIVERGENCE * F.col("total"))).drop("gain")
    found = own.join(kept, "context", "left")
    level = written(
        found.select(
            "key",
            "n",
            F.coalesce(chance, "below").alias("p"),
            F.when(F.col("left").isNotNull(), F.col("context")).alias("context"),
            "total",
            "left",
            F.log10(chance / (F.col("left") * F.col("below"))).alias("delta"),
        ),
        "tree",
    )
    discard(own)
    return level


def _weights(words: DataFrame, levels: list[DataFrame], share: float) -> DataFrame:
    """key, n, base, weight: what each time a code occurs adds to a text; a code may have two rows, and a word has a base."""
    none = F.lit(0.0)
    tables = [words.select("key", "n", F.log10(F.col("n") + 1.0).alias("base"), (F.log10("n") + share).alias("weight"))]
    for level in levels:
        kept = level.where("context IS NOT NULL")
        tables.append(kept.select("key", "n", none.alias("base"), F.col("delta").alias("weight")))
        contexts = kept.groupBy("context").agg(F.max("total").alias("n"), F.max("left").alias("left"))
        tables.append(contexts.select(F.col("context").alias("key"), "n", none.alias("base"), F.log10("left").alias("weight")))
    whole = tables[0]
    for table in tables[1:]:
        whole = whole.unionByName(table)
    return written(whole, "weights")


def _frequent(weights: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted codes, and for each one base and weight; those with a base are words."""
    few = weights.toArrow()
    names, index = np.unique(few.column("key").to_numpy().view(np.uint64), return_inverse=True)
    return names, np.stack([np.bincount(index, few.column(c).to_numpy(), len(names)) for c in ("base", "weight")])


def score_texts(docs: DataFrame, training: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of `docs`: doc_id, training, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from the rows for which `training` holds (null: it does
    not). `score` is the tree's log10 probability of the text, all unknown
    words being one token; `base_score` that by add-one counts. A null text
    counts as empty: its only token is the end. Without training rows every
    token is unknown and certain. Whole texts are counted and scored. Repeated
    rows are counted and scored each for itself. Words and sequences are
    compared as 64-bit codes.
    """
    spark = prepare(docs.sparkSession)
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.coalesce(training, F.lit(False)).alias("training"))
    learned = docs.where("training")
    size = learned.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = min(MOST_RANGES, max(3, math.ceil(math.log2(size / RANGE_BYTES + 1))))
    short = written(_counted(learned, (1, 2), ranges), "counts")
    words, pairs = short.where("size = 1"), short.where("size = 2")
    total = words.agg(F.sum("n"), F.count(F.lit(1)), F.count(F.when(F.col("n") == 1, 1))).first()
    n_train, kinds, once = int(total[0] or 0), int(total[1]), int(total[2])
    unknown = (once + 0.5) / (n_train + 1.0) if n_train else 1.0
    release_shuffles(spark)
    long = written(_counted(learned, tuple(range(3, DEPTH + 2)), ranges, _marks_of(pairs)), "counts")
    release_shuffles(spark)
    listed = pairs.unionByName(long)
    continued = written(_continued(learned, ranges, _marks_of(listed)), "continued")
    release_shuffles(spark)
    root = (1 - unknown) / max(1, n_train)
    shorter, levels = words.withColumn("p", F.col("n") * F.lit(root)), []
    for size in range(2, DEPTH + 2):
        own = pairs if size == 2 else long.where(F.col("size") == size)
        levels.append(_level(own.join(continued, "key"), shorter))
        shorter = levels[-1]
    weights = _weights(words, levels, math.log10(root) if n_train else 0.0)
    discard(continued, short, long, *levels)
    release_shuffles(spark)
    often = F.col("n") >= max(BROADCAST_TIMES, least_of_most(weights, BROADCAST_CODES))
    shared = spark.sparkContext.broadcast((*_frequent(weights.where(often)), _marks_of(weights)))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, values, marks = shared.value
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts = batch.num_rows
            if not texts:
                continue
            tokens = Tokens.of(batch.column(1).to_pylist())
            codes, owner = [], []
            for own, real in tokens.sequences():
                at = np.nonzero(real)[0]
                at = at[_marked(marks, own[at])]
                codes.append(own[at])
                owner.append(tokens.owner[at])
            distinct, index = np.unique(np.concatenate(codes), return_inverse=True)
            pair, n = np.unique(np.concatenate(owner) * max(1, len(distinct)) + index, return_counts=True)
            holder, code = np.divmod(pair, max(1, len(distinct)))
            spot = np.minimum(np.searchsorted(names, distinct), max(0, len(names) - 1))
            often = (names[spot] == distinct if len(names) else np.zeros(len(distinct), bool))[code]
            values_of = [own[spot[code[often]]] for own in values]
            sums = [np.bincount(holder[often], n[often] * own, texts) for own in (values_of[0] > 0, *values_of)]
            holder, code, n = holder[~often], code[~often], n[~often]
            cuts = pa.array(np.searchsorted(holder, np.arange(texts + 1)).astype(np.int32))
            columns = [
                pa.array(row + np.arange(texts)),
                batch.column(0),
                batch.column(2),
                pa.array(np.bincount(tokens.owner, None, texts).astype(np.int64)),
                pa.array(np.rint(sums[0]).astype(np.int64)),
                pa.array(sums[1].astype(float)),
                pa.array(sums[2].astype(float)),
                pa.ListArray.from_arrays(cuts, pa.array(signed(distinct[code]))),
                pa.ListArray.from_arrays(cuts, pa.array(n.astype(np.int32))),
            ]
            row += texts
            yield pa.RecordBatch.from_arrays(columns, names=NAMES)

    schema = f"row long, doc_id {kind}, training boolean, n_tokens long, known long, base double, score double, codes array<long>, times array<int>"
    scored = written(docs.select("doc_id", "text", "training").mapInArrow(run, schema), "scored")
    rare = scored.select("row", F.explode(F.arrays_zip("codes", "times")).alias("w"))
    rare = rare.select("row", F.col("w.codes").alias("key"), F.col("w.times").alias("times"))
    seldom = weights.where(~often).select("key", F.col("base").alias("own_base"), "weight")
    found = rare.join(seldom, "key").groupBy("row").agg(
        F.sum(F.when(F.col("own_base") > 0, F.col("times"))).alias("more"),
        F.sum(F.col("times") * F.col("own_base")).alias("more_base"),
        F.sum(F.col("times") * F.col("weight")).alias("more_score"),
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    missing = F.col("n_tokens") - F.col("known") - zero("more")
    return scored.join(found, "row", "left").select(
        "doc_id",
        "training",
        "n_tokens",
        (F.col("known") + zero("more")).cast("long").alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base") + zero("more_base") - F.col("n_tokens") * F.lit(math.log10(n_train + kinds + 1))).alias("base_score"),
        (F.col("score") + zero("more_score") + missing * F.lit(math.log10(unknown))).alias("score"),
    )
