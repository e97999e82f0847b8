"""Best-fit packing: a configuration program over the length histogram.

Documents become pieces of at most `size` tokens. How many pieces have each
length is all that decides a packing, so the driver gets that histogram, at
most `size` numbers whatever the data. The program chooses how often each
configuration (a set of lengths that fit one sequence) is used; multiplicative
weights price the lengths, and a knapsack finds the best configuration for the
prices. The rounded plan says for each length which ranks of its pieces go to
which sequences and offsets. Ranks are counted by the executors.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnflow.llm.common import prepare, ranked, written

#: Rounds of the weights, how fast they move, and how much higher the price of long pieces starts:
#: these have the fewest places to go.
ROUNDS, RATE, LEAN = 300, 0.1, 0.5

# How the vocabulary's library splits a text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts with any other character go to the library: versions of Unicode differ on what is a letter or a space.
_OTHER = re.compile("[^\t\n\r\x20-\x7eÀ-ÖØ-öø-ſ]")


def _byte_names() -> dict[str, int]:
    """The characters by which a byte-level vocabulary file writes bytes."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteTokens:
    """Token ids of whole texts, as little-endian 32-bit numbers.

    The ids are those of the vocabulary file's own library. Where the file's
    merges stand in the order of their ids, texts of common characters are
    merged by a faster library that gives the same ids.
    """

    def __init__(self, path: str, end: int):
        from tokenizers import Tokenizer

        if not os.path.exists(path):
            raise FileNotFoundError(path)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.added = [x["content"] for x in described.get("added_tokens", [])]
        self.fast = self._ranked(described["model"])
        self.end = struct.pack("<I", end)

    def _ranked(self, model: dict):
        import tiktoken

        names, vocab = _byte_names(), model["vocab"]
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        places = [vocab[m] for m in merged]
        if places != sorted(places):
            return None
        ranks = {bytes(names[c] for c in token): i for token, i in vocab.items() if token not in self.added}
        return tiktoken.Encoding("bytes", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str | None) -> bytes:
        if not text:
            return self.end
        if self.fast is None or _OTHER.search(text) or any(a in text for a in self.added):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes() + self.end
        return self.fast.encode_to_numpy(text).astype("<u4", copy=False).tobytes() + self.end


def pieces_of(docs: DataFrame, doc_id: str, text: str, path: str, size: int, end: int) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32): texts cut into `size` tokens, the first piece the shorter one."""
    prepare(docs.sparkSession)
    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = ByteTokens(path, end)
        for batch in batches:
            owner, piece, start, length, sums = [], [], [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                ids = tokens.ids(text)
                total = len(ids) // 4
                count = -(-total // size)
                first = total - (count - 1) * size
                for k in range(count):
                    a = 0 if k == 0 else first + (k - 1) * size
                    n = first if k == 0 else size
                    owner.append(row)
                    piece.append(k)
                    start.append(a)
                    length.append(n)
                    sums.append(zlib.crc32(ids[4 * a : 4 * (a + n)]))
            columns = [batch.column(0).take(pa.array(owner, pa.int64()))]
            columns += [pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, sums))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def best_configuration(value: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """Copies of each length (index + 1) that fit `size` together at the largest value, at most `counts` of each.

    A knapsack by dynamic programming; the copies of a length are offered in
    lots of 1, 2, 4 and so on, and a rest.
    """
    lots = []
    for i in np.nonzero(counts)[0]:
        left, lot = int(min(counts[i], size // (i + 1))), 1
        while left > 0:
            lot = min(lot, left)
            lots.append((int(i), lot))
            left -= lot
            lot *= 2
    best = np.zeros(size + 1)
    taken = np.zeros((len(lots), size + 1), bool)
    for k, (i, lot) in enumerate(lots):
        room = (i + 1) * lot
        with_lot = best[: size + 1 - room] + value[i] * lot
        better = with_lot > best[room:]
        taken[k, room:] = better
        best[room:] = np.where(better, with_lot, best[room:])
    found, room = np.zeros(len(counts), np.int64), size
    for k in range(len(lots) - 1, -1, -1):
        if taken[k, room]:
            i, lot = lots[k]
            found[i] += lot
            room -= (i + 1) * lot
    return found


def configurations(
    counts: np.ndarray, size: int, rounds: int = ROUNDS, rate: float = RATE
) -> list[tuple[np.ndarray, float]]:
    """Configurations and how often each is used, so that all pieces are covered: a near-optimal solution
    of the configuration program.

    A length's price is its share of a sequence times a weight. A round buys
    the configuration of the highest price, one part in `rounds` of all that is
    needed or until one of its lengths is covered; what was covered loses
    weight by the factor exp(-rate * share of the length covered), and a covered
    length leaves the program.
    """
    lengths = np.arange(1, size + 1)
    left = counts.astype(float)
    log_weight = LEAN * lengths / size
    part = max(1.0, float(np.dot(counts, lengths)) / size / rounds)
    used: dict[bytes, list] = {}
    while left.any():
        price = lengths / size * np.exp(log_weight - log_weight[left > 0].max())
        chosen = best_configuration(price, np.ceil(left).astype(np.int64), size)
        some = chosen > 0
        amount = min(part, float((left[some] / chosen[some]).min()))
        left[some] -= amount * chosen[some]
        left[left < 1e-9] = 0.0
        log_weight[some] -= rate * amount * chosen[some] / counts[some]
        entry = used.setdefault(chosen.tobytes(), [chosen, 0.0])
        entry[1] += amount
    return [(c, x) for c, x in used.values()]


@dataclass
class Plan:
    """For each length the intervals of ranks: first rank, first sequence, and the offsets in each sequence."""

    intervals: dict[int, list[tuple[int, int, list[int]]]] = field(default_factory=dict)
    placed: dict[int, int] = field(default_factory=dict)
    sequences: int = 0

    def add(self, configuration: dict[int, int], times: int) -> None:
        """`times` sequences with so many pieces of each length."""
        offset = 0
        for length in sorted(configuration, reverse=True):
            copies = configuration[length]
            offsets = [offset + k * length for k in range(copies)]
            offset += copies * length
            first = self.placed.get(length, 0)
            self.intervals.setdefault(length, []).append((first, self.sequences, offsets))
            self.placed[length] = first + copies * times
        self.sequences += times


def _grouped_fit(left: np.ndarray, size: int) -> list[tuple[dict[int, int], int]]:
    """Sequences for the pieces that rounding left: each takes the longest piece that still fits.

    Equal sequences are counted instead of repeated, so that the work follows
    the lengths and not the pieces.
    """
    left, found = left.copy(), []
    while left.any():
        own = _best_fit_one(left, size)
        times = min(int(left[n - 1]) // k for n, k in own.items())
        for n, k in own.items():
            left[n - 1] -= k * times
        found.append((own, times))
    return found


def _best_fit_one(left: np.ndarray, size: int) -> dict[int, int]:
    room, own, rest = size, {}, left.copy()
    while True:
        fitting = np.nonzero(rest[:room])[0]
        if not len(fitting):
            return own
        length = int(fitting[-1]) + 1
        copies = int(min(rest[length - 1], room // length))
        own[length] = own.get(length, 0) + copies
        rest[length - 1] -= copies
        room -= copies * length


def plan_sequences(counts: np.ndarray, size: int) -> Plan:
    """Round the program's solution down, use no piece twice, and fit the rest."""
    counts = counts.astype(np.int64)
    plan, full = Plan(), int(counts[size - 1])
    if full:
        plan.add({size: 1}, full)
    left = counts.copy()
    left[size - 1] = 0
    if left.any():
        solution = sorted(configurations(left, size), key=lambda c: (-int(np.dot(c[0], np.arange(1, size + 1))), c[0].tobytes()))
        for configuration, amount in solution:
            used = configuration > 0
            times = int(min(np.floor(amount + 1e-9), (left[used] // configuration[used]).min()))
            if times > 0:
                plan.add({int(i) + 1: int(configuration[i]) for i in np.nonzero(used)[0]}, times)
                left -= times * configuration
        for own, times in _grouped_fit(left, size):
            plan.add(own, times)
    return plan


def pack(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", size: int = 1024, end: int = 2
) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null text counts as empty and is one piece with the end id alone. Rows
    that repeat a doc_id are packed each for itself. An empty table packs into
    nothing. The pieces are written once; their histogram (at most `size` rows)
    goes to the driver and the plan back.
    """
    pieces = written(pieces_of(docs, doc_id, text, path, size, end), "pieces")
    counts = np.zeros(size, np.int64)
    for row in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[row["length"] - 1] = row["n"]
    if not counts.any():
        return pieces.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    plan = plan_sequences(counts, size)
    shared = docs.sparkSession.sparkContext.broadcast(plan.intervals)
    rows = ranked(pieces, ["length"], ["doc_id", "piece", "ids_crc32"], "rank")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    schema = rows.select("doc_id", "piece", "start", "length", "ids_crc32").schema.add("sequence_id", "long").add("offset", "long")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        intervals = shared.value
        firsts = {n: np.array([f for f, _, _ in own]) for n, own in intervals.items()}
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                own = np.nonzero(length == n)[0]
                which = np.searchsorted(firsts[int(n)], rank[own], side="right") - 1
                for k in np.unique(which):
                    first, base, offsets = intervals[int(n)][k]
                    rows_k = own[which == k]
                    step = rank[rows_k] - first
                    sequence[rows_k] = base + step // len(offsets)
                    offset[rows_k] = np.array(offsets)[step % len(offsets)]
            kept = [batch.column(c) for c in columns[:5]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=columns)

    return rows.select(*columns[:5], "rank").mapInArrow(place, schema)

