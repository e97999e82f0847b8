"""Conversation structure repair by a dynamic program with checkpoints at square-root distance.

A conversation should read `(s?(ua)+)?` by the initials of its roles: nothing,
or an optional system turn and then pairs of user and assistant. Rows may be
kept, given another role, deleted, and empty turns inserted; the cheapest edits
are wanted, and of equally cheap ones those whose initials come first.

An automaton of four states reads the repaired roles. A vector holds for each
state what the rest of the conversation costs from there. Vectors are computed
from the end backward, but stored only at every so many rows; then the rows are
walked forward, the vectors of one block at a time computed again from the
checkpoint behind it, and at each step the first edit is taken that is tight,
which is one after which the rest costs just so much less.

Conversations of up to `ROWS` rows and `BYTES` bytes are repaired by one task
each, with the root of their rows as distance. The rows of larger ones are sorted by range; many
tasks find the least costs between the states of each block, products of these
give the checkpoints, and the walk is a stream that holds one block. The walk of
one conversation stays in order, as the hash of what it yields does.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnflow.llm.common import column, prepare, written

RETYPE, DELETE, INSERT, TRUNCATED_COST = 2, 3, 2, 1
#: States: nothing read, the system turn, a user's turn, an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after the one turn that may be inserted or made by a new role, and the initial that may be kept and its state.
NEXT = (USER, USER, ASSISTANT, USER)
KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: A row's kind is the place of its initial in `INITIALS`, 4 more if its text is truncated, or one of those that must go.
INITIALS, BLANK, DUPLICATE = "sua?", 8, 9
#: Rows and bytes up to which a conversation is one task's; beyond, it is walked in blocks of 2**BLOCK_BITS rows at most.
ROWS, BYTES, BLOCK_BITS = 8192, 1 << 25, 10
_SPACE, _NEVER = " \t\n\x0b\x0c\r", 1 << 60

Vector = tuple[int, int, int, int]


def kind_of(role: str, text: str) -> int:
    """The kind of a row that repeats none before it."""
    said = text.rstrip(_SPACE)
    if not said:
        return BLANK
    return max(0, INITIALS.find(role[0]) if role and role[0] in "sua" else 3) + (0 if said[-1] in ".!?" else 4)


def settled(costs: tuple[int, ...]) -> Vector:
    """Costs where turns may be inserted before what `costs` are of."""
    start, system, user, assistant = costs
    user, assistant = min(user, INSERT + assistant), min(assistant, INSERT + user)
    return min(start, INSERT + user), min(system, INSERT + user), user, assistant


#: What it costs to end from each state.
END = settled((0, _NEVER, _NEVER, 0))


def _kept(state: int, kind: int) -> int | None:
    return KEPT[state].get(INITIALS[kind & 3])


def before(kind: int, after: Vector) -> Vector:
    """The costs before a row from those after it."""
    if kind >= BLANK:
        return settled(tuple(DELETE + c for c in after))
    more = TRUNCATED_COST * (kind >> 2)
    costs = []
    for state in range(4):
        kept = _kept(state, kind)
        cost = min(DELETE + after[state], more + RETYPE + after[NEXT[state]])
        costs.append(cost if kept is None else min(cost, more + after[kept]))
    return settled(tuple(costs))


def between(kinds: list[int]) -> list[Vector]:
    """For each state after the rows the least costs to it from each state before them."""
    found = []
    for goal in range(4):
        costs: Vector = tuple(0 if s == goal else _NEVER for s in range(4))
        for kind in reversed(kinds):
            costs = before(kind, costs)
        found.append(costs)
    return found


class Walk:
    """One conversation, repaired block by block, and what is counted on the way."""

    def __init__(self):
        self.state, self.cost, self.place, self.rows = START, 0, 0, 0
        self.faults = {BLANK: 0, DUPLICATE: 0, 4: 0}
        self.illegal, self.initial = 0, None
        self.first_turn = self.last_turn = None
        self.turns = 0
        self.audit: list[str] = []
        self.hash, self.lines = hashlib.sha256(), 0

    def _see(self, kind: int, turn: int | None, role: str) -> None:
        self.rows += 1
        self.faults[kind if kind >= BLANK else 4] += kind >= 4
        if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = role[:1]
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
            self.turns += 1

    def _put(self, edit: str, turn: int | None, role: str, text: str) -> tuple:
        self.audit.append(edit)
        if edit != "D":
            self.hash.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
            self.lines += 1
        self.place += 1
        return self.place - 1, edit, turn, role, text

    def _inserted(self) -> tuple:
        self.cost += INSERT
        self.state = NEXT[self.state]
        return self._put("I", None, ROLE[self.state], "")

    def block(self, rows: list[tuple], kinds: list[int], after: Vector) -> Iterator[tuple]:
        """The edits (place, edit, turn, role, text) of rows (turn, role, text), where the rest costs `after`."""
        costs = [after]
        for kind in reversed(kinds):
            costs.append(before(kind, costs[-1]))
        for (turn, role, text), kind in zip(rows, kinds):
            self._see(kind, turn, role)
            here, rest = costs.pop(), costs[-1]
            more = TRUNCATED_COST * (4 <= kind < BLANK)
            while True:
                state, least = self.state, here[self.state]
                if DELETE + rest[state] == least:
                    self.cost += DELETE
                    yield self._put("D", turn, role, text)
                    break
                if INSERT + here[NEXT[state]] == least:
                    yield self._inserted()
                    continue
                kept = _kept(state, kind)
                if kept is not None and more + rest[kept] == least:
                    self.cost, self.state = self.cost + more, kept
                    yield self._put("K", turn, role, text)
                else:
                    self.cost, self.state = self.cost + more + RETYPE, NEXT[state]
                    yield self._put("R", turn, ROLE[self.state], text)
                break

    def whole(self, rows: list[tuple], kinds: list[int]) -> Iterator[tuple]:
        """The edits of a whole conversation, with checkpoints at every root of its rows."""
        step = math.isqrt(len(kinds)) + 1
        checkpoints, costs = [END], END
        for at in range(len(kinds) - 1, -1, -1):
            costs = before(kinds[at], costs)
            if at % step == 0:
                checkpoints.append(costs)
        for at in range(0, len(kinds), step):
            checkpoints.pop()
            yield from self.block(rows[at : at + step], kinds[at : at + step], checkpoints[-1])

    def ended(self) -> Iterator[tuple]:
        while END[self.state]:
            yield self._inserted()

    def summary(self) -> tuple:
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        faults = (self.faults[BLANK], self.faults[DUPLICATE], self.faults[4])
        return gaps, *faults, self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest()


EDITS = ("place long", "edit string", "turn long", "role string", "text string")
SUMMARY = ("gaps long", "blank long", "duplicate long", "truncated long", "illegal long", "cost long", "audit string", "repaired_sha256 string")


def _walked(units: Iterator[tuple], summaries: bool, kind) -> Iterator[pa.RecordBatch]:
    """Batches of results. A unit is (conversation, its rows, kinds, what follows); None stands for a whole one."""
    fields = SUMMARY if summaries else EDITS
    types = [kind, *(pa.string() if f.endswith("string") else pa.int64() for f in fields)]
    names = ["conv_id", *(f.split()[0] for f in fields)]
    out: list[tuple] = []
    weight = 0

    def batch() -> pa.RecordBatch:
        columns = [pa.array([row[k] for row in out], t) for k, t in enumerate(types)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    walk, of = None, None
    for key, name, rows, kinds, after in units:
        if walk is None or key != of:
            walk, of = Walk(), key
        steps = walk.whole(rows, kinds) if after is None else walk.block(rows, kinds, after)
        last = after is None or after == "last"
        if after == "last":
            steps = walk.block(rows, kinds, END)
        for found in (steps, walk.ended() if last else ()):
            for edit in found:
                if not summaries:
                    out.append((name, *edit))
                    weight += len(edit[-1])
                    if len(out) >= 1000 or weight > 1 << 22:
                        yield batch()
                        out, weight = [], 0
        if last and summaries:
            out.append((name, *walk.summary()))
            weight += len(out[-1][-2])
        if len(out) >= 1000 or weight > 1 << 22:
            yield batch()
            out, weight = [], 0
    if out:
        yield batch()


def _order(df: DataFrame) -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()]


def _small(rows: DataFrame, summaries: bool, schema: str) -> DataFrame:
    """Conversations that fit a task each, read in order of their rows."""

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        number, name, own = 0, None, []

        def unit():
            seen, kinds = set(), []
            for _, role, text in own:
                kinds.append(DUPLICATE if (role, text) in seen and text.strip(_SPACE) else kind_of(role, text))
                seen.add((role, text))
            return number, name, own, kinds, None

        for batch in batches:
            for conv, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if own and conv != name:
                    yield unit()
                    number, own = number + 1, []
                name = conv
                own.append(tuple(row))
        if own:
            yield unit()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None

        def typed():
            nonlocal kind
            for batch in batches:
                kind = batch.schema.types[0]
                yield batch

        stream = typed()
        first = next(stream, None)
        if first is not None:
            yield from _walked(units(_again(first, stream)), summaries, kind)

    return rows.repartition("conv_id").sortWithinPartitions(*_order(rows)).mapInArrow(run, schema)


def _again(first, rest):
    yield first
    yield from rest


def _large(rows: DataFrame, summaries: bool, schema: str) -> DataFrame:
    """Conversations in blocks: least costs of each block, checkpoints behind them, and the walk as a stream."""
    names = ["large", "conv_id", "turn", "role", "text"]

    def add_kinds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = [kind_of(r, t) for r, t in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(kinds, pa.int32())], names=[*batch.schema.names, "kind"])

    tie = rows.withColumn("tie", F.monotonically_increasing_id())
    order = ["large", F.col("turn").asc_nulls_first(), "role", "text", "tie"]
    dealt = tie.repartitionByRange(*order).sortWithinPartitions(*order).select(*names)
    fields = T.StructType([*dealt.schema.fields, T.StructField("kind", T.IntegerType())])
    # The ids rise in the order of the rows, over all tasks.
    sorted_rows = written(dealt.mapInArrow(add_kinds, fields).withColumn("at", F.monotonically_increasing_id()), "turns")
    coded = sorted_rows.withColumn("code", F.xxhash64("role", "text")).withColumn("block", F.shiftright("at", BLOCK_BITS))
    firsts = coded.where(F.col("kind") != BLANK).groupBy("large", "code").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("times"))
    firsts = firsts.where("times > 1").select("large", "code", "first")
    repeats = (F.col("kind") != BLANK) & (F.col("at") > F.coalesce("first", F.col("at")))
    coded = coded.join(firsts, ["large", "code"], "left").withColumn("kind", F.when(repeats, DUPLICATE).otherwise(F.col("kind")))
    kinds = written(coded.select("large", "block", "at", "kind"), "kinds")

    def costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks():
            own, key = [], None
            for batch in batches:
                for *here, kind in zip(*(batch.column(c).to_pylist() for c in ("large", "block", "kind"))):
                    if own and here != key:
                        yield *key, own
                        own = []
                    key = here
                    own.append(kind)
            if own:
                yield *key, own

        for large, block, own in blocks():
            flat = [min(c, _NEVER) for goal in between(own) for c in goal]
            columns = [pa.array([large], pa.int64()), pa.array([block], pa.int64()), pa.array([flat], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["large", "block", "least"])

    keys = ["large", "block"]
    least = kinds.repartition(*keys).sortWithinPartitions(*keys, "at").mapInArrow(costs, "large long, block long, least array<long>")

    def chain(blocks: pd.DataFrame) -> pd.DataFrame:
        """What follows each block, from the last one backward; nothing for the last."""
        blocks = blocks.sort_values("block", ascending=False)
        after, follows = END, []
        for k, least in enumerate(blocks["least"]):
            follows.append(None if k == 0 else list(after))
            after = tuple(min(int(least[4 * goal + s]) + after[goal] for goal in range(4)) for s in range(4))
        return blocks[["large", "block"]].assign(follows=follows)

    # One row of 16 costs for each block of a conversation.
    follows = written(least.groupBy("large").applyInPandas(chain, "large long, block long, follows array<long>"), "checkpoints")
    rows = sorted_rows.withColumn("block", F.shiftright("at", BLOCK_BITS)).drop("kind")
    rows = rows.join(kinds, ["large", "block", "at"]).join(follows, ["large", "block"])
    rows = rows.select("large", "block", "at", "conv_id", "turn", "role", "text", "kind", "follows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return

        def units():
            own, kinds, key, name, after = [], [], None, None, None
            for batch in _again(first, batches):
                for large, block, _, conv, turn, role, text, kind, follows in zip(*(c.to_pylist() for c in batch.columns)):
                    if own and (large, block) != key:
                        yield key[0], name, own, kinds, after
                        own, kinds = [], []
                    key, name, after = (large, block), conv, "last" if follows is None else tuple(follows)
                    own.append((turn, role, text))
                    kinds.append(kind)
            if own:
                yield key[0], name, own, kinds, after

        yield from _walked(units(), summaries, first.column("conv_id").type)

    return rows.repartition("large").sortWithinPartitions("large", "at").mapInArrow(run, schema)


def _repaired(messages: DataFrame, names: tuple[str, str, str, str], summaries: bool) -> DataFrame:
    prepare(messages.sparkSession)
    conv, turn, role, text = map(column, names)
    said = [F.coalesce(c.cast("string"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))]
    rows = messages.select(conv.alias("conv_id"), turn.cast("long").alias("turn"), *said)
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, " + ", ".join(SUMMARY if summaries else EDITS)
    counts = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("text")).alias("bytes"))
    large = counts.where((F.col("rows") > ROWS) | (F.col("bytes") > BYTES)).select(F.col("conv_id").alias("of"))
    large = written(large.withColumn("large", F.monotonically_increasing_id()), "large")
    if large.isEmpty():
        return _small(rows, summaries, schema)
    same = F.col("conv_id").eqNullSafe(F.col("of"))
    few = _small(rows.join(large, same, "left_anti"), summaries, schema)
    return few.unionByName(_large(rows.join(large, same).drop("of"), summaries, schema))


def repair(messages: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """All edits of all conversations, in their order: conv_id, place, edit, turn, role, text.

    `edit` is K (kept), R (a new role), D (deleted: not part of the repaired
    conversation) or I (inserted, without turn and text); `place` counts the
    edits of a conversation from 0, `role` is the repaired one.

    Rows are taken by turn (nulls first), rows of one turn by role and text. A
    null role or text stands as one space; a text without any but spaces is
    blank. Rows that repeat role and text of an earlier one are deleted, as are
    blank ones. A null conv_id is a conversation as any other. Rows without a
    known role can only be deleted or get one. Other columns are left out; an
    empty table gives an empty table.
    """
    return _repaired(messages, (conv_id, turn, role, text), False)


def audit(messages: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each conversation, about the edits of `repair`: conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit, repaired_sha256.

    `gaps` are turns that lack between the first and the last, null turns
    ignored; then the rows by their first fault; `illegal` are neighbours whose
    roles do not follow one another; `audit` has the initials of all edits, and
    the hash is that of the lines `role:text` of the repaired conversation.
    """
    return _repaired(messages, (conv_id, turn, role, text), True)


def damaged(messages: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text) with planted damage, told by the crc32 of `conv_id:turn` modulo 20.

    0 drops a row, 1 empties its text, 2 takes its sentence ends away, 3 repeats
    it, 4 makes its role user. Nulls stand as one space, but for ids and turns
    that are returned.
    """
    said = [F.coalesce(column(c).cast("string"), F.lit(" ")) for c in (conv_id, turn, role, text)]
    fate = F.crc32(F.concat(said[0], F.lit(":"), said[1])) % 20
    texts = F.when(fate == 1, "").when(fate == 2, F.translate(said[3], ".!?", "")).otherwise(said[3])
    rows = messages.select(
        column(conv_id).alias("conv_id"),
        column(turn).alias("turn"),
        F.when(fate == 4, "user").otherwise(said[2]).alias("role"),
        texts.alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1))),
    )
    return rows.drop("col")
