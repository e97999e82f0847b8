import hashlib
import heapq
import re
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from txnflow.llm import conversation_repair as cr
from txnflow.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]")


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(key.encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def plain_repair(rows):
    """The summary of one conversation's rows (turn, role, text): cheapest edits by a search over whole edit strings."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults, seen = [], set()
    for _, role, text in rows:
        said = WORD.findall(text)
        faults.append("" if said else "blank")
        if said and (role, text) in seen:
            faults[-1] = "duplicate"
        elif said and said[-1] not in ".!?":
            faults[-1] = "truncated"
        seen.add((role, text))
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    heap, done = [(0, "", 0, "", ())], set()
    while True:  # edit strings in order of cost, then of their letters
        cost, edits, at, last, made = heapq.heappop(heap)
        if at == len(rows) and last in ("", "a"):
            break
        if (at, last) in done:
            continue
        done.add((at, last))
        for new in follow[last]:
            if new != "s":
                name = {"u": "user", "a": "assistant"}[new]
                heapq.heappush(heap, (cost + 2, edits + "I", at, new, (*made, f"{name}:")))
        if at < len(rows):
            _, role, text = rows[at]
            heapq.heappush(heap, (cost + 3, edits + "D", at + 1, last, made))
            if faults[at] not in ("blank", "duplicate"):
                more = faults[at] == "truncated"
                for new in follow[last]:
                    if role[:1] == new:
                        heapq.heappush(heap, (cost + more, edits + "K", at + 1, new, (*made, f"{role}:{text}")))
                    if new != "s":
                        name = {"u": "user", "a": "assistant"}[new]
                        heapq.heappush(heap, (cost + more + 2, edits + "R", at + 1, new, (*made, f"{name}:{text}")))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, edits, hashlib.sha256("\n".join(made).encode()).hexdigest())


def plain(rows):
    by = defaultdict(list)
    for conv, *row in rows:
        by[conv].append(tuple(row))
    return {conv: plain_repair(own) for conv, own in by.items()}


texts = st.sampled_from(["Yes.", "no", " ", "", "ok? ", "Why!\n", "a b"])
roles = st.sampled_from(["user", "assistant", "system", "tool", "", "a", "U"])
messages = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 9)), roles, texts), max_size=9)


@settings(max_examples=400, deadline=None)
@given(messages, st.integers(1, 4))
def test_walk_is_the_cheapest_and_first(rows, block):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, kinds = set(), []
    for _, role, text in rows:
        kinds.append(cr.DUPLICATE if (role, text) in seen and text.strip() else cr.kind_of(role, text))
        seen.add((role, text))
    want = plain_repair(rows)
    walk = cr.Walk()
    edits = [*walk.whole(rows, kinds), *walk.ended()]
    assert walk.summary() == want
    assert "".join(e[1] for e in edits) == want[6] and [e[0] for e in edits] == list(range(len(edits)))
    # The same from checkpoints that products of the blocks' costs give.
    parts = [kinds[k : k + block] for k in range(0, len(kinds), block)]
    after = [cr.END]
    for part in reversed(parts):
        least = cr.between(part)
        after.append(tuple(min(least[g][s] + after[-1][g] for g in range(4)) for s in range(4)))
    walk = cr.Walk()
    for k, part in enumerate(parts):
        list(walk.block(rows[k * block : k * block + block], part, after[len(parts) - 1 - k]))
    list(walk.ended())
    assert walk.summary() == want


def found(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_plain_search(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = dict.fromkeys((r[0] for r in rows), plain_repair([])) | plain(plain_damage(rows))
    got = QUERIES["op13_conversation_repair"](spark, f"/root/testdata/{sf}")
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert got.count() == len(want) and found(got) == want


def odd_rows():
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (1, None, "user", "A."), (1, 3, "user", "A."), (1, 3, "assistant", "B"), (2, 5, "", "x" * 200_000)]
    rows += [(3, k % 7 if k % 5 else None, ("user", "assistant", "system", "tool")[k * k % 4], f"text {k % 11}" + "." * (k % 2)) for k in range(300)]
    rows += [(4, 1, "user", "Same.")] * 150 + [(4, 2, "assistant", "Same.")] * 3
    return rows


def test_large_conversations_equal_small_ones(spark, monkeypatch):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, {"a": 1}) for r in rows], "`c.id` long, turn long, role string, text string, place map<string,int>")
    want = plain([(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows])
    assert found(cr.audit(df, "c.id")) == want
    for limit, size in ((100, 3), (0, 4)):
        monkeypatch.setattr(cr, "ROWS", limit)
        monkeypatch.setattr(cr, "BLOCK_BITS", size)
        assert found(cr.audit(df, "c.id")) == want
        lines, edits = defaultdict(list), defaultdict(list)
        for r in sorted(cr.repair(df, "c.id").collect(), key=lambda r: r["place"]):
            edits[r["conv_id"]].append(r["edit"])
            assert (r["turn"] is None or r["edit"] != "I") and (r["text"] == "" or r["edit"] != "I")
            if r["edit"] != "D":
                lines[r["conv_id"]].append(f"{r['role']}:{r['text']}")
        for conv, row in want.items():
            assert "".join(edits[conv]) == row[6]
            assert hashlib.sha256("\n".join(lines[conv]).encode()).hexdigest() == row[7]


def test_damage_and_no_rows(spark):
    rows = odd_rows() + [(k, t, "user", "Hello. You? ") for k in range(5, 60) for t in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    key = lambda r: str(r)
    assert sorted(map(tuple, cr.damaged(df).collect()), key=key) == sorted(plain_damage(rows), key=key)
    assert cr.audit(df.limit(0)).collect() == [] and cr.repair(df.limit(0)).collect() == []
    named = spark.createDataFrame([("x", 1, "user", "Hi.")], "conv_id string, turn int, role string, text string")
    assert found(cr.audit(named)) == plain([("x", 1, "user", "Hi.")])
