import re

import duckdb
import pytest

from txnflow.llm import quote_threads
from txnflow.llm.queries import CHECK_SQL, QUERIES
from txnflow.llm.quote_threads import link_quotes

MESSAGES = [
    (1, 0, "user", "Hello there, all.\nShall we MEET   at noon?\n"),
    (1, 1, "assistant", "> Shall we meet at noon?\nYes, gladly."),
    (1, 2, "user", "On Monday, Bob wrote:\n>> shall we meet at noon?\n> Yes, gladly.\n>\n> unknown words\n\nFine.\nSee you."),
    (1, 3, "user", "> Hello there, all.\nHi!"),
    (1, 4, "user", "> > Yes, gladly.\nonly deep"),
    (1, 5, "user", "> Hi!\n> Fine.\n>See you.\n\n\n  > Hello there, all.\nme too"),
    (1, 6, "user", "> Hi!\n> Fine.\ntie"),
    (2, 0, "user", "> Yes, gladly.\nanother conversation"),
    (2, 1, "user", None),
    (2, 2, "user", ""),
    (2, 3, None, "same\nsame"),
    (2, 4, "user", "> same\n>same"),
    (None, 1, "user", "Hello"),
    (None, 2, "user", "> Hello"),
    (3, None, "user", "Hello"),
    (3, 5, "user", "> Hello\n> not before\nok"),
    (3, 6, "user", "not before"),
    (4, 0, "user", "a\r\nb"),
    (4, 1, "user", "> a\r\n> b \r\nc\r"),
    (5, 0, "user", "first"),
    (5, 0, "user", "second"),
    (5, 1, "user", "> second\nthird"),
]
CHAIN = [(9, 0, "user", "m0")] + [(9, i, "user", f"> m{i - 1}\nm{i}") for i in range(1, 40)]
SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Each distinct row with its thread, message by message."""
    rows = list(dict.fromkeys(rows))

    def lines(text):
        for x in (text or "").split("\n") if text is not None else []:
            marks = re.match(r"[ \t]*(?:>[ \t]*)+", x)
            bare = x[marks.end() :] if marks else x
            yield (marks[0].count(">") if marks else 0), re.sub(r"[\x20\x09-\x0D]+", " ", bare).strip(" ").lower(), x

    parent, linked = {}, {}
    for conv, turn, _, _ in rows:
        if conv is None or turn is None:
            continue
        votes, quotes = {}, set()
        for c, t, _, text in rows:
            if (c, t) == (conv, turn):
                quotes |= {(i, n, p) for i, (n, p, _) in enumerate(lines(text)) if n and p}
        for _, n, p in quotes:
            origins = [t for c, t, _, text in rows if c == conv and t is not None and any(m == 0 and q == p for m, q, _ in lines(text))]
            if origins and min(origins) < turn:
                linked[conv, turn] = linked.get((conv, turn), 0) + 1
                if n == 1:
                    votes[min(origins)] = votes.get(min(origins), 0) + 1
        linked[conv, turn] = linked.get((conv, turn), 0)
        if votes:
            parent[conv, turn] = max(votes, key=lambda t: (votes[t], t))
        linked[conv, turn] = len({(i, n, p) for i, n, p in quotes if (o := [t for c, t, _, x in rows if c == conv and t is not None and any(m == 0 and q == p for m, q, _ in lines(x))]) and min(o) < turn})
    out = []
    for conv, turn, role, text in rows:
        root, depth = turn, 0
        while (conv, root) in parent:
            root, depth = parent[conv, root], depth + 1
        own = [x for n, _, x in lines(text) if not n and not re.match(quote_threads.ATTRIBUTION, x)]
        kept = re.sub(r"^(?:[\x20\x09-\x0D]*\n)+|[\x20\x09-\x0D]+\Z", "", "\n".join(own))
        out.append([conv, turn, role, parent.get((conv, turn)), root, depth, text, sum(n > 0 and p != "" for n, p, _ in lines(text)), linked.get((conv, turn), 0), kept])
    none = lambda x: (x is not None, x if x is not None else 0)
    text = lambda x: (x is not None, x or "")
    for row in out:
        before = [r for r in out if r[0] == row[0] and r[4] == row[4] and (none(r[1]), text(r[2]), text(r[6])) < (none(row[1]), text(row[2]), text(row[6]))]
        row.append(len(before))
        turns = [r[1] for r in out if r[0] == row[0] is not None and None not in (r[1], row[1]) and r[1] < row[1]]
        row.append(row[3] if row[3] is not None else max(turns, default=None))
        place = lambda r: (none(r[1]), text(r[2]), text(r[6]))
        row.append(sum(r[0] == row[0] and place(r) < place(row) for r in out))
    return sorted(((*r[:6], r[10], *r[7:10], *r[11:]) for r in out), key=repr)


FIELDS = ("parent_turn", "thread_turn", "depth", "position", "n_quote_lines", "n_linked", "body", "follows_turn", "place")


@pytest.mark.parametrize("size", [1024, 3])
def test_small_cases(spark, monkeypatch, size):
    monkeypatch.setattr(quote_threads, "SLICE", size)
    rows = MESSAGES + CHAIN
    frame = spark.createDataFrame(rows + rows[:3], SCHEMA)
    got = link_quotes(frame).collect()
    assert sorted(((r.conv_id, r.turn, r.role, *(r.thread[f] for f in FIELDS)) for r in got), key=repr) == brute(rows)
    found = {(r.conv_id, r.turn): r.thread for r in got}
    assert [found[1, t].parent_turn for t in range(7)] == [None, 0, 1, 0, None, 2, 3]
    assert [found[1, t].follows_turn for t in range(7)] == [None, 0, 1, 0, 3, 2, 3] and found[1, 6].place == 6
    assert found[1, 2].body == "Fine.\nSee you." and found[9, 39].depth == 39 and found[9, 39].position == 39


def compare(spark, connection, frame):
    relation = connection.sql(CHECK_SQL["op9_chat_formatting"])
    assert relation.columns == frame.columns
    assert sorted(map(tuple, frame.collect()), key=repr) == sorted(relation.fetchall(), key=repr)


def test_query_equals_sql(spark, sf_dir):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
    compare(spark, connection, QUERIES["op9_chat_formatting"](spark, sf_dir))


def test_sql_equals_small_cases(spark):
    rows = [r for r in MESSAGES + CHAIN if r[0] is not None and r[1] is not None]
    connection = duckdb.connect()
    connection.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    connection.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    compare(spark, connection, link_quotes(spark.createDataFrame(rows, SCHEMA)).select("conv_id", "turn", "role", "thread.*"))


def test_a_conversation_without_quotes_runs_through(spark, monkeypatch):
    monkeypatch.setattr(quote_threads, "SLICE", 4)
    rows = [(1, 3 * t, "user", f"message {t}") for t in range(40)] + [(None, 1, "user", "alone"), (2, None, "user", "alone")]
    found = {(r.conv_id, r.turn): r.thread for r in link_quotes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [found[1, 3 * t].follows_turn for t in range(40)] == [None, *range(0, 117, 3)]
    assert [found[1, 3 * t].place for t in range(40)] == list(range(40))
    assert found[None, 1].follows_turn is None and found[2, None].follows_turn is None


def test_query_orders_whole_conversations(spark, sf_dir):
    found = QUERIES["op9_chat_formatting"](spark, sf_dir).collect()
    by_conversation = {}
    for r in sorted(found, key=lambda r: (r.conv_id, r.place)):
        by_conversation.setdefault(r.conv_id, []).append(r)
    assert len(found) > len(by_conversation) > 1
    for rows in by_conversation.values():
        assert [r.place for r in rows] == list(range(len(rows)))
        turns = sorted({r.turn for r in rows})
        assert all(r.follows_turn == max((t for t in turns if t < r.turn), default=None) for r in rows if r.parent_turn is None)


def test_other_columns_and_empty_table(spark):
    frame = spark.createDataFrame([(1, 0, "user", "x", 5, "k")], SCHEMA + ", THREAD int, parent string")
    assert link_quotes(frame).columns == ["conv_id", "turn", "role", "text", "parent", "thread"]
    assert link_quotes(frame).collect()[0].parent == "k"
    assert link_quotes(frame.limit(0)).count() == 0


def test_long_message_and_native_plan(spark):
    long = "\n".join(f"line {i}" for i in range(20_000))
    frame = spark.createDataFrame([(1, 0, "u", long), (1, 1, "u", "> " + long.replace("\n", "\n> "))], SCHEMA)
    found = link_quotes(frame)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert {r.turn: (r.thread.n_linked, r.thread.parent_turn) for r in found.collect()} == {0: (0, None), 1: (20_000, 0)}
