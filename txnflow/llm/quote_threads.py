"""Quotation linking: conversations in reply order, without their quotes.

A line's quote level is the number of `>` it starts with. A passage is a line
without its marks, white space collapsed, in lower case. A quoted passage links
to the first message of its conversation that has it unquoted, if that came
before. A message replies to the message to which most of its passages of level
1 link (ties: the latest). Messages that reply to none begin threads.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txnflow.llm.common import column, fresh, written

MARKS = r"^[ \t]*(?:>[ \t]*)+"
# The line that mail programs put before a quote, in four languages.
ATTRIBUTION = r"^[ \t]*(?:On|Am|Le|El) .*(?:wrote|schrieb.*|a écrit|escribió)[ \t]*:[ \t\r]*$"
SPACES = r"[\x20\x09-\x0D]+"
#: Turns that one task ranks at a time; a thread of any length is ranked slice by slice.
SLICE = 1024


def level(line: Column) -> Column:
    """Quote level of a line; 0 for lines of the writer's own."""
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), "[^>]", ""))


def passage(line: Column) -> Column:
    """A line as it is compared: without marks, white space collapsed, lower-cased."""
    bare = F.regexp_replace(line, MARKS, "")
    return F.lower(F.trim(F.regexp_replace(bare, SPACES, " ")))


def body(text: Column) -> Column:
    """A text without quoted and attribution lines, and without blank lines around what is left."""
    own = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: (level(x) == 0) & ~x.rlike(ATTRIBUTION))
    return F.regexp_replace(F.array_join(own, "\n"), r"^(?:[\x20\x09-\x0D]*\n)+|[\x20\x09-\x0D]+$", "")


def _parents(messages: DataFrame, conv: str, turn: str, text: str) -> DataFrame:
    """(conv, turn, parent, n_linked): each message that links to others, and whom it replies to."""
    lines = messages.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    read = lines.select("conv", "turn", "line_no", level(F.col("line")).alias("level"), passage(F.col("line")).alias("passage"))
    read = read.where((F.col("passage") != "") & F.col("conv").isNotNull() & F.col("turn").isNotNull())
    read = read.withColumn("hash", F.xxhash64("passage"))
    key = ["conv", "hash", "passage"]
    origins = read.where("level = 0").groupBy(*key).agg(F.min("turn").alias("origin"))
    quotes = read.where("level > 0").distinct()
    linked = quotes.join(origins, key).where("origin < turn")
    votes = linked.groupBy("conv", "turn", "origin").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("level") == 1, 1)).alias("direct")
    )
    best = F.max(F.when(F.col("direct") > 0, F.struct("direct", "origin")))["origin"]
    return votes.groupBy("conv", "turn").agg(best.alias("parent"), F.sum("n").alias("n_linked"))


def _roots(parents: DataFrame) -> DataFrame:
    """(conv, turn, root, depth) of messages that reply; paths double with each round, so a chain of n takes log n."""
    path = parents.where("parent IS NOT NULL").select("conv", "turn", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth"))
    path = written(path, "replies")
    while True:
        further = path.select("conv", F.col("turn").alias("root"), F.col("root").alias("above"), F.col("depth").alias("more"))
        longer = path.join(further, ["conv", "root"], "left")
        step = longer.select(
            "conv",
            "turn",
            F.coalesce("above", "root").alias("root"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.col("above").isNotNull().alias("moved"),
        )
        step = written(step, "replies")
        path = step.drop("moved")
        if step.where("moved").isEmpty():
            return path


def _numbered(rows: DataFrame, group: list[str], part: str, turn: str, others: list[Column], kept: list[str], place: str, before: str) -> DataFrame:
    """`rows` with `place`, a row's number in its group by turn and `others`, from 0, and `before`, the turn before its own.

    A group of any length is ranked part by part; only one row for each part goes on to the next.
    """
    inside = Window.partitionBy(*group, part).orderBy(turn, *others)
    lower = Window.partitionBy(*group, part).orderBy(turn).rangeBetween(Window.unboundedPreceding, -1)
    ranked = rows.withColumn(place, F.row_number().over(inside) - 1).withColumn(before, F.max(turn).over(lower))
    sizes = rows.groupBy(*group, part).agg(F.count(F.lit(1)).alias("own"), F.max(turn).alias("top"))
    earlier = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.coalesce(F.sum("own").over(earlier), F.lit(0)), F.max("top").over(earlier)]
    keys = [*group, part]
    names = [fresh([*kept, *rows.columns, place, before], f"size_{i}") for i in range(len(keys) + 2)]
    sizes = sizes.select(*(F.col(c).alias(n) for c, n in zip(keys, names)), *(c.alias(n) for c, n in zip(carried, names[len(keys) :])))
    on = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(n)) for c, n in zip(keys, names)))
    number, top = names[len(keys) :]
    found = ranked.join(sizes, on, "left")
    return found.withColumns({place: (F.col(place) + F.col(number)).cast("long"), before: F.coalesce(before, top)}).drop(*names)


def link_quotes(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """`messages` without repeated rows, and a struct `thread` (in place of a column so named).

    Fields: parent_turn, thread_turn (where the thread began), depth, position
    (from 0, by turn in the thread), n_quote_lines, n_linked, body, follows_turn
    and place. Reading by thread_turn and position puts every reply after what it
    replies to. A message without a link follows the turn before it in its
    conversation: follows_turn is parent_turn or else that turn, null for a
    conversation's first, and place numbers the rows of a whole conversation. Rows of
    one conversation and turn count as one message for links, and each has its
    own body; a row without conversation or turn links with nothing and is its
    own thread; a null text has no lines. Repeated rows count once; columns that
    hold maps do not tell rows apart. Built-in functions only.
    """
    keep = [c for c in messages.columns if c.lower() != "thread"]
    comparable = [c for c in keep if "map<" not in messages.schema[c].dataType.simpleString()]
    rows = messages.select(*map(column, keep)).dropDuplicates(comparable)
    parents = written(_parents(rows, conv, turn, text), "parents")
    roots = _roots(parents)
    names = {n: fresh(keep, n) for n in ("parent", "n_linked", "root", "depth", "slice", "position", "lower", "place", "before")}
    links = parents.join(roots, ["conv", "turn"], "left")
    links = links.select(F.col("conv").alias(fresh(keep, "link_conv")), F.col("turn").alias(fresh(keep, "link_turn")), *(F.col(c).alias(names[c]) for c in ("parent", "n_linked", "root", "depth")))
    same = (F.col(conv) == F.col(links.columns[0])) & (F.col(turn) == F.col(links.columns[1]))
    found = rows.join(links, same, "left").drop(*links.columns[:2])
    found = found.withColumn(names["root"], F.coalesce(names["root"], turn)).withColumn(names["slice"], F.floor(F.col(turn) / SLICE))
    others = [column(c) for c in comparable if c not in (conv, turn)]
    placed = _numbered(found, [conv], names["slice"], turn, others, keep, names["place"], names["before"])
    placed = _numbered(placed, [conv, names["root"]], names["slice"], turn, others, keep, names["position"], names["lower"])
    quoted = F.filter(F.split(text, "\n"), lambda x: (level(x) > 0) & (passage(x) != ""))
    result = F.struct(
        F.col(names["parent"]).alias("parent_turn"),
        F.col(names["root"]).alias("thread_turn"),
        F.coalesce(names["depth"], F.lit(0)).cast("long").alias("depth"),
        F.col(names["position"]).alias("position"),
        F.coalesce(F.size(quoted), F.lit(0)).cast("long").alias("n_quote_lines"),
        F.coalesce(names["n_linked"], F.lit(0)).cast("long").alias("n_linked"),
        body(F.col(text)).alias("body"),
        F.when(F.col(conv).isNotNull(), F.coalesce(names["parent"], names["before"])).alias("follows_turn"),
        F.col(names["place"]).alias("place"),
    )
    return placed.select(*map(column, keep), result.alias("thread"))
