"""N-gram Jaccard join: prefix join of distinct shingle sets, rare shingles first.

1. Documents of the same shingles are one set from here on; one document stands
   for it.
2. A set is known by marks of its shingles, the lowest ones: all that are below a
   fixed bound, and as many as its prefix at least. Marks are dealt out in sorted,
   packed rows, and counted. Those that only one set has end there; a set gets the
   others back, with how many sets have them.
3. Marks below the bound are ordered by their exact counts, rare ones first, the
   others come after them. A set's prefix is as many of its first marks in that
   order that any set similar enough must share one. Marks of one set only fill
   most prefixes, and such a set is done.
4. Sets with a common prefix mark, neighbours in size, are linked; linked sets
   form blocks.
5. Blocks are verified on whole sets: from each member on, those not reached yet
   are compared, so that a block of n similar members costs some n comparisons, and
   no list of all pairs is ever made. Large blocks are dealt out in chunks, which
   share some pivots; only members that are not in a block's largest component
   after that meet the other chunks.
6. Verified links give components, and these go back to all documents.

Shingles are compared as 64-bit codes. Marks, which are shorter, only decide how
much work is done, never the result: the order holds for all sets alike, and two
shingles of one mark only make more candidates.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txnflow.llm.common import (
    Counts,
    at_places,
    column,
    components,
    fresh,
    from_planes,
    located,
    mixed,
    planes,
    prepare,
    release_shuffles,
    space_words,
    word_codes,
    written,
)

#: Words of a shingle, and the least similarity of a link in percent.
SHINGLE, PERCENT = 5, 80
#: Bits of a shingle's mark, and the bound below which all marks are counted. With four in ten of them, a set of which
#: over half of the shingles are its own fills its prefix with these.
MARK_BITS, COUNTED = 40, (1 << 40) * 2 // 5
#: Marks that one step counts at once, about, and marks of a task that are packed together.
BUCKET_MARKS, PACKED_MARKS = 1 << 20, 1 << 20
#: Shingles that one task verifies at once; larger blocks are dealt out in chunks of about half of it.
BLOCK_SHINGLES = 2_000_000
#: Members of a large block, about, that go to each of its chunks in the first round.
PIVOTS = 64
SET_COLUMNS = ("block", "block_sets", "chunks", "n", "code", "shingles")

_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct codes of a text's shingles; a text of fewer words is one shingle, one without words has none."""
    words = space_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    codes = word_codes(words)
    width = min(SHINGLE, len(codes))
    n = len(codes) - width + 1
    total = np.full(n, width, np.uint64)
    for k in range(width):
        total = mixed(total * _STEP + codes[k : k + n])
    return np.unique(total)


def prefix_size(n: int) -> int:
    """Shingles of which a set of n must share one with any set that is similar enough."""
    return n - -(-n * PERCENT // 100) + 1


def _set_code(codes: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(codes.tobytes()) - (1 << 63)


def marks(codes: np.ndarray) -> np.ndarray:
    """The marks by which a set is known where others are looked for, in order: the counted ones, and its prefix at least."""
    found = np.sort(mixed(codes) >> np.uint64(64 - MARK_BITS))
    return found[: max(prefix_size(len(codes)), int(np.searchsorted(found, np.uint64(COUNTED))))]


def _profiles(docs: DataFrame) -> DataFrame:
    """For each document its size, the code of its set, its marks and those of them beyond its prefix."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(text) for text in batch.column(1).to_pylist()]
            sizes = [len(codes) for codes in sets]
            known = [len(marks(codes)) for codes in sets]
            spare = [m - prefix_size(n) for m, n in zip(known, sizes)]
            made = (sizes, map(_set_code, sets), known, spare)
            columns = [batch.column(0), *batch.columns[2:], *(pa.array(list(x), pa.int64()) for x in made)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "file", "place", "n", "code", "marks", "spare"])

    schema = f"doc_id {kind}, file long, place long, n long, code long, marks long, spare long"
    return docs.select("doc_id", "text", "file", "place").mapInArrow(run, schema)


def packed(found: np.ndarray, places: np.ndarray, file: int, buckets: int) -> Iterator[dict]:
    """Marks and the places of their sets, all of one file, as a row for each bucket of marks."""
    order = np.argsort(found, kind="stable")
    found, places = found[order], places[order]
    first = places.min()
    bucket = (found * np.uint64(buckets)) >> np.uint64(MARK_BITS)
    starts = np.nonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))[0]
    for start, end in zip(starts, [*starts[1:], len(found)]):
        steps = np.diff(found[start:end], prepend=np.uint64(0))
        offsets = (places[start:end] - first).astype(np.uint64)
        row = {"bucket": int(bucket[start]), "file": file, "first": int(first)}
        yield row | {"marks": zlib.compress(planes(steps), 1), "offsets": zlib.compress(planes(offsets), 1)}


def unpacked(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """The marks of a row of `packed`, and the places of their sets."""
    found = np.cumsum(from_planes(zlib.decompress(row["marks"]), np.uint64), dtype=np.uint64)
    return found, from_planes(zlib.decompress(row["offsets"]), np.uint64).astype(np.int64) + row["first"]


def shared_marks(rows: list[dict]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(file, places, marks, times) for each of a bucket's rows: its marks that the bucket has several times.

    Rows stay packed, and are opened one by one, once to count and once to tell.
    """
    counts = Counts(BUCKET_MARKS)
    for row in rows:
        counts.add(*np.unique(unpacked(row)[0], return_counts=True))
    names, times = counts.take()
    names, times = names[times > 1], times[times > 1]
    for row in rows if len(names) else ():
        found, places = unpacked(row)
        at = np.minimum(np.searchsorted(names, found), len(names) - 1)
        several = names[at] == found
        if several.any():
            yield row["file"], places[several], found[several], times[at[several]]


def _shared(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """(file, place, times, mark): the marks of each set that other sets have as well, with how many sets have them."""
    total = sets.agg(F.sum("marks")).first()[0] or 0
    buckets = -(-total // BUCKET_MARKS) or 1

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        fields = [("bucket", pa.int32()), ("file", pa.int64()), ("first", pa.int64()), ("marks", pa.binary()), ("offsets", pa.binary())]
        return pa.RecordBatch.from_pylist(rows, pa.schema(fields))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, waiting, places = None, [], []

        def pack() -> Iterator[pa.RecordBatch]:
            if waiting:
                at = np.repeat(np.array(places, np.int64), [len(x) for x in waiting])
                yield batch_of(list(packed(np.concatenate(waiting), at, here, buckets)))
                waiting.clear()
                places.clear()

        size = 0
        for batch in batches:
            for text, file, place in zip(*(c.to_pylist() for c in batch.columns)):
                if file != here or size > PACKED_MARKS:
                    yield from pack()
                    here, size = file, 0
                waiting.append(marks(shingles(text)))
                places.append(place)
                size += len(waiting[-1])
        yield from pack()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(rows: list[dict]) -> Iterator[pa.RecordBatch]:
            for file, places, found, times in shared_marks(rows):
                columns = (np.full(len(found), file, np.int64), places, times.astype(np.int64), found.view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["file", "place", "times", "mark"])

        rows: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if rows and rows[0]["bucket"] != row["bucket"]:
                    yield from told(rows)
                    rows = []
                rows.append(row)
        yield from told(rows)

    texts = at_places(docs, sets, "file", "place").select("text", "file", "place")
    dealt = texts.mapInArrow(deal, "bucket int, file long, first long, marks binary, offsets binary")
    together = dealt.repartition("bucket").sortWithinPartitions("bucket")
    return together.mapInArrow(count, "file long, place long, times long, mark long")


def _prefixes(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """(code, n, prefix): the marks in a set's prefix that other sets have as well; sets without any are left out."""
    hits = _shared(docs, sets).groupBy("file", "place").agg(F.sort_array(F.collect_list(F.struct("times", "mark"))).alias("hits"))
    # Marks that no other set has come before these.
    room = F.size("hits") - F.col("spare")
    found = hits.join(sets, ["file", "place"]).where(room > 0)
    return found.select("code", "n", F.slice("hits.mark", F.lit(1), room.cast("int")).alias("prefix"))


def _set_links(prefixes: DataFrame) -> DataFrame:
    """Links (a, b) between sets that share a prefix mark and stand next to each other in size.

    Any two sets that share a mark and may be similar are joined by a chain of
    such links, so that there are no more links than prefix marks.
    """
    mark = prefixes.select(F.explode("prefix").alias("mark"), "code", "n")
    order = Window.partitionBy("mark").orderBy("n", "code")
    near = mark.withColumn("before", F.lag("code").over(order)).withColumn("least", F.lag("n").over(order))
    linked = near.where((F.col("before") != F.col("code")) & (F.col("least") * 100 >= F.col("n") * PERCENT))
    return linked.select(F.least("before", "code").alias("a"), F.greatest("before", "code").alias("b")).distinct()


def _members(sets: DataFrame, blocks: DataFrame) -> DataFrame:
    """(block, block_sets, chunks, code, n, file, place): the sets of blocks."""
    blocks = blocks.select(F.col("node").alias("code"), F.col("root").alias("block"))
    blocked = written(sets.select("code", "n", "file", "place").join(blocks, "code"), "blocked")
    sizes = blocked.groupBy("block").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles"))
    whole = F.col("shingles") <= BLOCK_SHINGLES
    chunks = F.when(whole, 1).otherwise(F.ceil(F.col("shingles") / (BLOCK_SHINGLES // 2)))
    sizes = sizes.select("block", F.col("sets").alias("block_sets"), chunks.cast("int").alias("chunks"))
    return written(blocked.join(sizes, "block"), "members")


def _member_sets(docs: DataFrame, members: DataFrame) -> DataFrame:
    """Members with their shingles, from the texts they came from."""
    named = members.select("file", "place", *SET_COLUMNS[:-1])
    texts = at_places(docs, members, "file", "place").join(named, ["file", "place"]).select(*SET_COLUMNS[:-1], "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sets, pa.binary())], names=list(SET_COLUMNS))

    return texts.mapInArrow(run, "block long, block_sets long, chunks int, n long, code long, shingles binary")


def linked_pairs(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that join all sets that are linked by any way, at most one for each set.

    Sets are visited from one to those it is similar to; each is compared with
    the sets that no other has reached before.
    """
    n = len(sets)
    sizes = np.fromiter(map(len, sets), np.int64, n)
    names, codes = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    marked = np.zeros(len(names), bool)
    found: list[tuple[int, int]] = []
    rest = np.arange(n)
    rest_codes, rest_starts = codes, starts
    waiting: list[int] = []
    reached = np.zeros(n, bool)
    order = iter(np.argsort(-sizes, kind="stable"))
    stale = 0
    while True:
        if waiting:
            here = waiting.pop()
        else:
            here = next((int(i) for i in order if not reached[i]), None)
            if here is None:
                return found
            reached[here] = True
            stale += 1
        if stale * 4 > len(rest):  # leave those reached out of what is compared
            rest = rest[~reached[rest]]
            if not len(rest):
                return found
            rest_codes = np.concatenate([codes[starts[i] : starts[i] + sizes[i]] for i in rest])
            rest_starts = np.concatenate([[0], np.cumsum(sizes[rest])[:-1]])
            stale = 0
        own = codes[starts[here] : starts[here] + sizes[here]]
        marked[own] = True
        common = np.add.reduceat(marked[rest_codes].astype(np.int32), rest_starts)
        marked[own] = False
        union = sizes[rest] + sizes[here] - common
        for other in rest[(100 * common >= PERCENT * union) & ~reached[rest]]:
            found.append((here, int(other)))
            reached[other] = True
            stale += 1
            waiting.append(int(other))


def _linked(dealt: DataFrame) -> DataFrame:
    """Links (many, a, b) within the rows of equal (block, i, j); `many` marks blocks of several chunks."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        many = bool(rows["many"].iloc[0])
        rows = rows.drop_duplicates("code")
        codes = rows["code"].to_numpy()
        links = linked_pairs([np.frombuffer(x, np.uint64) for x in rows["shingles"]]) if len(rows) > 1 else []
        found = pd.DataFrame({"a": [codes[i] for i, _ in links], "b": [codes[j] for _, j in links]}, dtype="int64")
        return found.assign(many=many)[["many", "a", "b"]]

    rows = dealt.select("block", "i", "j", (F.col("chunks") > 1).alias("many"), "code", "shingles")
    return rows.groupBy("block", "i", "j").applyInPandas(run, "many boolean, a long, b long")


def _chunk(code: str, chunks: str, seed: int):
    return F.pmod(F.xxhash64(F.lit(seed), code), F.col(chunks)).cast("int")


def _verified(sets: DataFrame, members: DataFrame) -> DataFrame:
    """Verified links (a, b) between set codes that join all sets linked by any way.

    First each member is compared within its chunk, and with the pivots of its
    block. Two members of a block's largest component then need no comparison
    any more: only the others meet all chunks.
    """
    home = F.when(F.col("chunks") > 1, _chunk("code", "chunks", 1)).otherwise(0)
    one_in = F.greatest(F.lit(1).cast("long"), F.floor(F.col("block_sets") / PIVOTS))
    pivot = (F.col("chunks") > 1) & (F.pmod(F.xxhash64(F.lit(2), "code"), one_in) == 0)
    everywhere = F.sequence(F.lit(0), F.col("chunks") - 1)
    first = sets.withColumn("i", F.explode(F.when(pivot, everywhere).otherwise(F.array(home)))).withColumn("j", F.lit(0))
    links = written(_linked(first), "links")
    large = members.where("chunks > 1")
    if large.isEmpty():
        return links.select("a", "b")
    classes = components(links.where("many").select("a", "b")).select(F.col("node").alias("code"), F.col("root").alias("class"))
    classed = large.select("block", "code", "n").join(classes, "code", "left").withColumn("class", F.coalesce("class", "code"))
    counts = classed.groupBy("block", "class").agg(F.count(F.lit(1)).alias("size"))
    largest = counts.groupBy("block").agg(F.max(F.struct("size", "class"))["class"].alias("largest"))
    rest = classed.join(largest, "block").where("class <> largest").select("block", "code", "n")
    rest = written(rest, "rest")
    parts = F.ceil(F.sum("n") / (BLOCK_SHINGLES // 2)).cast("int")
    dealt = rest.groupBy("block").agg(parts.alias("parts"))
    again = sets.where("chunks > 1").join(dealt, "block")
    stay = again.withColumn("i", home).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    move = again.join(rest.select("code").distinct(), "code", "left_semi").withColumn("j", _chunk("code", "parts", 3))
    move = move.withColumn("i", F.explode(everywhere))
    columns = ("block", "i", "j", "chunks", "code", "shingles")
    more = _linked(stay.select(*columns).unionByName(move.select(*columns)))
    return links.unionByName(more).select("a", "b")


def _link_counts(sets: DataFrame, members: DataFrame, classes: DataFrame, copies: DataFrame) -> DataFrame:
    """(code, others): for each distinct set how many documents of other sets are linked to it.

    All members of a component are compared, chunk by chunk, and only counts
    leave a task.
    """
    parts = F.ceil(F.sum("n") / (BLOCK_SHINGLES // 2)).cast("int")
    own = written(members.select("code", "n").join(classes, "code").join(copies, "code"), "classed")
    own = own.join(own.groupBy("class").agg(parts.alias("parts")), "class").drop("n")
    rows = sets.select("code", "shingles").join(own, "code").withColumn("home", _chunk("code", "parts", 4))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("class", F.least("home", "with").alias("i"), F.greatest("home", "with").alias("j"), "home", "code", "copies", "shingles")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("code")
        here = (rows["home"] == rows["i"]).to_numpy()
        found = linked_copies([np.frombuffer(x, np.uint64) for x in rows["shingles"]], rows["copies"].to_numpy(), here, bool((rows["i"] == rows["j"]).iloc[0]))
        return pd.DataFrame({"code": rows["code"], "others": found}, dtype="int64")

    counted = rows.groupBy("class", "i", "j").applyInPandas(run, "code long, others long")
    return counted.groupBy("code").agg(F.sum("others").alias("others"))


def linked_copies(sets: list[np.ndarray], copies: np.ndarray, here: np.ndarray, alone: bool) -> np.ndarray:
    """For each set the copies of those linked to it: of all others if `alone`, else of those on the other side of `here`."""
    found = np.zeros(len(sets), np.int64)
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    left, right = np.nonzero(here)[0], np.nonzero(here if alone else ~here)[0]
    if not len(left) or not len(right):
        return found
    names, codes = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    marked = np.zeros(len(names), bool)
    across = np.concatenate([codes[starts[k] : starts[k] + sizes[k]] for k in right])
    across_starts = np.cumsum(sizes[right]) - sizes[right]
    for k in left:
        own = codes[starts[k] : starts[k] + sizes[k]]
        marked[own] = True
        common = np.add.reduceat(marked[across].astype(np.int32), across_starts)
        marked[own] = False
        linked = right[(100 * common >= PERCENT * (sizes[right] + sizes[k] - common)) & (right != k)]
        found[k] += copies[linked].sum()
        if not alone:
            found[linked] += copies[k]
    return found


def _compared(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Of documents in their places: profiles of all, members of blocks, their sets, and (code, class) of the linked ones."""
    profiles = written(_profiles(docs), "profiles")
    sets = profiles.where("n > 0").groupBy("code").agg(F.min(F.struct("file", "place")).alias("row"), *(F.first(c).alias(c) for c in ("n", "marks", "spare")))
    sets = written(sets.select("code", "row.file", "row.place", "n", "marks", "spare"), "sets")
    prefixes = written(_prefixes(docs, sets), "prefixes")
    release_shuffles(docs.sparkSession)
    members = _members(sets, components(_set_links(prefixes)))
    shown = _member_sets(docs, members)
    classes = components(_verified(shown, members)).select(F.col("node").alias("code"), F.col("root").alias("class"))
    return profiles, members, shown, classes


def join_similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", count_links: bool = False) -> DataFrame:
    """One row for each row of `docs`: doc_id, n_shingles, component_id, the smallest doc_id that links reach.

    Two documents are linked if their shingle sets have a Jaccard similarity of
    `PERCENT` or more; there is no limit on links, groups or sizes. Null texts
    and those without words have no shingles and are linked with nothing.
    Repeated rows are linked like any copies, unless they have no words. A null
    doc_id counts as larger than any other. An empty table gives an empty table.

    Components need only so many links as join them. With `count_links` all
    pairs of distinct sets in a component are compared, which takes the square
    of its size, and a column n_links has how many other rows each row is linked to.
    """
    prepare(docs.sparkSession)
    docs = located(docs.select(column(doc_id).alias("doc_id"), column(text).alias("text")), "file", "place")
    profiles, members, member_sets, classes = _compared(docs)
    # The smallest id of each set, then of each class: sets are few where documents are copies.
    sets = profiles.where("n > 0").groupBy("code").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    sets = sets.join(classes, "code", "left").withColumn("class", F.coalesce("class", "code"))
    least = sets.groupBy("class").agg(F.min("first_id").alias("least_id"))
    named = sets.join(least, "class").select("code", F.coalesce("least_id", "first_id").alias("component_id"), "copies")
    if count_links:
        copies = named.select("code", "copies")
        named = named.join(_link_counts(member_sets, members, classes, copies), "code", "left")
    found = profiles.select("doc_id", "n", "code").join(named, "code", "left")
    alone = F.col("n") == 0
    columns = [
        F.col("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    ]
    if count_links:
        columns.append(F.when(alone, 0).otherwise(F.col("copies") - 1 + F.coalesce("others", F.lit(0))).cast("long").alias("n_links"))
    return found.select(*columns)


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with one row of each component, one of the smallest id, and its columns as they were.

    Exactly one row of a component stays, also where rows repeat, where one id
    stands with several texts, and where no row has an id (ids come before
    null). Of rows with the kept id and the same shingles, that with the first
    text stays. Rows without words stay, whatever their id. Only places in files
    are joined; texts are read again, and not shuffled.
    """
    prepare(docs.sparkSession)
    file, place = fresh(docs.columns, "file"), fresh(docs.columns, "place")
    rows = located(docs, file, place)
    own = [column(c).alias(n) for c, n in ((doc_id, "doc_id"), (text, "text"), (file, "file"), (place, "place"))]
    profiles, _, _, classes = _compared(rows.select(*own))
    named = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id").alias("first")
    sets = profiles.where("n > 0").select("code", named).groupBy("code").agg(F.min("first").alias("first"))
    sets = sets.join(classes, "code", "left").withColumn("class", F.coalesce("class", "code"))
    best = sets.groupBy("class").agg(F.min(F.struct("first", "code")).alias("best"))
    best = best.select("best.code", F.col("best.first.doc_id").alias("first_id"))
    chosen = profiles.join(best, "code").where((F.col("n") > 0) & F.col("doc_id").eqNullSafe(F.col("first_id")))
    chosen = written(chosen.select("code", "file", "place"), "chosen")
    twice = written(chosen.groupBy("code").count().where("count > 1").select("code"), "twice")
    stay = chosen
    if not twice.isEmpty():  # the same id and shingles more than once: the first text stays
        among = chosen.join(twice, "code", "left_semi")
        texts = at_places(rows, among, file, place).select(*own[1:]).join(among, ["file", "place"])
        first = texts.groupBy("code").agg(F.min(F.struct("text", "file", "place")).alias("row")).select("code", "row.file", "row.place")
        stay = chosen.join(twice, "code", "left_anti").unionByName(first)
    stay = stay.select("file", "place").unionByName(profiles.where("n = 0").select("file", "place"))
    return at_places(rows, stay, file, place).select(*map(column, docs.columns))
