"""Helpers the operators share: text passes, fresh names, written steps, ranks, components."""

from __future__ import annotations

import gc
import math
import tempfile
import time
import weakref
import zipfile
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from txnflow.session import scratch_path

#: The package's sources, as the executors get them.
SHIPPED = "txnflow-sources.zip"
#: Rows and bytes in one Arrow batch, whichever is reached first; a single longer text is a batch of its own.
BATCH_ROWS, BATCH_BYTES = 1000, 1 << 20

#: Rows of a file that share one row of marks, as a power of two, and bytes of marks up to which they are broadcast.
CHUNK_BITS, BROADCAST_BYTES = 15, 1 << 26

#: The folders of written tables.
_FOLDERS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()

ARROW = {
    "long": (pa.int64(), T.LongType()),
    "int": (pa.int32(), T.IntegerType()),
    "double": (pa.float64(), T.DoubleType()),
    "boolean": (pa.bool_(), T.BooleanType()),
    "string": (pa.string(), T.StringType()),
    "binary": (pa.binary(), T.BinaryType()),
    "longs": (pa.list_(pa.int64()), T.ArrayType(T.LongType())),
    "ints": (pa.list_(pa.int32()), T.ArrayType(T.IntegerType())),
    "strings": (pa.list_(pa.string()), T.ArrayType(T.StringType())),
}

#: Bytes of one-byte characters that no word of `alnum_words` holds, as spaces; A-Z as a-z.
_ALNUM = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)

_M1, _M2 = np.uint64(0x7FB5D329728EA185), np.uint64(0x81DADEF4BC2DD44D)


@lru_cache(maxsize=1)
def _driver_folder() -> tempfile.TemporaryDirectory:
    """The driver's own folder, from which Spark serves the sources until the driver ends."""
    return tempfile.TemporaryDirectory(prefix="txnflow-")


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the text passes, which stay as set since jobs run later, and this package for the executors' Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if SHIPPED not in context._python_includes:
        package = Path(__file__).resolve().parents[1]
        path = Path(_driver_folder().name) / SHIPPED
        with zipfile.ZipFile(path, "w") as archive:
            for source in sorted(package.rglob("*.py")):
                archive.write(source, source.relative_to(package.parent))
        context.addPyFile(str(path))
    return spark


def fresh(taken: Iterable[str], name: str) -> str:
    """`name`, lengthened until no column in `taken` has it (case does not matter)."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name


def column(name: str) -> Column:
    """The column of that very name, whatever characters are in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def map_texts(df: DataFrame, text: str, keep: Sequence[str], outputs: dict[str, str], build: Callable) -> DataFrame:
    """Columns `keep`, then what a function gives for each text.

    `build()` runs once in a task; what it returns takes a list of texts (None
    for null) and gives one list for each output. `outputs` maps names to keys
    of `ARROW`; a name must not be in `keep`.
    """
    prepare(df.sparkSession)
    # Numbers stand for names on the way: a function over batches takes no names with dots.
    kept = [column(c).alias(f"c{k}") for k, c in enumerate(keep)]
    source = df.select(*kept, column(text).alias("text"))
    fields = [*source.schema.fields[:-1], *(T.StructField(f"made{k}", ARROW[kind][1]) for k, kind in enumerate(outputs.values()))]
    kinds, n_kept = [ARROW[k][0] for k in outputs.values()], len(keep)
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = build()
        for batch in batches:
            if not batch.num_rows:
                continue
            made = work(batch.column(n_kept).to_pylist())
            arrays = [pa.array(values, type=kind) for values, kind in zip(made, kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n_kept], *arrays], names=names)

    return source.mapInArrow(run, T.StructType(fields)).toDF(*keep, *outputs)


def space_words(text: str | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased, in UTF-8."""
    return (text or "").encode().lower().split()


def alnum_words(text: str | None) -> list[bytes]:
    """Words of digits, letters and all beyond ASCII, with A-Z lower-cased, in UTF-8."""
    return (text or "").encode().translate(_ALNUM).split()


def word_codes(words: Sequence[bytes]) -> np.ndarray:
    """64-bit codes of words; two words share one with a chance of 2**-64."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit codes."""
    x = x ^ (x >> np.uint64(31))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(33))


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as Parquet in the shared folder, read back: lineage ends here and no row is computed twice."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _FOLDERS[table] = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete what `written` wrote for these very tables; nothing may read them any more."""
    for table in tables:
        path = _FOLDERS.pop(table, None)
        if path is not None:
            jvm, conf = table.sparkSession._jvm, table.sparkSession._jsparkSession.sessionState().newHadoopConf()
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)


def least_of_most(counted: DataFrame, most: int) -> int:
    """The least n such that no more than `most` rows of `counted` have that n or more; n goes by eighths of doublings."""
    steps = counted.groupBy(F.floor(8 * F.log2("n")).alias("step")).count().orderBy(F.desc("step")).collect()
    rows, least = 0, 1 << 62
    for step, more in steps:
        rows += more
        if rows > most:
            break
        least = math.ceil(2 ** (step / 8) - 1e-9)
    return least


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of tables that nothing refers to any more; it does so after a collection.

    The driver's Python lets go of its tables in the background, so a second collection finds those.
    """
    gc.collect()
    for _ in range(2):
        spark._jvm.System.gc()
        time.sleep(0.2)


def located(df: DataFrame, file: str, place: str) -> DataFrame:
    """`df` with the file (as a 64-bit code of its path) and the place in it that each row was read from.

    A table that does not come straight from Parquet files, one row for one of
    theirs, is written first.
    """

    def named(rows: DataFrame) -> DataFrame:
        hidden = rows.metadataColumn("_metadata")
        return rows.select("*", F.xxhash64(hidden["file_path"]).alias(file), hidden["row_index"].alias(place))

    try:
        rows = named(df)
        if rows.groupBy(file, place).count().where("count > 1").isEmpty():
            return rows
    except AnalysisException:
        pass
    return named(written(df, "rows"))


def at_places(rows: DataFrame, places: DataFrame, file: str, place: str) -> DataFrame:
    """The `rows` of `located` that stand at `places` (file, place), which are known by a bit for each row of a file.

    The bits are broadcast where they take `BROADCAST_BYTES` at most, so that
    rows stay where they are; with more bits Spark joins the rows to them.
    """
    chunk, bits = fresh(rows.columns, "chunk"), fresh(rows.columns, "bits")
    within = F.col("place").bitwiseAND(F.lit((1 << CHUNK_BITS) - 1))
    marks = places.groupBy("file", F.shiftright("place", CHUNK_BITS).alias(chunk)).agg(F.bitmap_construct_agg(within).alias(bits))
    of = fresh([*rows.columns, chunk, bits], "of_file")
    marks = written(marks.withColumnRenamed("file", of), "marks")
    if marks.count() << (CHUNK_BITS - 3) <= BROADCAST_BYTES:
        marks = F.broadcast(marks)
    at = column(place).bitwiseAND(F.lit((1 << CHUNK_BITS) - 1))
    byte = F.conv(F.hex(F.substr(column(bits), (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    same = (column(file) == column(of)) & (F.shiftright(column(place), CHUNK_BITS) == column(chunk))
    found = rows.join(marks, same).where(F.getbit(byte, at.bitwiseAND(F.lit(7)).cast("int")) == 1)
    return found.select(*map(column, rows.columns))


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[str], rank: str, slices: int = 1024) -> DataFrame:
    """Add each row's rank (from 0) among the rows of equal `keys`.

    Rows of a key are dealt over `slices` by the hash of `order`, ranked within
    the slice, and moved by the sizes of the slices before. So a key with most
    of all rows is still ranked by many tasks. `df` must be a written table.
    """
    part, size, before = (fresh(df.columns, n) for n in ("slice", "slice_rows", "rows_before"))
    dealt = df.withColumn(part, F.pmod(F.xxhash64(*order), F.lit(slices)).cast("int"))
    earlier = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        dealt.groupBy(*keys, part)
        .agg(F.count(F.lit(1)).alias(size))
        .withColumn(before, F.coalesce(F.sum(size).over(earlier), F.lit(0)))
        .drop(size)
    )
    own = Window.partitionBy(*keys, part).orderBy(*order)
    return (
        dealt.withColumn(rank, F.row_number().over(own) - 1)
        .join(sizes, [*keys, part])
        .withColumn(rank, (F.col(rank) + F.col(before)).cast("long"))
        .drop(part, before)
    )


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of `edges` (a long, b long): rows (node, root), `root` the same node for all.

    Each round joins every node to the neighbour of lowest hash and contracts
    the edges, which leaves under half of the nodes to be expected, whatever the
    shape of the graph. Nulls and loops are ignored. Rounds are written, so none
    is computed twice.
    """
    live = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b").distinct()
    live = written(live, "edges")
    parents = []
    for turn in range(rounds):
        if live.isEmpty():
            break
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        weight = F.xxhash64(F.lit(turn), F.col("b"))
        own = F.xxhash64(F.lit(turn), F.col("a"))
        best = both.groupBy("a").agg(F.min(F.struct(weight.alias("weight"), "b")).alias("best"))
        nearer = F.col("best.weight") < own
        best = best.select(F.col("a").alias("node"), F.when(nearer, F.col("best.b")).otherwise(F.col("a")).alias("root"))
        best = written(best, "parents")
        parents.append(best)
        left = best.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = best.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        rest = live.join(left, "a").join(right, "b").where("ra <> rb")
        rest = written(rest.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
        discard(live)
        live = rest
    else:
        raise RuntimeError("components did not settle")
    if not parents:
        return live.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = parents[0]
    for step in parents[1:]:
        up = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
        found = found.join(up, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return found


def unmixed(x: np.ndarray) -> np.ndarray:
    """The codes that `mixed` spread."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(pow(int(_M2), -1, 1 << 64))
    x = x ^ (x >> np.uint64(27)) ^ (x >> np.uint64(54))
    x = x * np.uint64(pow(int(_M1), -1, 1 << 64))
    return x ^ (x >> np.uint64(31)) ^ (x >> np.uint64(62))


def planes(x: np.ndarray) -> bytes:
    """Numbers as their first bytes, then their second ones and so on, which compresses well where they are small."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()


def from_planes(data: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def gram_keys(texts: Sequence[bytes], width: int, pad: int) -> np.ndarray:
    """For each byte of each text the `width` bytes that end with it, as a number; `pad` stands before a text."""
    before = bytes([pad]) * (width - 1)
    stream = np.frombuffer(before + before.join(texts), np.uint8).astype(np.uint64)
    n = len(stream) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    keys = np.zeros(n, np.uint64)
    for k in range(width):
        keys = (keys << np.uint64(8)) | stream[k : k + n]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes + width - 1)
    inside = np.ones(n, bool)  # a key that ends in the padding between two texts belongs to none
    for k in range(width - 1):
        at = ends[:-1] + k - (width - 1)
        inside[at[(at >= 0) & (at < n)]] = False
    return keys[inside]


class Counts:
    """Counts of 64-bit keys, merged now and then, within bounded memory."""

    def __init__(self, limit: int = 2_000_000):
        self.limit, self.parts, self.waiting = limit, [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray | None = None) -> None:
        if len(keys):
            self.parts.append((keys, np.ones(len(keys), np.int64) if counts is None else counts))
            self.waiting += len(keys)
            if self.waiting > 4 * self.limit:
                self.merge()

    def merge(self) -> None:
        if len(self.parts) > 1 or self.parts and len(self.parts[0][0]):
            keys = np.concatenate([k for k, _ in self.parts])
            counts = np.concatenate([c for _, c in self.parts])
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order]
            first = np.nonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[0]
            self.parts = [(keys[first], np.add.reduceat(counts, first))]
            self.waiting = len(first)

    def full(self) -> bool:
        return self.waiting > self.limit

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        """All keys with their counts; what follows starts anew."""
        self.merge()
        keys, counts = self.parts[0] if self.parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        self.parts, self.waiting = [], 0
        return keys, counts


def signed(keys: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(keys).view(np.int64)
