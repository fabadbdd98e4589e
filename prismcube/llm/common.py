"""Shared plumbing of the text operators: scratch tables, hashing, graph components."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes to bytes: A-Z to a-z, all else as it is.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Bytes to bytes: lower-cased words of [0-9a-z] and every byte over 0x7F; all else becomes a space.
WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
#: Bytes to bytes: x for what is in such a word, space for what is not.
WORD_CLASS = bytes(32 if c == 32 else 120 for c in WORDS)
#: Bytes to bytes: space for 0x20 and 0x09-0x0D, x for all else.
SPACE_CLASS = bytes(32 if c == 32 or 9 <= c <= 13 else 120 for c in range(256))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """name, with underscores until no column of df has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def whole_row(df: DataFrame):
    """All columns of df as one struct."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where a local session has none (tests), a temporary one is set; on a cluster that is an error."""
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    found = spark.sparkContext._jsc.sc().getCheckpointDir()
    if found.isDefined():
        return found.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = "file://" + tempfile.mkdtemp(prefix="prismcube-")
    spark.sparkContext.setCheckpointDir(own)
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def _delete_at_exit(spark: SparkSession, path: str) -> None:
    try:
        _delete(spark, path)
    except Exception:  # the session may have ended before the interpreter
        return


class Scratch:
    """Tables in the shared folder that cut lineage and outlive executors.

    save() writes a frame and gives it back read from the files; drop() removes tables that are
    no longer needed. What a lazy result still reads stays until the program ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, f"{shared_dir(spark)}/prismcube-{uuid.uuid4().hex}"
        self.n = 0
        atexit.register(_delete_at_exit, spark, self.root)

    def path(self, name: str) -> str:
        self.n += 1
        return f"{self.root}/{self.n:03d}-{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            _delete(self.spark, df._scratch_path)


def map_arrow(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow with make() called once in each task; its result turns one record batch into another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            yield f(batch)

    return df.mapInArrow(run, schema)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Smaller record batches for the actions inside, so that a batch of long texts stays small."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def bytes_of(texts: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of a string array, one after another; null is empty."""
    return (x.as_py() or b"" for x in texts.cast(pa.binary()))


def texts_of(batch: pa.RecordBatch, column: int = 1) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [b"" if x is None else x for x in batch.column(column).cast(pa.binary()).to_pylist()]


def lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """An Arrow list array of numpy arrays, without Python objects for their items."""
    offsets = np.zeros(len(values) + 1, np.int32)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    flat = np.concatenate(values) if values else np.zeros(0, kind.to_pandas_dtype())
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))


def count_words(data: bytes, classes: bytes) -> int:
    """Number of runs of word bytes, without a list of them."""
    marks = data.translate(classes)
    return marks.count(b" x") + marks.startswith(b"x")


def word_pieces(marked: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of bytes between spaces, in lists from about size bytes each, so that a very long text is not one list."""
    at = 0
    while at < len(marked):
        end = len(marked) if len(marked) - at <= size else marked.find(b" ", at + size)
        end = len(marked) if end < 0 else end
        if words := marked[at:end].split():
            yield words
        at = end + 1


def mix64(x: np.ndarray) -> np.ndarray:
    """A finaliser for uint64 values (the public splitmix64 constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def connected_components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(id, component) for every id of edges (a, b): component is the smallest id that links reach.

    Each round hooks every id to the smallest id beside it and contracts the links by that map, until
    only loops are left; the maps are then chained from the last round to the first. Rounds are few
    (a star takes one or two, a path of n about log n), each is linear, and each is written to the
    shared folder. No node's links are gathered anywhere: minima are combined before the shuffle and
    joins on a hub are plain equi-joins that adaptive execution splits.
    """
    spark = scratch.spark
    edges = scratch.save(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    maps: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = scratch.save(both.groupBy(F.col("a").alias("id")).agg(F.least(F.first("a"), F.min("b")).alias("to")), "hook")
        maps.append(hook)
        left = edges.join(hook.select(F.col("id").alias("a"), F.col("to").alias("x")), "a")
        right = left.join(hook.select(F.col("id").alias("b"), F.col("to").alias("y")), "b")
        after = right.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        before, edges = edges, scratch.save(after, "edges")
        scratch.drop(before)
    if not maps:
        return spark.createDataFrame([], "id long, component long")
    out = maps[-1].select("id", F.col("to").alias("component"))
    for hook in reversed(maps[:-1]):
        later = out.select(F.col("id").alias("to"), F.col("component").alias("final"))
        out = hook.join(later, "to", "left").select("id", F.coalesce("final", "to").alias("component"))
    out = scratch.save(out, "components")
    scratch.drop(edges, *maps)
    return out
