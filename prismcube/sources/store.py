"""Files by path in any store: listed by Spark, opened by Arrow's file systems where they are not local."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Bytes of a task's ranges.
TASK = 1 << 25


def local(path: str) -> str | None:
    """The local path, where the store is the file system (or a mount)."""
    u = urlparse(path)
    return (u.path or path) if u.scheme in ("", "file") else None


def open_read(path: str):
    """A file to read from, with seek."""
    if at := local(path):
        return open(at, "rb")  # noqa: SIM115
    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(path)
    return store.open_input_file(at)


def open_write(path: str):
    if at := local(path):
        os.makedirs(os.path.dirname(at) or ".", exist_ok=True)
        return open(at, "wb")  # noqa: SIM115
    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(path)
    store.create_dir(os.path.dirname(at), recursive=True)
    return store.open_output_stream(at)


def read_text(path: str) -> str:
    with open_read(path) as f:
        return f.read().decode("utf-8", "replace")


def write_text(path: str, text: str) -> None:
    with open_write(path) as f:
        f.write(text.encode())


def exists(path: str) -> bool:
    if at := local(path):
        return os.path.exists(at)
    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(path)
    return store.get_file_info(at).type != fs.FileType.NotFound


def listed(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of files; their contents are not read. One row a task, so that each file has its own."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    return files.repartitionByRange(max(1, files.count()), "path")


def ranges(spark: SparkSession, path: str, part: int) -> DataFrame:
    """(file, i, start, end) of the ranges of part bytes of files, dealt over tasks; empty files have none."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").filter("length > 0")
    starts = F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(part).cast("long"))).alias("i", "start")
    found = files.select(F.col("path").alias("file"), "length", starts)
    found = found.select("file", F.col("i").cast("long").alias("i"), "start", F.least(F.col("start") + part, "length").alias("end"))
    n, size = found.agg(F.count(F.lit(1)), F.sum(F.col("end") - F.col("start"))).first()  # of names
    return found.repartition(tasks(spark, n, size or 0), "file", "i")


def tasks(spark: SparkSession, n: int, size: int) -> int:
    """Tasks for n ranges of that many bytes: a few a core, more for more than `TASK` bytes each, so that small ranges share one."""
    return max(1, min(n, 10_000, max(4 * spark.sparkContext.defaultParallelism, -(-size // TASK))))


def chunks(path: str, size: int) -> Iterator[bytes]:
    """A file's bytes, a part at a time."""
    with open_read(path) as f:
        while data := f.read(size):
            yield bytes(data)


def read_range(path: str, start: int, end: int) -> bytes:
    with open_read(path) as f:
        f.seek(start)
        return bytes(f.read(end - start))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. A local session that has none gets a temporary one; on a cluster that is an error."""
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


class Kept:
    """kept(df, name) writes a table to the shared folder and gives it back, read from there; all go when the program ends."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.n = spark, f"{shared_dir(spark)}/prismcube-{uuid.uuid4().hex}", 0
        atexit.register(self._drop)

    def _drop(self) -> None:
        try:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
            path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
        except Exception:  # the session may have ended before the interpreter
            return

    def path(self, name: str) -> str:
        self.n += 1
        return f"{self.root}/{self.n:03d}-{name}"

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
