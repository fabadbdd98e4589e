"""One file of many rows in order, written by many tasks.

Rows are sorted by range; each task writes its rows' bytes as a part in the shared folder and tells its size, so that a
task that runs again leaves a part that no size names. A prefix sum over the sizes gives each part's offset, and the
parts are copied to their offsets in the file by tasks, or joined by the store where it can (concat). No row goes
through the driver, which sees one name and two numbers a part.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import store

#: Bytes that are copied at a time.
COPY = 1 << 24


def write_bytes(rows: DataFrame, path: str, *order: str, shared: bool | None = None) -> int:
    """Writes the binary column data of rows, by the columns of order, as one file; its size. Null data are no bytes.

    A path of the file system is written in place, which needs a folder that all machines see: on a cluster the caller
    says so (shared=True). Other stores join the parts, or raise where they cannot.
    """
    spark = rows.sparkSession
    at = store.local(path)
    if at is not None and not (shared or spark.sparkContext.master.startswith("local")):
        raise ValueError(f"{path} is written in place by many machines: say shared=True if all of them see it")
    keep = store.Kept(spark)
    folder = keep.path("parts")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, size = TaskContext.get().partitionId(), None, 0
        name = f"{folder}/{part:08d}-{uuid.uuid4().hex}"
        for batch in batches:
            for data in batch.column(0).to_pylist():
                if data:
                    out = out or store.open_write(name)
                    out.write(data)
                    size += len(data)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "name": [name], "size": pa.array([size], pa.int64())})

    parts = keep(rows.sort(*order).select(F.col("data").cast("binary")).mapInArrow(write, "part long, name string, size long"), "sizes")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a task
    placed = parts.select("name", "part", "size", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    total = parts.agg(F.sum("size")).first()[0] or 0
    if at is None:
        _concat(spark, path, [r.name for r in placed.orderBy("part").collect()])
        return total
    with store.open_write(path) as f:
        f.truncate(total)

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, offset in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with open(at, "r+b") as f:
                    f.seek(offset)
                    for data in store.chunks(name, COPY):
                        f.write(data)
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    n = parts.count()
    placed.select("name", "offset").repartition(max(1, min(n, 10_000)), "name").mapInArrow(copy, "n long").agg(F.sum("n")).collect()
    return total


def _concat(spark, path: str, names: list[str]) -> None:
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(conf)
    fs.create(target, True).close()
    if names:
        array = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(names))
        for i, n in enumerate(names):
            array[i] = jvm.org.apache.hadoop.fs.Path(n)
        fs.concat(target, array)


def write_lines(lines: DataFrame, path: str, *order: str, shared: bool | None = None) -> int:
    """Writes the column text as lines of one file, in order."""
    return write_bytes(lines.select(*order, F.concat(F.coalesce("text", F.lit("")), F.lit("\n")).cast("binary").alias("data")), path, *order, shared=shared)
