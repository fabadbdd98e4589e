"""Text files of any size by lines and tokens that know their numbers.

A file is cut into ranges of bytes; a line belongs to the range in which it begins. A first pass counts the lines, rows and
tokens of each range, prefix sums over the counts (a row a range) give the numbers at which ranges begin, and a second pass
numbers in place. No line leaves the task that reads it, and no file is held whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import store

SEPARATORS = re.compile(r"[ ,;|\t]+")
#: Bytes of a range.
PART = 1 << 24


def lines_of(path: str, start: int, end: int) -> list[str]:
    """The lines that begin in [start, end) of a file."""
    with store.open_read(path) as f:
        first = max(start - 1, 0)
        f.seek(first)
        data = bytes(f.read(end - first))
        if start:
            at = data.find(b"\n")
            data = data[at + 1 :] if at >= 0 else b""
        if not data:
            return []
        if data.endswith(b"\n"):
            data = data[:-1]
        else:
            rest = []
            while chunk := bytes(f.read(1 << 16)):
                at = chunk.find(b"\n")
                rest.append(chunk if at < 0 else chunk[:at])
                if at >= 0:
                    break
            data += b"".join(rest)
    return [x.removesuffix("\r") for x in data.decode("utf-8", "replace").split("\n")]


def words_of(line: str) -> list[str]:
    return [w for w in SEPARATORS.split(line.strip(" ")) if w]


def _numbered(spark: SparkSession, path: str, part: int, count: Callable[[list[str]], tuple[int, ...]], emit: Callable[..., pa.RecordBatch], schema: str) -> DataFrame:
    """emit(lines, *firsts) for each range; firsts: the sums of count over the ranges before."""
    ranges = store.ranges(spark, path, part)
    n = len(count([]))
    names = [f"n{i}" for i in range(n)]

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, i, start, end in zip(*(c.to_pylist() for c in b.columns), strict=True):
                own = count(lines_of(file, start, end))
                yield pa.RecordBatch.from_pydict({"file": [file], "i": pa.array([i], pa.int64()), "start": pa.array([start], pa.int64()), "end": pa.array([end], pa.int64()), **{k: pa.array([v], pa.int64()) for k, v in zip(names, own, strict=True)}})

    counted = store.Kept(spark)(ranges.mapInArrow(counts, "file string, i long, start long, end long, " + ", ".join(f"{k} long" for k in names)), "counts")
    before = Window.partitionBy("file").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)  # some numbers a range
    firsts = counted.select("file", "i", "start", "end", *(F.coalesce(F.sum(k).over(before), F.lit(0)).alias(k) for k in names))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, _, start, end, *own in zip(*(c.to_pylist() for c in b.columns), strict=True):
                yield emit(lines_of(file, start, end), *own)

    return firsts.repartition(max(1, min(10_000, counted.count())), "file", "i").mapInArrow(number, schema)


def read_text_lines(spark: SparkSession, path: str, part: int = PART) -> DataFrame:
    """ord, text of the lines of a text file that are not blank; ord counts all lines from 0."""

    def emit(lines: list[str], first: int) -> pa.RecordBatch:
        kept = [(first + i, x) for i, x in enumerate(lines) if x.strip(" ")]
        return pa.RecordBatch.from_pydict({"ord": pa.array([i for i, _ in kept], pa.int32()), "text": pa.array([x for _, x in kept], pa.string())})

    return _numbered(spark, path, part, lambda lines: (len(lines),), emit, "ord int, text string")


def _cells(r: np.ndarray, c: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"r": pa.array(r.astype(np.int32)), "c": pa.array(c.astype(np.int32)), "v": pa.array(v.astype(float))})


def read_matrix(spark: SparkSession, path: str, cols: int, part: int = PART) -> DataFrame:
    """r, c, v of a matrix. A line of `cols` numbers is a row; a line of two is a 1-based (row, col) mark of value 1; others fail."""

    def emit(lines: list[str], first: int) -> pa.RecordBatch:
        rows, marks = [], []
        for w in filter(None, map(words_of, lines)):
            if len(w) == cols:
                rows.append(w)
            elif len(w) == 2:
                marks.append(w)
            else:
                raise ValueError(f"not a matrix row nor a mark: {' '.join(w)}")
        m, p = np.array(rows, float).reshape(-1, cols), np.array(marks, float).reshape(-1, 2).astype(int) - 1
        r, c = np.indices(m.shape).reshape(2, -1)
        return _cells(np.concatenate([r + first, p[:, 0]]), np.concatenate([c, p[:, 1]]), np.concatenate([m.ravel(), np.ones(len(p))]))

    return _numbered(spark, path, part, lambda lines: (sum(len(words_of(x)) == cols for x in lines),), emit, "r int, c int, v double")


def read_coefficients(spark: SparkSession, path: str, cols: int, part: int = PART) -> DataFrame:
    """r, c, v of numbers in any layout, row by row."""

    def emit(lines: list[str], first: int) -> pa.RecordBatch:
        v = np.array([w for x in lines for w in words_of(x)], float)
        return _cells(*np.divmod(np.arange(len(v)) + first, cols), v)

    return _numbered(spark, path, part, lambda lines: (sum(len(words_of(x)) for x in lines),), emit, "r int, c int, v double")
