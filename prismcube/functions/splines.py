"""Splines along tracks of any length: the banded system of a track is solved in blocks of knots.

A block's coefficients are linear in those of the knots beside it: c = p + U left + V right. Only the first and last few of
them matter to its neighbours, so a block is a small row of numbers. Neighbours are joined in groups of `FAN`, those again,
until one row is left of each track; then the coefficients beside each block are worked out from the top down, and each block fills
in its own. No task holds more than a block or a group of rows, however long a track is.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import store
from . import interp

#: Knots of a block (the last of a track has up to twice as many), and neighbours that are joined at once.
BLOCK, FAN = 256, 256


@lru_cache(maxsize=64)
def _inverse(n: int, degree: int, first: bool, last: bool) -> tuple[np.ndarray, int]:
    """The inverse of the conditions of a block of n knots on its own coefficients, and how many come before its first knot.

    Rows are the block's knots, before them the conditions of a track's begin and behind them those of its end, where the block has these.
    """
    extra, difference = degree // 2, interp.end_differences(degree)
    lead, tail = extra * first, extra * last
    places = np.arange(-lead, n + tail)
    rows = interp.spline_basis(np.arange(n)[:, None] - places, degree)
    ends = [np.zeros((lead, len(places))), np.zeros((tail, len(places)))]
    for i in range(extra):
        if first:
            ends[0][i, i : i + len(difference)] = difference
        if last:
            ends[1][i, len(places) - len(difference) - i : len(places) - i] = difference
    return np.linalg.inv(np.vstack([ends[0], rows, ends[1]])), lead


def _parts(y: np.ndarray, degree: int, first: bool, last: bool) -> tuple[np.ndarray, int]:
    """p, U and V of a block as the columns of one matrix, and how many coefficients come before its first knot."""
    n, m = len(y), degree // 2 + 1
    inverse, lead = _inverse(n, degree, first, last)
    right = np.zeros((len(inverse), 1 + 2 * m))
    right[lead : lead + n, 0] = y
    if not first:
        right[lead : lead + n, 1 : 1 + m] = -interp.spline_basis(np.arange(n)[:, None] - np.arange(-m, 0), degree)
    if not last:
        right[lead : lead + n, 1 + m :] = -interp.spline_basis(np.arange(n)[:, None] - np.arange(n, n + m), degree)
    return inverse @ right, lead


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Two neighbours as one: each is (2, m, 1 + 2 m), the first and last coefficients by p, U and V."""
    m = a.shape[1]
    # x = a's last, z = b's first: x = ap + au L + av z, z = bp + bu x + bv R
    ap, au, av, bp, bu, bv = a[1, :, :1], a[1, :, 1 : 1 + m], a[1, :, 1 + m :], b[0, :, :1], b[0, :, 1 : 1 + m], b[0, :, 1 + m :]
    x = np.linalg.solve(np.eye(m) - av @ bu, np.hstack([ap + av @ bp, au, av @ bv]))
    z = bu @ x
    z[:, :1] += bp
    z[:, 1 + m :] += bv
    begin, end = a[0, :, 1 + m :] @ z, b[1, :, 1 : 1 + m] @ x
    begin[:, : 1 + m] += a[0, :, : 1 + m]
    end[:, :1] += b[1, :, :1]
    end[:, 1 + m :] += b[1, :, 1 + m :]
    return np.stack([begin, end])


def _borders(parts: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The coefficients beside each of some neighbours, if these are beside all."""
    m, ahead, behind = len(left), [parts[0]], [parts[-1]]
    for p in parts[1:]:
        ahead.append(_joined(ahead[-1], p))
    for p in reversed(parts[:-1]):
        behind.append(_joined(p, behind[-1]))
    behind.reverse()
    out, before = [], left
    for i in range(len(parts) - 1):
        a, b = ahead[i], behind[i + 1]
        x = np.linalg.solve(np.eye(m) - a[1, :, 1 + m :] @ b[0, :, 1 : 1 + m], a[1, :, 0] + a[1, :, 1 : 1 + m] @ left + a[1, :, 1 + m :] @ (b[0, :, 0] + b[0, :, 1 + m :] @ right))
        z = b[0, :, 0] + b[0, :, 1 : 1 + m] @ x + b[0, :, 1 + m :] @ right
        out.append((before, z))
        before = x
    return [*out, (before, right)]


def _block_of(i: Column, n: Column, block: int) -> Column:
    """The block of a knot; what is left at a track's end belongs to its last whole block."""
    return F.least(F.floor(i / block), F.greatest(F.floor(n / block) - 1, F.lit(0))).cast("long")


def coefficients(knots: DataFrame, degree: int = 3, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """(part, i, n, c) of knots (part, i, y) with i = 0 .. n - 1: c are the spline's coefficients at i - m .. i + m, m = degree // 2 + 1.

    Coefficients further out than degree // 2 places from a track's ends are 0. Tracks with a null value, a null or missing number, or fewer than
    degree + 2 knots have no rows; a number that comes twice is an error.
    """
    if degree not in (2, 3, 5) or block < 2 * degree + 4:
        raise ValueError("the degree is 2, 3 or 5, and a block has 2 degree + 4 knots at least")
    keep, m, extra = store.Kept(knots.sparkSession), degree // 2 + 1, degree // 2
    kind = knots.schema["part"].dataType.simpleString()
    knots = knots.select("part", F.col("i").cast("long").alias("i"), F.col("y").cast("double").alias("y"))
    whole = knots.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.count("y").alias("there"), F.count("i").alias("numbered"), F.min("i").alias("low"), F.max("i").alias("high"))
    whole = whole.filter((F.col("there") == F.col("n")) & (F.col("numbered") == F.col("n")) & (F.col("low") == 0) & (F.col("high") == F.col("n") - 1) & (F.col("n") >= degree + 2))
    inside = knots.join(whole.select("part", "n"), "part").withColumn("g", _block_of(F.col("i"), F.col("n"), block))
    blocks = inside.groupBy("part", "g").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("i", "y"))).alias("s"))
    last = F.col("g") == F.greatest(F.floor(F.col("n") / block) - 1, F.lit(0))
    blocks = keep(blocks.select("part", "g", "n", F.col("s.i").alias("i"), F.col("s.y").alias("y"), last.alias("last")), "blocks")

    def own(b: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
        for k, (g, i, y, end) in enumerate(zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in ("g", "i", "y", "last")), strict=True)):
            if i != list(range(g * block, g * block + len(i))):
                raise ValueError("a knot's number comes twice")
            yield k, *_parts(np.array(y), degree, g == 0, end)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [np.stack([w[:m], w[-m:]]).ravel().tolist() for _, w, _ in own(b)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(rows, pa.list_(pa.float64()))], names=["part", "g", "ends"])

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for s in b.column(2).to_pylist():
                joined = np.array(s[0]["ends"]).reshape(2, m, -1)
                for q in s[1:]:
                    joined = _joined(joined, np.array(q["ends"]).reshape(2, m, -1))
                rows.append(joined.ravel().tolist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(rows, pa.list_(pa.float64()))], names=["part", "g", "ends"])

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [[], [], []]
            for k, (s, beside) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)):
                pairs = _borders([np.array(q["ends"]).reshape(2, m, -1) for q in s], np.array(beside[:m]), np.array(beside[m:]))
                for q, (left, right) in zip(s, pairs, strict=True):
                    for column, v in zip(out, (k, q["g"], [*left.tolist(), *right.tolist()]), strict=True):
                        column.append(v)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(out[0], pa.int64())), pa.array(out[1], pa.int64()), pa.array(out[2], pa.list_(pa.float64()))], names=["part", "g", "beside"])

    def groups(level: DataFrame) -> DataFrame:
        return level.groupBy("part", F.floor(F.col("g") / fan).alias("h")).agg(F.array_sort(F.collect_list(F.struct("g", "ends"))).alias("s"))

    row = f"part {kind}, g long, ends array<double>"
    levels = [keep(blocks.mapInArrow(ends, row), "ends")]
    while (levels[-1].agg(F.max("g")).first()[0] or 0) > 0:
        levels.append(keep(groups(levels[-1]).mapInArrow(up, row), "ends"))
    beside = levels[-1].select("part", "g", F.array_repeat(F.lit(0.0), 2 * m).alias("beside"))
    for level in reversed(levels[:-1]):
        rows = groups(level).join(beside.withColumnRenamed("g", "h"), ["part", "h"]).select("part", "h", "s", "beside")
        beside = keep(rows.mapInArrow(down, f"part {kind}, g long, beside array<double>"), "beside")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = b.column(b.schema.get_field_index("beside")).to_pylist()
            of, at, c = [], [], []
            for k, w, lead in own(b):
                left, right = near[k][:m], near[k][m:]
                mine, i = w @ np.array([1.0, *left, *right]), b.column(b.schema.get_field_index("i"))[k].as_py()
                tail = len(mine) - lead - len(i)
                full = np.concatenate([np.zeros(m - lead) if lead else left, mine, np.zeros(m - tail) if tail else right])
                of.append(np.full(len(i), k))
                at.append(np.array(i))
                c.append(np.lib.stride_tricks.sliding_window_view(full, 2 * m + 1))
            if of:
                c = pa.FixedSizeListArray.from_arrays(pa.array(np.concatenate(c).ravel()), 2 * m + 1).cast(pa.list_(pa.float64()))
                place = pa.array(np.concatenate(of))
                yield pa.RecordBatch.from_arrays([b.column(0).take(place), pa.array(np.concatenate(at)), b.column(b.schema.get_field_index("n")).take(place), c], names=["part", "i", "n", "c"])

    assert extra  # a degree of 1 needs no coefficients
    return blocks.join(beside, ["part", "g"]).mapInArrow(fill, f"part {kind}, i long, n long, c array<double>")


def _basis(u: Column, degree: int) -> Column:
    """interp.spline_basis() of a column."""
    half, out, c = (degree + 1) / 2, None, 1.0
    for j in range(degree + 2):
        base = F.greatest(u + (half - j), F.lit(0.0))
        power = base
        for _ in range(degree - 1):
            power = power * base
        out = power * c if out is None else out + power * c
        c = -c * (degree + 1 - j) / (j + 1)
    return F.when(F.abs(u) < half, out / factorial(degree)).otherwise(0.0)


def along(knots: DataFrame, places: DataFrame, degree: int = 3, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """places (part, t, and others) with v: the spline of that degree through knots (part, i, y) at t, in steps of knots from 0.

    Null where t is null, outside of the knots, or of a track without coefficients(). Places meet the knot nearest to them, one row each.
    """
    m = degree // 2 + 1
    c = coefficients(knots, degree, block, fan).select(F.col("part").alias("_part"), F.col("i").alias("_i"), F.col("n").alias("_n"), F.col("c").alias("_c"))
    nearest = F.floor(F.col("t") + 0.5).cast("long")
    found = places.join(c, (F.col("part") == F.col("_part")) & (nearest == F.col("_i")), "left")
    total = None
    for k in range(2 * m + 1):
        term = F.get("_c", F.lit(k)) * _basis(F.col("t") - (F.col("_i") + (k - m)), degree)
        total = term if total is None else total + term
    inside = (F.col("t") >= 0) & (F.col("t") <= F.col("_n") - 1)
    return found.select(*(F.col(f"`{n}`") for n in places.columns), F.when(inside, total).alias("v"))
