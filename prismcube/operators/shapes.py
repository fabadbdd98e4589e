"""Connected shapes over tiles.

Each tile labels its own cells; cells at a tile's border that touch one of another tile give links between labels, and
the links' connected parts (by joins) join the labels. A shape may cross any number of tiles, and a task never holds
more than a tile.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import store
from . import tiles
from .graph import components


def labelled(there: np.ndarray) -> np.ndarray:
    """For each cell that is there, the index (row by row) of the first cell of its 8-connected part; -1 elsewhere."""
    rows, cols = there.shape
    n = np.arange(there.size).reshape(there.shape)
    pairs = []
    for dy, dx in ((0, 1), (1, 0), (1, 1), (1, -1)):
        a, b = np.s_[: rows - dy, max(-dx, 0) : cols - max(dx, 0)], np.s_[dy:, max(dx, 0) : cols + min(dx, 0)]
        both = there[a] & there[b]
        pairs.append((n[a][both], n[b][both]))
    a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
    root = n.ravel().copy()
    while len(a):
        x, y = root[a], root[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root != (up := root[root])).any():
            root = up
    return np.where(there, root.reshape(there.shape), -1)


def label_shapes(kept: DataFrame, rows: int, cols: int, tile: int = tiles.TILE, keep=None, names: tuple[str, ...] = ()) -> DataFrame:
    """k, r, c, v, shape, and the doubles of names, of the cells of kept with v > 0: shape is r * cols + c of the first cell (row by row) of the 8-connected part."""
    keep = keep or store.Kept(kept.sparkSession)

    def own(table: pa.Table) -> pa.Table:
        r, c = (table.column(x).to_numpy() for x in ("r", "c"))
        r0, c0 = int(r.min()), int(c.min())
        there = np.zeros((int(r.max()) - r0 + 1, int(c.max()) - c0 + 1), bool)
        there[r - r0, c - c0] = True
        first = labelled(there)[r - r0, c - c0].astype(np.int64)
        i, j = np.divmod(first, there.shape[1])
        return table.append_column("label", pa.array((i + r0) * cols + j + c0, pa.int64())).select(["k", "r", "c", "v", *names, "label"])

    cells = kept.filter("v > 0").select(*(F.col(x).cast("int").alias(x) for x in ("k", "r", "c")), *(F.col(x).cast("double").alias(x) for x in ("v", *names)))
    cells = cells.withColumn("ty", F.floor(F.col("r") / tile).cast("int")).withColumn("tx", F.floor(F.col("c") / tile).cast("int"))
    cells = keep(cells.groupBy("k", "ty", "tx").applyInArrow(own, ", ".join(["k int, r int, c int, v double", *(f"{x} double" for x in names), "label long"])), "cells")
    # links between the labels of cells that touch across a border: down and to the right, so that each pair is met once
    place = lambda x: F.floor(F.col(x) / tile)
    edge = lambda x: F.col(x) % tile
    border = cells.filter((edge("r") == 0) | (edge("r") == tile - 1) | (edge("c") == 0) | (edge("c") == tile - 1)).select("k", "r", "c", "label")
    steps = F.array(*(F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in ((0, 1), (1, 0), (1, 1), (1, -1))))
    ahead = border.withColumn("s", F.explode(steps)).select("k", (F.col("r") + F.col("s.dy")).alias("r"), (F.col("c") + F.col("s.dx")).alias("c"), F.col("label").alias("from"), place("r").alias("ty"), place("c").alias("tx"))
    ahead = ahead.filter((place("r") != F.col("ty")) | (place("c") != F.col("tx")))
    size = rows * cols  # labels of all frames as one kind of id
    links = ahead.join(border, ["k", "r", "c"]).select((F.col("k").cast("long") * size + F.col("from")).alias("a"), (F.col("k").cast("long") * size + F.col("label")).alias("b"))
    parts = components(links, keep).withColumnRenamed("id", "own")
    out = cells.withColumn("own", F.col("k").cast("long") * size + F.col("label")).join(parts, "own", "left")
    return out.select("k", "r", "c", "v", *names, (F.coalesce("part", "own") - F.col("k").cast("long") * size).alias("shape"))


def peak_lines(kept: DataFrame, rows: int, cols: int, shortest: int = 11, longest: int = 20, tile: int = tiles.TILE) -> DataFrame:
    """k, x1, y1, x2, y2, v1, v2 of the shapes of kept that are segments.

    A shape's first end is the cell farthest from its mean, the other the one farthest from that (ties: the first, row
    by row). It is a segment if no cell is off the line between them by more than a fiftieth of its length, and the
    longer of its extents is within shortest and longest (negative: no limit).
    """
    keep = store.Kept(kept.sparkSession)
    cells = keep(label_shapes(kept, rows, cols, tile, keep), "shapes")
    far = lambda r, c, of: F.max_by(of, F.struct((F.pow(F.col("r") - r, F.lit(2)) + F.pow(F.col("c") - c, F.lit(2))).alias("d"), (-F.col("r")).alias("r"), (-F.col("c")).alias("c")))
    cell, by = F.struct("r", "c", "v"), ["k", "shape"]
    mean = cells.groupBy(*by).agg(F.avg("r").alias("mr"), F.avg("c").alias("mc"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    first = keep(cells.join(mean, by).groupBy(*by).agg(far(F.col("mr"), F.col("mc"), cell).alias("p")), "first")
    last = keep(cells.join(first, by).groupBy(*by, "p").agg(far(F.col("p.r"), F.col("p.c"), cell).alias("q")), "last")
    dr, dc = F.col("q.r") - F.col("p.r"), F.col("q.c") - F.col("p.c")
    off = F.abs((F.col("r") - F.col("p.r")).cast("long") * dc - (F.col("c") - F.col("p.c")).cast("long") * dr)
    length = F.greatest(F.abs(dr), F.abs(dc)) + 1
    inside = (F.lit(shortest < 0) | (length >= shortest)) & (F.lit(longest < 0) | (length <= longest))
    thin = cells.join(last.filter(inside), by).groupBy(*by, "p", "q").agg(F.max(off).alias("off"))
    lines = thin.filter(50 * F.col("off") <= dr.cast("long") * dr + dc.cast("long") * dc)
    ends = lines.select("k", F.array_sort(F.array("p", "q")).alias("e"))
    a, b = F.col("e")[0], F.col("e")[1]
    return ends.select("k", a.c.alias("x1"), a.r.alias("y1"), b.c.alias("x2"), b.r.alias("y2"), a.v.alias("v1"), b.v.alias("v2"))
