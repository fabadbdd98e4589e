"""Joins and set operations over tracks, tiles and cubes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..sources import store
from .repeats import drop_repeats_scan  # noqa: F401
from .scans import prefix_max, prefix_sums


def splice(cells: DataFrame, shapes: DataFrame) -> DataFrame:
    """One cube of several (scene, b, y, x, v) one under another; shapes: scene, height, in the scenes' order. Values become whole numbers of 16 bits."""
    off = prefix_sums(shapes.select("scene", "height"), ["scene"], "height", store.Kept(cells.sparkSession)).select("scene", F.col("before").alias("off"))
    v = F.greatest(F.least(F.round("v"), F.lit(65535.0)), F.lit(0.0)).cast("int")
    return cells.join(off, "scene").select("b", (F.col("y") + F.col("off")).alias("y"), "x", v.alias("v"))


#: The end of a file whose end is not known.
OPEN = (1 << 63) - 1


def group_intervals(files: DataFrame) -> DataFrame:
    """Groups of files (name, first, last) by the greedy rule: by start, a file joins the latest group that ends before it, else opens one.

    A second file of an equal start is dropped. A file without an end is never followed, one without a start opens a group behind all.

    Where all files so far have ended, a stretch begins: what the rule does in it depends on the files before by the number of groups
    alone, which is the most files that were open at once. Open files, stretches and groups so far are thus prefix sums and maxima over
    the files sorted by range. Each stretch is then gone through in order, with the free groups and the open files as heaps.
    """
    keep = store.Kept(files.sparkSession)
    one = files.select("name", F.col("first").cast("long").alias("first"), F.col("last").cast("long").alias("last"))
    one = keep(one.withColumn("n", F.row_number().over(W.partitionBy("first").orderBy("name"))).filter("n = 1").drop("n"), "files")
    known = one.filter("first IS NOT NULL").withColumn("end", F.when(F.col("last").isNull(), F.lit(OPEN)).otherwise(F.greatest("first", "last")))
    # a file that ends where another begins is still open there
    steps = known.select("*", F.explode(F.array(F.struct(F.col("first").alias("t"), F.lit(0).alias("kind"), F.lit(1).alias("step")), F.struct(F.col("end").alias("t"), F.lit(1).alias("kind"), F.lit(-1).alias("step")))).alias("e"))
    steps = prefix_sums(steps.select("name", "first", "last", "end", "e.*"), ["t", "kind"], "step", keep)
    begun = steps.filter("kind = 0").select("name", "first", "last", "end", (F.col("before") + 1).alias("open"))
    begun = prefix_max(begun, ["first"], "open", keep).withColumnRenamed("before", "groups").withColumn("new", (F.col("open") == 1).cast("int"))
    begun = prefix_sums(begun, ["first"], "new", keep).withColumn("stretch", F.col("before") + F.col("new"))

    def run(batches):
        import heapq

        import pyarrow as pa

        at, free, busy, fresh, n = None, [], [], 0, 0
        for b in batches:
            out = []
            for stretch, groups, first, end in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if stretch != at:  # all groups are free, and none is in a heap
                    at, free, busy, fresh, n = stretch, [], [], groups, groups
                while busy and busy[0][0] < first:
                    heapq.heappush(free, -heapq.heappop(busy)[1])
                if free:  # these are later than those that the stretch has not used
                    g = -heapq.heappop(free)
                elif fresh:
                    fresh -= 1
                    g = fresh
                else:
                    g, n = n, n + 1
                heapq.heappush(busy, (end, g))
                out.append(g)
            yield pa.RecordBatch.from_arrays([b.column(4), b.column(2), b.column(5), pa.array(out, pa.int32())], names=["name", "first", "last", "grp"])

    rows = begun.select("stretch", "groups", "first", "end", "name", "last").repartition("stretch").sortWithinPartitions("stretch", "first")
    out = rows.mapInArrow(run, "name string, first long, last long, grp int")
    behind = begun.agg(F.coalesce(F.max("open"), F.lit(0)).cast("int").alias("grp"))
    return out.unionByName(one.filter("first IS NULL").crossJoin(F.broadcast(behind)))


def _level(size):
    """The level whose cells (2 to the level wide) are not smaller than a size; sizes of 0 go to a small one."""
    return F.greatest(F.ceil(F.log2(F.greatest(size, F.lit(1e-9)))), F.lit(-30)).cast("int")


def _cells(lo, hi, level):
    """Cells along one axis that an interval touches, at most two or three at its own level or a larger one."""
    width = F.pow(F.lit(2.0), level)
    return F.sequence(F.floor(lo / width), F.floor(hi / width))


def in_rectangles(points: DataFrame, boxes: DataFrame) -> DataFrame:
    """Points strictly inside boxes (box, x0, y0, x1, y1).

    Boxes lie in a few cells of a grid as coarse as they are large, and points in one cell of each grid that a box uses, so
    both sides meet in an equi-join, however many boxes there are.
    """
    level = _level(F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")))
    b = boxes.filter("x1 > x0 AND y1 > y0").withColumn("level", level)
    levels = [r[0] for r in b.select("level").distinct().collect()]  # the sizes' powers of two
    b = b.withColumn("cx", F.explode(_cells(F.col("x0"), F.col("x1"), F.col("level")))).withColumn("cy", F.explode(_cells(F.col("y0"), F.col("y1"), F.col("level"))))
    at = lambda c: F.floor(F.col(c) / F.pow(F.lit(2.0), F.col("level")))
    p = points.withColumn("level", F.explode(F.array(*map(F.lit, levels)) if levels else F.array().cast("array<int>"))).withColumn("cx", at("x")).withColumn("cy", at("y"))
    inside = (F.col("x") > F.col("x0")) & (F.col("x") < F.col("x1")) & (F.col("y") > F.col("y0")) & (F.col("y") < F.col("y1"))
    return p.join(b, ["level", "cx", "cy"]).filter(inside).drop("level", "cx", "cy")


def in_polygon(points: DataFrame, polygon: list[tuple[float, float]]) -> DataFrame:
    """Points inside a polygon, by the parity of crossed edges."""
    odd = F.lit(False)
    for (xa, ya), (xb, yb) in zip(polygon, polygon[1:] + polygon[:1], strict=True):
        if ya != yb:
            crosses = (F.lit(ya) > F.col("y")) != (F.lit(yb) > F.col("y"))
            odd = odd != (crosses & (F.col("x") < (xb - xa) * (F.col("y") - ya) / (yb - ya) + xa))
    return points.filter(odd)


def within_radius(points: DataFrame, x: float, y: float, radius: float = 0.006) -> DataFrame:
    d = (F.col("x") - x) * (F.col("x") - x) + (F.col("y") - y) * (F.col("y") - y)
    return points.filter(d < radius * radius)


def hex_islands(names: DataFrame) -> DataFrame:
    """Runs of neighbouring hexadecimal names: name, id, grp (from 0); by (part)."""
    order = W.partitionBy("part").orderBy("ord")
    n = names.withColumn("id", F.conv("name", 16, 10).cast("long"))
    new = F.coalesce((F.abs(F.col("id") - F.lag("id").over(order)) != 1).cast("int"), F.lit(0))
    return n.withColumn("new", new).withColumn("grp", F.sum("new").over(order.rowsBetween(W.unboundedPreceding, 0))).select("part", "ord", "name", "id", "grp")


def intersecting(a: DataFrame, b: DataFrame) -> DataFrame:
    """Pairs of rectangles (id, x, y, w, h) of a and b that touch or overlap.

    Each side lies in a few cells of the grid of its own size and of every larger one that the other side uses; a pair meets at
    the larger of both, and counts in the cell that holds the corner of what they share.
    """

    def placed(df: DataFrame, s: str) -> DataFrame:
        df = df.select(*(F.col(c).alias(f"{s}_{c}") for c in ("id", "x", "y", "w", "h")))
        return df.withColumn(f"{s}_level", _level(F.greatest(f"{s}_w", f"{s}_h")))

    a, b = placed(a, "a"), placed(b, "b")
    levels = {s: [r[0] for r in df.select(f"{s}_level").distinct().collect()] for s, df in (("a", a), ("b", b))}  # powers of two
    every = F.array(*map(F.lit, sorted({*levels["a"], *levels["b"]}))) if levels["a"] and levels["b"] else F.array().cast("array<int>")

    def dealt(df: DataFrame, s: str) -> DataFrame:
        df = df.withColumn("level", F.explode(F.filter(every, lambda x: x >= F.col(f"{s}_level"))))
        for c, n in (("x", "w"), ("y", "h")):
            df = df.withColumn(f"c{c}", F.explode(_cells(F.col(f"{s}_{c}"), F.col(f"{s}_{c}") + F.col(f"{s}_{n}"), F.col("level"))))
        return df

    on = (F.col("a_x") <= F.col("b_x") + F.col("b_w")) & (F.col("b_x") <= F.col("a_x") + F.col("a_w")) & (F.col("a_y") <= F.col("b_y") + F.col("b_h")) & (F.col("b_y") <= F.col("a_y") + F.col("a_h"))
    corner = lambda c: F.floor(F.greatest(f"a_{c}", f"b_{c}") / F.pow(F.lit(2.0), F.col("level"))) == F.col(f"c{c}")
    out = dealt(a, "a").join(dealt(b, "b"), ["level", "cx", "cy"])
    out = out.filter(on & (F.col("level") == F.greatest("a_level", "b_level")) & corner("x") & corner("y"))
    return out.drop("level", "cx", "cy", "a_level", "b_level")


#: Tiles of a piece of a region, and of a task.
PIECE, TASK = 1 << 14, 1 << 20


def _places(regions: DataFrame, tile: int) -> DataFrame:
    """regions with tw, th (see tile_grid), cols, rows (numbers of tiles) and a row for each tile (tx, ty).

    A region's tiles grow with its area, so regions are cut into pieces, and these are dealt over tasks before tiles are made.
    """

    def adjusted(n: str):
        return F.ceil(F.col(n) / F.greatest(F.round(F.col(n) / F.least(F.col(n), F.lit(tile))), F.lit(1)))

    t = regions.filter("rw > 0 AND rh > 0").withColumn("tw", adjusted("rw")).withColumn("th", adjusted("rh"))
    t = t.withColumn("cols", F.ceil(F.col("rw") / F.col("tw")).cast("long")).withColumn("rows", F.ceil(F.col("rh") / F.col("th")).cast("long"))
    t, n = store.Kept(regions.sparkSession)(t, "regions"), F.col("cols") * F.col("rows")
    tasks = min(10_000, -(-(t.agg(F.sum(n)).first()[0] or 0) // TASK))  # a number
    t = t.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), n - 1, F.lit(PIECE).cast("long"))))
    if tasks > 1:
        t = t.repartition(tasks)
    t = t.withColumn("_i", F.explode(F.sequence("_from", F.least(F.col("_from") + PIECE, n) - 1)))
    return t.withColumn("tx", F.expr("_i div rows").cast("int")).withColumn("ty", (F.col("_i") % F.col("rows")).cast("int")).drop("_from", "_i")


def _keys(regions: DataFrame) -> list[str]:
    return [c for c in regions.columns if c not in ("rx", "ry", "rw", "rh")]


def tile_grid(regions: DataFrame, tile: int) -> DataFrame:
    """Tiles (tx, ty, x, y, w, h) of regions (rx, ry, rw, rh and keys, which stay): the size adjusted so that tiles are about equal, edge tiles clipped."""
    t = _places(regions, tile).withColumn("x", F.col("rx") + F.col("tx") * F.col("tw")).withColumn("y", F.col("ry") + F.col("ty") * F.col("th"))
    w, h = F.least(F.col("tw"), F.col("rx") + F.col("rw") - F.col("x")), F.least(F.col("th"), F.col("ry") + F.col("rh") - F.col("y"))
    return t.select(*_keys(regions), "tx", "ty", *(c.cast("long").alias(n) for c, n in ((F.col("x"), "x"), (F.col("y"), "y"), (w, "w"), (h, "h"))))


def _around(tiles: DataFrame) -> DataFrame:
    """tiles with the places of the 3 by 3 surroundings of each, itself left out: nx, ny."""
    steps = F.array(*(F.struct((F.col("tx") + x).alias("nx"), (F.col("ty") + y).alias("ny")) for x in (-1, 0, 1) for y in (-1, 0, 1) if x or y))
    return tiles.withColumn("_near", F.explode(steps)).select("*", "_near.nx", "_near.ny").drop("_near")


def grid_neighbours(regions: DataFrame, tile: int) -> DataFrame:
    """Each tile's neighbours in the grid that tile_grid makes of regions. A grid has no holes, so its bounds tell them; nothing is joined."""
    keys = _keys(regions)
    known = regions.dropna(subset=keys) if keys else regions  # regions of an unknown key are no one's
    near = _around(_places(known, tile)).filter("nx >= 0 AND ny >= 0 AND nx < cols AND ny < rows")
    return near.select(*keys, "tx", "ty", "nx", "ny")


def tile_neighbours(tiles: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Each tile's neighbours in its 3 by 3 surroundings of the same keys, itself left out; of any tiles. Tiles are never broadcast: a few regions may have many."""
    near = _around(tiles.select(*keys, "tx", "ty"))
    there = tiles.select(*keys, F.col("tx").alias("nx"), F.col("ty").alias("ny"))
    return near.join(there.hint("merge"), [*keys, "nx", "ny"]).select(*keys, "tx", "ty", "nx", "ny")


def drop_repeats(records: DataFrame, tolerance: float = 1e-5) -> DataFrame:
    """Records (part, ord, time) whose time differs from the one before by more than the tolerance; for gaps that are either clearly below or above it."""
    before = F.lag("time").over(W.partitionBy("part").orderBy("ord"))
    return records.withColumn("before", before).filter(F.col("before").isNull() | (F.abs(F.col("time") - F.col("before")) > tolerance)).drop("before")


def drop_equal_lines(lines: DataFrame) -> DataFrame:
    """Lines (part, ord, text) that differ from the one before."""
    before = F.lag("text").over(W.partitionBy("part").orderBy("ord"))
    return lines.filter(F.col("text").isNotNull()).withColumn("before", before).filter(F.col("before").isNull() | (F.col("before") != F.col("text"))).drop("before")
