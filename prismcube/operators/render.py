"""Rendering: lookups from sampled statistics (linear, cut, CLAHE, Wallis), global or by tile with bilinear blending.

A lookup is a formula of a group's statistics (linear, cut, Wallis) or a table over the bins of the source range
(CLAHE); so cells join one row a group, or one a group and bin. Outside of tiles every value is mapped, beyond the
source range as the formula says or by the first or last bin; in tiles only values inside the range are. NaN stays, and
so does a group whose samples have no value inside the range.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..sources import store
from . import aggregates as A


@dataclass(frozen=True)
class Render:
    mode: str = "wallis|minmax|cut|tile"
    src_min: float = 7
    src_umax: float = 4000
    src_step: float = 1
    dst_min: float = 0
    dst_max: float = 255
    cut_lower: float = 0.002
    cut_upper: float = 0.002
    hist_clip: float = 10
    dst_mean: float = 127
    dst_std: float = 70
    c: float = 0.8
    b: float = 0.9

    @property
    def kind(self) -> str:
        """Of several words in the mode, the first of this order holds."""
        m = self.mode.lower()
        return next((k for k, word in (("wallis", "wallis"), ("cut", "cut"), ("clahe", "hist")) if word in m), "linear")

    @property
    def bins(self) -> int:
        return int((self.src_umax - self.src_min) / self.src_step)

    @property
    def middle(self) -> float:
        """What stands for a bin, from its low edge."""
        return 0.0 if self.src_step == 1 else 0.5 * self.src_step

    @property
    def whole(self) -> bool:
        """Whether the first frame's lookups serve all."""
        return "global" in self.mode.lower()


def _line(p: Render, low: Column, high: Column) -> tuple[Column, Column]:
    """Slope and offset that bring low and high to the ends of the target range."""
    a = F.when(high - low > 1.1920928955078125e-07, F.try_divide(F.lit(float(p.dst_max - p.dst_min)), high - low)).otherwise(0.0)
    return a, p.dst_min - a * low


def _ends(samples: DataFrame, p: Render, by: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """The histogram, and by, st, ed, valid: the bins that stay after the cut, and how many values they hold."""
    hist = A.histogram(samples, p.src_min, p.src_umax, p.src_step, by)
    if p.cut_lower >= 0 and p.cut_upper >= 0:
        ends = A.histogram_cut(hist, p.bins, p.cut_lower, p.cut_upper, by)
    else:
        ends = samples.select(*by).distinct().withColumn("first", F.lit(0)).withColumn("last", F.lit(p.bins - 1))
    st, ed = F.coalesce("first", F.lit(0)), F.coalesce("last", F.lit(p.bins - 1))
    ends = ends.select(*by, F.when(st > ed, 0).otherwise(st).alias("st"), F.when(st > ed, p.bins - 1).otherwise(ed).alias("ed"))
    return hist, ends


def lookups(samples: DataFrame, p: Render, by: tuple[str, ...]) -> DataFrame:
    """The lookups of groups of samples (by.., v) that have a value inside the source range: by and their statistics, for CLAHE by, bin, dst."""
    if p.kind == "wallis":
        s = A.masked_stats(samples, p.src_min, p.src_umax, by).filter("mean IS NOT NULL")
        r1 = F.try_divide(F.lit(p.c * p.dst_std), p.c * F.col("std") + p.dst_std / p.c)
        some = F.col("min") < F.col("max")
        low = F.when(some, F.col("min")).otherwise(float(p.src_min))
        bins = F.when(some, F.greatest(((F.col("max") - F.col("min")) / p.src_step).cast("int"), F.lit(1))).otherwise(p.bins)
        s = s.withColumn("r1", r1)
        return s.select(*by, (p.b * p.dst_mean + (1 - p.b - F.col("r1")) * F.col("mean")).alias("r0"), "r1", low.alias("low"), bins.alias("bins"))
    hist, ends = _ends(samples, p, by)
    inside = hist.filter((F.col("bin") >= 0) & (F.col("bin") < p.bins)).join(ends, list(by)).filter("bin BETWEEN st AND ed")
    if p.kind == "cut":
        held = inside.groupBy(*by, "st", "ed").agg(F.sum("n").alias("valid")).filter("valid > 0")
        a, b = _line(p, p.src_min + F.col("st") * p.src_step + p.middle, p.src_min + F.col("ed") * p.src_step + p.middle)
        return held.select(*by, a.alias("a"), b.alias("b"))
    every, n = W.partitionBy(*by), F.col("n")
    h = inside.withColumn("valid", F.sum("n").over(every)).filter("valid > 0")
    if p.hist_clip > 0:  # the limit follows the samples; the excess goes to all bins alike, the rest one each in even steps
        taken = samples.groupBy(*by).agg(F.count(F.lit(1)).alias("samples"))
        h = h.join(taken, list(by))
        m, at = F.col("ed") - F.col("st") + 1, F.col("bin") - F.col("st")
        limit = F.greatest(F.lit(1), F.floor(p.hist_clip * F.col("samples") / m))
        h = h.withColumn("limit", limit).withColumn("excess", F.sum(F.greatest(n - F.col("limit"), F.lit(0))).over(every))
        left = F.col("excess") % m
        step = F.greatest(F.floor(m / F.greatest(left, F.lit(1))), F.lit(1))
        extra = (left > 0) & (at % step == 0) & (F.floor(at / step) < left)
        h = h.withColumn("n", F.least("n", "limit") + F.floor(F.col("excess") / m) + extra.cast("long"))
    h = h.withColumn("cum", F.sum("n").over(every.orderBy("bin").rowsBetween(W.unboundedPreceding, 0)))
    low, high = F.min("cum").over(every), F.max("cum").over(every)
    h = h.withColumn("dst", p.dst_min + F.coalesce(F.try_divide((p.dst_max - p.dst_min) * (F.col("cum") - low), high - low), F.lit(0.0)))
    # beyond the bins that stay, the first and the last hold
    groups = h.select(*by, "st", "ed").distinct().withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(p.bins - 1))))
    held = groups.withColumn("from", F.greatest("st", F.least("ed", "bin"))).join(h.select(*by, F.col("bin").alias("from"), "dst"), [*by, "from"])
    return held.select(*by, "bin", "dst")


def _bin(p: Render) -> Column:
    """The source range's bin of v, held inside."""
    return F.greatest(F.lit(0.0), F.least(F.lit(float(p.bins - 1)), (F.col("v") - p.src_min) / p.src_step)).cast("int")


def _packed(luts: DataFrame, p: Render, by: tuple[str, ...]) -> DataFrame:
    """luts with each group's statistics as one struct lut; for CLAHE, its dst by bin as one array."""
    if p.kind == "clahe":
        bins = F.array_sort(F.collect_list(F.struct("bin", "dst")))
        return luts.groupBy(*by).agg(bins.alias("s")).select(*by, F.struct(F.transform("s", lambda x: x["dst"]).alias("dst")).alias("lut"))
    return luts.select(*by, F.struct(*(c for c in luts.columns if c not in by)).alias("lut"))


def _value(lut: Column, p: Render) -> Column:
    """v by a lookup (a struct of _packed); null without one."""
    v = F.col("v")
    if p.kind == "clahe":
        return F.get(lut["dst"], F.col("bin"))
    if p.kind == "cut":
        return lut["a"] * v + lut["b"]
    i = F.greatest(F.lit(0.0), F.least(lut["bins"] - 1.0, (v - lut["low"]) / p.src_step)).cast("int")
    value = F.greatest(F.least(lut["r1"] * (lut["low"] + i * p.src_step + p.middle) + lut["r0"], F.lit(float(p.dst_max))), F.lit(float(p.dst_min)))
    return F.when(lut.isNotNull(), value)


def _straight(p: Render) -> Column:
    a, b = _line(p, F.lit(float(p.src_min)), F.lit(float(p.src_umax)))
    return a * F.col("v") + b


def render(frames: DataFrame, p: Render, step: tuple[int, int] = (1, 1), shape: tuple[int, int] | None = None) -> DataFrame:
    """Each frame by its own lookup, or all by the first frame's ("global" in the mode).

    step: lines and places from one sample to the next; shape: lines and places of a frame, of which no sample is taken
    beyond the last whole step.
    """
    fine = F.when(~F.isnan("v"), F.col("v"))
    if p.kind == "linear":
        return frames.select("k", "r", "c", F.when(fine.isNotNull(), _straight(p)).otherwise(F.col("v")).alias("v"))
    samples = frames.filter((F.col("r") % step[0] == 0) & (F.col("c") % step[1] == 0))
    if shape:
        most = [max(n // s, 1) * s for n, s in zip(shape, step, strict=True)]
        samples = samples.filter((F.col("r") < most[0]) & (F.col("c") < most[1]))
    out = frames.withColumn("bin", F.when(fine.isNotNull(), _bin(p)))
    if p.whole:
        first = samples.groupBy().agg(F.min("k").alias("k"))
        luts = _packed(lookups(samples.join(F.broadcast(first), "k").withColumn("all", F.lit(0)), p, ("all",)), p, ("all",))
        out = out.withColumn("all", F.lit(0)).join(F.broadcast(luts), "all", "left")  # one row
    else:
        # written once, so that its size decides whether it is broadcast and samples are read once
        luts = store.Kept(frames.sparkSession)(_packed(lookups(samples, p, ("k",)), p, ("k",)), "lookups")
        out = out.join(luts, "k", "left")
    return out.select("k", "r", "c", F.when(fine.isNotNull(), F.coalesce(_value(F.col("lut"), p), "v")).otherwise(F.col("v")).alias("v"))


def tiling(length: int, tile: int) -> list[tuple[int, int]]:
    """(start, length) of tiles; the last takes the rest."""
    n = max(length // tile, 1)
    return [(i * tile, tile if i + 1 < n else length - i * tile) for i in range(n)]


def render_tiles(frames: DataFrame, rows: int, cols: int, p: Render, grid: tuple[int, int] = (8, 8), step: tuple[int, int] = (3, 3), tile: tuple[int, int] = (0, 0)) -> DataFrame:
    """A lookup for each tile, blended between tile centres with whole-number weights.

    tile: lines and places of a tile; where 0, the frame by the grid (tiles along x and y), or 512 where that is 0. A
    tile's samples begin at its corner. A tile without lookup takes a neighbour's.
    """
    tr = tile[0] or (max(rows // grid[1], 1) if grid[1] else 512)
    tc = tile[1] or (max(cols // grid[0], 1) if grid[0] else 512)
    xs, ys = tiling(cols, tc), tiling(rows, tr)
    tx, ty = F.least(F.floor(F.col("c") / tc), F.lit(len(xs) - 1)).cast("int"), F.least(F.floor(F.col("r") / tr), F.lit(len(ys) - 1)).cast("int")
    samples = frames.withColumn("tx", tx).withColumn("ty", ty)
    for at, t, size, segments, s in (("r", "ty", tr, ys, step[0]), ("c", "tx", tc, xs, step[1])):
        inside = F.col(at) - F.col(t) * size
        length = F.when(F.col(t) == len(segments) - 1, segments[-1][1]).otherwise(size)
        samples = samples.filter((inside % s == 0) & (inside < F.greatest(F.floor(length / s), F.lit(1)) * s))
    by = ("tx", "ty") if p.whole else ("k", "tx", "ty")
    if p.whole:
        samples = samples.join(F.broadcast(samples.groupBy().agg(F.min("k").alias("k"))), "k")  # one row
    luts = None if p.kind == "linear" else lookups(samples, p, by)

    def place(at: str, segments: list[tuple[int, int]]):
        """Which gap between centres a place lies in (0: before the first), the weight of the tile after it, and their sum."""
        centres = [s + n // 2 for s, n in segments]
        gap, weight, span = F.lit(0), F.lit(0), F.lit(1)
        for i, (a, b) in enumerate(zip(centres, centres[1:], strict=False)):
            here = (F.col(at) >= a) & (F.col(at) < b)
            gap, weight, span = F.when(here, i + 1).otherwise(gap), F.when(here, F.col(at) - a).otherwise(weight), F.when(here, b - a).otherwise(span)
        end = F.col(at) >= centres[-1]
        return F.when(end, len(centres)).otherwise(gap), F.when(end, 0).otherwise(weight), F.when(end, 1).otherwise(span)

    qx, wx, sx = place("c", xs)
    qy, wy, sy = place("r", ys)
    inside = ~F.isnan("v") & (F.col("v") >= p.src_min) & (F.col("v") < p.src_umax)
    if luts is None:
        return frames.select("k", "r", "c", F.when(inside, _straight(p)).otherwise(F.col("v")).alias("v"))
    out = frames.withColumn("bin", F.when(inside, _bin(p)))
    for name, col in (("qx", qx), ("wx", wx), ("sx", sx), ("qy", qy), ("wy", wy), ("sy", sy)):
        out = out.withColumn(name, col)
    # the lookups of the four tiles around each gap are one row, so cells meet them in one join
    spark, own = frames.sparkSession, [] if p.whole else ["k"]
    luts = store.Kept(spark)(_packed(luts, p, by), "lookups")
    around = luts.select(*own).distinct() if own else spark.range(1).select()
    for q, t0, t1, n in (("qx", "x0", "x1", len(xs)), ("qy", "y0", "y1", len(ys))):
        around = around.withColumn(q, F.explode(F.sequence(F.lit(0), F.lit(n))))
        around = around.withColumn(t0, F.greatest(F.col(q) - 1, F.lit(0))).withColumn(t1, F.least(F.col(q), F.lit(n - 1)))
    for d, x, y in (("l0", "x0", "y0"), ("l1", "x1", "y0"), ("l2", "x0", "y1"), ("l3", "x1", "y1")):
        around = around.join(luts.select(*own, F.col("tx").alias(x), F.col("ty").alias(y), F.col("lut").alias(d)), [*own, x, y], "left")
    around = around.select(*own, "qx", "qy", "l0", "l1", "l2", "l3")
    out = out.join(F.broadcast(around) if p.whole else around, [*own, "qx", "qy"], "left")
    for e, d in (("e0", "l0"), ("e1", "l1"), ("e2", "l2"), ("e3", "l3")):
        out = out.withColumn(e, _value(F.col(d), p)).drop(d)
    near = {"d00": ("e0", "e1", "e2", "e3"), "d10": ("e1", "e0", "e2", "e3"), "d01": ("e2", "e1", "e0", "e3"), "d11": ("e3", "e2", "e1", "e0")}
    d = {k: F.coalesce(*v) for k, v in near.items()}
    top = (F.col("sx") - F.col("wx")) * d["d00"] + F.col("wx") * d["d10"]
    low = (F.col("sx") - F.col("wx")) * d["d01"] + F.col("wx") * d["d11"]
    v = ((F.col("sy") - F.col("wy")) * top + F.col("wy") * low) / (F.col("sx") * F.col("sy"))
    return out.select("k", "r", "c", F.when(inside, F.coalesce(v, "v")).otherwise(F.col("v")).alias("v"))
