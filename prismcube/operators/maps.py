"""Cell-wise maps. Frames are k, r, c, v; coefficient tables are r, c and values, joined by cell."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from ..cube import FLT_MAX, FLT_MIN, is_nodata
from ..sources import store

#: Coefficient rows up to which a table is sent to all tasks (24 bytes each); larger ones are shuffled.
BROADCAST_CELLS = 4_000_000


def small(table: DataFrame, cells: int | None = None) -> DataFrame:
    """table with a broadcast hint, if it has few enough rows; cells: an upper bound that the caller knows from the cube's shape."""
    n = cells if cells is not None else table.count()
    return F.broadcast(table) if n <= BROADCAST_CELLS else table


def once(table: DataFrame, name: str) -> DataFrame:
    """small() of a table that is worked out here and written first, so that its plan runs once and not again for the join."""
    return small(store.Kept(table.sparkSession)(table, name))


def clamped(d: Column, v: Column, nodata=(), lo: float = FLT_MIN, hi: float = FLT_MAX, overflow: str = "keep") -> Column:
    """d raised to lo; above hi the value stays as it was (keep) or becomes hi (clamp); nodata stays."""
    over = v if overflow == "keep" else F.lit(hi)
    return F.when(is_nodata(v, nodata), v).when(d < lo, F.lit(lo)).when(d > hi, over).otherwise(d)


def uniform(frames: DataFrame, coef: DataFrame, nodata=(), lo=FLT_MIN, hi=FLT_MAX, overflow="keep", cells=None) -> DataFrame:
    """a[r, c] * v + b[r, c] in every frame; coef: r, c, a, b."""
    out = frames.join(small(coef, cells), ["r", "c"])
    return out.select("k", "r", "c", clamped(F.col("a") * F.col("v") + F.col("b"), F.col("v"), nodata, lo, hi, overflow).alias("v"))


def dark_constant(frames: DataFrame, dark: DataFrame, nodata=(), lo=FLT_MIN, hi=FLT_MAX, overflow="keep", cells=None) -> DataFrame:
    """v - b[r, c]; dark: r, c, b."""
    out = frames.join(small(dark, cells), ["r", "c"])
    return out.select("k", "r", "c", clamped(F.col("v") - F.col("b"), F.col("v"), nodata, lo, hi, overflow).alias("v"))


def dark_linear(frames: DataFrame, dark: DataFrame, index: DataFrame, nodata=(), lo=FLT_MIN, hi=FLT_MAX, overflow="keep", cells=None) -> DataFrame:
    """v - (a[r, c] * idx[k] + b[r, c]); dark: r, c, a, b; index: k, idx."""
    out = frames.join(small(dark, cells), ["r", "c"]).join(small(index), "k")
    return out.select("k", "r", "c", clamped(F.col("v") - (F.col("a") * F.col("idx") + F.col("b")), F.col("v"), nodata, lo, hi, overflow).alias("v"))


def extend(frames: DataFrame, matrix: DataFrame, cells=None) -> DataFrame:
    """Every frame's cells take the matrix (r, c, v); cells outside it become 0."""
    m = small(matrix.select("r", "c", F.col("v").alias("m")), cells)
    return frames.join(m, ["r", "c"], "left").select("k", "r", "c", F.coalesce("m", F.lit(0.0)).alias("v"))


def minus_background(frames: DataFrame, background: DataFrame, interval: int = 30) -> DataFrame:
    """v[k, r, c] - background[k div interval, r, c]; both sides meet by block and cell."""
    bg = background.select(F.col("k").alias("block"), "r", "c", F.col("v").alias("bg"))
    out = frames.withColumn("block", F.floor(F.col("k") / interval).cast("int")).join(bg.withColumn("block", F.col("block").cast("int")), ["block", "r", "c"])
    return out.select("k", "r", "c", (F.col("v") - F.col("bg")).alias("v"))


def linear_lookup(v: Column, a: float, b: float) -> Column:
    return a * v + b


def table_lookup(v: Column, table: list[float]) -> Column:
    """table[(int) v], the index held inside the table."""
    i = F.greatest(F.lit(0), F.least(F.lit(len(table) - 1), v.cast("int")))
    return F.element_at(F.array(*(F.lit(float(t)) for t in table)), i + 1)


def map_lookup(v: Column, table: list[float], low: float, step: float) -> Column:
    """table[bin(v)] over a domain that begins at low, the bin held inside it."""
    return table_lookup((v - low) / step, table)


#: Bins of the first look at a frame's values.
PERCENTILE_BINS = 4096


def percentiles(frames: DataFrame, shares: list[float], by: tuple[str, ...] = ("k",)) -> DataFrame:
    """by, p0, p1, ..: percentiles (linear between ranks) of the values without NaN.

    Counts of equal bins tell which bins hold the ranks that are wanted; only values of those are counted one by one, so
    no group's values meet in one task, and equal ones are counted before the shuffle.
    """
    fine = frames.select(*by, "v").filter(F.col("v").isNotNull() & ~F.isnan("v"))
    ends = fine.groupBy(*by).agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("total"))
    ranks = [[f(F.lit(s) * (F.col("total") - 1)).cast("long") for f in (F.floor, F.ceil)] for s in shares]
    bin_of = F.coalesce(F.least(F.floor(F.try_divide(F.col("v") - F.col("lo"), F.col("hi") - F.col("lo")) * PERCENTILE_BINS), F.lit(PERCENTILE_BINS - 1)), F.lit(0)).cast("int")
    binned = fine.join(once(ends, "ends"), list(by)).withColumn("bin", bin_of)
    counts = binned.groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n"), F.first("total").alias("total"))
    line = W.partitionBy(*by).orderBy("bin").rowsBetween(W.unboundedPreceding, 0)
    counts = counts.withColumn("below", F.sum("n").over(line) - F.col("n"))
    holds = F.lit(False)
    for pair in ranks:
        for r in pair:
            holds = holds | ((r >= F.col("below")) & (r < F.col("below") + F.col("n")))
    wanted = counts.filter(holds).select(*by, "bin", "below", "total")
    values = binned.drop("total").join(once(wanted, "wanted"), [*by, "bin"]).groupBy(*by, "bin", "v").agg(F.count(F.lit(1)).alias("n"), F.first("below").alias("below"), F.first("total").alias("total"))
    inside = W.partitionBy(*by, "bin").orderBy("v").rowsBetween(W.unboundedPreceding, 0)
    values = values.withColumn("from", F.col("below") + F.sum("n").over(inside) - F.col("n"))
    picked = [F.max(F.when((r >= F.col("from")) & (r < F.col("from") + F.col("n")), F.col("v"))) for pair in ranks for r in pair]
    out = values.groupBy(*by).agg(F.first("total").alias("total"), *(c.alias(f"x{i}") for i, c in enumerate(picked)))
    exact = []
    for i, s in enumerate(shares):
        at, low, high = F.lit(s) * (F.col("total") - 1), F.col(f"x{2 * i}"), F.col(f"x{2 * i + 1}")
        exact.append(F.when(low == high, low).otherwise((F.ceil(at) - at) * low + (at - F.floor(at)) * high).alias(f"p{i}"))
    return out.select(*by, *exact)


def stretch(frames: DataFrame, percent: float = 1.0, by: tuple[str, ...] = ("k",)) -> DataFrame:
    """round(255 * (clip(v, pa, pb) - pa) / (pb - pa)) with percentiles pa, pb (linear) of each frame without NaN; half to even."""
    p = percentiles(frames, [percent / 100, 1 - percent / 100], by).withColumnsRenamed({"p0": "pa", "p1": "pb"})
    out = frames.join(once(p, "percentiles"), list(by))
    v = F.least(F.greatest("v", "pa"), "pb")
    return out.select("k", "r", "c", F.bround(255 * F.try_divide(v - F.col("pa"), F.col("pb") - F.col("pa"))).alias("v"))


def gain_offset(stats: DataFrame) -> DataFrame:
    """a = 1 / std (0 for a std of 0), b = -mean * a; stats keep their keys."""
    a = F.when(F.col("std") == 0, 0.0).otherwise(1.0 / F.when(F.col("std") == 0, 1.0).otherwise(F.col("std")))
    return stats.withColumn("a", a).withColumn("b", -F.col("mean") * F.col("a"))


def two_point(cells: DataFrame) -> DataFrame:
    """Gain and offset of each cell (r, c, low, high) that bring it to its row's medians; a difference of 0 counts as 1e-4."""
    row = W.partitionBy("r")
    lo, hi = F.median("low").over(row), F.median("high").over(row)
    d = F.col("high") - F.col("low")
    a = (hi - lo) / F.when(d == 0, 1e-4).otherwise(d)
    return cells.withColumn("a", a).withColumn("b", lo - F.col("a") * F.col("low"))


def reflectance_gain(v: Column, reflectance: float = 9500.0) -> Column:
    return F.try_divide(F.lit(reflectance), v)


def bad_pixels(cells: DataFrame, module: int = 512) -> DataFrame:
    """1-based (row, col) of cells (r, c, light, sigma, dark) that stand out from their module's row."""
    part = W.partitionBy("r", F.floor(F.col("c") / module))
    d = F.col("light") - F.col("dark")
    md, ms, mk = F.avg(d).over(part), F.avg("sigma").over(part), F.avg("dark").over(part)
    bad = (d > 1.5 * md) | (d < 0.5 * md) | (F.col("sigma") > 2 * ms) | (F.col("dark") > 1.5 * mk) | (F.col("dark") < 0.5 * mk)
    return cells.withColumn("bad", bad).filter("bad").select((F.col("r") + 1).alias("row"), (F.col("c") + 1).alias("col"))


def shift_module(frames: DataFrame, shift: int = 577, module: int = 512, lines: int | None = None) -> DataFrame:
    """Lines of the middle module move up by shift; modules 0 to 2 alone are written."""
    n = F.lit(lines) if lines is not None else F.max("r").over(W.partitionBy()) + 1
    r = F.when(F.floor(F.col("c") / module) == 1, F.col("r") - shift).otherwise(F.col("r"))
    out = frames.filter(F.col("c") < 3 * module).withColumn("n", n).withColumn("r", r)
    return out.filter("r >= 0 AND r < n").select("k", "r", "c", "v")


def rectangles(bounds: DataFrame) -> DataFrame:
    """All (row, col) of closed ranges (row0, row1, col0, col1; other columns stay)."""
    keys = [c for c in bounds.columns if c not in ("row0", "row1", "col0", "col1")]
    whole = bounds.filter("row0 <= row1 AND col0 <= col1")
    rows = whole.withColumn("row", F.explode(F.sequence("row0", "row1")))
    return rows.select(*keys, "row", F.explode(F.sequence("col0", "col1")).alias("col"))


def geo_grid(points: DataFrame, gsd: float = 1 / 110000, lon0: float = 120.0, lat0: float = 34.0) -> DataFrame:
    """Longitude and latitude of a regular grid by column i and line j."""
    return points.withColumn("lon", lon0 + F.col("i") * gsd).withColumn("lat", lat0 - F.col("j") * gsd).withColumn("z", F.lit(0.0))


def homography(points: DataFrame, h: list[list[float]]) -> DataFrame:
    """x, y through a 3 by 3 matrix."""
    at = lambda row: row[0] * F.col("x") + row[1] * F.col("y") + row[2]
    w = at(h[2])
    return points.withColumn("hx", F.try_divide(at(h[0]), w)).withColumn("hy", F.try_divide(at(h[1]), w))


def bounding_box(points: DataFrame) -> DataFrame:
    box = points.agg(F.min("x").alias("xmin"), F.min("y").alias("ymin"), F.max("x").alias("xmax"), F.max("y").alias("ymax"))
    return box.select("xmin", "ymin", (F.col("xmax") - F.col("xmin")).alias("w"), (F.col("ymax") - F.col("ymin")).alias("h"))


def crop(frames: DataFrame, x: int, y: int, w: int, h: int, fill: float = 0.0) -> DataFrame:
    """A w by h window at (x, y) of every frame; cells outside the image hold fill."""
    grid = frames.select("k").distinct().withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(h - 1)))).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(w - 1))))
    inside = frames.filter((F.col("c") >= x) & (F.col("c") < x + w) & (F.col("r") >= y) & (F.col("r") < y + h))
    inside = inside.select("k", (F.col("r") - y).cast("int").alias("r"), (F.col("c") - x).cast("int").alias("c"), "v")
    return grid.join(inside, ["k", "r", "c"], "left").select("k", "r", "c", F.coalesce("v", F.lit(fill)).alias("v"))


#: Bytes of a binary column that are unpacked at a time.
UNPACKED = 1 << 20


def _cut(data: pa.Array, most: int) -> Iterator[pa.Array]:
    """Slices of a binary array of about that many bytes, a row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(data), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at, done = 0, 0
    while at < len(data):
        end = max(int(np.searchsorted(ends, done + most, "right")), at + 1)
        yield data.slice(at, end - at)
        at, done = end, int(ends[end - 1])


def _unpacked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    from ..sources.files import unpack12 as unpack

    for batch in batches:
        for data in _cut(batch, UNPACKED):
            rows = [x or b"" for x in data.to_pylist()]
            if any(len(x) % 3 for x in rows):
                parts = [unpack(x) for x in rows]
                values, sizes = np.concatenate(parts), [len(x) for x in parts]
            else:  # whole threes, as in packets: rows one behind another are unpacked at once
                values, sizes = unpack(b"".join(rows)), [len(x) // 3 * 2 for x in rows]
            yield pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.array(values.astype(np.int32, copy=False)))


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def unpack12(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """12-bit samples of a binary column: three bytes hold two, high bits first; null has none. About UNPACKED bytes are unpacked at a time, however many an Arrow batch holds."""
    return _unpacked(batches)


def to_type(v: Column, kind: str) -> Column:
    """What a raster file keeps of v: rounded and held in the type's range for whole numbers."""
    ranges = {"byte": (0, 255), "uint16": (0, 65535), "int16": (-32768, 32767), "uint32": (0, 4294967295), "int32": (-2147483648, 2147483647)}
    if kind in ranges:
        lo, hi = ranges[kind]
        return F.greatest(F.least(F.round(v), F.lit(float(hi))), F.lit(float(lo))).cast("long" if kind == "uint32" else "int")
    return v.cast({"float32": "float", "float64": "double"}[kind])
