"""Aggregations of lines, blocks and bins, and detectors built from them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..cube import DBL_EPSILON, FLT_EPSILON, is_nodata
from . import tiles
from .maps import minus_background, once


def share(n: Column, ratio: float) -> Column:
    """int(n * ratio) with the product in single precision."""
    return (n.cast("float") * F.lit(ratio).cast("float")).cast("int")


def _values(nodata) -> Column:
    return F.array_sort(F.collect_list(F.when(~is_nodata(F.col("v"), nodata), F.col("v"))))


def upper_median(values: Column) -> Column:
    """The middle of a sorted array, the upper of two; null if it is empty."""
    return F.get(values, F.floor(F.size(values) / 2).cast("int"))


def line_stats(frames: DataFrame, cut_lower: float = 0.0, cut_upper: float = 0.0, nodata=()) -> DataFrame:
    """k, r, mean, std (of the population) of each line without nodata and trimmed at both ends; (0, 0) if nothing is left. A line's cells meet in one row."""
    s = frames.groupBy("k", "r").agg(_values(nodata).alias("s")).withColumn("n", F.size("s"))
    lo, hi = share(F.col("n"), cut_lower), share(F.col("n"), cut_upper)
    s = s.withColumn("s", F.slice("s", lo + 1, F.greatest(F.col("n") - lo - hi, F.lit(0)))).withColumn("n", F.size("s"))
    total = lambda f: F.aggregate("s", F.lit(0.0), lambda a, x: a + f(x))
    mean = F.try_divide(total(lambda x: x), F.col("n"))
    s = s.withColumn("mean", F.coalesce(mean, F.lit(0.0)))
    var = F.try_divide(total(lambda x: (x - F.col("mean")) * (x - F.col("mean"))), F.col("n"))
    return s.select("k", "r", "mean", F.sqrt(F.coalesce(var, F.lit(0.0))).alias("std"))


def stats_to_coefficients(stats: DataFrame) -> DataFrame:
    """Gain and offset that bring each line to its frame's average mean and std; (1, 0) for flat lines."""
    frame, flat = W.partitionBy("k"), F.col("std") <= FLT_EPSILON
    m, s = F.avg(F.when(~flat, F.col("mean"))).over(frame), F.avg(F.when(~flat, F.col("std"))).over(frame)
    a = F.when(flat, 1.0).otherwise(F.try_divide(s, F.col("std")))
    return stats.withColumn("m", m).withColumn("a", a).select("k", "r", "a", F.when(flat, 0.0).otherwise(F.col("m") - F.col("mean") * F.col("a")).alias("b"))


def line_median(frames: DataFrame, nodata=()) -> DataFrame:
    return frames.groupBy("k", "r").agg(_values(nodata).alias("s")).select("k", "r", upper_median(F.col("s")).alias("v"))


def sort_lines(frames: DataFrame) -> DataFrame:
    """Values of each line in ascending order, NaN last."""
    return frames.withColumn("c", F.row_number().over(W.partitionBy("k", "r").orderBy("v")) - 1)


def background(frames: DataFrame, ksize: int = 30, method: str = "average") -> DataFrame:
    """k is the block: average or upper median of each cell over ksize frames."""
    g = frames.groupBy(F.floor(F.col("k") / ksize).cast("int").alias("k"), "r", "c")
    return g.agg(F.avg("v").alias("v")) if method == "average" else g.agg(_values(()).alias("s")).select("k", "r", "c", upper_median(F.col("s")).alias("v"))


def remove_background(frames: DataFrame, ksize: int = 30, method: str = "average") -> DataFrame:
    """Each value less its block's background: an average by one window (one shuffle, no join), a median once a block, joined back."""
    if method != "average":
        return minus_background(frames, background(frames, ksize, method), ksize)
    block = W.partitionBy(F.floor(F.col("k") / ksize).cast("int"), "r", "c")
    return frames.select("k", "r", "c", (F.col("v") - F.avg("v").over(block)).alias("v"))


def histogram(frames: DataFrame, low: float, high: float, step: float = 1.0, by: tuple[str, ...] = ("k",)) -> DataFrame:
    """by, bin, n over all bins of [low, high), and under and over counts as bins -1 and the number of bins; NaN and infinities are left out."""
    bins = int((high - low) / step)
    v = F.col("v")
    b = F.when(v < low, -1).when(v >= high, bins).otherwise(F.least(((v - low) / step).cast("int"), F.lit(bins - 1)))
    counts = frames.filter(~F.isnan(v) & (F.abs(v) < float("inf"))).groupBy(*by, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = frames.select(*by).distinct().withColumn("bin", F.explode(F.sequence(F.lit(-1), F.lit(bins))))
    return grid.join(counts, [*by, "bin"], "left").select(*by, "bin", F.coalesce("n", F.lit(0)).alias("n"))


def _inside(hist: DataFrame, bins: int) -> DataFrame:
    return hist.filter((F.col("bin") >= 0) & (F.col("bin") < bins))


def cumulative(hist: DataFrame, bins: int, by=("k",)) -> DataFrame:
    return _inside(hist, bins).withColumn("cum", F.sum("n").over(W.partitionBy(*by).orderBy("bin").rowsBetween(W.unboundedPreceding, 0)))


def histogram_cut(hist: DataFrame, bins: int, lower: float, upper: float, by=("k",)) -> DataFrame:
    """by, first, last: the bins that stay when the shares of counts at both ends are cut."""
    h = cumulative(hist, bins, by)
    every = W.partitionBy(*by)
    h = h.withColumn("total", F.sum("n").over(every)).withColumn("down", F.col("total") - F.col("cum") + F.col("n"))
    first = F.min(F.when(F.col("cum") > share(F.col("total"), lower), F.col("bin")))
    last = F.max(F.when(F.col("down") > share(F.col("total"), upper), F.col("bin")))
    return h.groupBy(*by).agg(first.alias("first"), last.alias("last"))


def histogram_clip(hist: DataFrame, bins: int, limit: int, by=("k",)) -> DataFrame:
    """Counts held to limit, the excess spread: an equal part to every bin, what is left one each from bin 0 in even steps."""
    h, every = _inside(hist, bins), W.partitionBy(*by)
    h = h.withColumn("excess", F.sum(F.greatest(F.col("n") - limit, F.lit(0))).over(every))
    h = h.withColumn("each", F.floor(F.col("excess") / bins)).withColumn("left", F.col("excess") % bins)
    step = F.greatest(F.floor(F.lit(bins) / F.greatest("left", F.lit(1))), F.lit(1))
    extra = (F.col("left") > 0) & (F.col("bin") % step == 0) & (F.floor(F.col("bin") / step) < F.col("left"))
    return h.select(*by, "bin", (F.least("n", F.lit(limit)) + F.col("each") + extra.cast("long")).alias("n"))


def histogram_median(hist: DataFrame, bins: int, low: float, step: float = 1.0, by=("k",)) -> DataFrame:
    """The value of the bin of the lower median: its low edge, plus half a step unless the step is 1."""
    h = cumulative(hist, bins, by).withColumn("total", F.sum("n").over(W.partitionBy(*by)))
    b = F.min(F.when(F.col("cum") >= F.floor((F.col("total") + 1) / 2), F.col("bin")))
    return h.filter("total > 0").groupBy(*by).agg(b.alias("bin")).select(*by, (low + F.col("bin") * step + (0.0 if step == 1 else 0.5 * step)).alias("v"))


def masked_stats(frames: DataFrame, low: float, high: float, by=("k",)) -> DataFrame:
    """mean, std, min and max of the values in [low, high)."""
    v = F.when(~F.isnan("v") & (F.col("v") >= low) & (F.col("v") < high), F.col("v"))
    return frames.groupBy(*by).agg(F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"))


def stripe_stats(frames: DataFrame, lines: int, tile: int = 20) -> DataFrame:
    """Mean and std of each column in stripes of tile lines; the last stripe takes the rest but for the last line."""
    n = max(lines // tile, 1)
    s = F.least(F.floor(F.col("r") / tile), F.lit(n - 1)).cast("int")
    return frames.filter(F.col("r") < lines - 1).groupBy("k", s.alias("s"), "c").agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"))


def residuals(d: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Root mean square, mean, and the residual of largest size of column d."""
    return d.groupBy(*by).agg(F.sqrt(F.avg(F.col("d") * F.col("d"))).alias("rms"), F.avg("d").alias("mean"), F.max(F.abs("d")).alias("worst"))


def empty_tiles(frames: DataFrame, tile: int, nodata=()) -> DataFrame:
    """Whether all of a tile is 0 or nodata."""
    empty = (F.col("v") == 0) | is_nodata(F.col("v"), nodata)
    return frames.groupBy("k", F.floor(F.col("r") / tile).cast("int").alias("ty"), F.floor(F.col("c") / tile).cast("int").alias("tx")).agg(F.bool_and(empty).alias("empty"))


def packet_frames(packets: DataFrame) -> DataFrame:
    """Packets (file, ord, data_type, band): each META packet begins a frame, which the source counts as line, or a window does; file, line, packets, valid (as many image packets as the file has bands)."""
    if "line" not in packets.columns:
        order = W.partitionBy("file").orderBy("ord").rowsBetween(W.unboundedPreceding, 0)
        packets = packets.withColumn("line", F.sum((F.col("data_type") == "META").cast("int")).over(order) - 1)
    p = packets.filter("line >= 0")
    image = F.col("data_type") == "IMAGE"
    f = p.groupBy("file", "line").agg(F.count(F.when(image, 1)).alias("packets"), F.max(F.when(image, F.col("band"))).alias("top"))
    return f.withColumn("valid", F.col("packets") == F.max("top").over(W.partitionBy("file")) + 1).select("file", "line", "packets", "valid")


def destripe(frames: DataFrame, tile_size: int = 31, lo: float = 0.0, hi: float = 3.4028234663852886e38) -> DataFrame:
    """Each line scaled to the moving average of line sums; the window reaches one line less back than ahead, and over lines that are there."""
    e = tile_size // 2
    sums = frames.groupBy("k", "r").agg(F.sum("v").alias("h"))
    m = F.avg("h").over(W.partitionBy("k").orderBy("r").rangeBetween(1 - e, e))
    corr = sums.withColumn("corr", F.when(F.col("h") == 0, F.lit(1.7976931348623157e308)).otherwise((m - F.col("h")) / F.nullif("h", F.lit(0.0)))).select("k", "r", "corr")
    v = F.col("v") + F.col("v") * F.col("corr")
    return frames.join(corr, ["k", "r"]).select("k", "r", "c", F.when(v < lo, lo).when(v > hi, hi).otherwise(v).alias("v"))


def median_filter(frames: DataFrame, rows: int, cols: int, ksize: int = 3, tile: int = tiles.TILE) -> DataFrame:
    """Upper median of ksize by ksize cells that are there, the border replicated."""
    return tiles.tiled(frames, rows, cols, ksize // 2, lambda p: tiles.median(p, ksize), tile=tile)


#: The public table of small Gaussian kernels.
GAUSS = {1: (1.0,), 3: (0.25, 0.5, 0.25), 5: (0.0625, 0.25, 0.375, 0.25, 0.0625), 7: (0.03125, 0.109375, 0.21875, 0.28125, 0.21875, 0.109375, 0.03125)}


def gauss_kernel(ksize: int) -> tuple[float, ...]:
    if ksize in GAUSS:
        return GAUSS[ksize]
    sigma = 0.3 * ((ksize - 1) * 0.5 - 1) + 0.8
    w = np.exp(-((np.arange(ksize) - (ksize - 1) / 2) ** 2) / (2 * sigma * sigma))
    return tuple((w / w.sum()).tolist())


def gauss(frames: DataFrame, rows: int, cols: int, ksize: int = 3, band: int = 0, dim: int = 1, tile: int = tiles.TILE, shared: bool = True) -> DataFrame:
    """Gaussian smoothing along lines' axis (dim 1), places (dim 0) or both, mirrored at the border without the edge; lines before band stay as they are.

    Weights of cells that are not there go to the others (shared), or such cells count as 0.
    """
    kernel = gauss_kernel(ksize)
    axes = (0,) if dim == 1 else (1,) if dim == 0 else (1, 0)
    return tiles.tiled(frames, rows, cols, ksize // 2, lambda p: tiles.smooth(p, kernel, axes, band, shared), tile=tile)


#: The peak test's ratios (0 at the centre, whose place in the parameter holds the threshold).
PEAK = ((0.1, 0.1, 0.1, 0.1, 0.1), (0.1, 1, 1, 1, 0.1), (0.1, 1, 0, 1, 0.1), (0.1, 1, 1, 1, 0.1), (0.1, 0.1, 0.1, 0.1, 0.1))


def peaks(frames: DataFrame, rows: int, cols: int, threshold: float = 100.0, ratios=PEAK, tolerance: int | None = None, tile: int = tiles.TILE) -> DataFrame:
    """k, r, c, v, n: v is 0 where the cell is no peak; n, the neighbours that are not below centre * ratio (null if it is none). A neighbour that is not there is 0."""
    h, w = len(ratios), len(ratios[0])
    tolerance = max(w, h) if tolerance is None else tolerance
    return tiles.tiled(frames, rows, cols, max(w, h) // 2, lambda p: tiles.peak(p, ratios, threshold, tolerance), f"{tiles.CELLS}, n long", tile)


#: Pixels of a row of anomaly()'s vectors.
PIXELS = 4096


def _vectors(frames: DataFrame, ksize: int) -> DataFrame:
    """(block, part, frames, r, c, x): vectors of the pixels that have all frames of their block, up to PIXELS or so in a row, and the other pixels without."""
    # a part is a square of pixels, so its size does not grow with the frame
    side = int(PIXELS**0.5)
    block, part = F.floor(F.col("k") / ksize).cast("int"), F.struct(F.floor(F.col("r") / side).alias("y"), F.floor(F.col("c") / side).alias("x"))
    dealt = frames.select(block.alias("block"), part.alias("part"), F.col("k").cast("int").alias("k"), F.col("r").cast("int").alias("r"), F.col("c").cast("int").alias("c"), F.col("v").cast("double").alias("v"))
    counts = dealt.groupBy("block").agg(F.array_sort(F.collect_set("k")).alias("frames"))
    dealt = dealt.join(once(counts, "frames"), "block")

    def pack(table):
        import pyarrow as pa

        k, r, c = (table.column(n).to_numpy() for n in ("k", "r", "c"))
        every = np.array(table.column("frames")[0].as_py())
        cells = r.astype(np.int64) << 32 | c.astype(np.int64)
        pixels, at = np.unique(cells, return_inverse=True)
        x = np.full((len(pixels), len(every)), np.nan)
        count = np.zeros(len(pixels), int)
        x[at, np.searchsorted(every, k)] = table.column("v").to_numpy()
        np.add.at(count, at, 1)
        whole = count == len(every)
        out = {"block": [table.column("block")[0].as_py()], "size": [len(every)]}
        for name, which in (("pixels", whole), ("others", ~whole)):
            out[name] = [pixels[which].tobytes()]
        return pa.table({"block": pa.array(out["block"], pa.int32()), "size": pa.array(out["size"], pa.int32()), "pixels": pa.array(out["pixels"], pa.binary()), "others": pa.array(out["others"], pa.binary()), "x": pa.array([x[whole].tobytes()], pa.binary())})

    return dealt.groupBy("block", "part").applyInArrow(pack, "block int, size int, pixels binary, others binary, x binary")


def anomaly(frames: DataFrame, ksize: int = 30) -> DataFrame:
    """Squared Mahalanobis distance of each pixel's vector of ksize frames, by block; k is the block.

    Cells are shuffled once, into squares of pixels. Moments are sums of outer products, merged with their means; each
    block has one matrix of ksize by ksize, which is inverted once and sent to the block's squares, not to its
    pixels. A pixel that lacks a frame of its block (a frame of which the cube has any cell) is left out of the moments, and
    its distance is null.
    """
    import pyarrow as pa

    vectors = _vectors(frames, ksize)

    def moments(batches):
        for batch in batches:
            for b, n, x in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                x = np.frombuffer(x, float).reshape(-1, n)
                if len(x):
                    mean = x.mean(axis=0)
                    d = x - mean
                    yield pa.RecordBatch.from_pydict({"block": pa.array([b], pa.int32()), "n": pa.array([len(x)], pa.int64()), "mean": pa.array([mean.tobytes()], pa.binary()), "m2": pa.array([(d.T @ d).tobytes()], pa.binary())})

    def merge(table):
        total, mean, m2 = 0, 0.0, 0.0
        for r in table.to_pylist():
            other, square = np.frombuffer(r["mean"], float), np.frombuffer(r["m2"], float)
            size, n = len(other), total + r["n"]
            d = other - mean
            m2 = m2 + square.reshape(size, size) + np.outer(d, d) * (total * r["n"] / n)
            mean, total = mean + d * (r["n"] / n), n
        return total, mean, m2

    def part(table):
        n, mean, m2 = merge(table)
        return pa.table({"block": table.column("block").slice(0, 1), "n": pa.array([n], pa.int64()), "mean": pa.array([mean.tobytes()], pa.binary()), "m2": pa.array([m2.tobytes()], pa.binary())})

    def solve(table):
        n, mean, m2 = merge(table)
        cov = m2 / (n - 1) if n > 1 else m2 * 0
        if np.linalg.det(cov) == 0:
            cov = cov + 1e-6 * np.eye(len(mean))
        return pa.table({"block": table.column("block").slice(0, 1), "mean": pa.array([mean.tobytes()], pa.binary()), "inv": pa.array([np.linalg.inv(cov).tobytes()], pa.binary())})

    kinds = "block int, n long, mean binary, m2 binary"
    sums = vectors.select("block", "size", "x").mapInArrow(moments, kinds)
    sums = sums.withColumn("salt", F.pmod(F.xxhash64("mean"), F.lit(32))).groupBy("block", "salt").applyInArrow(lambda t: part(t.drop_columns("salt")), kinds)
    solved = sums.groupBy("block").applyInArrow(solve, "block int, mean binary, inv binary")

    def score(batches):
        for batch in batches:
            for r in batch.to_pylist():
                pixels, others = (np.frombuffer(r[c], np.int64) for c in ("pixels", "others"))
                d = np.frombuffer(r["x"], float).reshape(-1, r["size"])
                if len(d):
                    d = d - np.frombuffer(r["mean"], float)
                    v = np.einsum("ij,ij->i", d @ np.frombuffer(r["inv"], float).reshape(r["size"], -1), d)
                else:
                    v = np.zeros(0)
                every = np.concatenate([pixels, others])
                yield pa.RecordBatch.from_pydict(
                    {
                        "k": pa.array(np.full(len(every), r["block"], np.int32)),
                        "r": pa.array((every >> 32).astype(np.int32)),
                        "c": pa.array((every & 0xFFFFFFFF).astype(np.int32)),
                        "v": pa.concat_arrays([pa.array(v), pa.nulls(len(others), pa.float64())]),
                    }
                )

    return vectors.join(solved, "block", "left").mapInArrow(score, tiles.CELLS)


def calibrate(frames: DataFrame, cut_dark=0.03, cut_bright=0.1, threshold_dark=0.03, threshold_bright=0.03, sample_dark=40, sample_bright=40, scale: bool = True, tile_size: int | None = None, interpolate=None, nodata=(), tile_overlap: int | None = None, rows: int | None = None) -> DataFrame:
    """Relative calibration of lines: k, r, a, b, bad, hi, lo.

    Each line's trimmed sorted values give a dark and a bright sample, grown from their ends while the next
    value is within the threshold of the running mean. Lines with both samples give the tile's targets, which
    the others are brought to. With tiles, targets are interpolated between tile centres by `interpolate`
    (knots, values, places); tiles are few, lines one row each. Lines beyond the last whole tile are a tile of their own
    if they are more than tile_overlap (half a tile), else they go to the last; rows: the lines of a frame, if tiles are
    used, without it up to the frame's last line that is there.
    """
    least = 3
    s = frames.groupBy("k", "r").agg(_values(nodata).alias("s")).withColumn("n", F.size("s"))
    s = s.withColumn("st", share(F.col("n"), cut_dark)).withColumn("ed", F.col("n") - 1 - share(F.col("n"), cut_bright)).withColumn("ok", F.col("ed") >= F.col("st"))
    factor = lambda t, sign: float(np.float32(1 + sign * np.float32(t)))

    def grow(values: Column, f: float, most: int, dark: bool) -> Column:
        start = F.struct(F.get(values, F.lit(0)).alias("sum"), F.lit(1).alias("n"), F.lit(True).alias("on"))

        def step(acc, x):
            edge = acc["sum"] / acc["n"] * f
            take = acc["on"] & (x <= edge if dark else x >= edge) & (acc["n"] < most)
            return F.struct((acc["sum"] + F.when(take, x).otherwise(0.0)).alias("sum"), (acc["n"] + take.cast("int")).alias("n"), take.alias("on"))

        return F.aggregate(F.slice(values, 2, F.lit(most)), start, step)

    inner = F.slice("s", F.col("st") + 1, F.greatest(F.col("ed") - F.col("st") + 1, F.lit(0)))
    s = s.withColumn("inner", F.when(F.col("ok"), inner).otherwise(F.array(F.lit(0.0))))
    # the end of the other side is never taken
    length = F.greatest(F.size("inner") - 1, F.lit(1))
    s = s.withColumn("d", grow(F.slice("inner", F.lit(1), length), factor(threshold_dark, 1), sample_dark, True))
    s = s.withColumn("w", grow(F.slice(F.reverse("inner"), F.lit(1), length), factor(threshold_bright, -1), sample_bright, False))
    apart = F.col("d.sum") / F.col("d.n") * factor(threshold_dark, 1) < F.col("w.sum") / F.col("w.n") * factor(threshold_bright, -1)
    stat = F.when(~F.col("ok"), 2).when((F.col("d.n") >= least) & (F.col("w.n") >= least) & apart, 0).otherwise(1)
    lines = s.select("k", "r", stat.alias("stat"), F.col("d.sum").alias("sd"), F.col("d.n").alias("nd"), F.col("w.sum").alias("sw"), F.col("w.n").alias("nw"))
    frame = W.partitionBy("k")
    if tile_size is None:
        lines = lines.withColumn("tile", F.lit(0))
    else:
        overlap = tile_size // 2 if tile_overlap is None or tile_overlap < 0 else tile_overlap
        lines = lines.withColumn("rows", F.lit(rows) if rows is not None else F.max("r").over(frame) + 1)
        whole = F.greatest(F.floor(F.col("rows") / tile_size), F.lit(1))
        lines = lines.withColumn("tiles", (whole + (F.col("rows") - whole * tile_size > overlap).cast("int")).cast("int"))
        lines = lines.withColumn("tile", F.least(F.floor(F.col("r") / tile_size), F.col("tiles") - 1).cast("int"))
    tile = W.partitionBy("k", "tile")
    good, poor = F.col("stat") == 0, F.col("stat") == 1
    total = lambda c, when: F.sum(F.when(when, c)).over(tile)
    lines = lines.withColumn("lo", F.try_divide(total(F.col("sd"), good), total(F.col("nd"), good))).withColumn("hi", F.try_divide(total(F.col("sw"), good), total(F.col("nw"), good)))
    lines = lines.withColumn("pooled", F.try_divide(total(F.col("sd") + F.col("sw"), poor), total(F.col("nd") + F.col("nw"), poor))).withColumn("any", F.max(good).over(frame))
    if tile_size is not None:
        lines = _between_tiles(lines, tile_size, interpolate)
    sl, su = F.col("sd") / F.col("nd"), F.col("sw") / F.col("nw")
    mean = (F.col("sd") + F.col("sw")) / (F.col("nd") + F.col("nw"))
    fits = (F.col("stat") < 2) & (su - sl > DBL_EPSILON)
    a = F.when(F.col("any"), F.when(fits, F.try_divide(F.col("hi") - F.col("lo"), su - sl)).otherwise(1.0)).when(F.col("pooled").isNull(), 1.0).otherwise(F.try_divide(mean, F.col("pooled")) if scale else F.lit(1.0))
    lines = lines.withColumn("a", a)
    b = F.when(F.col("any"), F.when(fits, F.col("lo") - F.col("a") * sl).otherwise(0.0)).when(F.col("pooled").isNull(), 0.0).otherwise(F.lit(0.0) if scale else mean - F.col("pooled"))
    bad = F.when(F.col("any"), (~fits).cast("int")).otherwise(F.col("pooled").isNull().cast("int"))
    return lines.select("k", "r", "a", b.alias("b"), bad.alias("bad"), F.when(F.col("any"), F.col("hi")).alias("hi"), F.when(F.col("any"), F.col("lo")).alias("lo"))


def _between_tiles(lines: DataFrame, tile_size: int, interpolate) -> DataFrame:
    """hi and lo of every line from the tiles that have them; a frame's lines meet in one task."""
    schema = lines.schema

    def run(table):
        import pyarrow as pa

        t = table.to_pylist()
        known = {x["tile"]: (x["hi"], x["lo"]) for x in t if x["hi"] is not None}
        if len(known) > 1:
            rows, count, order = t[0]["rows"], t[0]["tiles"], sorted(known)
            centres = [i * tile_size + (tile_size if i + 1 < count else rows - i * tile_size) / 2 for i in order]
            x, places = np.array([0.0, *centres, rows]), np.array([float(q["r"]) for q in t])
            for which, name in enumerate(("hi", "lo")):
                y = [known[i][which] for i in order]
                for q, v in zip(t, interpolate(x, np.array([y[0], *y, y[-1]]), places), strict=True):
                    q[name] = float(v)
        elif known:
            (only,) = known.values()
            for q in t:
                q["hi"], q["lo"] = only
        return pa.Table.from_pylist(t, schema=table.schema)

    return lines.groupBy("k").applyInArrow(run, schema)
