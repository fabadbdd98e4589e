"""Line segments of frames, from the published description of the detector (Grompone von Gioi et al., IPOL 2012): level-line
angles, region growing in order of gradient size, a rectangle for each region, and acceptance by the expected number of false alarms.

Nothing sees a whole frame. Angles come from tiles with a margin. A region only ever grows into an adjacent cell that has an angle, so
connected shapes of such cells (operators.shapes) are independent, whatever tiles they cross, and are grown one by one. A rectangle also counts cells
of other shapes; it is sent to the tiles that it touches, which count theirs, and the counts are added. A task holds a tile or a shape.
"""

from __future__ import annotations

from math import atan2, cos, lgamma, log, log10, pi, sin

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import store
from . import shapes, tiles

SEGMENT = "k int, x1 double, y1 double, x2 double, y2 double, width double, p double, nfa double"

#: Lines and places of the tiles in which a rectangle's cells are counted, and how much narrower than a region its rectangles may be.
COUNT_TILE = 64
NARROWER = tuple(0.5 * i for i in range(6))


def _reach(scale: float, sigma_scale: float) -> int:
    return 0 if scale == 1 else int(np.ceil(sigma_scale / scale * np.sqrt(2 * 3 * log(10))))


def _taken(a: np.ndarray, scale: float, sigma_scale: float, first: int, last: int, n: int, low: int) -> np.ndarray:
    """Lines first .. last of the smaller frame from a, which holds the lines from low of a frame of n."""
    if scale == 1:
        return a[first - low : last + 1 - low]
    sigma, half = sigma_scale / scale, _reach(scale, sigma_scale)
    at = np.arange(first, last + 1) / scale
    near = np.floor(at + 0.5).astype(int)[:, None] + np.arange(-half, half + 1)
    w = np.exp(-0.5 * ((near - at[:, None]) / sigma) ** 2)
    near = np.mod(near, 2 * n)
    near = np.where(near >= n, 2 * n - 1 - near, near)
    return np.einsum("ij,ij...->i...", w / w.sum(1, keepdims=True), a[near - low])


def subsample(m: np.ndarray, scale: float, sigma_scale: float) -> np.ndarray:
    """Smoothed by a Gaussian of sigma_scale / scale and taken at 1 / scale steps, borders mirrored."""
    for _ in range(2):
        m = _taken(m, scale, sigma_scale, 0, int(np.ceil(m.shape[0] * scale)) - 1, m.shape[0], 0).T
    return m


def level_lines(m: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Angles of level lines (NaN where the gradient is not above the threshold) and gradient sizes, on a 2 by 2 stencil."""
    a, b = m[1:, 1:] - m[:-1, :-1], m[:-1, 1:] - m[1:, :-1]
    gx, gy = (a + b) / 2, (a - b) / 2
    size = np.sqrt(gx * gx + gy * gy)
    return np.where(size > threshold, np.arctan2(gx, -gy), np.nan), size


def _apart(a, b):
    d = np.abs(np.mod(a - b + pi, 2 * pi) - pi)
    return d


def log_nfa(n: int, k: int, p: float, tests: float) -> float:
    """-log10 of tests times the binomial tail of k or more of n; terms that no longer count are left out."""
    if n == 0 or k == 0:
        return -tests
    if k == n:
        return -tests - n * log10(p)
    terms: list[float] = []
    for i in range(k, n + 1):
        terms.append(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * log(p) + (n - i) * log(1 - p))
        if i > (n + 1) * p and terms[-1] < terms[0] - 60:  # terms fall from here on, and the first is among the sum
            break
    top = max(terms)
    return -(top + log(sum(np.exp(np.array(terms) - top)))) / log(10) - tests


def level_cells(frames: DataFrame, rows: int, cols: int, scale: float, sigma_scale: float, threshold: float, tile: int) -> DataFrame:
    """k, r, c, v (gradient size), angle of the cells of the smaller frames whose gradient is above the threshold. Cells that are not there are 0."""
    half, size = _reach(scale, sigma_scale), {"r": rows, "c": cols}
    small = {x: int(np.ceil(n * scale)) for x, n in size.items()}
    if half + 4 > tile / scale:
        raise ValueError("the smoothing reaches further than a tile")

    def span(t: int, x: str) -> tuple[int, int, int, int]:
        first, last = t * tile, min((t + 1) * tile, small[x] - 1)
        return first, last, max(int(np.floor(first / scale + 0.5)) - half - 2, 0), min(int(np.floor(last / scale + 0.5)) + half + 2, size[x] - 1)

    def seen_by(x: str) -> Column:
        """The tiles of the smaller frame that need a line or place."""
        t, out, count = F.floor(F.col(x) * scale / tile), [], -(-(small[x] - 1) // tile)
        for d in (-1, 0, 1):
            low = F.floor((t + d) * tile / scale + 0.5) - half - 2
            high = F.floor(F.least((t + d + 1) * tile, F.lit(small[x] - 1)) / scale + 0.5) + half + 2
            out.append(F.when((t + d >= 0) & (t + d < count) & (F.col(x) >= low) & (F.col(x) <= high), (t + d).cast("int")))
        return F.explode(F.array_compact(F.array(*out)))

    def run(table: pa.Table) -> pa.Table:
        k, y, x = (table.column(c)[0].as_py() for c in ("k", "ty", "tx"))
        (r0, r1, top, low), (c0, c1, left, right) = span(y, "r"), span(x, "c")
        m = np.zeros((low - top + 1, right - left + 1))
        m[table.column("r").to_numpy() - top, table.column("c").to_numpy() - left] = table.column("v").to_numpy()
        m = _taken(_taken(m, scale, sigma_scale, r0, r1, rows, top).T, scale, sigma_scale, c0, c1, cols, left).T
        angle, v = level_lines(m, threshold)
        i, j = np.nonzero(~np.isnan(angle))
        return pa.table({"k": pa.array(np.full(len(i), k, np.int32)), "r": pa.array((i + r0).astype(np.int32)), "c": pa.array((j + c0).astype(np.int32)), "v": v[i, j], "angle": angle[i, j]})

    dealt = frames.select(*(F.col(x).cast("int").alias(x) for x in ("k", "r", "c")), F.col("v").cast("double").alias("v"))
    dealt = dealt.withColumn("ty", seen_by("r")).withColumn("tx", seen_by("c"))
    return dealt.groupBy("k", "ty", "tx").applyInArrow(run, f"{tiles.CELLS}, angle double")


def _rectangle(r: np.ndarray, c: np.ndarray, w: np.ndarray, theta: float) -> tuple[float, ...]:
    """The rectangle of a region's cells: its middle, direction (along theta), ends from the middle, and width."""
    my, mx = float((r * w).sum() / w.sum()), float((c * w).sum() / w.sum())
    dy, dx = r - my, c - mx
    xy = (w * dy * dx).sum()
    v = np.linalg.eigh(np.array([[(w * dy**2).sum(), xy], [xy, (w * dx**2).sum()]]))[1][:, 1]  # the direction in which the region is longest
    t = atan2(v[0], v[1])
    t = t + pi if _apart(t, theta) > pi / 2 else t
    along, across = dy * sin(t) + dx * cos(t), dy * cos(t) - dx * sin(t)
    return my, mx, t, float(along.min()), float(along.max()), max(float(across.max() - across.min()), 1.0)


def _density(n: int, rec: tuple[float, ...]) -> float:
    return n / max((rec[4] - rec[3]) * rec[5], 1e-9)


def grow_regions(r: np.ndarray, c: np.ndarray, angle: np.ndarray, size: np.ndarray, bins: np.ndarray, tau: float, least: int, density_th: float) -> list[tuple]:
    """(seed's index, *rectangle) of the regions of one shape's cells, sorted row by row; seeds are taken by falling bin."""
    n, width = len(r), int(c.max()) - int(c.min()) + 3
    key = (r.astype(np.int64) - int(r.min()) + 1) * width + c - int(c.min()) + 1
    near = np.stack([key + dy * width + dx for dy in (-1, 0, 1) for dx in (-1, 0, 1)], 1)
    at = np.minimum(np.searchsorted(key, near), n - 1)
    beside = [[j for j, there in zip(js, ok, strict=True) if there] for js, ok in zip(at.tolist(), (key[at] == near).tolist(), strict=True)]
    a, co, si, free, out = angle.tolist(), np.cos(angle).tolist(), np.sin(angle).tolist(), [True] * n, []

    def grow(seed: int, tolerance: float) -> tuple[list[int], float]:
        part, sx, sy, theta, i = [seed], co[seed], si[seed], a[seed], 0
        free[seed] = False
        while i < len(part):
            for j in beside[part[i]]:
                if free[j] and abs((a[j] - theta + pi) % (2 * pi) - pi) <= tolerance:
                    free[j] = False
                    part.append(j)
                    sx, sy = sx + co[j], sy + si[j]
                    theta = atan2(sy, sx)
            i += 1
        return part, theta

    def release(cells) -> None:
        for j in cells:
            free[j] = True

    for seed in np.argsort(-bins, kind="stable").tolist():
        if not free[seed]:
            continue
        part, theta = grow(seed, tau)
        if len(part) < least:
            continue
        of = lambda p: (r[p], c[p], size[p])
        rec = _rectangle(*of(part), theta)
        if _density(len(part), rec) < density_th:  # a tighter tolerance, from the angles near the seed; then a shorter reach
            p = np.array(part)
            close = p[np.hypot(r[p] - r[seed], c[p] - c[seed]) < rec[5]]
            spread = np.sqrt((_apart(angle[close], a[seed]) ** 2).mean())
            release(part)
            part, theta = grow(seed, 2 * spread)
            if len(part) < 2:
                continue
            rec = _rectangle(*of(part), theta)
            reach = max(abs(rec[3]), abs(rec[4]))
            while _density(len(part), rec) < density_th and len(part) >= 2:
                reach *= 0.75
                p = np.array(part)
                far = np.hypot(r[p] - r[seed], c[p] - c[seed]) > reach
                release(p[far].tolist())
                part = p[~far].tolist()
                if len(part) >= 2:
                    rec = _rectangle(*of(part), theta)
            if len(part) < 2:
                continue
        out.append((seed, *rec))
    return out


def _touched(rec: tuple[float, ...], rows: int, cols: int) -> list[tuple[int, int]]:
    """The counting tiles that a rectangle may touch."""
    my, mx, t, lo, hi, width = rec
    y, x = (np.array([m + e * u + s * w for e in (lo - 0.5, hi + 0.5) for s in (-width / 2, width / 2)]) for m, u, w in ((my, sin(t), cos(t)), (mx, cos(t), -sin(t))))
    ends = [(max(int(v.min()) // COUNT_TILE, 0), min(int(v.max() + 1), n - 1) // COUNT_TILE + 1) for v, n in ((y, rows), (x, cols))]
    ty, tx = (g.ravel() for g in np.mgrid[ends[0][0] : ends[0][1], ends[1][0] : ends[1][1]])
    dy, dx = (ty + 0.5) * COUNT_TILE - my, (tx + 0.5) * COUNT_TILE - mx
    along, across = dy * sin(t) + dx * cos(t), dy * cos(t) - dx * sin(t)
    slack = COUNT_TILE * 0.75 + 1  # half a tile's diagonal, and more
    touched = (np.abs(across) <= width / 2 + slack) & (along >= lo - slack) & (along <= hi + slack)
    return list(zip(ty[touched].tolist(), tx[touched].tolist(), strict=True))


def _widths(width: float) -> list[float]:
    return [width - d for d in NARROWER if width - d >= 0.5] or [width]


REC = ("my", "mx", "t", "lo", "hi", "width")


def line_segments(frames: DataFrame, rows: int, cols: int, thickness=(1.0, 1.0), length=(11.0, 20.0), scale=0.8, sigma_scale=0.6, quant=2.0, ang_th=22.5, log_eps=0.0, density_th=0.7, n_bins=1024, tile: int = tiles.TILE) -> DataFrame:
    """Segments of every frame whose width and length are inside the ranges; a negative bound is none."""
    tau, p, keep = pi * ang_th / 180, ang_th / 180, store.Kept(frames.sparkSession)
    high, wide = int(np.ceil(rows * scale)) - 1, int(np.ceil(cols * scale)) - 1
    if high < 1 or wide < 1:
        return frames.sparkSession.createDataFrame([], SEGMENT)
    tests = 5 * (log10(high + 1) + log10(wide + 1)) / 2 + log10(11)
    least = int(-tests / log10(p))
    cells = keep(level_cells(frames, rows, cols, scale, sigma_scale, quant / np.sin(tau), tile), "angles")
    of_shapes = keep(shapes.label_shapes(cells, high, wide, tile, keep, ("angle",)), "shapes")
    large = of_shapes.groupBy("k", "shape").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least).select("k", "shape")
    tops = cells.groupBy("k").agg(F.max("v").alias("top"))

    def grown(table: pa.Table) -> pa.Table:
        table = table.sort_by([("r", "ascending"), ("c", "ascending")])
        k = table.column("k")[0].as_py()
        r, c, v, angle = (table.column(x).to_numpy() for x in ("r", "c", "v", "angle"))
        bins = np.minimum((v / table.column("top")[0].as_py() * n_bins).astype(int), n_bins - 1)
        found = grow_regions(r, c, angle, v, bins, tau, least, density_th)
        columns = {"k": pa.array([k] * len(found), pa.int32()), "id": pa.array([int(r[q[0]]) * wide + int(c[q[0]]) for q in found], pa.int64())}
        columns |= {n: pa.array([float(q[1 + i]) for q in found], pa.float64()) for i, n in enumerate(REC)}
        touched = [[{"ty": a, "tx": b} for a, b in _touched(q[1:], high, wide)] for q in found]
        return pa.table(columns | {"touched": pa.array(touched, pa.list_(pa.struct({"ty": pa.int32(), "tx": pa.int32()})))})

    schema = "k int, id long, " + ", ".join(f"{n} double" for n in REC) + ", touched array<struct<ty int, tx int>>"
    regions = keep(of_shapes.join(large, ["k", "shape"]).join(tops, "k").groupBy("k", "shape").applyInArrow(grown, schema), "regions")

    def count(own: pa.Table, sent: pa.Table) -> pa.Table:
        names = ("k", "id", "w", "n", "k0", "k1", "k2")
        if not sent.num_rows:
            return pa.table({x: pa.array([], pa.int64() if x == "id" else pa.int32()) for x in names})
        y, x = sent.column("ty")[0].as_py() * COUNT_TILE, sent.column("tx")[0].as_py() * COUNT_TILE
        angle = np.full((min(COUNT_TILE, high - y), min(COUNT_TILE, wide - x)), np.nan)
        if own.num_rows:
            angle[own.column("r").to_numpy() - y, own.column("c").to_numpy() - x] = own.column("angle").to_numpy()
        gy, gx = np.mgrid[y : y + angle.shape[0], x : x + angle.shape[1]]
        out = []
        for k, i, my, mx, t, lo, hi, width in zip(*(sent.column(c).to_pylist() for c in ("k", "id", *REC)), strict=True):
            along, across = (gy - my) * sin(t) + (gx - mx) * cos(t), np.abs((gy - my) * cos(t) - (gx - mx) * sin(t))
            apart, inside = _apart(angle, t), (along >= lo - 0.5) & (along <= hi + 0.5)
            for w, own_width in enumerate(_widths(width)):
                within = inside & (across <= own_width / 2)
                out.append((k, i, w, int(within.sum()), *(int((within & (apart <= q * pi)).sum()) for q in (p, p / 2, p / 4))))
        return pa.table({c: pa.array([q[j] for q in out], pa.int64() if c == "id" else pa.int32()) for j, c in enumerate(names)})

    sent = regions.select("k", "id", *REC, F.explode("touched").alias("q")).select("k", "id", *REC, "q.ty", "q.tx")
    placed = cells.withColumn("ty", F.floor(F.col("r") / COUNT_TILE).cast("int")).withColumn("tx", F.floor(F.col("c") / COUNT_TILE).cast("int"))
    placed = placed.join(sent.select("k", "ty", "tx").distinct(), ["k", "ty", "tx"], "left_semi")
    by = ["k", "ty", "tx"]
    counts = placed.groupBy(*by).cogroup(sent.groupBy(*by)).applyInArrow(count, "k int, id long, w int, n int, k0 int, k1 int, k2 int")
    sums = counts.groupBy("k", "id", "w").agg(*(F.sum(x).alias(x) for x in ("n", "k0", "k1", "k2")))
    sums = sums.groupBy("k", "id").agg(F.array_sort(F.collect_list(F.struct("w", "n", "k0", "k1", "k2"))).alias("counts"))

    def judged(batches):
        for b in batches:
            out = []
            for q in b.to_pylist():
                best = None
                widths = _widths(q["width"])
                for s in q["counts"]:  # narrower rectangles may mean more
                    for i, prob in enumerate((p, p / 2, p / 4)):
                        value = log_nfa(s["n"], s[f"k{i}"], prob, tests)
                        if best is None or value > best[0]:
                            best = value, widths[s["w"]], prob
                if best is not None and best[0] > log_eps:
                    (y1, x1), (y2, x2) = ((q["my"] + sin(q["t"]) * e + 0.5, q["mx"] + cos(q["t"]) * e + 0.5) for e in (q["lo"], q["hi"]))
                    out.append((q["k"], x1 / scale, y1 / scale, x2 / scale, y2 / scale, best[1] / scale, best[2], float(best[0])))
            names = [x.split()[0] for x in SEGMENT.split(", ")]
            yield pa.RecordBatch.from_pydict({x: pa.array([s[i] for s in out], pa.float64() if i else pa.int32()) for i, x in enumerate(names)})

    found = regions.drop("touched").join(sums, ["k", "id"]).mapInArrow(judged, SEGMENT)
    far = F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    for value, (low, top) in ((F.col("width"), thickness), (far, length)):
        if low >= 0:
            found = found.filter(value >= low)
        if top >= 0:
            found = found.filter(value <= top)
    return found
