"""Operators whose result at a cell depends on the scan so far or on whole shapes, over numpy.

All take tiles with a margin; what a scan carries from tile to tile is composed by operators.scans.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import store
from . import scans, tiles


def _window_medians(wide: np.ndarray, i: int, cols: int, pad: int, r: int, low: float, high: float, step: float) -> tuple[np.ndarray, np.ndarray]:
    """Of line i of a matrix padded by pad with NaN: the histogram medians of windows of radius r, and whether the radius grows there."""
    bins = int((high - low) / step)
    w = np.stack([wide[i + pad + dy, pad + dx : pad + dx + cols] for dy in range(-r, r + 1) for dx in range(-r, r + 1)])
    with np.errstate(invalid="ignore"):
        under, over = w < low, w >= high
    inside = ~(under | over | np.isnan(w))
    n = inside.sum(axis=0)
    s = np.sort(np.where(inside, w, np.inf), axis=0)
    middle = np.take_along_axis(s, np.maximum((n + 1) // 2 - 1, 0)[None], axis=0)[0]
    b = np.minimum(((np.where(n > 0, middle, low) - low) / step).astype(int), bins - 1)
    value = np.where(n > 0, low + b * step + (0 if step == 1 else step / 2), 0.0)
    return value, (under.sum(axis=0) >= r) | (over.sum(axis=0) >= r)


def despeckle_frame(m: np.ndarray, ksize: int, low: float, high: float, step: float) -> np.ndarray:
    """Adaptive histogram median. The radius carries on from cell to cell in scan order: it grows (to ksize) while at
    least as many neighbours as it counts are under or over the range, else it shrinks (to 1). What each radius would
    give is worked out for a line at once; the scan then only chooses."""
    rows, cols = m.shape
    out, radius = np.zeros_like(m), ksize
    wide = np.pad(np.where(np.isfinite(m), m, np.nan), ksize, constant_values=np.nan)
    for i in range(rows):
        grows, value = np.zeros((ksize + 1, cols), bool), np.zeros((ksize + 1, cols))
        for r in range(1, ksize + 1):
            value[r], grows[r] = _window_medians(wide, i, cols, ksize, r, low, high, step)
        finite = np.isfinite(m[i])
        for j in range(cols):
            if not finite[j]:
                out[i, j] = m[i, j]
                continue
            out[i, j] = value[radius, j]
            radius = min(radius + 1, ksize) if grows[radius, j] else max(radius - 1, 1)
    return out


def _despeckle_tile(p: tiles.Patch, tile: int, ksize: int, low: float, high: float, step: float) -> dict[str, np.ndarray]:
    """v1.. and e1..: what each cell of a tile becomes, and the radius after it, if the radius is 1.. where its line enters the tile."""
    rows, cols = p.there.shape
    c0 = 0 if p.c0 == 0 else ksize  # where the tile's own cells begin
    own = slice(c0, min(c0 + tile, cols))
    wide = np.pad(np.where(p.there & np.isfinite(p.v), p.v, np.nan), ksize, constant_values=np.nan)
    values, grows = np.zeros((ksize + 1, rows, cols)), np.zeros((ksize + 1, rows, cols), bool)
    for i in range(rows):  # a line at a time, so that the windows of a line are in memory
        for r in range(1, ksize + 1):
            values[r, i], grows[r, i] = _window_medians(wide, i, cols, ksize, r, low, high, step)
    radius = np.tile(np.arange(1, ksize + 1), (rows, 1))
    v, e = np.zeros((ksize, rows, cols)), np.zeros((ksize, rows, cols), np.int32)
    line = np.arange(rows)[:, None]
    for j in range(own.start, own.stop):
        finite = (p.there[:, j] & np.isfinite(p.v[:, j]))[:, None]
        v[:, :, j] = np.where(finite, values[radius, line, j], p.v[:, j, None]).T
        after = np.where(grows[radius, line, j], np.minimum(radius + 1, ksize), np.maximum(radius - 1, 1))
        radius = np.where(finite, after, radius)
        e[:, :, j] = radius.T
    return {f"v{s + 1}": v[s] for s in range(ksize)} | {f"e{s + 1}": e[s] for s in range(ksize)}


def despeckle(frames: DataFrame, rows: int, cols: int, ksize: int = 3, hist_min: float = 7, hist_max: float = 4000, hist_step: float = 1, tile: int = tiles.TILE) -> DataFrame:
    """Adaptive histogram median of frames of any size (see despeckle_frame): the radius is a state that lines carry from tile to tile.

    Each tile works out, for every radius at which one of its lines may enter, what its cells become and with which radius the line
    leaves. The lines' pieces, in scan order, are steps of a scan over that state; each piece's entry then chooses.
    """
    states, keep, across = range(1, ksize + 1), store.Kept(frames.sparkSession), -(-cols // tile)
    if tile <= ksize:
        raise ValueError("the radius is no smaller than a tile")
    schema = ", ".join(["k int, r int, c int", *(f"v{s} double" for s in states), *(f"e{s} int" for s in states)])
    cells = keep(tiles.tiled(frames, rows, cols, ksize, lambda p: _despeckle_tile(p, tile, ksize, hist_min, hist_max, hist_step), schema, tile), "cells")
    piece = F.col("r").cast("long") * across + F.floor(F.col("c") / tile)
    cells = cells.withColumn("i", piece)
    steps = cells.groupBy("k", "i").agg(F.max_by(F.array(*(f"e{s}" for s in states)), "c").alias("step"))
    entries = scans.entry_states(steps, ["k"], ksize, keep)
    return cells.join(entries, ["k", "i"]).select("k", "r", "c", F.element_at(F.array(*(f"v{s}" for s in states)), F.col("entry")).alias("v"))


def inpaint_frame(m: np.ndarray, mask: np.ndarray, radius: int = 3) -> np.ndarray:
    """Fast-marching inpainting (Telea 2004): cells are filled outside in, each from known neighbours by direction, distance and level."""
    rows, cols = m.shape
    out, far = m.astype(float).copy(), 1e6
    state = np.where(mask, 2, 0)  # 0 known, 1 in the band, 2 unknown
    t = np.where(mask, far, 0.0)
    heap: list[tuple[float, int, int]] = []
    near = lambda i, j: ((a, b) for a, b in ((i - 1, j), (i + 1, j), (i, j - 1), (i, j + 1)) if 0 <= a < rows and 0 <= b < cols)
    wide = np.pad(mask, 1)
    beside = wide[:-2, 1:-1] | wide[2:, 1:-1] | wide[1:-1, :-2] | wide[1:-1, 2:]
    for i, j in np.argwhere(~mask & beside).tolist():
        heapq.heappush(heap, (0.0, i, j))

    def solve(i, j):
        x = min((t[a, b] for a, b in ((i, j - 1), (i, j + 1)) if 0 <= b < cols and state[a, b] != 2), default=far)
        y = min((t[a, b] for a, b in ((i - 1, j), (i + 1, j)) if 0 <= a < rows and state[a, b] != 2), default=far)
        if abs(x - y) < 1:
            return (x + y + np.sqrt(2 - (x - y) ** 2)) / 2
        return min(x, y) + 1

    def slope(f, i, j, usable):
        def one(a, b, c, d):
            fore, back = usable(a, b), usable(c, d)
            if fore and back:
                return (f[a, b] - f[c, d]) / 2
            return f[a, b] - f[i, j] if fore else f[i, j] - f[c, d] if back else 0.0

        return one(i + 1, j, i - 1, j), one(i, j + 1, i, j - 1)

    known = lambda a, b: 0 <= a < rows and 0 <= b < cols and state[a, b] != 2
    while heap:
        _, i, j = heapq.heappop(heap)
        state[i, j] = 0
        for a, b in near(i, j):
            if state[a, b] != 2:
                continue
            t[a, b] = solve(a, b)
            ty, tx = slope(t, a, b, known)
            total = weight = 0.0
            for y in range(max(a - radius, 0), min(a + radius, rows - 1) + 1):
                for x in range(max(b - radius, 0), min(b + radius, cols - 1) + 1):
                    dy, dx = a - y, b - x
                    d2 = dy * dy + dx * dx
                    if state[y, x] == 2 or d2 == 0 or d2 > radius * radius:
                        continue
                    direction = abs(dy * ty + dx * tx) / np.sqrt(d2) or 1e-6
                    w = direction / (d2 * (1 + abs(t[y, x] - t[a, b])))
                    gy, gx = slope(out, y, x, known)
                    total += w * (out[y, x] + gy * dy + gx * dx)
                    weight += w
            if weight:
                out[a, b] = total / weight
            state[a, b] = 1
            heapq.heappush(heap, (t[a, b], a, b))
    return out


def inpaint(frames: DataFrame, bad: DataFrame, rows: int, cols: int, radius: int = 3, tile: int = 500, margin: int = 10) -> DataFrame:
    """Cells of bad (k, r, c, or r, c for all frames) from their surroundings in their tile and its margin. Cells that are not there are unknown, too."""
    keys = [c for c in ("k", "r", "c") if c in bad.columns]
    marked = frames.join(bad.select(*keys).distinct().withColumn("bad", F.lit(1.0)), keys, "left").select("k", "r", "c", "v", F.coalesce("bad", F.lit(0.0)).alias("bad"))

    def kernel(p: tiles.Patch) -> dict[str, np.ndarray]:
        mask = ~p.there | (p.values["bad"] > 0)
        if not (p.there & mask).any():
            return {"v": p.v}
        return {"v": inpaint_frame(np.where(p.there, p.v, 0.0), mask, radius)}

    return tiles.tiled(marked, rows, cols, min(margin, tile), kernel, tile=tile, names=("v", "bad"))


def line_shapes(m: np.ndarray, shortest: int, longest: int) -> list[tuple[int, int, int, int]]:
    """Ends of the 8-connected parts of m > 0 that are thin enough to be one segment and of that length: shapes.peak_lines for one matrix."""
    rows, cols = m.shape
    seen, out = ~(m > 0), []
    for i, j in zip(*np.nonzero(m > 0), strict=True):
        if seen[i, j]:
            continue
        seen[i, j], todo, part = True, [(int(i), int(j))], []
        while todo:
            y, x = todo.pop()
            part.append((y, x))
            for a in range(max(y - 1, 0), min(y + 2, rows)):
                for b in range(max(x - 1, 0), min(x + 2, cols)):
                    if not seen[a, b]:
                        seen[a, b] = True
                        todo.append((a, b))
        if len(part) < 2:
            continue
        p = np.array(sorted(part))
        first = p[np.argmax(((p - p.mean(0)) ** 2).sum(1))]
        last = p[np.argmax(((p - first) ** 2).sum(1))]
        d = last - first
        off = np.abs((p - first) @ np.array([d[1], -d[0]]))
        length = np.abs(d).max() + 1
        if 50 * off.max() <= (d * d).sum() and (shortest < 0 or length >= shortest) and (longest < 0 or length <= longest):
            a, b = sorted([tuple(first.tolist()), tuple(last.tolist())])
            out.append((a[1], a[0], b[1], b[0]))
    return out
