"""One-dimensional interpolators over numpy, and their use along a cube's spectra."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def _hermite(x: np.ndarray, y: np.ndarray, d: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Cubic pieces through values and slopes; outside the knots is an error. y and d may have rows."""
    if len(at) and (at.min() < x[0] or at.max() > x[-1]):
        raise ValueError("a place is outside the knots")
    i = np.clip(np.searchsorted(x, at, "right") - 1, 0, len(x) - 2)
    h = x[i + 1] - x[i]
    t = (at - x[i]) / h
    a, b = (1 + 2 * t) * (1 - t) ** 2, t * (1 - t) ** 2
    return a * y[..., i] + b * h * d[..., i] + t * t * (3 - 2 * t) * y[..., i + 1] + t * t * (t - 1) * h * d[..., i + 1]


def pchip(x, y, at):
    """Monotone cubic (Fritsch-Butland): weighted harmonic means inside, one-sided differences at the ends."""
    x, y = np.asarray(x, float), np.asarray(y, float)
    h, s = np.diff(x), np.diff(y) / np.diff(x)
    d = np.zeros_like(y)
    if len(x) > 2:
        w1, w2 = 2 * h[1:] + h[:-1], h[1:] + 2 * h[:-1]
        a, b = s[..., :-1], s[..., 1:]
        same = a * b > 0
        with np.errstate(divide="ignore", invalid="ignore"):
            d[..., 1:-1] = np.where(same, (w1 + w2) / np.where(same, w1 / np.where(same, a, 1) + w2 / np.where(same, b, 1), 1), 0)
    d[..., 0], d[..., -1] = s[..., 0], s[..., -1]
    return _hermite(x, y, d, np.asarray(at, float))


def makima(x, y, at):
    """Modified Akima cubic."""
    x, y = np.asarray(x, float), np.asarray(y, float)
    s = np.diff(y) / np.diff(x)
    left, right = 2 * s[..., :1] - s[..., 1:2], 2 * s[..., -1:] - s[..., -2:-1]
    s = np.concatenate([2 * left - s[..., :1], left, s, right, 2 * right - s[..., -1:]], axis=-1)
    w = np.abs(np.diff(s)) + np.abs(s[..., :-1] + s[..., 1:]) / 2
    w1, w2 = w[..., 2:], w[..., :-2]
    total = w1 + w2
    d = np.where(total > 0, (w1 * s[..., 1:-2] + w2 * s[..., 2:-1]) / np.where(total > 0, total, 1), 0)
    return _hermite(x, y, d, np.asarray(at, float))


def cubic_hermite(x, y, slopes, at):
    return _hermite(np.asarray(x, float), np.asarray(y, float), np.asarray(slopes, float), np.asarray(at, float))


def barycentric(x, y, at, order: int = 3):
    """Floater-Hormann rational interpolation; no poles, exact at knots and for polynomials of the order."""
    x, y, at = np.asarray(x, float), np.asarray(y, float), np.asarray(at, float)
    n = len(x) - 1
    order = min(order, n)
    w = np.zeros(n + 1)
    for k in range(n + 1):
        for i in range(max(0, k - order), min(n - order, k) + 1):
            others = [j for j in range(i, i + order + 1) if j != k]
            w[k] += (-1.0) ** i / np.prod(x[k] - x[others])
    d = at[:, None] - x
    hit = d == 0
    q = w / np.where(hit, 1, d)
    out = (y @ q.T) / q.sum(axis=1)
    rows, cols = np.nonzero(hit)
    out[..., rows] = y[..., cols]
    return out


def spline_basis(u, degree: int) -> np.ndarray:
    """Centred B-spline of a degree by the truncated-power sum; exactly 0 outside of its support, where the powers would not cancel."""
    u = np.asarray(u, float)
    near = np.abs(u) < (degree + 1) / 2
    u = np.where(near, u, 0.0)
    total, sign, c = np.zeros_like(u), 1.0, 1.0
    for j in range(degree + 2):
        total += sign * c * np.maximum(u + (degree + 1) / 2 - j, 0) ** degree
        sign, c = -sign, c * (degree + 1 - j) / (j + 1)
    return np.where(near, total / np.prod(np.arange(1, degree + 1)), 0.0)


def end_differences(degree: int) -> np.ndarray:
    """Weights of the difference of degree + 1 steps, which is zero at the ends of a spline's coefficients."""
    out = np.array([1.0])
    for _ in range(degree + 1):
        out = np.convolve(out, [1, -1])
    return out


def spline_coefficients(y, degree: int) -> np.ndarray:
    """Coefficients at the places -(degree // 2) .. n - 1 + degree // 2 of the spline through y (.., n), by one dense solution."""
    y = np.asarray(y, float)
    n, extra, difference = y.shape[-1], degree // 2, end_differences(degree)
    places = np.arange(-extra, n + extra)
    ends = np.zeros((2 * extra, len(places)))
    size = min(len(difference), len(places))
    for i in range(extra):
        ends[i, i : i + size] = difference[:size][: len(places) - i]
        ends[extra + i, len(places) - size - i : len(places) - i] = difference[:size]
    conditions = spline_basis(np.arange(n)[:, None] - places, degree)
    return np.linalg.lstsq(np.vstack([conditions, ends]), np.concatenate([y.T, np.zeros((2 * extra, *y.shape[:-1]))]), rcond=None)[0].T


def cardinal_spline(x, y, at, degree: int = 3):
    """B-spline of degree 2, 3 or 5 on equidistant knots (the first two give place and step), through all values.

    Coefficients solve the interpolation conditions together with as many zero differences of the coefficients
    at the two ends as the degree leaves free, so polynomials below the degree are met exactly. Long tracks: splines.along().
    """
    x, y, at = np.asarray(x, float), np.asarray(y, float), np.asarray(at, float)
    n, extra = y.shape[-1], degree // 2
    t = (at - x[0]) / (x[1] - x[0])
    return spline_coefficients(y, degree) @ spline_basis(t[:, None] - np.arange(-extra, n + extra), degree).T


KINDS = {"pchip": pchip, "makima": makima, "barycentric": barycentric, "cubic": cardinal_spline, "quintic": lambda x, y, at: cardinal_spline(x, y, at, 5), "quadratic": lambda x, y, at: cardinal_spline(x, y, at, 2)}


def kind_of(name: str) -> str:
    """The interpolator of a task's parameter: spline_cubic, ..., and pchip for what is not known."""
    name = name.strip().lower().removeprefix("spline_")
    return name if name in KINDS else "pchip"


def resample_frames(cells: DataFrame, wl0: list[float], wl1: list[float], size: tuple[int, int, int], kind: str = "pchip") -> tuple[DataFrame, int]:
    """Cells (b, y, x, v) at the wavelengths wl1, and their number of bands.

    wl0 holds a wavelength for each band, or one for each column and band (then wl1 has its numbers for each column,
    too). A pixel's cells meet in one row; a pixel that lacks a band is left out.
    """
    from pyspark.sql import functions as F

    nx, _, nb = size
    if len(wl0) == nb:
        bands, own = len(wl1), None
    elif len(wl0) == nb * nx and len(wl1) // nx:
        bands = len(wl1) // nx
        own = {x: (wl0[x * nb : (x + 1) * nb], wl1[x * bands : (x + 1) * bands]) for x in range(nx)}
    else:
        raise ValueError("the wavelengths and the cube differ in length")
    f, straight = KINDS[kind], (np.array(wl0, float), np.array(wl1, float))
    spectra = cells.groupBy("y", "x").agg(F.array_sort(F.collect_list(F.struct(F.col("b").cast("int").alias("b"), F.col("v").cast("double").alias("v")))).alias("s")).filter(F.size("s") == nb)

    def run(batches):
        for batch in batches:
            ys, xs = batch.column("y").to_numpy(), batch.column("x").to_numpy()
            spec = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, nb)
            if own is None:
                out = f(straight[0], spec, straight[1]) if len(spec) else np.zeros((0, bands))
            else:
                out = np.stack([f(np.array(own[x][0]), s, np.array(own[x][1])) for x, s in zip(xs.tolist(), spec, strict=True)]) if len(spec) else np.zeros((0, bands))
            n = len(spec)
            yield pa.RecordBatch.from_pydict({"b": pa.array(np.tile(np.arange(bands, dtype=np.int32), n)), "y": pa.array(np.repeat(ys, bands).astype(np.int32)), "x": pa.array(np.repeat(xs, bands).astype(np.int32)), "v": pa.array(out.ravel())})

    rows = spectra.select("y", "x", F.transform("s", lambda s: s["v"]).alias("v"))
    return rows.mapInArrow(run, "b int, y int, x int, v double"), bands


def resample_spectra(spectra: DataFrame, wl0, wl1: list[float], kind: str = "pchip") -> DataFrame:
    """spectra (.., x, spec) at wavelengths wl1; wl0 is a list for all columns or a mapping of x to lists. A batch at a time; no shuffle."""
    f = KINDS[kind]
    names = [c for c in spectra.columns if c != "spec"]

    def run(batches):
        for b in batches:
            spec, xs = b.column("spec").to_pylist(), b.column("x").to_pylist()
            if isinstance(wl0, dict):
                out = [f(wl0[x], np.array(s, float), np.array(wl1, float)).tolist() for x, s in zip(xs, spec, strict=True)]
            else:
                if any(len(s) != len(wl0) for s in spec):
                    raise ValueError("a spectrum and the wavelengths differ in length")
                out = f(np.array(wl0, float), np.array(spec, float), np.array(wl1, float)).tolist() if spec else []
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(out, pa.list_(pa.float64()))], names=[*names, "spec"])

    schema = ", ".join(f"`{f_.name}` {f_.dataType.simpleString()}" for f_ in spectra.schema.fields if f_.name != "spec")
    return spectra.select(*names, "spec").mapInArrow(run, f"{schema}, spec array<double>")


def interpolate_positions(ord_: np.ndarray, values: np.ndarray, velocity: np.ndarray | None, step: float, at: np.ndarray) -> np.ndarray:
    """A track's coordinate at other lines: cubic Hermite with velocities (times the time of a line), or pchip where velocities are missing or next to zero."""
    if len(ord_) < 3:
        raise ValueError("three records at least")
    if velocity is None or (np.abs(velocity) < 1e-4).all():
        return pchip(ord_, values, at)
    return cubic_hermite(ord_, values, velocity * step, at)
