"""Cells as blocks: a row holds a tile of a frame as one array, so a cell costs its own bytes and no key.

A block is k, ty, tx (the frame and the tile's place in the grid), r0, c0, height, width, and v: its cells row by row,
null where the cube has none. Blocks of one grid meet by (ty, tx); operators are numpy over whole arrays, a block, a
stack of frames of one tile, or a line of tiles at a time. Sources give blocks without a shuffle where their files do
(a strip or tile is a block), else to_blocks gathers cells once; to_cells gives the long form back.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..cube import FLT_MAX, FLT_MIN
from . import tiles
from .maps import BROADCAST_CELLS

PLACE = "k int, ty int, tx int, r0 int, c0 int, height int, width int"
#: Lines and places of a block.
TILE = (256, 256)
_PLACE = pa.schema([(n.split()[0], pa.int32()) for n in PLACE.split(", ")])
_KEYS = [f.name for f in _PLACE]


def arrays(column) -> list[np.ndarray]:
    """The lists of a column as float64 arrays, NaN for null; `there` is lost, see present()."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, offsets = column.values, column.offsets.to_numpy()
    values = flat.to_numpy(zero_copy_only=False).astype(float)
    return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def present(column) -> list[np.ndarray | None]:
    """Which items of each list are not null; None if all are there."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, offsets = column.values, column.offsets.to_numpy()
    if not flat.null_count:
        return [None] * len(column)
    valid = flat.is_valid().to_numpy(zero_copy_only=False)
    return [valid[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def lists(values: list[np.ndarray], there: list[np.ndarray | None], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0)
    mask = np.concatenate([~t if t is not None else np.zeros(len(v), bool) for v, t in zip(values, there, strict=True)]) if any(t is not None for t in there) else None
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(kind.to_pandas_dtype()), kind, mask=mask))


def _kind(blocks: DataFrame) -> str:
    return blocks.schema["v"].dataType.elementType.simpleString()


def to_blocks(frames: DataFrame, tile: tuple[int, int] = TILE, kind: str = "float") -> DataFrame:
    """Blocks of cells (k, r, c, v); kind: the type in which values are kept. A block covers the cells that its tile has."""
    arrow = pa.float32() if kind == "float" else pa.float64()

    def run(table: pa.Table) -> pa.Table:
        r, c = (table.column(x).to_numpy() for x in ("r", "c"))
        r0, c0 = int(r.min()), int(c.min())
        shape = int(r.max()) - r0 + 1, int(c.max()) - c0 + 1
        m, there = np.zeros(shape), np.zeros(shape, bool)
        m[r - r0, c - c0], there[r - r0, c - c0] = table.column("v").to_numpy(), True
        keys = [table.column(x)[0].as_py() for x in ("k", "ty", "tx")]
        columns = [pa.array([x], pa.int32()) for x in (*keys, r0, c0, *shape)]
        return pa.Table.from_arrays([*columns, lists([m.ravel()], [None if there.all() else there.ravel()], arrow)], names=[*_KEYS, "v"])

    own = frames.select(*(F.col(x).cast("int").alias(x) for x in ("k", "r", "c")), F.col("v").cast("double").alias("v"))
    own = own.withColumn("ty", F.floor(F.col("r") / tile[0]).cast("int")).withColumn("tx", F.floor(F.col("c") / tile[1]).cast("int"))
    return own.groupBy("k", "ty", "tx").applyInArrow(run, f"{PLACE}, v array<{kind}>")


def to_cells(blocks: DataFrame) -> DataFrame:
    """k, r, c, v of the cells that blocks have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for place, v, there in zip(_places(b), arrays(b.column("v")), present(b.column("v")), strict=True):
                i = np.arange(len(v)) if there is None else np.flatnonzero(there)
                r, c = np.divmod(i, place["width"])
                yield pa.RecordBatch.from_pydict({"k": pa.array(np.full(len(i), place["k"], np.int32)), "r": pa.array((r + place["r0"]).astype(np.int32)), "c": pa.array((c + place["c0"]).astype(np.int32)), "v": pa.array(v[i])})

    return blocks.select(*_KEYS, "v").mapInArrow(run, "k int, r int, c int, v double")


def _places(table) -> list[dict]:
    return [dict(zip(_KEYS, p, strict=True)) for p in zip(*(table.column(k).to_pylist() for k in _KEYS), strict=True)]


def spectral_blocks(spark: SparkSession, sf_dir: str, tile: int = TILE[0]) -> DataFrame:
    """E as blocks of whole lines, a row for each band: vectors meet by their lines' tile, four bytes a value."""
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.floor(F.col("vec_id") / (20 * tile)).cast("int").alias("ty"), "vec_id", F.col("embedding").cast("array<float>").alias("v"))

    def run(table: pa.Table) -> pa.Table:
        ids, ty = table.column("vec_id").to_numpy(), table.column("ty")[0].as_py()
        r, c = np.divmod(ids, 20)
        r0, height = int(r.min()), int(r.max() - r.min()) + 1
        vectors = arrays(table.column("v"))
        bands = max(map(len, vectors))
        m, there = np.zeros((bands, height, 20)), np.zeros((bands, height, 20), bool)
        for y, x, v in zip((r - r0).tolist(), c.tolist(), vectors, strict=True):
            m[: len(v), y, x], there[: len(v), y, x] = v, True
        columns = [np.arange(bands), *(np.full(bands, x) for x in (ty, 0, r0, 0, height, 20))]
        whole = [None if t.all() else t.ravel() for t in there]
        return pa.Table.from_arrays([*(pa.array(x.astype(np.int32)) for x in columns), lists([x.ravel() for x in m], whole, pa.float32())], names=[*_KEYS, "v"])

    return e.groupBy("ty").applyInArrow(run, f"{PLACE}, v array<float>")


def map_blocks(blocks: DataFrame, f: Callable[[dict, np.ndarray], np.ndarray], kind: str = "double", more: tuple[str, ...] = ()) -> DataFrame:
    """f(place, v) for each block's values (NaN where there is no cell), in place; more: list columns that f gets as arrays in place."""
    arrow = pa.float32() if kind == "float" else pa.float64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            extra = [arrays(b.column(c)) for c in more]
            out = [f(place | {c: x[i] for c, x in zip(more, extra, strict=True)}, v) for i, (place, v) in enumerate(zip(_places(b), arrays(b.column("v")), strict=True))]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in _KEYS), lists(out, present(b.column("v")), arrow)], names=[*_KEYS, "v"])

    return blocks.select(*_KEYS, "v", *more).mapInArrow(run, f"{PLACE}, v array<{kind}>")


def _is_nodata(v: np.ndarray, nodata) -> np.ndarray:
    return np.isnan(v) | np.isin(v, nodata) if nodata else np.isnan(v)


def uniform(blocks: DataFrame, coef: DataFrame, nodata=(), lo: float = FLT_MIN, hi: float = FLT_MAX, overflow: str = "keep", cells: int | None = None) -> DataFrame:
    """a * v + b as maps.uniform has it; coef: ty, tx, a, b (arrays of a block's cells) on the same grid. cells: how many coefficients there are, if known; few enough are broadcast."""

    def one(place: dict, v: np.ndarray) -> np.ndarray:
        d = place["a"] * v + place["b"]
        d = np.where(d < lo, lo, np.where(d > hi, v if overflow == "keep" else hi, d))
        return np.where(_is_nodata(v, nodata), v, d)

    own = coef.select("ty", "tx", "a", "b")
    own = F.broadcast(own) if cells is not None and cells <= BROADCAST_CELLS else own
    return map_blocks(blocks.join(own, ["ty", "tx"]), one, more=("a", "b"))


def remove_background(blocks: DataFrame, ksize: int = 30, method: str = "average") -> DataFrame:
    """Each value less the average or upper median of its cell over ksize frames; a stack of a tile's frames meets, so each value moves once."""

    def run(table: pa.Table) -> pa.Table:
        there = present(table.column("v"))
        m = np.stack(arrays(table.column("v")))
        seen = np.stack([np.ones(m.shape[1], bool) if t is None else t for t in there])
        if method == "average":
            with np.errstate(invalid="ignore", divide="ignore"):
                level = np.where(seen, m, 0.0).sum(axis=0) / seen.sum(axis=0)
        else:
            valid = seen & ~np.isnan(m)
            s, n = np.sort(np.where(valid, m, np.inf), axis=0), valid.sum(axis=0)
            level = np.where(n > 0, np.take_along_axis(s, np.minimum(n // 2, len(m) - 1)[None], axis=0)[0], np.nan)
        return pa.Table.from_arrays([*(table.column(k) for k in _KEYS), lists(list(m - level), there, pa.float64())], names=[*_KEYS, "v"])

    same = blocks.withColumn("g", F.floor(F.col("k") / ksize))
    return same.groupBy("g", "ty", "tx").applyInArrow(run, f"{PLACE}, v array<double>")


def line_stats(blocks: DataFrame, across: int, cut_lower: float = 0.0, cut_upper: float = 0.0, nodata=()) -> DataFrame:
    """k, r, mean, std of each line without nodata and trimmed at both ends, as aggregates.line_stats has it. across: tiles in a line of the grid; with one, nothing moves."""

    def run(table: pa.Table) -> pa.Table:
        places, values, there = _places(table), arrays(table.column("v")), present(table.column("v"))
        rows: dict[tuple[int, int], list[np.ndarray]] = {}
        for p, v, t in zip(places, values, there, strict=True):
            own = ~_is_nodata(v, nodata) & (True if t is None else t)
            seen = np.ones(len(v), bool) if t is None else t
            for i in range(p["height"]):
                line = slice(i * p["width"], (i + 1) * p["width"])
                if seen[line].any():
                    rows.setdefault((p["k"], p["r0"] + i), []).append(v[line][own[line]])
        out = []
        for parts in rows.values():
            s = np.sort(np.concatenate(parts))
            lo, hi = (int(np.float32(len(s)) * np.float32(x)) for x in (cut_lower, cut_upper))
            s = s[lo : max(len(s) - hi, lo)]
            out.append((s.mean(), s.std()) if len(s) else (0.0, 0.0))
        keys = list(rows)
        return pa.table({"k": pa.array([k for k, _ in keys], pa.int32()), "r": pa.array([r for _, r in keys], pa.int32()), "mean": pa.array([m for m, _ in out], pa.float64()), "std": pa.array([s for _, s in out], pa.float64())})

    schema = "k int, r int, mean double, std double"
    own = blocks.select(*_KEYS, "v")
    if across > 1:
        return own.groupBy("k", "ty").applyInArrow(run, schema)
    return own.mapInArrow(lambda batches: (b for batch in batches for b in run(batch).to_batches()), schema)


def tiled(blocks: DataFrame, rows: int, cols: int, margin: int, kernel: Callable[[tiles.Patch], dict[str, np.ndarray]], tile: tuple[int, int] = TILE) -> DataFrame:
    """kernel over each block with a margin of its neighbours' cells (see tiles.tiled); neighbours send strips, not cells. tile: the grid's."""
    if margin > min(tile):
        raise ValueError("the margin is larger than a block")
    kind = _kind(blocks)
    arrow = pa.float32() if kind == "float" else pa.float64()

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns: dict[str, list] = {k: [] for k in _KEYS}
            values, seen = [], []
            for p, v, there in zip(_places(b), arrays(b.column("v")), present(b.column("v")), strict=True):
                shape = p["height"], p["width"]
                m, t = v.reshape(shape), (np.ones(shape, bool) if there is None else there.reshape(shape))
                for dy in (-1, 0, 1):
                    for dx in (-1, 0, 1):
                        # the part of this block that lies in the margin of the tile (dy, dx) away
                        y0, x0 = (p["ty"] + dy) * tile[0], (p["tx"] + dx) * tile[1]
                        a, z = max(y0 - margin - p["r0"], 0), min(y0 + tile[0] + margin - p["r0"], shape[0])
                        e, w = max(x0 - margin - p["c0"], 0), min(x0 + tile[1] + margin - p["c0"], shape[1])
                        if a >= z or e >= w or y0 < 0 or x0 < 0 or y0 >= rows or x0 >= cols:
                            continue
                        place = p | {"ty": p["ty"] + dy, "tx": p["tx"] + dx, "r0": p["r0"] + a, "c0": p["c0"] + e, "height": z - a, "width": w - e}
                        for k in _KEYS:
                            columns[k].append(place[k])
                        values.append(m[a:z, e:w].ravel())
                        part = t[a:z, e:w].ravel()
                        seen.append(None if part.all() else part)
            yield pa.RecordBatch.from_arrays([*(pa.array(columns[k], pa.int32()) for k in _KEYS), lists(values, seen, arrow)], names=[*_KEYS, "v"])

    def run(table: pa.Table) -> pa.Table:
        k, ty, tx = (table.column(c)[0].as_py() for c in ("k", "ty", "tx"))
        r0, c0 = max(ty * tile[0] - margin, 0), max(tx * tile[1] - margin, 0)
        shape = min((ty + 1) * tile[0] + margin, rows) - r0, min((tx + 1) * tile[1] + margin, cols) - c0
        there, v = np.zeros(shape, bool), np.full(shape, np.nan)
        for p, x, t in zip(_places(table), arrays(table.column("v")), present(table.column("v")), strict=True):
            at = np.s_[p["r0"] - r0 : p["r0"] - r0 + p["height"], p["c0"] - c0 : p["c0"] - c0 + p["width"]]
            v[at] = x.reshape(p["height"], p["width"])
            there[at] = True if t is None else t.reshape(p["height"], p["width"])
        own = np.s_[ty * tile[0] - r0 : min((ty + 1) * tile[0], rows) - r0, tx * tile[1] - c0 : min((tx + 1) * tile[1], cols) - c0]
        out, seen = kernel(tiles.Patch({"v": v}, there, r0, c0, rows, cols))["v"][own], there[own]
        if not seen.any():
            return pa.Table.from_arrays([pa.array([], pa.int32())] * len(_KEYS) + [lists([], [], pa.float64())], names=[*_KEYS, "v"])
        place = (k, ty, tx, ty * tile[0], tx * tile[1], *out.shape)
        return pa.Table.from_arrays([*(pa.array([x], pa.int32()) for x in place), lists([out.ravel()], [None if seen.all() else seen.ravel()], pa.float64())], names=[*_KEYS, "v"])

    pieces = blocks.select(*_KEYS, "v").mapInArrow(spread, f"{PLACE}, v array<{kind}>")
    return pieces.groupBy("k", "ty", "tx").applyInArrow(run, f"{PLACE}, v array<double>")


def median_filter(blocks: DataFrame, rows: int, cols: int, ksize: int = 3, tile: tuple[int, int] = TILE) -> DataFrame:
    """Upper median of ksize by ksize cells that are there, the border replicated."""
    return tiled(blocks, rows, cols, ksize // 2, lambda p: tiles.median(p, ksize), tile)
