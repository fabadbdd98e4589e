"""Cubes from raster files and back."""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..cube import Cube
from . import png, store, tiff
from .envi import EnviSource
from .files import envi_header, envi_text
from .lists import FORMATS, format_of, header_of

#: Output types by their names, and what numpy calls them; those of complex numbers hold the real part's value.
KINDS = {"byte": "u1", "uint16": "u2", "int16": "i2", "uint32": "u4", "int32": "i4", "float32": "f4", "float64": "f8", "cfloat32": "c8", "cfloat64": "c16"}
#: Cells of a block that a task writes at a time.
BLOCK_CELLS = 1 << 20


def open_cube(spark: SparkSession, path: str, **window: int) -> Cube:
    """The cube of a flat raster with a header, of a TIFF, of an array of bands, lines and samples (.npy), or of a table (b, y, x, v); window: xoff, xsize, ... are read options of flat rasters and TIFFs."""
    kind = format_of(path)
    if kind == "envi":
        header = envi_header(store.read_text(header_of(path)))
        spark.dataSource.register(EnviSource)
        reader = spark.read.format("envi").option("path", path)
        for k, v in window.items():
            reader = reader.option(k, v)
        nodata = (float(header["nodata"]),) if header["nodata"] else ()
        return Cube(reader.load(), (header["samples"], header["lines"], header["bands"]), nodata)
    if kind == "gtiff":
        d = tiff.read_directory(path)
        spark.dataSource.register(tiff.TiffSource)
        reader = spark.read.format("tiff").option("path", path)
        for k, v in window.items():
            reader = reader.option(k, v)
        return Cube(reader.load(), d.size, () if d.nodata is None else (d.nodata,))
    if kind == "npy":
        with store.open_read(path) as f:
            np.lib.format.read_magic(f)
            shape, _, dtype = np.lib.format.read_array_header_1_0(f)
            offset = f.tell()
        bands, lines, samples = (1,) * (3 - len(shape)) + tuple(shape)
        return Cube(_array(spark, path, offset, dtype.str, lines, samples, bands), (samples, lines, bands))
    if kind == "parquet":
        cells = spark.read.parquet(path).select("b", "y", "x", F.col("v").cast("double").alias("v"))
        ends = cells.agg(F.max("x"), F.max("y"), F.max("b")).first()
        return Cube(cells, tuple((e if e is not None else -1) + 1 for e in ends))
    raise ValueError(f"no reader for {kind} files: {path}")


def _array(spark: SparkSession, path: str, offset: int, kind: str, lines: int, samples: int, bands: int) -> DataFrame:
    step = max(1, BLOCK_CELLS // max(samples, 1))
    parts = spark.range(bands).select(F.col("id").cast("int").alias("b"), F.explode(F.sequence(F.lit(0), F.lit(max(lines - 1, 0)), F.lit(step))).alias("y"))

    def run(batches):
        for batch in batches:
            for b, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n, size = min(step, lines - y), np.dtype(kind).itemsize
                with store.open_read(path) as f:
                    f.seek(offset + (b * lines + y) * samples * size)
                    m = np.frombuffer(f.read(n * samples * size), kind).astype(float)
                i, x = np.divmod(np.arange(len(m)), max(samples, 1))
                yield pa.RecordBatch.from_pydict({"b": pa.array(np.full(len(m), b, np.int32)), "y": pa.array((i + y).astype(np.int32)), "x": pa.array(x.astype(np.int32)), "v": pa.array(m)})

    return parts.mapInArrow(run, "b int, y int, x int, v double")


def output_path(path: str, out: str | None = None, suffix: str = "_mod") -> str:
    """Where a result goes: out (a folder keeps the name), or beside the input with a suffix; .png and .jpg become .tif."""
    stem, ext = os.path.splitext(path)
    if out and not out.endswith("/") and not ((at := store.local(out)) and os.path.isdir(at)):
        return out
    if out:
        return os.path.join(out, os.path.basename(path))
    return f"{stem}{suffix}{'.tif' if ext in ('.png', '.jpg') else ext}"


def write_image(cube: Cube, path: str, kind: str, overwrite: bool, tags: dict, offset: tuple[int, int, int], size: tuple[int, int, int], shared: bool | None = None) -> int:
    """Writes a cube as TIFF or PNG, by the name; the number of cells that the image has."""
    if (at := store.local(path)) and os.path.exists(at) and not overwrite:
        raise ValueError(f"{path} is there")
    if path.lower().endswith(".png"):
        if any(offset) or size != cube.size:
            raise ValueError("a PNG holds the cube alone")
        png.write_png(cube, path, kind.lower(), {k: v for k, v in tags.items() if isinstance(k, str)}, shared)
    else:
        own = {k: v for k, v in tags.items() if isinstance(k, int)}
        options = dict(zip(("samples", "lines", "bands", "xoff", "yoff", "boff"), (*size, *offset), strict=True)) | {"kind": KINDS[kind.lower()], "tags": json.dumps(own)}
        cube.cells.sparkSession.dataSource.register(tiff.TiffSource)
        cells = cube.cells.select(*(F.col(c).cast("int").alias(c) for c in "byx"), F.col("v").cast("double").alias("v"))
        cells = cells.repartition("b", F.floor(F.col("y") / max(1, BLOCK_CELLS // max(size[0], 1)))).sortWithinPartitions("b", "y", "x")
        cells.write.format("tiff").mode("overwrite" if overwrite else "append").options(**options).save(path)
    return size[0] * size[1] * size[2]


def write_raster(cube: Cube, path: str, kind: str = "float32", overwrite: bool = False, tags: dict | None = None, offset: tuple[int, int, int] = (0, 0, 0), size: tuple[int, int, int] | None = None, shared: bool | None = None) -> int:
    """Writes a cube as a flat raster (bsq) with a header and returns the number of cells written; .tif and .png name images (write_image), other formats that are no flat raster raise.

    Tasks write blocks of lines at their places in one file, which all see (a local or mounted path); a task that runs
    again writes the same bytes there. Cells that are not there are 0. A file that is there is written into if its shape and
    type are the same, else that is an error, unless overwrite. offset and size: where the cube lies (x, y, b) in a larger
    raster. Whole-number types hold rounded values inside their range.
    """
    at, target = store.local(path), FORMATS.get(path.rsplit("/", 1)[-1].rsplit(".", 1)[-1].lower(), "envi")
    if target not in ("envi", "hfa", "gtiff", "png"):
        raise ValueError(f"no writer for {target} files: {path}")
    if at is None:
        raise ValueError("a raster is written in place: give a local or mounted path, or write the cells as a table")
    if not (shared or cube.cells.sparkSession.sparkContext.master.startswith("local")):
        raise ValueError(f"{path} is written in place by many machines: say shared=True if all of them see it")
    samples, lines, bands = size or cube.size
    if target in ("gtiff", "png"):
        return write_image(cube, path, kind, overwrite, tags or {}, offset, size or cube.size, shared)
    tags = {k: v for k, v in (tags or {}).items() if isinstance(k, str)}
    np_kind = KINDS[kind.lower()]
    item = np.dtype(np_kind).itemsize
    header = header_of(at)
    if os.path.exists(at) and os.path.exists(header) and not overwrite:
        h = envi_header(store.read_text(header))
        if (h["samples"], h["lines"], h["bands"]) != (samples, lines, bands) or np.dtype(h["dtype"]) != np.dtype("<" + np_kind) or h["interleave"] != "bsq":
            raise ValueError(f"{path} is there and has another shape or type")
    else:
        with store.open_write(at) as f:
            f.truncate(samples * lines * bands * item)
        store.write_text(header, envi_text(samples, lines, bands, np_kind, "bsq", tags))
    step, info = max(1, BLOCK_CELLS // max(cube.size[0], 1)), np.iinfo(np_kind) if np_kind[0] in "iu" else None
    xoff, yoff, boff = offset
    width, height = cube.size[0], cube.size[1]

    def write(table: pa.Table) -> pa.Table:
        b, first = table.column("b")[0].as_py(), table.column("block")[0].as_py() * step
        m = np.zeros((min(step, height - first), width))
        m[table.column("y").to_numpy() - first, table.column("x").to_numpy()] = table.column("v").to_numpy()
        if info:
            m = np.clip(np.floor(np.nan_to_num(m) + 0.5), info.min, info.max)
        m = m.astype("<" + np_kind)
        fd = os.open(at, os.O_WRONLY)
        try:
            whole = width == samples
            for i in range(1 if whole else len(m)):
                place = ((b + boff) * lines + first + yoff + i) * samples + xoff
                os.pwrite(fd, (m if whole else m[i]).tobytes(), place * item)
        finally:
            os.close(fd)
        return pa.table({"cells": pa.array([table.num_rows], pa.int64())})

    cells = cube.cells.select("b", F.floor(F.col("y") / step).cast("int").alias("block"), F.col("y").cast("int").alias("y"), F.col("x").cast("int").alias("x"), F.col("v").cast("double").alias("v"))
    done = cells.groupBy("b", "block").applyInArrow(write, "cells long")
    return done.agg(F.sum("cells")).first()[0] or 0


def write_table(cube: Cube, path: str, overwrite: bool = False) -> None:
    """Writes the cells as Parquet by band, sorted inside files, for any store."""
    cells = cube.cells.select("b", "y", "x", "v").repartition("b", F.floor(F.col("y") / 512)).sortWithinPartitions("b", "y", "x")
    cells.write.mode("overwrite" if overwrite else "error").partitionBy("b").parquet(path)
