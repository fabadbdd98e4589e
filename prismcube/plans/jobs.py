"""A task list run on a file: window, tasks, the raster and its side files; and a JSON job of many.

The paths and suffixes of side files: _mean.txt and _mean_std.txt (or _median.txt), _a.txt, _b.txt, _badpixels.txt and
_uniform.xml (with debug _hi.txt and _lo.txt), _peak_points.txt and _peak_lines.txt (or _<type>.txt), _background.
"""

from __future__ import annotations

import os
import re
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..cube import Cube
from ..sources import files, lists, raster, store, tiff
from . import tasks as T

SPLIT = re.compile(r"[ ,;|]+")


def window_of(text: str) -> dict[str, int]:
    """xoff, xsize, yoff, ysize, boff, bsize of a window's text: up to six numbers between blanks, commas, semicolons or bars."""
    numbers = [int(x) for x in SPLIT.split(text.strip()) if x]
    return dict(zip(("xoff", "xsize", "yoff", "ysize", "boff", "bsize"), numbers[: len(numbers) // 2 * 2], strict=False))


def nodata_of(text: str) -> tuple[float, ...]:
    """The values of a nodata list; NaN is always one."""
    return tuple(v for v in (float(x) for x in SPLIT.split(text.strip()) if x) if v == v)


def _matrix(table: DataFrame, column: str, path: str) -> None:
    files.write_lines(files.matrix_text(table, "k", "r", column).withColumnRenamed("value", "text"), path, "k")


def write_tables(result: T.Result, task_list: list[T.Task], stem: str, kind: str) -> list[str]:
    """The side files of a result, by a stem; their paths."""
    spark, out, cube = result.cube.cells.sparkSession, [], result.cube

    def path(suffix: str) -> str:
        out.append(f"{stem}_{suffix}")
        return out[-1]

    for t, tables in zip(task_list, result.steps, strict=True):
        order = t.order or cube.order
        if t.name == "statistic":
            method = t.params.get("method", "mean")
            s = tables["statistic"]
            _matrix(s, "mean" if method == "mean" else "v", path(f"{method}.txt"))
            if method == "mean":
                _matrix(s, "std", path("mean_std.txt"))
                if t.flag("nuc", False):
                    _matrix(tables["coefficients"], "a", path("mean_a.txt"))
                    _matrix(tables["coefficients"], "b", path("mean_b.txt"))
                    store.write_text(path("mean.xml"), T.uniform_xml(os.path.basename(out[-2]), os.path.basename(out[-1]), order))
        elif t.name == "nuc":
            c = tables["coefficients"]
            for column, suffix in (("a", "a"), ("b", "b"), ("bad", "badpixels"), *((("hi", "hi"), ("lo", "lo")) if t.flag("debug", False) else ())):
                _matrix(c, column, path(f"{suffix}.txt"))
            name = os.path.basename(stem)
            store.write_text(path("uniform.xml"), T.uniform_xml(f"{name}_a.txt", f"{name}_b.txt", order, f"{name}_badpixels.txt" if t.flag("debug", False) else None))
        elif t.name == "extractor":
            frames, what = cube.size[order[2]], t.params.get("type", "peak")
            if what == "peak":
                files.write_lines(files.features_text(tables["points"].select("k", F.col("c").alias("x"), F.col("r").alias("y"), "v"), frames, ["x", "y", "v"]), path("peak_points.txt"), "k", "ord")
                files.write_lines(files.features_text(tables["lines"], frames, ["x1", "y1", "v1", "x2", "y2", "v2"]), path("peak_lines.txt"), "k", "ord")
            else:
                files.write_lines(files.features_text(tables["segments"], frames, ["x1", "y1", "x2", "y2", "width", "p", "nfa"]).filter("k >= 0"), path(f"{what}.txt"), "k", "ord")
        elif t.name == "background" and not t.flag("removal", True):
            b = tables["background"]
            k = t.whole("ksize", 30)
            size = list(cube.size)
            size[order[2]] = -(-size[order[2]] // k)
            raster.write_raster(replace(cube, order=order).with_frames(b, tuple(size)), path("background.dat"), kind, True)
    return out


def process(
    spark: SparkSession, image: str, task_list: str | list[T.Task], out: str | None = None, background: str | None = None, window: str = "", nodata: str = "", kind: str | None = None,
    overwrite: bool = False, crop: bool = False, keep_lines: bool = False,
) -> tuple[T.Result, list[str]]:
    """Runs a task list (its path, or tasks) on an image and writes what it makes: the result and the paths.

    The raster goes to out, or beside the image with _mod; its type is kind, or what the tasks ask for, or the image's.
    crop: the raster holds the window alone, else the whole image's places. keep_lines: an extractor's cube is
    written, too.
    """
    if isinstance(task_list, str):
        task_list = T.read_tasks(store.read_text(task_list), os.path.dirname(task_list) or ".")
    if not task_list:
        raise ValueError("no tasks")
    cube = raster.open_cube(spark, image)
    whole, where = cube.size, window_of(window)
    if where:
        cube = cube.window(**where, rebase=True)
    if nodata:
        cube = replace(cube, nodata=nodata_of(nodata))
    inputs = {"background": raster.open_cube(spark, background).ordered(task_list[0].order or (0, 1, 2)).frames()} if background else {}
    result = T.run(cube, task_list, inputs)
    target = raster.output_path(image, out)
    paths = write_tables(result, task_list, os.path.splitext(raster.output_path(image, out, ""))[0], "float32")
    if result.raster and (keep_lines or not any(t.name == "extractor" for t in task_list)):
        offset = (0, 0, 0) if crop or not where else tuple(max(where.get(k, 0), 0) for k in ("xoff", "yoff", "boff"))
        size = result.cube.size if crop or not where else tuple(n if cube.size[i] == result.cube.size[i] else result.cube.size[i] for i, n in enumerate(whole))
        kind = kind or result.kind or _kind_of(image)
        raster.write_raster(result.cube, target, kind, overwrite, _tags(image), offset, size)
        paths.append(target)
    return result, paths


def _header(image: str) -> dict | None:
    return files.envi_header(store.read_text(lists.header_of(image))) if lists.format_of(image) == "envi" else None


def _kind_of(image: str) -> str:
    names = {v: k for k, v in raster.KINDS.items()}
    if lists.format_of(image) == "gtiff":
        return names.get(tiff.read_directory(image).dtype.str.lstrip("<>|"), "float32")
    header = _header(image)
    return names.get(header["dtype"].lstrip("<>"), "float32") if header else "float32"


def _tags(image: str) -> dict:
    """The entries of the image's header, or its tags, that say where it lies."""
    if lists.format_of(image) == "gtiff":
        return tiff.place_tags(image)
    header = _header(image)
    return {k: v for k, v in header["tags"].items() if k in ("map info", "coordinate system string", "projection info")} if header else {}


def run_job(spark: SparkSession, path: str, templates: str = "") -> list[tuple[str, list[str]]]:
    """A JSON job: every task list (a template's path, or a type, whose template lies in the folder) on every image in turn; each works on the raster of the one before, if that made one. (image, paths) of each."""
    job, out = T.read_job(path), []
    folder = job.get("dstdir") or os.path.dirname(os.path.abspath(path))
    for d in job.get("data", []):
        image = d["img"]
        for n, t in enumerate(job.get("tasklist", [])):
            template = t.get("template") or os.path.join(templates, f"{t['type']}.xml")
            target = os.path.join(folder, f"{os.path.splitext(os.path.basename(d['img']))[0]}_{n}.dat")
            result, paths = process(spark, image, template, target, overwrite=True)
            out.append((image, paths))
            image = target if target in paths else image
    return out


def extract(spark: SparkSession, arguments: list[str], out: str, splice: int = 1, packed: bool = True) -> list[str]:
    """Raw packet files and images to one raster for each file (0), for all together (1) or for each group of frame intervals (2), with records beside it; the paths.

    A lone .aux file gives its .pos text.
    """
    from ..operators import tables

    if len(arguments) == 1 and arguments[0].endswith(".aux"):
        target = arguments[0][:-4] + ".pos"
        files.write_lines(files.aux_text(files.read_aux(spark, arguments[0], packed=True)), target, "ord")
        return [target]
    raw, images = lists.file_list(arguments)
    scenes = []  # (name, cells, size, first, last)
    for f in raw:
        p = files.read_packets(spark, f, packed=packed)
        cells = files.decode(p)
        ends = cells.agg(F.max("x"), F.max("y"), F.max("b")).first()
        valid = files.aux_of(p)
        frames = valid.agg(F.min("frame"), F.max("frame")).first()
        scenes.append((f, cells.select("b", "y", "x", "v"), tuple((e if e is not None else -1) + 1 for e in ends), frames[0], frames[1], valid))
    for f in images:
        cube = raster.open_cube(spark, f)
        aux = os.path.splitext(f)[0] + ".aux"
        records = files.read_aux(spark, aux, packed=True) if store.exists(aux) else None
        frames = records.agg(F.min("frame"), F.max("frame")).first() if records is not None else (None, None)
        scenes.append((f, cube.cells, cube.size, frames[0], frames[1], records))
    if splice == 0:
        groups = [[s] for s in scenes]
    elif splice == 1:
        groups = [scenes]
    else:
        known = [s for s in scenes if s[5] is not None]
        order = tables.group_intervals(spark.createDataFrame([(s[0], s[3], s[4]) for s in known], "name string, first long, last long")).collect() if known else []
        of = {r.name: r.grp for r in order}
        groups = [[s for s in sorted(known, key=lambda s: s[3]) if of.get(s[0]) == g] for g in sorted(set(of.values()))]
    paths = []
    for n, group in enumerate(g for g in groups if g):
        target = out if len(groups) == 1 else f"{os.path.splitext(out)[0]}_{n}{os.path.splitext(out)[1]}"
        size = (max(s[2][0] for s in group), sum(s[2][1] for s in group), max(s[2][2] for s in group))
        cells, at, lines = None, 0, None
        for i, s in enumerate(group):
            part = s[1].select("b", (F.col("y") + at).alias("y"), "x", "v")
            cells = part if cells is None else cells.unionByName(part)
            if all(g[5] is not None for g in group):
                text = files.aux_text(s[5].select("file", "ord", "frame", "msg")).select(F.lit(i).alias("i"), "ord", "text")
                lines = text if lines is None else lines.unionByName(text)
            at += s[2][1]
        raster.write_raster(Cube(cells, size), target, "uint16", True)
        paths.append(target)
        if lines is not None:
            paths.append(os.path.splitext(target)[0] + ".pos")
            files.write_lines(lines, paths[-1], "i", "ord")
    return paths
