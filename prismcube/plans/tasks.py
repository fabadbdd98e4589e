"""Task lists: read from XML, checked, rewritten and folded over a cube into one lazy plan."""

from __future__ import annotations

import json
import os
import warnings
import xml.etree.ElementTree as ET
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..cube import AXES, FLT_MAX, FLT_MIN, Cube
from ..functions.interp import KINDS, kind_of, resample_frames
from ..operators import aggregates as A
from ..operators import kernels as K
from ..operators import maps as M
from ..operators import render as R
from ..operators import segments as S
from ..operators import shapes
from ..sources import files, lists, raster, store

#: The parameters that each task reads.
PARAMETERS = {
    name: set(words.split())
    for name, words in {
        "uniform": "a b dst_min dst_max",
        "dark": "a b index dst_min dst_max",
        "extend": "file",
        "dpc": "file dim_prior",
        "sort": "",
        "gauss": "ksize band dim",
        "median": "method ksize hist_min hist_max hist_step",
        "destripe": "tile_size",
        "statistic": "method cut_lower cut_upper nuc nuc@apply",
        "nuc": "cut_dark cut_bright threshold_dark threshold_bright sample_dark sample_bright tile_size tile_overlap a interp apply debug",
        "interp": "wl0 wl1 type",
        "background": "ksize method removal",
        "removal": "interval background",
        "anomaly": "ksize",
        "render": "mode src_min src_umax src_step dst_min dst_max cut_lower cut_upper hist_clip dst_mean dst_std c b resample_col_step resample_row_step tile_cols tile_rows grid_x grid_y",
        "extractor": "type dimension matrix tolerance length_min length_max thickness_min thickness_max scale sigma_scale quant ang_th log_eps density_th n_bins",
    }.items()
}


@dataclass(frozen=True)
class Task:
    name: str
    params: dict[str, str] = field(default_factory=dict)
    order: tuple[int, int, int] | None = None

    def number(self, key: str, default: float) -> float:
        return float(self.params.get(key, default))

    def whole(self, key: str, default: int) -> int:
        return int(float(self.params.get(key, default)))

    def flag(self, key: str, default: bool) -> bool:
        return str(self.params.get(key, default)).strip().lower() in ("1", "true", "yes")


@dataclass
class Result:
    """The cube after the last task, side tables by name (and as they are after each task), the output type that the tasks ask for, and whether any changes the cube."""

    cube: Cube
    tables: dict[str, DataFrame] = field(default_factory=dict)
    kind: str | None = None
    raster: bool = False
    steps: list[dict[str, DataFrame]] = field(default_factory=list)


def read_tasks(text: str, folder: str = ".") -> list[Task]:
    """Tasks of an XML document; parameters that name a file beside it are resolved."""
    root = ET.fromstring(text)
    order = (root.findtext("dim_prior") or "0,1,2").replace(" ", "").split(",")
    every = tuple(int(x) for x in order)
    out = []
    for t in root.iter("task"):
        params = {c.tag: (c.text or "").strip() for c in t}
        for c in t:
            params |= {f"{c.tag}@{k}": v for k, v in c.attrib.items()}
        for key in ("a", "b", "file", "index", "background"):
            value = params.get(key, "")
            if value and (t.get("name") != "nuc" or key != "a") and not store.exists(value) and store.exists(os.path.join(folder, value)):
                params[key] = os.path.join(folder, value)
        name = t.get("name", "")
        if unknown := sorted(set(params) - PARAMETERS.get(name, set(params))):
            warnings.warn(f"{name} does not read {', '.join(unknown)}", stacklevel=2)
        out.append(Task(name, params, every))
    return out


def axes_of(text: str) -> tuple[int, int, int]:
    return tuple(int(x) for x in text.replace(" ", "").split(","))


def peak_test(t: Task) -> tuple[list[list[float]], float]:
    """The ratios and the threshold of a peak test: `dimension` (width, height) and `matrix`, whose centre is the threshold; what cannot be read is the usual one."""
    try:
        w, h = (int(float(x)) for x in t.params.get("dimension", "5 5").split()[:2])
    except ValueError:
        w, h = 5, 5
    usual = [x for row in A.PEAK for x in row]
    usual[12] = 100.0
    try:
        m = [float(x) for x in t.params["matrix"].split()[: w * h]] if "matrix" in t.params else usual
    except ValueError:
        m = []
    if len(m) < w * h:
        if (w, h) != (5, 5):
            raise ValueError("the matrix has fewer numbers than the dimension asks for")
        m = usual
    rows = [list(m[y * w : (y + 1) * w]) for y in range(h)]
    threshold, rows[h // 2][w // 2] = rows[h // 2][w // 2], 0.0
    return rows, threshold or -FLT_MAX


def bad_cells(spark, t: Task, cube: Cube) -> DataFrame:
    """The bad cells of a mask file as k, r, c: a raster of the cube's own shape, or a text matrix over the first two axes of the task's own order, for all of the third."""
    names = {AXES[i]: n for i, n in zip(cube.order, ("c", "r", "k"), strict=True)}
    kind = lists.format_of(t.params["file"])
    if kind in ("npy", "parquet") or kind == "envi" and store.exists(lists.header_of(t.params["file"])):
        mask = raster.open_cube(spark, t.params["file"]).cells.filter("v <> 0")
        return mask.select(*(mask[a].alias(n) for a, n in names.items()))
    own = axes_of(t.params["dim_prior"]) if t.params.get("dim_prior") else cube.order
    m = files.read_matrix(spark, t.params["file"], cube.size[own[0]]).filter("v <> 0")
    return m.select(m["c"].alias(names[AXES[own[0]]]), m["r"].alias(names[AXES[own[1]]]))


def uniform_xml(a: str, b: str, order: tuple[int, int, int], bad: str | None = None) -> str:
    """The task list that applies coefficients estimated in an order of axes: lines and places of the estimate become the matrix."""
    prior = ",".join(str(order[i]) for i in (1, 2, 0))
    more = f'<task name="dpc"><file>{bad}</file></task>' if bad else ""
    return f'<HSP><dim_prior>{prior}</dim_prior><task name="uniform"><a>{a}</a><b>{b}</b></task>{more}</HSP>'


def read_job(path: str) -> dict:
    """A JSON job: paths resolved beside it; data needs img, tasks need type or template; unknown keys are warned of."""
    with open(path) as f:
        job = json.load(f)
    base = os.path.dirname(os.path.abspath(path))
    at = lambda p: p if os.path.isabs(p) or "://" in p else os.path.normpath(os.path.join(base, p))
    for key in set(job) - {"dstdir", "tmpdir", "data", "tasklist", "tile_size", "margins", "max_processes", "timeout", "omp_num_threads", "debug"}:
        warnings.warn(f"unknown key {key}", stacklevel=2)
    if "dstdir" in job:
        job["dstdir"] = at(job["dstdir"])
    for d in job.get("data", []):
        if "img" not in d:
            raise ValueError("data needs img")
        d["img"] = at(d["img"])
    for t in job.get("tasklist", []):
        if not {"type", "template"} & set(t):
            raise ValueError("a task needs type or template")
        if "template" in t:
            t["template"] = at(t["template"])
    return job


def rewrite(tasks: list[Task]) -> list[Task]:
    """Cheaper lists of the same result: a background that is removed at once becomes one window."""
    return [Task("remove_background", t.params, t.order) if t.name == "background" and t.flag("removal", True) else t for t in tasks]


def _clamp(t: Task) -> dict:
    return {"lo": t.number("dst_min", FLT_MIN), "hi": t.number("dst_max", FLT_MAX)}


def run(cube: Cube, tasks: list[Task], inputs: dict[str, DataFrame] | None = None) -> Result:
    """Applies tasks in order. inputs holds side tables by name ("background"); coefficient files are read from the tasks' paths."""
    spark, inputs, out = cube.cells.sparkSession, inputs or {}, Result(cube)
    for t in rewrite(tasks):
        cube = out.cube.ordered(t.order) if t.order else out.cube
        f, rows, cols = cube.frames(), cube.extent(1), cube.extent(0)
        matrix = lambda key, name, t=t, cols=cols: files.read_coefficients(spark, t.params[key], cols).withColumnRenamed("v", name)
        size = None
        out.raster = out.raster or t.name not in ("statistic", "nuc", "background", "extractor")
        if t.name == "uniform":
            f = M.uniform(f, matrix("a", "a").join(matrix("b", "b"), ["r", "c"]), cube.nodata, **_clamp(t), cells=rows * cols)
        elif t.name == "dark" and t.params.get("a"):
            index = files.read_text_lines(spark, t.params["index"]).selectExpr("ord AS k", "CAST(regexp_extract(text, '-?[0-9]+', 0) AS DOUBLE) AS idx")
            f = M.dark_linear(f, matrix("a", "a").join(matrix("b", "b"), ["r", "c"]), index, cube.nodata, **_clamp(t), cells=rows * cols)
        elif t.name == "dark":
            f = M.dark_constant(f, matrix("b", "b"), cube.nodata, **_clamp(t), cells=rows * cols)
        elif t.name == "extend":
            f = M.extend(f, files.read_matrix(spark, t.params["file"], cols), rows * cols)
        elif t.name == "dpc":
            f = K.inpaint(f, bad_cells(spark, t, cube), rows, cols)
        elif t.name == "sort":
            f = A.sort_lines(f)
        elif t.name == "gauss":
            f = A.gauss(f, rows, cols, t.whole("ksize", 3), t.whole("band", 0), t.whole("dim", 1))
        elif t.name == "median" and t.params.get("method") == "adapt":
            f = K.despeckle(f, rows, cols, t.whole("ksize", 3), t.number("hist_min", 7), t.number("hist_max", 4000), t.number("hist_step", 1))
        elif t.name == "median":
            f = A.median_filter(f, rows, cols, t.whole("ksize", 3))
        elif t.name == "destripe":
            f = A.destripe(f, t.whole("tile_size", 31))
        elif t.name == "statistic":
            if t.params.get("method", "mean") == "mean":
                out.tables["statistic"] = A.line_stats(f, t.number("cut_lower", 0), t.number("cut_upper", 0), cube.nodata)
                if t.flag("nuc", False):
                    out.tables["coefficients"] = A.stats_to_coefficients(out.tables["statistic"])
                    if t.flag("nuc@apply", True):
                        f = _by_line(f, out.tables["coefficients"], cube.nodata)
            else:
                out.tables["statistic"] = A.line_median(f, cube.nodata)
        elif t.name == "nuc":
            tile = t.whole("tile_size", 2**31 - 1)
            c = A.calibrate(
                f, t.number("cut_dark", 0.03), t.number("cut_bright", 0.1), t.number("threshold_dark", 0.03), t.number("threshold_bright", 0.03), t.whole("sample_dark", 40), t.whole("sample_bright", 40),
                t.flag("a", True), tile if tile < rows else None, KINDS[kind_of(t.params.get("interp", "pchip"))], cube.nodata, t.whole("tile_overlap", -1), rows,
            )
            out.tables["coefficients"] = c
            if t.flag("apply", True):
                f = _by_line(f, c, cube.nodata)
        elif t.name == "background":
            out.tables["background"] = inputs["background"] = A.background(f, t.whole("ksize", 30), t.params.get("method", "average"))
        elif t.name == "remove_background":
            f = A.remove_background(f, t.whole("ksize", 30), t.params.get("method", "average"))
        elif t.name == "removal":
            if t.params.get("background"):
                background = raster.open_cube(spark, t.params["background"]).ordered(cube.order).frames()
            elif "background" in inputs:
                background = inputs["background"]
            else:
                raise ValueError("removal needs a background: a path, an input, or a task before it")
            f = M.minus_background(f, background, t.whole("interval", 30))
            out.kind = out.kind or "float32"
        elif t.name == "anomaly":
            k = t.whole("ksize", 30)
            f = A.anomaly(f, k)
            size = list(cube.size)
            size[cube.order[2]] = -(-cube.extent(2) // k)
            out.kind = out.kind or "float32"
        elif t.name == "interp":
            cells, bands = resample_frames(cube.cells, lists.wavelengths(t.params["wl0"]), lists.wavelengths(t.params["wl1"]), cube.size, kind_of(t.params.get("type", "pchip")))
            size = [cube.size[0], cube.size[1], bands]
            f = Cube(cells, tuple(size), cube.nodata, cube.order).frames()
        elif t.name == "render":
            names = ("src_min", "src_umax", "src_step", "dst_min", "dst_max", "cut_lower", "cut_upper", "hist_clip", "dst_mean", "dst_std", "c", "b")
            p = R.Render(**{n: t.number(n, getattr(R.Render, n)) for n in names}, mode=t.params.get("mode", R.Render.mode))
            step = max(t.whole("resample_row_step", 3), 1), max(t.whole("resample_col_step", 3), 1)
            if "tile" in p.mode.lower():
                f = R.render_tiles(f, rows, cols, p, (t.whole("grid_x", 8), t.whole("grid_y", 8)), step, (t.whole("tile_rows", 0), t.whole("tile_cols", 0)))
            else:
                f = R.render(f, p, step, (rows, cols))
            if p.dst_max < 256:
                out.kind = out.kind or "byte"
        elif t.name == "extractor" and t.params.get("type", "peak") != "peak":
            keep = lambda k, t=t: (t.number(f"{k}_min", {"thickness": 1, "length": 11}[k]), t.number(f"{k}_max", {"thickness": 1, "length": 20}[k]))
            detector = {n: t.number(n, d) for n, d in (("scale", 0.8), ("sigma_scale", 0.6), ("quant", 2.0), ("ang_th", 22.5), ("log_eps", 0.0), ("density_th", 0.7))}
            out.tables["segments"] = S.line_segments(f, rows, cols, keep("thickness"), keep("length"), n_bins=t.whole("n_bins", 1024), **detector)
        elif t.name == "extractor":
            ratios, threshold = peak_test(t)
            kept = A.peaks(f, rows, cols, threshold, ratios, t.whole("tolerance", max(len(ratios), len(ratios[0]))))
            out.tables["points"] = kept.filter("n = 0").select("k", "c", "r", "v")
            out.tables["lines"] = shapes.peak_lines(kept, rows, cols, t.whole("length_min", 11), t.whole("length_max", 20))
            f = kept.select("k", "r", "c", "v")
        else:
            warnings.warn(f"unknown task {t.name} is left out", stacklevel=2)
        out.cube = cube.with_frames(f, tuple(size) if size else None)
        out.steps.append(dict(out.tables))
    return out


def _by_line(frames: DataFrame, coefficients: DataFrame, nodata) -> DataFrame:
    """Gain and offset of each frame's line."""
    from pyspark.sql import functions as F

    j = frames.join(coefficients.select("k", "r", "a", "b"), ["k", "r"])
    return j.select("k", "r", "c", M.clamped(F.col("a") * F.col("v") + F.col("b"), F.col("v"), nodata).alias("v"))
