"""Small text files beside the cubes: wavelengths, lists of files, strips, points and control points, and their export."""

from __future__ import annotations

import os
import re
from xml.sax.saxutils import escape

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import store

#: Extensions of rasters and what they are called; all but flat rasters, arrays and tables need other libraries.
FORMATS = {
    "tif": "gtiff", "tiff": "gtiff", "mem": "memory", "bmp": "bmp", "jpg": "jpeg", "png": "png", "img": "hfa", "bt": "bt", "ecw": "ecw", "fits": "fits", "gif": "gif", "hdf": "hdf",
    "hdr": "envi", "pix": "pcidsk", "dat": "envi", "parquet": "parquet", "npy": "npy", "raw": "packets",
}


def header_of(path: str) -> str:
    return re.sub(r"\.[^./]*$", "", path) + ".hdr"


def format_of(path: str, default: str = "envi") -> str:
    """A path's format: flat where a header lies beside it, else by its extension; without extension, in memory."""
    name = path.rsplit("/", 1)[-1]
    if "." not in name:
        return "memory"
    if store.exists(header_of(path)):
        return "envi"
    return FORMATS.get(name.rsplit(".", 1)[-1].lower(), default)


def is_raw(path: str) -> bool:
    """Raw packets are .dat files without a header."""
    return path.lower().endswith(".dat") and not store.exists(header_of(path))


def file_list(paths: list[str]) -> tuple[list[str], list[str]]:
    """(raw files, images) of arguments that exist; a .txt holds one path a line, as it is or beside the list."""
    raw, images = [], []
    for path in paths:
        if not store.exists(path):
            continue
        found = [path]
        if path.endswith(".txt"):
            lines = [x.rstrip("\r") for x in store.read_text(path).split("\n")]
            both = [(x, os.path.join(os.path.dirname(path), x)) for x in lines if len(x) > 1]
            found = [a if store.exists(a) else b for a, b in both if store.exists(a) or store.exists(b)]
        for f in found:
            (raw if is_raw(f) else images).append(f)
    return raw, images


def wavelengths(text: str) -> list[float]:
    """Numbers between commas, blanks and semicolons, of which two in a row are an error."""
    return [float(x) for x in re.split(r"[, ;]", text)]


def read_strips(text: str, least: int = 50) -> list[tuple[str, str, int, int]]:
    """(strip, path, start, size): a count of strips, then for each a line of its name and number of images, then the images. Strips of fewer than `least` images are left out."""
    lines = text.splitlines()
    out, at = [], 1
    for _ in range(int(lines[0])):
        strip, n = lines[at].split()[:2]
        rows = [x.split() for x in lines[at + 1 : at + 1 + int(n)]]
        at += 1 + int(n)
        if int(n) >= least:
            out += [(strip, r[0], int(r[1]), int(r[2])) for r in rows]
    return out


def strips_text(strips: list[tuple[str, str, int, int]]) -> str:
    names = list(dict.fromkeys(s[0] for s in strips))
    out = [str(len(names))]
    for n in names:
        own = [s for s in strips if s[0] == n]
        out += [f"{n} {len(own)}", *(f"{p} {a} {b}" for _, p, a, b in own)]
    return "\n".join(out) + "\n"


def dms(text: Column) -> Column:
    """Degrees of d:m:s."""
    d = F.split(text, ":")
    n = lambda i: F.get(d, F.lit(i)).try_cast("double")
    return n(0) + n(1) / 60 + n(2) / 3600


def control_points(lines: DataFrame) -> DataFrame:
    """(name, lon, lat, h) of lines (text) of words: the name first, latitude and longitude as d:m:s fifth and sixth, the height seventh."""
    w = F.split(F.trim("text"), r"\s+")
    return lines.filter(F.size(w) >= 7).select(F.get(w, F.lit(0)).alias("name"), dms(F.get(w, F.lit(5))).alias("lon"), dms(F.get(w, F.lit(4))).alias("lat"), F.get(w, F.lit(6)).try_cast("double").alias("h"))


def point_lines(lines: DataFrame) -> DataFrame:
    """(name, note, x, y) of lines (text) of comma-separated values."""
    w = F.split(F.rtrim("text"), ",")
    at = lambda i: F.get(w, F.lit(i))
    return lines.filter(F.size(w) >= 4).select(at(0).alias("name"), at(1).alias("note"), at(2).try_cast("double").alias("x"), at(3).try_cast("double").alias("y"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "text")


def kml(points: list[tuple], line: bool = False, folder: str | None = None) -> str:
    """A document of named points (name, x, y, and a height), or of one line through them, in a folder if it has a name."""
    at = lambda p: f"{p[1]},{p[2]},{p[3] if len(p) > 3 else 0}"
    if line:
        body = "<Placemark><LineString><coordinates>" + " ".join(map(at, points)) + "</coordinates></LineString></Placemark>"
    else:
        body = "".join(f"<Placemark><name>{escape(str(p[0]))}</name><Point><coordinates>{at(p)}</coordinates></Point></Placemark>" for p in points)
    if folder:
        body = f"<Folder><name>{escape(folder)}</name>{body}</Folder>"
    return f'<?xml version="1.0" encoding="UTF-8"?><kml xmlns="http://www.opengis.net/kml/2.2"><Document>{body}</Document></kml>'
