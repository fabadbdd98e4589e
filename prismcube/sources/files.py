"""Readers and writers of the formats around a cube: text matrices, headers of flat rasters, raw packets, records and cameras.

Files are listed by Spark. Text (numbered) and packets (packets) are read by ranges, so one file is many tasks'; records are
read a part at a time, and what a part cuts off is carried into the next; parsers are plain functions over bytes or lines.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import store
from .numbered import read_coefficients, read_matrix, read_text_lines  # noqa: F401
from .ordered import write_lines  # noqa: F401
from .packets import HEADER, TOKEN, header, read_packets  # noqa: F401

SEPARATORS = r"[ ,;|\t]+"
#: Type codes of the flat binary format and their numpy names.
ENVI_TYPES = {1: "u1", 2: "i2", 3: "i4", 4: "f4", 5: "f8", 6: "c8", 9: "c16", 12: "u2", 13: "u4"}
#: Bytes of a file that are read at a time.
PART = 1 << 24


def matrix_text(cells: DataFrame, key: str = "k", order: str = "r", value: str = "v") -> DataFrame:
    """A line of tab-separated numbers (six significant digits) for each key."""
    number = F.format_string("%.6g", F.col(value).cast("double"))
    number = F.regexp_replace(F.regexp_replace(number, r"(\.[0-9]*?)0+(e|$)", "$1$2"), r"\.(e|$)", "$1")
    s = cells.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), number.alias("t")))).alias("s"))
    return s.select(key, F.array_join(F.transform("s", lambda x: x["t"]), "\t").alias("value"))


_HEADER = {"samples", "lines", "bands", "header offset", "file type", "data type", "interleave", "byte order"}


def envi_header(text: str) -> dict:
    """samples, lines, bands, interleave, type and byte order of a header."""
    pairs = {k.strip().lower(): v.strip() for k, v in re.findall(r"^([^=\n]+)=\s*(\{[^}]*\}|[^\n]*)", text, re.M)}
    kind = ("<" if int(pairs.get("byte order", 0)) == 0 else ">") + ENVI_TYPES[int(pairs["data type"])]
    return {"samples": int(pairs["samples"]), "lines": int(pairs["lines"]), "bands": int(pairs["bands"]), "interleave": pairs.get("interleave", "bsq").lower(), "dtype": kind, "offset": int(pairs.get("header offset", 0)), "nodata": pairs.get("data ignore value"), "tags": {k: v for k, v in pairs.items() if k not in _HEADER}}


def envi_text(samples: int, lines: int, bands: int, kind: str, interleave: str = "bsq", tags: dict[str, str] | None = None) -> str:
    """A header; tags are further entries, such as a map's place."""
    code = next(k for k, v in ENVI_TYPES.items() if v == kind.lstrip("<>="))
    head = f"ENVI\nsamples = {samples}\nlines = {lines}\nbands = {bands}\nheader offset = 0\nfile type = ENVI Standard\ndata type = {code}\ninterleave = {interleave}\nbyte order = 0\n"
    return head + "".join(f"{k} = {v}\n" for k, v in (tags or {}).items())


def unpack12(data: bytes) -> np.ndarray:
    a = np.frombuffer(data[: len(data) // 3 * 3], np.uint8).reshape(-1, 3).astype(np.int32)
    out = np.stack([(a[:, 0] << 4) + (a[:, 1] >> 4), ((a[:, 1] & 15) << 8) + a[:, 2]], 1).ravel()
    if len(data) % 3 == 2:  # one sample more
        out = np.append(out, (data[-2] << 4) + (data[-1] >> 4)).astype(np.int32)
    return out


def pack12(values) -> bytes:
    v = np.asarray(values, np.int32).reshape(-1, 2)
    return np.stack([v[:, 0] >> 4, (v[:, 0] & 15) << 4 | v[:, 1] >> 8, v[:, 1] & 255], 1).astype(np.uint8).tobytes()


def packets_in(parts: Iterable[bytes], token: bytes = TOKEN, packed: bool = True) -> Iterator[dict]:
    """Packets of a raw stream that comes in parts: token, 2-byte sample count, type, band (one byte; of 12 bits when it begins with 2 or less), 3-byte frame, payload.

    What a part cuts off waits for the next; what the end cuts off is left out. line counts the frames' first (META)
    packets from 0, and is -1 before them.
    """
    rest, ord_, line, head = b"", 0, -1, len(token) + HEADER
    for part in parts:
        rest, pos = rest + part, 0
        while True:
            at = rest.find(token, pos)
            if at < 0:
                at = max(len(rest) - len(token) + 1, pos)
                break
            if at + head > len(rest):
                break
            h, start = header(rest[at + len(token) : at + head], packed), at + head
            if start + h["n_bytes"] > len(rest):
                break
            line += h["data_type"] == "META"
            yield {"ord": ord_, "line": line, **h, "payload": rest[start : start + h["n_bytes"]]}
            ord_, pos = ord_ + 1, start + h["n_bytes"]
        rest = rest[at:]


def packets_of(data: bytes, token: bytes = TOKEN, packed: bool = True) -> Iterator[dict]:
    return packets_in([data], token, packed)


def packet(samples: int, kind: int, band: int, frame: int, payload: bytes, token: bytes = TOKEN) -> bytes:
    """One packet, for tests and simulations."""
    return token + struct.pack(">HBBB", samples, kind, band >> 8, band & 255) + frame.to_bytes(3, "big") + payload


def _batches(rows: Iterable[dict], schema: pa.Schema, size, most: int = PART) -> Iterator[pa.RecordBatch]:
    """Record batches of rows, of about that many bytes."""
    held, total = [], 0
    for r in rows:
        held.append(r)
        total += size(r)
        if total > most:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, total = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def decode(packets: DataFrame, last: int | None = None) -> DataFrame:
    """file, b, y, x, v of the valid frames of packets; y counts them. SWIR lines are flipped inside each of four modules. last: only so many places at the end of each packet.

    Packets are written once, since they are used for the frames and for the samples.
    """
    from pyspark.sql import Window as W

    from ..operators.aggregates import packet_frames
    from ..operators.maps import unpack12 as unpack

    packets = store.Kept(packets.sparkSession)(packets, "packets")
    lines = packet_frames(packets).filter("valid").withColumn("y", F.row_number().over(W.partitionBy("file").orderBy("line")) - 1)
    p = packets
    if "line" not in p.columns:
        order = W.partitionBy("file").orderBy("ord").rowsBetween(W.unboundedPreceding, 0)
        p = p.withColumn("line", F.sum((F.col("data_type") == "META").cast("int")).over(order) - 1)
    p = p.filter("data_type = 'IMAGE'").join(lines.select("file", "line", "y"), ["file", "line"]).withColumn("s", unpack(F.col("payload")))
    p = p.select("file", "image_type", F.col("band").alias("b"), "y", F.size("s").alias("n"), F.posexplode("s").alias("i", "v"))
    m = F.floor(F.col("n") / 4)
    part = F.floor(F.col("i") / m)
    flipped = F.when((F.col("image_type") == "SWIR") & (part < 4), part * m + (m - 1 - (F.col("i") - part * m))).otherwise(F.col("i"))
    p = p.withColumn("x", flipped.cast("int"))
    if last is not None:
        p = p.filter(F.col("x") >= F.col("n") - last)
    return p.select("file", "b", "y", "x", F.col("v").cast("double").alias("v"))


def records_in(parts: Iterable[bytes]) -> Iterator[tuple[int, bytes]]:
    """(frame, message) of a record file that comes in parts: two int32, then as many bytes; empty ones are skipped, a cut one ends."""
    rest = b""
    for part in parts:
        rest, at = rest + part, 0
        while at + 8 <= len(rest):
            frame, n = struct.unpack_from("<ii", rest, at)
            if n < 0:
                return
            if at + 8 + n > len(rest):
                break
            if n:
                yield frame, rest[at + 8 : at + 8 + n]
            at += 8 + n
        rest = rest[at:]


def aux_records(data: bytes) -> Iterator[tuple[int, bytes]]:
    return records_in([data])


def unpack_message(data: bytes) -> str:
    """The text of a record's 12-bit samples, one character each, up to the first zero."""
    return bytes((unpack12(data) & 255).astype(np.uint8)).split(b"\0")[0].decode("latin-1")


_AUX = pa.schema([("file", pa.string()), ("ord", pa.int32()), ("frame", pa.int32()), ("msg", pa.string())])


def read_aux(spark: SparkSession, path: str, packed: bool = False, part: int = PART) -> DataFrame:
    """file, ord, frame, msg of record files, read a part at a time; packed: messages are 12-bit samples."""

    def run(batches):
        for b in batches:
            for file in b.column(0).to_pylist():
                rows = ({"file": file, "ord": i, "frame": f, "msg": unpack_message(m) if packed else m.decode("latin-1")} for i, (f, m) in enumerate(records_in(store.chunks(file, part))))
                yield from _batches(rows, _AUX, lambda r: len(r["msg"]) + 50)

    return store.listed(spark, path).select("path").mapInArrow(run, "file string, ord int, frame int, msg string")


def aux_text(records: DataFrame) -> DataFrame:
    """file, ord, text: `frame<tab>message` lines of records, the message's first character left out."""
    return records.select("file", "ord", F.concat(F.col("frame").cast("string"), F.lit("\t"), F.expr("substring(msg, 2)")).alias("text"))


def aux_of(packets: DataFrame) -> DataFrame:
    """file, ord, frame, msg of the META packets of valid frames: the records that go with a decoded cube."""
    from ..operators.aggregates import packet_frames
    from pyspark.sql import Window as W

    text = F.udf(lambda p: unpack_message(bytes(p)), "string", useArrow=True)
    lines = packet_frames(packets).filter("valid").select("file", "line")
    p = packets.filter("data_type = 'META'").join(lines, ["file", "line"])
    return p.select("file", (F.row_number().over(W.partitionBy("file").orderBy("line")) - 1).alias("ord"), "frame", text("payload").alias("msg"))


def parse_camera(text: str) -> dict:
    """f, pixel, x0, y0 of the first line; three angles and three offsets of the second."""
    first, second = ([float(x) for x in re.split(SEPARATORS, line.strip())] for line in text.strip().splitlines()[:2])
    return dict(zip(("f", "pixel", "x0", "y0"), first, strict=False)) | {"angles": second[:3], "shift": second[3:6]}


def features_text(features: DataFrame, frames: int, columns: list[str]) -> DataFrame:
    """k, ord, text: the lines of features (k and columns) of frames 0 to frames - 1, each frame's number of rows first, with one decimal. A line before all holds the number of frames.

    Rows are in the order of their columns, sorted by range and numbered by prefix sums, so that no frame's rows are gathered.
    """
    from ..operators.scans import prefix_sums

    spark, keep = features.sparkSession, store.Kept(features.sparkSession)
    row = F.array_join(F.array(*(F.format_string("%.1f", F.col(c).cast("double")) for c in columns)), "\t")
    inside = features.filter(F.col("k").between(0, frames - 1)).select(F.col("k").cast("int").alias("k"), *columns, row.alias("text"), F.lit(1).alias("_one"))
    # numbers within all rows in order, less the rows of the frames before
    numbered = keep(prefix_sums(inside, ["k", *columns], "_one", keep).select("k", "before", "text"), "numbered")
    firsts = numbered.groupBy("k").agg(F.min("before").alias("first"), F.count(F.lit(1)).alias("n"))
    rows = numbered.join(firsts, "k").select("k", (F.col("before") - F.col("first") + 1).cast("int").alias("ord"), "text")
    every = spark.range(frames).select(F.col("id").cast("int").alias("k")).join(firsts, "k", "left")
    lines = every.select("k", F.lit(0).alias("ord"), F.coalesce("n", F.lit(0)).cast("string").alias("text")).unionByName(rows)
    first = features.sparkSession.createDataFrame([(-1, 0, str(frames))], "k int, ord int, text string")
    return first.unionByName(lines)
