"""PNG images written by many tasks: each deflates its lines, and the pieces follow one another in one stream."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ..cube import Cube
from . import ordered, store

#: Cells of the lines that a task deflates at a time.
BLOCK_CELLS = 1 << 20
#: Colour types by number of bands, and the prime of the checksum.
COLOURS, PRIME = {1: 0, 2: 4, 3: 2, 4: 6}, 65521


def chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def joined_sums(a: int, b: int, length: int) -> int:
    """The Adler checksum of two pieces from theirs; length is that of the second."""
    a1, a2, b1, b2 = a & 0xFFFF, a >> 16, b & 0xFFFF, b >> 16
    low = (a1 + b1 - 1) % PRIME
    high = (a2 + b2 + length % PRIME * (a1 - 1)) % PRIME
    return high << 16 | low


def write_png(cube: Cube, path: str, kind: str = "byte", tags: dict[str, str] | None = None, shared: bool | None = None) -> int:
    """Writes one to four bands as an image of 8 or 16 bits; its size in bytes. Values are rounded and held inside the range; cells that are not there are 0."""
    samples, lines, bands = cube.size
    if bands not in COLOURS or kind not in ("byte", "uint16"):
        raise ValueError("an image has one to four bands of byte or uint16")
    spark, keep = cube.cells.sparkSession, store.Kept(cube.cells.sparkSession)
    dtype, step = np.dtype("u1" if kind == "byte" else ">u2"), max(1, BLOCK_CELLS // max(samples * bands, 1))

    def deflate(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        first = block * step
        m = np.zeros((min(step, lines - first), samples, bands))
        real = [i for i, v in enumerate(table.column("v").to_pylist()) if v is not None]
        own = table.take(pa.array(real, pa.int64()))
        m[own.column("y").to_numpy() - first, own.column("x").to_numpy(), own.column("b").to_numpy()] = own.column("v").to_numpy()
        m = np.clip(np.floor(np.nan_to_num(m) + 0.5), 0, np.iinfo(dtype).max).astype(dtype)
        raw = b"".join(b"\0" + line.tobytes() for line in m)  # no filter
        d = zlib.compressobj(6, zlib.DEFLATED, -15)
        data = d.compress(raw) + d.flush(zlib.Z_FULL_FLUSH)
        return pa.table({"block": pa.array([block], pa.int64()), "data": pa.array([chunk(b"IDAT", (b"\x78\x9c" if block == 0 else b"") + data)], pa.binary()), "adler": pa.array([zlib.adler32(raw)], pa.int64()), "n": pa.array([len(raw)], pa.int64())})

    cells = cube.cells.select(*(F.col(c).cast("int").alias(c) for c in "byx"), F.col("v").cast("double").alias("v"))
    every = spark.range(max(1, -(-lines // step))).select(F.lit(0).alias("b"), (F.col("id") * step).cast("int").alias("y"), F.lit(0).alias("x"), F.lit(None).cast("double").alias("v"))  # a block without cells, too
    blocks = cells.unionByName(every).withColumn("block", F.floor(F.col("y") / step)).groupBy("block").applyInArrow(deflate, "block long, data binary, adler long, n long")
    blocks = keep(blocks, "blocks")
    total = 1
    for r in blocks.select("block", "adler", "n").orderBy("block").collect():  # three numbers a block of lines
        total = joined_sums(total, r.adler, r.n)
    head = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", samples, lines, dtype.itemsize * 8, COLOURS[bands], 0, 0, 0))
    head += b"".join(chunk(b"tEXt", k.encode("latin-1", "replace") + b"\0" + v.encode("latin-1", "replace")) for k, v in (tags or {}).items())
    tail = chunk(b"IDAT", b"\x03\x00" + struct.pack(">I", total)) + chunk(b"IEND", b"")
    ends = spark.createDataFrame([(-1, head), (2**62, tail)], "block long, data binary")
    return ordered.write_bytes(blocks.select("block", "data").unionByName(ends), path, "block", shared=shared)
