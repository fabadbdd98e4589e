"""TIFF rasters: a data source that reads the strips or tiles it needs, and a writer whose tasks fill one file.

`spark.dataSource.register(TiffSource)`, then format("tiff"). Reading: the directory is read once; each input
partition is a run of strips or tiles that meet the window (read options xoff, xsize, ...). Uncompressed, deflated, packed and
LZW data, both predictors, both byte orders and large files (64-bit offsets) are read. Writing: see RasterWriter.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from . import store

#: Cells of an input partition, and cells that a task sorts and writes at a time.
PART_CELLS, WRITE_CELLS = 1 << 22, 1 << 20
#: Codes of value types, and the tags that tell a raster's layout.
TYPES = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 6: "b", 7: "B", 8: "h", 9: "i", 10: "ii", 11: "f", 12: "d", 13: "I", 16: "Q", 17: "q", 18: "Q"}
WIDTH, LENGTH, BITS, COMPRESSION, PHOTOMETRIC, STRIP_AT, SAMPLES, STRIP_LINES, STRIP_SIZE, PLANAR, PREDICTOR = 256, 257, 258, 259, 262, 273, 277, 278, 279, 284, 317
TILE_WIDTH, TILE_LENGTH, TILE_AT, TILE_SIZE, SAMPLE_FORMAT = 322, 323, 324, 325, 339
#: Tags that say where a raster lies, what stands for no data, and its rational polynomial.
TIE_POINTS, NODATA, RPC = 33922, 42113, 50844
PLACE_TAGS = (33550, TIE_POINTS, 34264, 34735, 34736, 34737, 42112, NODATA, RPC)
_FORMATS = {1: "u", 2: "i", 3: "f", 6: "c"}


@dataclass(frozen=True)
class Directory:
    """The first image of a file: tags as (type, values), and the byte order."""

    tags: dict[int, tuple[int, tuple]]
    order: str

    def get(self, tag: int, default=None):
        return self.tags[tag][1] if tag in self.tags else default

    def one(self, tag: int, default: int | None = None) -> int:
        return self.get(tag, (default,))[0]

    @property
    def size(self) -> tuple[int, int, int]:
        """Samples, lines and bands."""
        return self.one(WIDTH), self.one(LENGTH), self.one(SAMPLES, 1)

    @property
    def dtype(self) -> np.dtype:
        bits, kind = set(self.get(BITS, (1,))), set(self.get(SAMPLE_FORMAT, (1,)))
        if len(bits) > 1 or len(kind) > 1 or (b := bits.pop()) % 8 or (k := kind.pop()) not in _FORMATS:
            raise ValueError("samples of different types, or of parts of bytes")
        return np.dtype(f"{self.order}{_FORMATS[k]}{b // 8}")

    @property
    def nodata(self) -> float | None:
        text = self.get(NODATA)
        return float(text[0].strip("\0 ")) if text and text[0].strip("\0 ") else None


def read_directory(path: str) -> Directory:
    with store.open_read(path) as f:
        head = f.read(16)
        order = {b"II": "<", b"MM": ">"}.get(head[:2])
        if order is None or struct.unpack(order + "H", head[2:4])[0] not in (42, 43):
            raise ValueError(f"no TIFF: {path}")
        big = head[2:4] == struct.pack(order + "H", 43)
        at = struct.unpack_from(order + ("Q" if big else "I"), head, 8 if big else 4)[0]
        f.seek(at)
        n = struct.unpack(order + ("Q" if big else "H"), f.read(8 if big else 2))[0]
        entry, data = (20, f.read(20 * n)) if big else (12, f.read(12 * n))
        tags = {}
        for i in range(n):
            tag, kind = struct.unpack_from(order + "HH", data, i * entry)
            count = struct.unpack_from(order + ("Q" if big else "I"), data, i * entry + 4)[0]
            if kind not in TYPES:
                continue
            form = f"{order}{count}s" if kind == 2 else order + TYPES[kind] * count if count < 3 else f"{order}{count * len(TYPES[kind])}{TYPES[kind][0]}"
            size, place = struct.calcsize(form), i * entry + (12 if big else 8)
            if size <= (8 if big else 4):
                raw = data[place : place + size]
            else:
                f.seek(struct.unpack_from(order + ("Q" if big else "I"), data, place)[0])
                raw = f.read(size)
            values = struct.unpack(form, raw)
            tags[tag] = (kind, (values[0].decode("latin-1"),) if kind == 2 else values)
    return Directory(tags, order)


def place_tags(path: str) -> dict[int, tuple[int, tuple]]:
    """The tags of a file that go with its result, too."""
    found = read_directory(path).tags
    return {t: found[t] for t in PLACE_TAGS if t in found}


#: The order of a rational polynomial's 92 numbers after two of its errors.
_RPC_NAMES = ("line_off", "samp_off", "lat_off", "long_off", "height_off", "line_scale", "samp_scale", "lat_scale", "long_scale", "height_scale")
_RPC_PARTS = ("line_num", "line_den", "samp_num", "samp_den")


def rpc_of(tags: dict[int, tuple[int, tuple]]) -> dict:
    """The rational polynomial of a file's tags, as rpc.parse gives it."""
    if RPC not in tags or len(tags[RPC][1]) < 92:
        raise ValueError("no rational polynomial in the tags")
    v = tags[RPC][1]
    return dict(zip(_RPC_NAMES, v[2:12], strict=True)) | {p: np.array(v[12 + 20 * i : 32 + 20 * i]) for i, p in enumerate(_RPC_PARTS)}


def rpc_tag(rpc: dict) -> dict[int, tuple[int, tuple]]:
    values = [-1.0, -1.0, *(float(rpc[n]) for n in _RPC_NAMES), *(float(x) for p in _RPC_PARTS for x in rpc[p])]
    return {RPC: (12, tuple(values))}


def gcp_tag(points: list[tuple[float, float, float, float, float]]) -> dict[int, tuple[int, tuple]]:
    """Ground control points (sample, line, lon, lat, height) as tie points."""
    return {TIE_POINTS: (12, tuple(float(v) for s, y, lon, lat, h in points for v in (s, y, 0, lon, lat, h)))}


def _unpacked_bits(data: bytes) -> bytes:
    out, i = bytearray(), 0
    while i < len(data):
        n = data[i]
        if n < 128:
            out += data[i + 1 : i + 2 + n]
            i += n + 2
        else:
            if n > 128:
                out += data[i + 1 : i + 2] * (257 - n)
            i += 1 + (n > 128)
    return bytes(out)


def _lzw(data: bytes) -> bytes:
    """Codes from the highest bit on, of 9 to 12 bits; the width grows one code early."""
    clear, end = 256, 257
    first = [bytes([i]) for i in range(256)] + [b"", b""]
    table, out, held, bits, width, before = list(first), [], 0, 0, 9, b""
    for byte in data:
        held, bits = held << 8 | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code, held = held >> bits, held & (1 << bits) - 1
        if code == end:
            break
        if code == clear:
            table, width, before = list(first), 9, b""
            continue
        word = table[code] if code < len(table) else before + before[:1]
        out.append(word)
        if before:
            table.append(before + word[:1])
        before = word
        width = 9 if len(table) < 511 else 10 if len(table) < 1023 else 11 if len(table) < 2047 else 12
    return b"".join(out)


_DECODERS = {1: lambda d: d, 5: _lzw, 8: zlib.decompress, 32946: zlib.decompress, 32773: _unpacked_bits}


@dataclass(frozen=True)
class Chunk:
    """A strip or tile: where it lies in the file and in the raster, and its bands (one of planes, or all)."""

    at: int
    size: int
    x: int
    y: int
    width: int
    lines: int
    bands: tuple[int, int]


def chunks(d: Directory, x: range, y: range, b: range) -> list[Chunk]:
    """The strips or tiles that meet a window."""
    width, length, bands = d.size
    tiled = TILE_AT in d.tags
    w, h = (d.one(TILE_WIDTH), d.one(TILE_LENGTH)) if tiled else (width, min(d.one(STRIP_LINES, length), length))
    at, size = (d.get(TILE_AT), d.get(TILE_SIZE)) if tiled else (d.get(STRIP_AT), d.get(STRIP_SIZE))
    across, down = -(-width // w), -(-length // h)
    planes = [(p, p + 1) for p in range(bands)] if d.one(PLANAR, 1) == 2 else [(0, bands)]
    out = []
    for p, own in enumerate(planes):
        if own[0] >= b.stop or own[1] <= b.start:
            continue
        for j in range(y.start // h, -(-y.stop // h)):
            for i in range(x.start // w, -(-x.stop // w)):
                k = (p * down + j) * across + i
                out.append(Chunk(at[k], size[k], i * w, j * h, w, h if tiled else min(h, length - j * h), own))
    return out


def decode(d: Directory, c: Chunk, data: bytes) -> np.ndarray:
    """Lines, samples and bands of a chunk."""
    how, n = d.one(COMPRESSION, 1), c.bands[1] - c.bands[0]
    if how not in _DECODERS:
        raise ValueError(f"compression {how} is not read")
    data, kind, shape = _DECODERS[how](data), d.dtype, (c.lines, c.width, n)
    whole = c.lines * c.width * n * kind.itemsize
    data = data[:whole].ljust(whole, b"\0")
    predictor = d.one(PREDICTOR, 1)
    if predictor == 3:  # bytes of a line by their significance, as differences
        m = np.frombuffer(data, np.uint8).reshape(c.lines, -1, n)
        m = np.cumsum(m, axis=1, dtype=np.uint8).reshape(c.lines, kind.itemsize, -1)
        return np.ascontiguousarray(m.transpose(0, 2, 1)).view(kind.newbyteorder(">"))[..., 0].reshape(shape)
    m = np.frombuffer(data, kind).reshape(shape)
    return np.cumsum(m, axis=1, dtype=kind.newbyteorder("=")) if predictor == 2 else m


class Part(InputPartition):
    def __init__(self, own: list[Chunk]):
        self.own = own


class TiffReader(DataSourceReader):
    def __init__(self, path: str, options: dict):
        self.path, self.directory = path, read_directory(path)
        get = lambda k, d: int(options.get(k, d))
        self.x, self.y, self.b = (range(get(f"{a}off", 0), min(get(f"{a}off", 0) + get(f"{a}size", n), n)) for a, n in zip("xyb", self.directory.size, strict=True))

    def partitions(self):
        parts, held = [], 0
        for c in chunks(self.directory, self.x, self.y, self.b):
            cells = c.width * c.lines * (c.bands[1] - c.bands[0])
            if not parts or held + cells > PART_CELLS:
                parts.append([])
                held = 0
            parts[-1].append(c)
            held += cells
        return [Part(p) for p in parts]

    def read(self, part: Part):
        for c in part.own:
            m = decode(self.directory, c, store.read_range(self.path, c.at, c.at + c.size))
            x0, x1 = max(self.x.start, c.x), min(self.x.stop, c.x + c.width)
            y0, y1 = max(self.y.start, c.y), min(self.y.stop, c.y + c.lines)
            b0, b1 = max(self.b.start, c.bands[0]), min(self.b.stop, c.bands[1])
            own = m[y0 - c.y : y1 - c.y, x0 - c.x : x1 - c.x, b0 - c.bands[0] : b1 - c.bands[0]].transpose(2, 0, 1).real.astype(float)
            for k in range(0, own.shape[1], step := max(1, (1 << 18) // max(own.shape[2] * own.shape[0], 1))):
                some = own[:, k : k + step]
                b, y, x = np.indices(some.shape).reshape(3, -1)
                yield pa.RecordBatch.from_pydict({"b": pa.array((b + b0).astype(np.int32)), "y": pa.array((y + y0 + k).astype(np.int32)), "x": pa.array((x + x0).astype(np.int32)), "v": pa.array(some.ravel())})


def directory_bytes(samples: int, lines: int, bands: int, kind: np.dtype, at: int, ifd_at: int, tags: dict[int, tuple[int, tuple]], big: bool) -> bytes:
    """The directory of a raster of planes in strips from byte at on; it lies at ifd_at."""
    item = kind.itemsize
    step = max(1, min(lines, (1 << 20) // max(samples * item, 1)))
    strips = [(b, y) for b in range(bands) for y in range(0, lines, step)]
    wide = 16 if big else 4
    fields = {
        WIDTH: (4, (samples,)), LENGTH: (4, (lines,)), BITS: (3, (item * 8,) * bands), COMPRESSION: (3, (1,)), PHOTOMETRIC: (3, (1,)), SAMPLES: (3, (bands,)), STRIP_LINES: (4, (step,)), PLANAR: (3, (2 if bands > 1 else 1,)),
        STRIP_AT: (wide, tuple(at + (b * lines + y) * samples * item for b, y in strips)), STRIP_SIZE: (wide, tuple(min(step, lines - y) * samples * item for _, y in strips)),
        SAMPLE_FORMAT: (3, ({v: k for k, v in _FORMATS.items()}[kind.kind],) * bands),
    }
    if bands > 1:
        fields[338] = (3, (0,) * (bands - 1))
    fields |= tags
    count, entry, room = ("<Q", 20, 8) if big else ("<H", 12, 4)
    head, rest = struct.pack(count, len(fields)), b""
    after = ifd_at + len(head) + entry * len(fields) + room
    for tag in sorted(fields):
        code, values = fields[tag]
        raw = (values[0].encode("latin-1").rstrip(b"\0") + b"\0") if code == 2 else struct.pack(f"<{len(values)}{TYPES[code][0]}" if len(TYPES[code]) == 1 else f"<{len(values)}I", *values)
        n = len(raw) if code == 2 else len(values) // len(TYPES[code])
        if len(raw) <= room:
            place = raw.ljust(room, b"\0")
        else:
            place = struct.pack("<Q" if big else "<I", after + len(rest))
            rest += raw + b"\0" * (len(raw) % 2)
        head += struct.pack("<HH" + ("Q" if big else "I"), tag, code, n) + place
    return head + b"\0" * room + rest


@dataclass
class Written(WriterCommitMessage):
    cells: int


class RasterWriter(DataSourceArrowWriter):
    """Tasks write cells (b, y, x, v) at their places in a file of another name beside the target; commit names it.

    Cells may come in any order (sorted ones are written in long runs); cells that never come are 0. A task that runs again
    writes the same bytes; abort removes the file, so that nothing is seen of a write that failed. All
    machines have to see the folder. Whole-number types hold rounded values inside their range.
    Options: path, samples, lines, bands, kind (a numpy name), xoff, yoff, boff (where the cells lie), tags (JSON).
    """

    def __init__(self, options: dict, overwrite: bool, flat: bool):
        path = store.local(options["path"])
        if path is None:
            raise ValueError("a raster is written in place: give a local or mounted path, or write the cells as a table")
        if os.path.exists(path) and not overwrite:
            raise ValueError(f"{path} is there")
        os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
        self.path, self.flat, self.own = path, flat, f"{path}.writing-{uuid.uuid4().hex}"
        self.size = tuple(int(options[k]) for k in ("samples", "lines", "bands"))
        self.kind = np.dtype("<" + options.get("kind", "f4"))
        self.offset = tuple(int(options.get(k, 0)) for k in ("xoff", "yoff", "boff"))
        self.tags = json.loads(options.get("tags", "{}"))
        self.begin = 0 if flat else 16
        with open(self.own, "wb"):
            pass

    def write(self, batches):
        held, n, total = [], 0, 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= WRITE_CELLS:
                total, held, n = total + self._put(held), [], 0
        return Written(total + self._put(held))

    def _put(self, batches) -> int:
        if not batches:
            return 0
        t = pa.Table.from_batches(batches)
        b, y, x = (t.column(c).to_numpy().astype(np.int64) + o for c, o in zip("byx", reversed(self.offset), strict=True))
        samples, lines, bands = self.size
        if ((x < 0) | (x >= samples) | (y < 0) | (y >= lines) | (b < 0) | (b >= bands)).any():
            raise ValueError("a cell lies outside the raster")
        place = (b * lines + y) * samples + x
        order = np.argsort(place, kind="stable")
        place, v = place[order], t.column("v").to_numpy()[order].astype(float)
        if self.kind.kind in "iu":
            info = np.iinfo(self.kind)
            v = np.clip(np.floor(np.nan_to_num(v) + 0.5), info.min, info.max)
        v = v.astype(self.kind)
        cuts = [0, *(np.flatnonzero(np.diff(place) != 1) + 1).tolist(), len(place)]
        fd = os.open(self.own, os.O_WRONLY)
        try:
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                os.pwrite(fd, v[lo:hi].tobytes(), self.begin + int(place[lo]) * self.kind.itemsize)
        finally:
            os.close(fd)
        return len(place)

    def commit(self, messages):
        samples, lines, bands = self.size
        end = self.begin + samples * lines * bands * self.kind.itemsize
        with open(self.own, "r+b") as f:
            f.truncate(end)
            if not self.flat:
                big, at = end > 0xFFF00000, end + end % 2
                f.seek(0)
                f.write(struct.pack("<2sHHHQ", b"II", 43, 8, 0, at) if big else struct.pack("<2sHIQ", b"II", 42, at, 0))
                f.seek(at)
                tags = {int(k): (v[0], tuple(v[1])) for k, v in self.tags.items()}
                f.write(directory_bytes(samples, lines, bands, self.kind, self.begin, at, tags, big))
        if self.flat:
            from .files import envi_text
            from .lists import header_of

            store.write_text(header_of(self.path), envi_text(samples, lines, bands, self.kind.str, "bsq", self.tags))
        os.replace(self.own, self.path)

    def abort(self, messages):
        if os.path.exists(self.own):
            os.remove(self.own)


class TiffSource(DataSource):
    @classmethod
    def name(cls):
        return "tiff"

    def schema(self):
        return "b int, y int, x int, v double"

    def reader(self, schema):
        return TiffReader(self.options["path"], dict(self.options))

    def writer(self, schema, overwrite):
        return RasterWriter(dict(self.options), overwrite, False)
