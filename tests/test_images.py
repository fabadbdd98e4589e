"""TIFF and PNG: files made here by hand are read, files written are read back by plain parsers."""

import os
import struct
import zlib

import numpy as np
import pytest

from prismcube.cube import Cube
from prismcube.sources import files, raster, rpc, tiff
from prismcube.sources.envi import EnviSource


def packed_bits(data):
    out = b""
    for i in range(0, len(data), 100):
        part = data[i : i + 100]
        out += bytes([257 - len(part), part[0]]) if len(part) > 1 and len(set(part)) == 1 else bytes([len(part) - 1]) + part
    return out + b"\x80"


def lzw(data):
    bits, table, width, word = [], {bytes([i]): i for i in range(256)}, 9, b""
    n = 258
    put = lambda code: bits.append(f"{code:0{width}b}")
    put(256)
    for byte in data:
        if word + bytes([byte]) in table:
            word += bytes([byte])
            continue
        put(table[word])
        table[word + bytes([byte])] = n
        n += 1
        width = 9 if n < 512 else 10 if n < 1024 else 11 if n < 2048 else 12
        if n == 4094:
            put(256)
            table, n, width = {bytes([i]): i for i in range(256)}, 258, 9
        word = bytes([byte])
    put(table[word])
    width = 9 if n + 1 < 512 else 10 if n + 1 < 1024 else 11 if n + 1 < 2048 else 12
    put(257)
    text = "".join(bits)
    text += "0" * (-len(text) % 8)
    return bytes(int(text[i : i + 8], 2) for i in range(0, len(text), 8))


PACK = {1: lambda d: d, 5: lzw, 8: zlib.compress, 32773: packed_bits}


def make(m, how=1, predictor=1, order="<", big=False, tile=None, lines=3, planar=1, tags=()):
    """A TIFF of an array (lines, samples, bands)."""
    h, w, n = m.shape
    kind = m.dtype.newbyteorder(order)
    planes = [m[..., b : b + 1] for b in range(n)] if planar == 2 else [m]
    th, tw = tile or (lines, w)
    parts = []
    for p in planes:
        for y in range(0, h, th):
            for x in range(0, w, tw):
                c = p[y : y + th, x : x + tw]
                if tile:
                    c = np.pad(c, ((0, th - c.shape[0]), (0, tw - c.shape[1]), (0, 0)))
                if predictor == 2:
                    c = np.concatenate([c[:, :1], np.diff(c, axis=1)], 1).astype(m.dtype)
                raw = c.astype(kind).tobytes()
                if predictor == 3:
                    rows = np.frombuffer(c.astype(m.dtype.newbyteorder(">")).tobytes(), np.uint8).reshape(c.shape[0], -1, m.dtype.itemsize).transpose(0, 2, 1).reshape(c.shape[0], -1, c.shape[2])
                    raw = np.concatenate([rows[:, :1], np.diff(rows, axis=1)], 1).astype(np.uint8).tobytes()
                parts.append(PACK[how](raw))
    out, at = b"\0" * 16, []
    for p in parts:
        at.append(len(out))
        out += p + b"\0" * (len(p) % 2)
    sizes = [len(p) for p in parts]
    fields = {256: (4, [w]), 257: (4, [h]), 258: (3, [m.dtype.itemsize * 8] * n), 259: (3, [how]), 262: (3, [1]), 277: (3, [n]), 284: (3, [planar]), 317: (3, [predictor]), 339: (3, [{"u": 1, "i": 2, "f": 3}[m.dtype.kind]] * n)}
    fields |= {322: (4, [tw]), 323: (4, [th]), 324: (4, at), 325: (4, sizes)} if tile else {278: (4, [th]), 273: (4, at), 279: (4, sizes)}
    fields |= dict(tags)
    entry, room, word = (20, 8, "Q") if big else (12, 4, "I")
    head, rest, ifd = struct.pack(order + ("Q" if big else "H"), len(fields)), b"", len(out)
    after = ifd + len(head) + entry * len(fields) + room
    for tag, (code, values) in sorted(fields.items()):
        raw = values if code == 2 else struct.pack(f"{order}{len(values)}{tiff.TYPES[code]}", *values)
        place = raw.ljust(room, b"\0") if len(raw) <= room else struct.pack(order + word, after + len(rest))
        rest += b"" if len(raw) <= room else raw
        head += struct.pack(order + "HH" + word, tag, code, len(values)) + place
    name = b"II" if order == "<" else b"MM"
    start = struct.pack(order + "2sHHHQ", name, 43, 8, 0, ifd) if big else struct.pack(order + "2sHI", name, 42, ifd).ljust(16, b"\0")
    return start + out[16:] + head + b"\0" * room + rest


def matrix(df, size):
    x, y, b = size
    m = np.full((y, x, b), np.nan)
    for r in df.collect():
        m[r.y, r.x, r.b] = r.v
    return m


CASES = [
    dict(), dict(order=">", planar=2), dict(how=8, predictor=2, tile=(16, 16)), dict(how=32773, lines=50), dict(how=5, predictor=2), dict(how=5, tile=(32, 16), planar=2, order=">"), dict(big=True, how=8, lines=1),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_tiff_layouts(case, tmp_path):
    rng = np.random.default_rng(case)
    smooth = (np.indices((37, 45)).sum(0)[..., None] * 7 + rng.integers(0, 4, (37, 45, 3))).astype("u2")
    kinds = [smooth, smooth.astype("u1"), smooth.astype("i4") - 50] if CASES[case].get("predictor") != 3 else []
    for m in kinds:
        (tmp_path / "a.tif").write_bytes(make(m, **CASES[case]))
        d = tiff.read_directory(str(tmp_path / "a.tif"))
        data, got = (tmp_path / "a.tif").read_bytes(), np.zeros(m.shape)
        assert d.size == (45, 37, 3)
        for c in tiff.chunks(d, range(45), range(37), range(3)):
            own = tiff.decode(d, c, data[c.at : c.at + c.size])[: 37 - c.y, : 45 - c.x]
            got[c.y : c.y + own.shape[0], c.x : c.x + own.shape[1], c.bands[0] : c.bands[1]] = own
        assert (got == m).all()
    f = rng.normal(size=(9, 11, 1)).astype("f4")
    for order in "<>":
        (tmp_path / "f.tif").write_bytes(make(f, 8, 3, order))
        d = tiff.read_directory(str(tmp_path / "f.tif"))
        data = (tmp_path / "f.tif").read_bytes()
        assert (np.concatenate([tiff.decode(d, c, data[c.at : c.at + c.size]) for c in tiff.chunks(d, range(11), range(9), range(1))]) == f).all()
    with pytest.raises(ValueError, match="no TIFF"):
        (tmp_path / "n.tif").write_bytes(b"PNG of some kind")
        tiff.read_directory(str(tmp_path / "n.tif"))


def test_tiff_source_reads_what_a_window_needs(spark, tmp_path, monkeypatch):
    m = np.arange(40 * 30 * 2, dtype="i4").reshape(40, 30, 2)
    path = str(tmp_path / "a.tif")
    (tmp_path / "a.tif").write_bytes(make(m, 8, lines=4, planar=2, tags={42113: (2, b"-9\0")}))
    cube = raster.open_cube(spark, path)
    assert cube.size == (30, 40, 2) and cube.nodata == (-9.0,) and (matrix(cube.cells, cube.size) == m).all()
    window = dict(xoff=3, xsize=5, yoff=9, ysize=6, boff=1, bsize=1)
    got = raster.open_cube(spark, path, **window).cells.collect()
    assert {(r.y, r.x, r.b, r.v) for r in got} == {(y, x, 1, m[y, x, 1]) for y in range(9, 15) for x in range(3, 8)} and len(got) == 30
    reader, ranges = tiff.TiffReader(path, {k: str(v) for k, v in window.items()}), []
    monkeypatch.setattr(tiff, "PART_CELLS", 130)
    read = tiff.store.read_range
    monkeypatch.setattr(tiff.store, "read_range", lambda p, a, b: ranges.append(a) or read(p, a, b))
    parts = reader.partitions()
    for p in parts:
        list(reader.read(p))
    assert len(parts) == 2 and len(ranges) == 2  # two strips of lines 8 to 15, of one band; the file has 20


@pytest.mark.parametrize("kind", ["byte", "int16", "uint32", "float32", "float64"])
def test_tiff_written_and_read(spark, tmp_path, kind):
    rng = np.random.default_rng(1)
    m = np.round(rng.uniform(0, 120, (23, 19, 3)))
    rows = [(int(b), int(y), int(x), float(m[y, x, b])) for y, x, b in np.ndindex(m.shape) if (y, x, b) != (4, 5, 1)]
    cube = Cube(spark.createDataFrame(rows, "b int, y int, x int, v double").repartition(5), (19, 23, 3))
    out = str(tmp_path / "sub" / "o.tif")
    tags = {42113: (2, ("7",)), 33550: (12, (2.0, 2.0, 0.0)), **tiff.gcp_tag([(0, 0, 10.5, 20.5, 3), (18, 22, 11, 21, 4)])}
    assert raster.write_raster(cube, out, kind, tags=tags) == 19 * 23 * 3
    m[4, 5, 1] = 0  # a cell that is not there
    d, data = tiff.read_directory(out), (tmp_path / "sub" / "o.tif").read_bytes()
    assert d.nodata == 7 and d.get(tiff.TIE_POINTS) == (0, 0, 0, 10.5, 20.5, 3, 18, 22, 0, 11, 21, 4) and d.dtype == np.dtype("<" + raster.KINDS[kind])
    planes = [np.concatenate([tiff.decode(d, c, data[c.at : c.at + c.size]) for c in tiff.chunks(d, range(19), range(23), range(b, b + 1))]) for b in range(3)]
    assert (np.concatenate(planes, 2) == m).all()
    again = raster.open_cube(spark, out)
    assert (matrix(again.cells, again.size) == m).all() and os.listdir(tmp_path / "sub") == ["o.tif"]
    with pytest.raises(ValueError, match="is there"):
        raster.write_raster(cube, out, kind)
    assert raster.write_raster(cube, out, kind, overwrite=True, offset=(1, 2, 0), size=(30, 30, 4), tags=tiff.place_tags(out)) == 3600
    again = raster.open_cube(spark, out)
    assert again.size == (30, 30, 4) and (matrix(again.cells, again.size)[2:25, 1:20, :3] == m).all() and again.nodata == (7.0,)


@pytest.mark.parametrize("kind", ["envi", "tiff"])
def test_a_write_that_fails_leaves_nothing(spark, tmp_path, kind):
    spark.dataSource.register(EnviSource)
    spark.dataSource.register(tiff.TiffSource)
    cells = spark.createDataFrame([(0, y, x, float(y * 8 + x)) for y in range(6) for x in range(8)], "b int, y int, x int, v double").repartition(3)
    write = lambda df, name, mode="append": df.write.format(kind).mode(mode).options(samples=8, lines=6, bands=1, kind="i2").save(str(tmp_path / name))
    with pytest.raises(Exception, match="outside"):
        write(cells.unionByName(spark.createDataFrame([(0, 6, 0, 1.0)], cells.schema)), "bad.dat")
    assert os.listdir(tmp_path) == []
    write(cells, "good.dat")
    with pytest.raises(Exception, match="is there"):
        write(cells, "good.dat")
    write(cells.withColumn("v", cells.v + 1), "good.dat", "overwrite")
    assert sorted(os.listdir(tmp_path)) == (["good.dat", "good.hdr"] if kind == "envi" else ["good.dat"])
    got = spark.read.format(kind).option("path", str(tmp_path / "good.dat")).load()
    assert (matrix(got, (8, 6, 1))[..., 0] == np.arange(48).reshape(6, 8) + 1).all()


def png_pixels(data):
    """(array, texts) of an image without interlace, whose lines have no filter."""
    at, stream, texts = 8, b"", {}
    while at < len(data):
        n, kind = struct.unpack_from(">I4s", data, at)
        body = data[at + 8 : at + 8 + n]
        assert struct.unpack_from(">I", data, at + 8 + n)[0] == zlib.crc32(kind + body)
        if kind == b"IHDR":
            w, h, bits, colour = struct.unpack_from(">IIBB", body)
        elif kind == b"tEXt":
            k, v = body.split(b"\0")
            texts[k.decode()] = v.decode()
        elif kind == b"IDAT":
            stream += body
        at += 12 + n
    bands = {0: 1, 4: 2, 2: 3, 6: 4}[colour]
    rows = np.frombuffer(zlib.decompress(stream), np.uint8).reshape(h, -1)
    assert (rows[:, 0] == 0).all()
    return np.frombuffer(rows[:, 1:].tobytes(), "u1" if bits == 8 else ">u2").reshape(h, w, bands), texts


@pytest.mark.parametrize("bands,kind", [(1, "byte"), (3, "byte"), (4, "uint16"), (2, "uint16")])
def test_png_written(spark, tmp_path, monkeypatch, bands, kind):
    from prismcube.sources import png

    monkeypatch.setattr(png, "BLOCK_CELLS", 40)  # many blocks
    rng = np.random.default_rng(bands)
    m = rng.integers(0, 256 if kind == "byte" else 65536, (33, 9, bands))
    rows = [(int(b), int(y), int(x), float(m[y, x, b])) for y, x, b in np.ndindex(m.shape) if not 10 <= y < 20]
    cube = Cube(spark.createDataFrame(rows, "b int, y int, x int, v double").repartition(3), (9, 33, bands))
    raster.write_raster(cube, str(tmp_path / "o.png"), kind, tags={"Title": "a cube"})
    m[10:20] = 0
    got, texts = png_pixels((tmp_path / "o.png").read_bytes())
    assert (got == m).all() and texts == {"Title": "a cube"}


def test_formats_without_a_writer_raise(spark, tmp_path):
    cube = Cube(spark.createDataFrame([(0, 0, 0, 1.0)], "b int, y int, x int, v double"), (1, 1, 1))
    for name in ("o.jpg", "o.gif", "o.ecw"):
        with pytest.raises(ValueError, match="no writer"):
            raster.write_raster(cube, str(tmp_path / name), "byte")
    assert os.listdir(tmp_path) == []


def test_rational_polynomial_in_tags(spark, tmp_path):
    rng = np.random.default_rng(0)
    p = {n: float(i + 1) for i, n in enumerate(rpc.NAMES)} | {k: rng.normal(size=20) for k in rpc.PARTS}
    cube = Cube(spark.createDataFrame([(0, 0, 0, 1.0)], "b int, y int, x int, v double"), (1, 1, 1))
    raster.write_raster(cube, str(tmp_path / "r.tif"), "byte", tags=tiff.rpc_tag(p))
    got = rpc.load(str(tmp_path / "r.tif"))
    assert all(got[n] == p[n] for n in rpc.NAMES) and all((got[k] == p[k]).all() for k in rpc.PARTS)
    with pytest.raises(ValueError, match="no rational"):
        tiff.rpc_of({})
    assert files.envi_text(1, 1, 1, "<u1").startswith("ENVI")
