"""Kernels, sources, interpolation, geometry and task lists on small inputs."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from prismcube.cube import FLT_MIN, Cube
from prismcube.functions import geo, interp
from prismcube.operators import aggregates as A
from prismcube.operators import kernels as K
from prismcube.operators import maps as M
from prismcube.plans import tasks
from prismcube.queries import RPC
from prismcube.sources import files, lists, raster
from prismcube.sources import rpc as rpc_files


def frame(spark, m, k=0):
    m = np.asarray(m, float)
    return spark.createDataFrame([(k, i, j, float(m[i, j])) for i in range(m.shape[0]) for j in range(m.shape[1])], "k int, r int, c int, v double")


def matrix(df, shape):
    m = np.full(shape, np.nan)
    for r in df.collect():
        m[r.r, r.c] = r.v
    return m


def test_clamp_quirk(spark):
    coef = spark.createDataFrame([(0, i, 1.0, 0.0) for i in range(5)], "r int, c int, a double, b double")
    f = frame(spark, [[-1.0, 0.0, 5.0, 20.0, float("nan")]])
    out = matrix(M.uniform(f, coef, hi=10.0), (1, 5))[0]
    assert out[0] == out[1] == FLT_MIN and out[2] == 5 and out[3] == 20 and np.isnan(out[4])
    assert matrix(M.uniform(f, coef, hi=10.0, overflow="clamp"), (1, 5))[0][3] == 10
    same = frame(spark, [[1.5, 2.5, 3.5, 4.5, 5.5]])
    assert matrix(M.uniform(same, coef), (1, 5)).tolist() == [[1.5, 2.5, 3.5, 4.5, 5.5]]


def test_calibration_equals_the_loop(spark):
    rng = np.random.default_rng(4)
    m = np.concatenate([rng.uniform(90, 110, (8, 30)), rng.uniform(480, 520, (8, 30))], 1)
    m[3] = 100.0  # flat: no bright sample
    got = {r.r: r for r in A.calibrate(frame(spark, m)).collect()}
    f = lambda t, s: float(np.float32(1 + s * np.float32(t)))
    lines = []
    for row in np.sort(m, axis=1):
        n = len(row)
        st, ed = int(np.float32(n) * np.float32(0.03)), n - 1 - int(np.float32(n) * np.float32(0.1))
        nd = nb = 1
        d, b = row[st], row[ed]
        while st + nd < ed and nd < 40 and row[st + nd] <= d / nd * f(0.03, 1):
            d, nd = d + row[st + nd], nd + 1
        while ed - nb > st and nb < 40 and row[ed - nb] >= b / nb * f(0.03, -1):
            b, nb = b + row[ed - nb], nb + 1
        lines.append((d, nd, b, nb, nd >= 3 and nb >= 3 and d / nd * f(0.03, 1) < b / nb * f(0.03, -1)))
    good = [x for x in lines if x[4]]
    lo, hi = sum(x[0] for x in good) / sum(x[1] for x in good), sum(x[2] for x in good) / sum(x[3] for x in good)
    for i, (d, nd, b, nb, _) in enumerate(lines):
        su, sl = b / nb, d / nd
        a = (hi - lo) / (su - sl) if su - sl > 2.3e-16 else 1.0
        assert got[i].a == pytest.approx(a, rel=1e-9) and got[i].b == pytest.approx(lo - a * sl if su > sl else 0.0, rel=1e-9, abs=1e-9) and got[i].bad == int(su - sl <= 2.3e-16)
    tiled = A.calibrate(frame(spark, m), tile_size=4, interpolate=interp.pchip).collect()
    assert len(tiled) == 8 and all(np.isfinite(r.a) for r in tiled)


def test_destripe_leaves_constants(spark):
    assert np.allclose(matrix(A.destripe(frame(spark, np.full((9, 4), 7.0)), 5), (9, 4)), 7)


def test_anomaly_is_invariant(spark):
    rng = np.random.default_rng(1)
    cube = rng.normal(size=(3, 6, 7))
    mix = np.array([[2, 1, 0], [0, 1, 3], [1, 0, 1.0]])
    rows = lambda a: spark.createDataFrame([(k, i, j, float(a[k, i, j])) for k in range(3) for i in range(6) for j in range(7)], "k int, r int, c int, v double")
    one, two = (matrix(A.anomaly(rows(a), 3), (6, 7)) for a in (cube, np.einsum("ij,jrc->irc", mix, cube)))
    assert np.allclose(one, two) and np.isclose(one.mean(), 3 * 41 / 42)


def test_despeckle_and_inpaint(spark):
    m = np.full((9, 9), 50.0)
    m[4, 4] = 3000
    assert matrix(K.despeckle(frame(spark, m), 9, 9), (9, 9))[4, 4] == 50
    ramp = np.add.outer(np.arange(12.0), 2 * np.arange(12.0))
    broken = ramp.copy()
    broken[5:7, 5:7] = -999
    bad = spark.createDataFrame([(r, c) for r in (5, 6) for c in (5, 6)], "r int, c int")
    out = matrix(K.inpaint(frame(spark, broken), bad, 12, 12), (12, 12))
    assert np.abs(out - ramp).max() < 1.5 and (out[0] == ramp[0]).all()


def test_line_shapes():
    m = np.zeros((30, 30))
    m[5, 3:16] = 1
    m[20:23, 20:23] = 1
    assert K.line_shapes(m, 11, 20) == [(3, 5, 15, 5)]


@pytest.mark.parametrize("kind", sorted(interp.KINDS))
def test_interpolators(kind):
    x = np.arange(8.0)
    y = np.array([1, 3, 2, 5, 4, 4, 6, 1.0])
    assert np.allclose(interp.KINDS[kind](x, y, x), y)
    assert np.allclose(interp.KINDS[kind](x, 2 * x + 1, np.linspace(0, 7, 29)), 2 * np.linspace(0, 7, 29) + 1)
    assert np.allclose(interp.KINDS[kind](x, np.stack([y, 2 * y]), x[:3] + 0.5)[1], 2 * interp.KINDS[kind](x, y, x[:3] + 0.5))


def test_pchip_is_monotone_and_bounded():
    x, y = np.array([0, 1, 3, 4.0]), np.array([0, 1, 1, 5.0])
    assert (np.diff(interp.pchip(x, y, np.linspace(0, 4, 200))) >= -1e-12).all()
    with pytest.raises(ValueError):
        interp.pchip(x, y, np.array([4.5]))


def test_rational_polynomials(spark):
    lon, lat, h = np.meshgrid(np.linspace(119.6, 120.4, 7), np.linspace(33.6, 34.4, 7), [20.0, 100.0, 180.0])
    lon, lat, h = lon.ravel(), lat.ravel(), h.ravel()
    line, sample = geo.rpc_forward(RPC, lon, lat, h)
    a, b = geo.rpc_inverse(RPC, line, sample, h)
    assert np.abs(a - lon).max() < 1e-5 and np.abs(b - lat).max() < 1e-5
    points = spark.createDataFrame([tuple(map(float, r)) for r in zip(lon, lat, h, line, sample, strict=True)], "lon double, lat double, h double, line double, sample double")
    fitted = geo.rpc_fit(points)
    assert fitted["rms"] < 0.05
    for form in (rpc_files.text, rpc_files.group_text):
        back = rpc_files.parse(form(RPC | {"affine": (1.0, 0.5, -2e-9, 3.0, 0.0, 1e-3)}))
        assert np.allclose(back["line_num"], RPC["line_num"]) and np.allclose(back["samp_den"], RPC["samp_den"]) and back["samp_scale"] == RPC["samp_scale"]
        assert back["affine"] == (1.0, 0.5, -2e-9, 3.0, 0.0, 1e-3)
    with pytest.raises(ValueError, match="missing"):
        rpc_files.parse("LINE_OFF: 1 pixels")
    other = RPC | {"samp_num": [0.02, 1.0, 0.01, 0.4, 0.002, *[0.0] * 15]}
    seen = [(r, *geo.rpc_forward(r, 120.1, 34.1, 80.0)) for r in (RPC, other)]
    assert np.allclose(geo.intersect(seen, (120.0, 34.0, 100.0)), (120.1, 34.1, 80.0), atol=1e-4)


def test_rotations():
    r = geo.rotation((0.1, -0.2, 0.3))
    assert np.allclose(r @ r.T, np.eye(3)) and np.isclose(np.linalg.norm(geo.to_quaternion(r)), 1)
    p = geo.camera_matrix(np.diag([1000.0, 1000.0, 1.0]), np.eye(3), np.zeros(3), np.eye(3), np.array([5.0, 6.0, 700.0]))
    g = geo.to_plane(p, (12.0, -7.0), 20.0)
    seen = p @ [*g, 1.0]
    assert np.allclose(seen[:2] / seen[2], (12, -7))


def test_packets(spark, tmp_path):
    rng = np.random.default_rng(3)
    lines, data = rng.integers(0, 4096, (3, 2, 8)), b"junk"
    for i, bands in enumerate(lines):
        data += files.packet(4, 0x00, 0, i, files.pack12([0] * 4))
        for b, s in enumerate(bands[: 1 if i == 1 else 2]):
            data += files.packet(8, 0x17, b, i, files.pack12(s))
    (tmp_path / "a.dat").write_bytes(data + files.TOKEN + b"\x00")
    p = files.read_packets(spark, str(tmp_path / "a.dat"))
    assert p.count() == 8
    out = files.decode(p).collect()
    assert {r.y for r in out} == {0, 1} and len(out) == 32
    flip = [1, 0, 3, 2, 5, 4, 7, 6]
    for r in out:
        assert r.v == lines[(0, 2)[r.y], r.b, flip[r.x]]
    assert (files.unpack12(files.pack12([0x123, 0x456])) == [0x123, 0x456]).all()


def test_text_and_records(spark, tmp_path):
    (tmp_path / "m.txt").write_text("1 2,3\n4;5\t6\n2 1\n")
    assert sorted(map(tuple, files.read_matrix(spark, str(tmp_path / "m.txt"), 3).collect())) == [(0, 0, 1.0), (0, 1, 2.0), (0, 2, 3.0), (1, 0, 1.0), (1, 0, 4.0), (1, 1, 5.0), (1, 2, 6.0)]
    (tmp_path / "bad.txt").write_text("1 2 3 4\n")
    with pytest.raises(Exception, match="not a matrix row"):
        files.read_matrix(spark, str(tmp_path / "bad.txt"), 3).collect()
    rec = (7).to_bytes(4, "little") + (3).to_bytes(4, "little") + b"abc" + (8).to_bytes(4, "little") + (0).to_bytes(4, "little") + (9).to_bytes(4, "little") + (50).to_bytes(4, "little") + b"x"
    (tmp_path / "r.aux").write_bytes(rec)
    assert [(r.frame, r.msg) for r in files.read_aux(spark, str(tmp_path / "r.aux")).collect()] == [(7, "abc")]
    text = files.matrix_text(spark.createDataFrame([(0, 1, 2.5), (0, 0, 1234567.0)], "k int, r int, v double")).first().value
    assert text == "1.23457e+06\t2.5"


@pytest.mark.parametrize("way", ["bsq", "bil", "bip"])
def test_envi(spark, tmp_path, way):
    from prismcube.sources.envi import EnviSource

    cube = np.arange(2 * 3 * 4, dtype="<u2").reshape(2, 3, 4)
    stored = {"bsq": cube, "bil": cube.transpose(1, 0, 2), "bip": cube.transpose(1, 2, 0)}[way]
    (tmp_path / "a.img").write_bytes(stored.tobytes())
    (tmp_path / "a.hdr").write_text(files.envi_text(4, 3, 2, "u2", way))
    want = {(b, y, x, float(cube[b, y, x])) for b in range(2) for y in range(3) for x in range(4)}
    whole = raster.open_cube(spark, str(tmp_path / "a.img"))
    assert set(map(tuple, whole.cells.collect())) == want and whole.size == (4, 3, 2)
    spark.dataSource.register(EnviSource)
    df = spark.read.format("envi").option("path", str(tmp_path / "a.img")).option("boff", 1).option("xsize", 2).load()
    assert set(map(tuple, df.collect())) == {q for q in want if q[0] == 1 and q[2] < 2}
    assert raster.write_raster(whole, str(tmp_path / "out.img"), "uint16") == 24
    assert np.array_equal(np.fromfile(tmp_path / "out.img", "<u2").reshape(2, 3, 4), cube)


def test_raster_write(spark, tmp_path):
    cells = [(*p, v) for p, v in zip(((b, y, x) for b in range(2) for y in range(3) for x in range(4)), [300.0, -2.0, 1.5, 2.5, 7.49, float("nan"), *map(float, range(18))], strict=True)]
    df = spark.createDataFrame(cells, "b int, y int, x int, v double").filter("NOT (b = 1 AND y = 2 AND x = 3)")
    out, blocks = str(tmp_path / "sub" / "o.dat"), raster.BLOCK_CELLS
    raster.BLOCK_CELLS = 4  # a line a block
    try:
        assert raster.write_raster(Cube(df, (4, 3, 2)), out, "byte", tags={"map info": "{x, 1}"}) == 23
    finally:
        raster.BLOCK_CELLS = blocks
    m = np.fromfile(out, "u1").reshape(2, 3, 4)
    assert m[0].ravel()[:6].tolist() == [255, 0, 2, 3, 7, 0] and m[1, 2, 3] == 0 and m[1, 2, 2] == 16
    assert files.envi_header((tmp_path / "sub" / "o.hdr").read_text())["tags"]["map info"] == "{x, 1}"
    with pytest.raises(ValueError, match="another shape"):
        raster.write_raster(Cube(df, (4, 3, 2)), out, "float32")
    one = spark.createDataFrame([(0, 0, 0, 9.0), (0, 0, 1, 8.0)], "b int, y int, x int, v double")
    raster.write_raster(Cube(one, (2, 1, 1)), out, "byte", offset=(1, 2, 1), size=(4, 3, 2))
    assert np.fromfile(out, "u1").reshape(2, 3, 4)[1, 2].tolist() == [m[1, 2, 0], 9, 8, 0]
    np.save(tmp_path / "a.npy", np.arange(24, dtype="i2").reshape(2, 3, 4))
    cube = raster.open_cube(spark, str(tmp_path / "a.npy"))
    assert cube.size == (4, 3, 2) and {(r.b, r.y, r.x): r.v for r in cube.cells.collect()}[1, 2, 3] == 23
    raster.write_table(cube, str(tmp_path / "t.parquet"))
    assert raster.open_cube(spark, str(tmp_path / "t.parquet")).size == (4, 3, 2)
    assert raster.output_path("/a/b.png") == "/a/b_mod.tif" and raster.output_path("/a/b.img", str(tmp_path)) == str(tmp_path / "b.img")
    with pytest.raises(ValueError, match="no reader"):
        raster.open_cube(spark, "/x/y.ecw")


def test_packets_in_parts(spark, tmp_path):
    rng, data = np.random.default_rng(8), b"\x09\x15"
    for i in range(40):
        data += files.packet(4, 0, 0, i, files.pack12([ord("a"), ord("b"), 0, 0])) + files.packet(20, 0x07, 0, i, files.pack12(rng.integers(0, 4096, 20)))
    (tmp_path / "p.dat").write_bytes(data + files.TOKEN)
    whole = list(files.packets_of(data))
    assert len(whole) == 80 and [p["line"] for p in whole[:4]] == [0, 0, 1, 1]
    for part in (1, 7, 64, 1000):
        assert list(files.packets_in((data[i : i + part] for i in range(0, len(data), part)))) == whole
    got = files.read_packets(spark, str(tmp_path / "*.dat"), part=50).orderBy("ord").collect()
    assert [(r.ord, r.line, bytes(r.payload)) for r in got] == [(p["ord"], p["line"], p["payload"]) for p in whole]
    assert files.decode(files.read_packets(spark, str(tmp_path / "p.dat"), part=33)).count() == 800
    records = b"".join(n.to_bytes(4, "little") + (6).to_bytes(4, "little") + files.pack12([ord(c) for c in "#xyz"]) for n in range(5))
    (tmp_path / "p.aux").write_bytes(records + b"\x01")
    aux = files.read_aux(spark, str(tmp_path / "p.aux"), packed=True, part=5)
    assert [r.text for r in files.aux_text(aux).orderBy("ord").collect()] == [f"{n}\txyz" for n in range(5)]
    files.write_lines(files.aux_text(aux), str(tmp_path / "p.pos"), "ord")
    assert (tmp_path / "p.pos").read_text() == "".join(f"{n}\txyz\n" for n in range(5))
    assert [r.msg for r in files.aux_of(files.read_packets(spark, str(tmp_path / "p.dat"))).orderBy("ord").collect()] == ["ab"] * 40


def test_lists(spark, tmp_path):
    (tmp_path / "a.dat").write_bytes(b"x")
    (tmp_path / "b.dat").write_bytes(b"x")
    (tmp_path / "b.hdr").write_text("ENVI")
    (tmp_path / "l.txt").write_text(f"a.dat\r\n{tmp_path}/b.dat\nnone.dat\n")
    raw, images = lists.file_list([str(tmp_path / "l.txt"), str(tmp_path / "b.dat"), str(tmp_path / "missing")])
    assert raw == [str(tmp_path / "a.dat")] and images == [str(tmp_path / "b.dat")] * 2
    assert lists.format_of(str(tmp_path / "b.img")) == "envi" and lists.format_of("x.tif") == "gtiff" and lists.format_of("x") == "memory" and lists.format_of("x.zzz") == "envi"
    assert lists.wavelengths("1,2;3 4.5") == [1, 2, 3, 4.5]
    with pytest.raises(ValueError):
        lists.wavelengths("1,,2")
    strips = [("s1", f"f{i}", i, 2) for i in range(3)]
    text = lists.strips_text([*strips, ("s2", "g", 1, 1)])
    assert lists.read_strips(text, 2) == strips and len(lists.read_strips(text, 1)) == 4
    points = spark.createDataFrame([("g1 a b c 30:30:36 120:15:00 5.5",), ("short",)], "text string")
    (r,) = lists.control_points(points).collect()
    assert (r.name, r.h) == ("g1", 5.5) and abs(r.lon - 120.25) < 1e-12 and abs(r.lat - 30.51) < 1e-12
    (r,) = lists.point_lines(spark.createDataFrame([("n,m,1.5,2.5\n",), ("x",)], "text string")).collect()
    assert tuple(r) == ("n", "m", 1.5, 2.5)
    assert "<Folder><name>f&amp;</name>" in lists.kml([("p<", 1.0, 2.0, 3.0)], folder="f&") and "1.0,2.0,3.0" in lists.kml([("p", 1.0, 2.0, 3.0)])
    out = files.features_text(spark.createDataFrame([(2, 1.25, 3.0), (2, 0.5, 1.0)], "k int, x double, y double"), 3, ["x", "y"])
    assert [r.text for r in out.orderBy("k", "ord").collect()] == ["3", "0", "0", "2", "0.5\t1.0", "1.3\t3.0"]


def test_rpc_files(tmp_path):
    grid = {"dx": np.arange(12).reshape(3, 4) / 100, "dy": -np.arange(12).reshape(3, 4) / 50, "step": (100, 200)}
    rpc_files.save(str(tmp_path / "a.rpb"), RPC | {"grid": grid, "affine": (1, 2, 3, 4, 5, 6)}, {"sx": 1, "sy": 2, "mx": 3, "my": 4})
    back = rpc_files.load(str(tmp_path / "a.rpb"))
    assert np.allclose(back["grid"]["dx"], grid["dx"]) and np.allclose(back["grid"]["dy"], grid["dy"]) and back["grid"]["step"] == (100, 200)
    assert back["affine"] == (1, 2, 3, 4, 5, 6) and "max : 3.000000" in (tmp_path / "a.rpb.res").read_text()
    assert np.allclose(rpc_files.parse((tmp_path / "a.rpb").read_text().replace("sampNumCoef", "pixelNumeratorCoefficients").replace("sampDenCoef", "pixelDenominatorCoefficients").replace("lineNumCoef", "lineNumeratorCoefficients").replace("lineDenCoef", "lineDenominatorCoefficients").replace("samp", "pixel").replace("latOff", "latitudeOff").replace("latSc", "latitudeSc").replace("longOff", "longitudeOff").replace("longSc", "longitudeSc"))["samp_num"], RPC["samp_num"])


def test_task_lists(spark, tmp_path):
    (tmp_path / "a.txt").write_text("2 2\n2 2\n")
    (tmp_path / "b.txt").write_text("1 1\n1 1\n")
    cells = spark.createDataFrame([(0, y, x, float(1 + x + 2 * y)) for y in range(2) for x in range(2)], "b int, y int, x int, v double")
    t = tasks.read_tasks(tasks.uniform_xml("a.txt", "b.txt", (2, 0, 1)), str(tmp_path))
    assert t[0].order == (0, 1, 2)
    out = tasks.run(Cube(cells, (2, 2, 1)), [*t, tasks.Task("sort"), tasks.Task("destripe", {"tile_size": "3"})]).cube
    assert sorted(r.v for r in out.cells.collect()) and out.size == (2, 2, 1)
    with pytest.warns(UserWarning, match="unknown task"):
        tasks.run(Cube(cells, (2, 2, 1)), [tasks.Task("nothing")])
    (tmp_path / "job.json").write_text(json.dumps({"dstdir": "out", "data": [{"img": "x.tif"}], "tasklist": [{"template": "t.xml"}]}))
    assert tasks.read_job(str(tmp_path / "job.json"))["data"][0]["img"] == str(tmp_path / "x.tif")


def test_stream_equals_table(spark, sf, tmp_path):
    from prismcube.streaming import frames as stream

    events = spark.read.parquet(f"{sf}/events.parquet")
    events.write.parquet(str(tmp_path / "in"))
    q = stream.tumbling(stream.follow(spark, str(tmp_path / "in"), events.schema)).writeStream.outputMode("complete").format("memory").queryName("tumbled").start()
    q.processAllAvailable()
    q.stop()
    key = lambda d: sorted((r.hour, r.event_type, r.n) for r in d.collect())
    assert key(spark.sql("SELECT * FROM tumbled")) == key(stream.tumbling(events))


def test_window_bounds(spark):
    cells = spark.createDataFrame([(b, y, x, 1.0) for b in range(2) for y in range(3) for x in range(4)], "b int, y int, x int, v double")
    cube = Cube(cells, (4, 3, 2)).window(xoff=-5, xsize=-1, yoff=1)
    assert cube.size == (3, 2, 2) and cube.cells.agg(F.max("x")).first()[0] == 2
    with pytest.raises(ValueError):
        Cube(cells, (4, 3, 2)).window(boff=2)


def sparse(spark, rng, rows, cols, frames=2, share=0.8):
    """Cells at random places of some frames, and the frames with NaN where there is none."""
    m = rng.normal(size=(frames, rows, cols)).round(3)
    gone = rng.uniform(size=m.shape) > share
    cells = [(k, i, j, float(m[k, i, j])) for k in range(frames) for i in range(rows) for j in range(cols) if not gone[k, i, j]]
    return spark.createDataFrame(cells, "k int, r int, c int, v double"), np.where(gone, np.nan, m)


def test_tiles_equal_whole_frames_and_loops(spark):
    # cells that are not there, small tiles: medians, weighted means and peaks against loops over offsets
    f, cube = sparse(spark, np.random.default_rng(5), 13, 11)
    rows, cols = cube.shape[1:]
    ratios = A.PEAK
    mirror = lambda a, n: abs(a) if a < n else 2 * (n - 1) - a
    for tile in (4, 512):
        got = {
            "median": {(r.k, r.r, r.c): r.v for r in A.median_filter(f, rows, cols, 3, tile=tile).collect()},
            "gauss": {(r.k, r.r, r.c): r.v for r in A.gauss(f, rows, cols, 5, band=2, dim=1, tile=tile).collect()},
            "peaks": {(r.k, r.r, r.c): (r.v, r.n) for r in A.peaks(f, rows, cols, 0.3, tile=tile).collect()},
        }
        for k, i, j in zip(*np.nonzero(~np.isnan(cube)), strict=True):
            at = (int(k), int(i), int(j))
            near = [cube[k, min(max(i + a, 0), rows - 1), min(max(j + b, 0), cols - 1)] for a in (-1, 0, 1) for b in (-1, 0, 1)]
            near = sorted(x for x in near if not np.isnan(x))
            assert got["median"][at] == near[len(near) // 2]
            if i < 2:
                assert got["gauss"][at] == cube[k, i, j]
            else:
                seen = [(w, cube[k, 2 + mirror(i - 2 + d, rows - 2), j]) for d, w in zip(range(-2, 3), A.GAUSS[5], strict=True)]
                seen = [(w, x) for w, x in seen if not np.isnan(x)]
                assert abs(got["gauss"][at] - sum(w * x for w, x in seen) / sum(w for w, _ in seen)) < 1e-12
            whole = np.pad(np.nan_to_num(cube[k]), 2)
            n = sum(cube[k, i, j] * ratios[a][b] <= whole[i + a, j + b] for a in range(5) for b in range(5) if ratios[a][b])
            assert got["peaks"][at] == ((cube[k, i, j], n) if cube[k, i, j] > 0.3 and n <= 5 else (0.0, None))
        assert all(len(x) == int((~np.isnan(cube)).sum()) for x in got.values())


def test_anomaly_of_thirty_frames(spark):
    # the default block, several squares of pixels, pixels that lack a frame
    rng = np.random.default_rng(1)
    m = rng.normal(size=(45, 9, 20)) @ np.diag(rng.uniform(1, 2, 20))
    cells = [(k, i, j, float(m[k, i, j])) for k in range(45) for i in range(9) for j in range(20) if (k, i, j) not in {(3, 0, 0), (44, 8, 19)}]
    df, pixels = spark.createDataFrame(cells, "k int, r int, c int, v double"), A.PIXELS
    A.PIXELS = 25
    try:
        got = {(r.k, r.r, r.c): r.v for r in A.anomaly(df).collect()}
    finally:
        A.PIXELS = pixels
    assert len(got) == 2 * 180
    for block, lo, hi, lacking in ((0, 0, 30, (0, 0)), (1, 30, 45, (8, 19))):
        at = [(i, j) for i in range(9) for j in range(20) if (i, j) != lacking]
        x = np.array([m[lo:hi, i, j] for i, j in at])
        d = x - x.mean(0)
        want = np.einsum("ij,jk,ik->i", d, np.linalg.inv(np.cov(x.T)), d)
        assert np.allclose([got[block, i, j] for i, j in at], want) and got[block, *lacking] is None


def test_percentiles(spark):
    rng = np.random.default_rng(7)
    values = {0: rng.normal(size=999), 1: np.repeat([1.0, 2.0, 5.0], [500, 3, 40]), 2: np.array([4.0]), 3: rng.exponential(size=400) ** 6}
    df = spark.createDataFrame([(k, float(v)) for k, x in values.items() for v in [*x, float("nan")]], "k int, v double")
    got = {r.k: (r.p0, r.p1, r.p2) for r in M.percentiles(df, [0.01, 0.5, 0.99]).collect()}
    for k, x in values.items():
        assert np.allclose(got[k], np.percentile(x, [1, 50, 99]), rtol=1e-12)


def test_destripe_of_missing_lines(spark):
    m = np.array([[1.0, 2], [3, 5], [7, 9], [4, 4]])
    df = frame(spark, m).filter("r <> 2")
    got, h = {(r.r, r.c): r.v for r in A.destripe(df, 3).collect()}, {0: 3.0, 1: 8.0, 3: 8.0}
    for r, window in ((0, (0, 1)), (1, (1,)), (3, (3,))):  # e = 1: the line itself and the next
        mean = np.mean([h[x] for x in window])
        assert np.allclose([got[r, c] for c in (0, 1)], m[r] * mean / h[r])


def test_despeckle_equals_the_scan():
    rng = np.random.default_rng(2)
    m = rng.uniform(0, 12, (9, 10))
    m[2, 3], m[5] = np.nan, 20.0
    low, high, step, radius = 2.0, 9.0, 0.5, 3
    want = np.zeros_like(m)
    for i in range(9):
        for j in range(10):
            if not np.isfinite(m[i, j]):
                want[i, j] = m[i, j]
                continue
            w = m[max(i - radius, 0) : i + radius + 1, max(j - radius, 0) : j + radius + 1]
            w = w[np.isfinite(w)]
            inside = sorted(x for x in w if low <= x < high)
            if inside:
                want[i, j] = low + int((inside[(len(inside) + 1) // 2 - 1] - low) / step) * step + step / 2
            radius = min(radius + 1, 3) if (w < low).sum() >= radius or (w >= high).sum() >= radius else max(radius - 1, 1)
    assert np.allclose(K.despeckle_frame(m, 3, low, high, step), want, equal_nan=True)


def test_inpaint_in_tiles(spark):
    # a smooth frame: cells at tile edges come back, tiles and whole frames agree nearly
    i, j = np.indices((40, 40))
    m = np.sin(i / 9) + j / 20
    f = frame(spark, m).filter("NOT (r = 20 AND c = 20)")
    bad = spark.createDataFrame([(r, c) for r in (9, 10, 30) for c in (9, 10, 11, 30)], "r int, c int")
    for tile in (10, 500):
        out = matrix(K.inpaint(f, bad, 40, 40, tile=tile), (40, 40))
        assert np.nanmax(np.abs(out - m)) < 0.15 and np.isnan(out[20, 20]) and np.isnan(out).sum() == 1
        assert out[0, 0] == m[0, 0]


def test_utm_and_local_metres(spark):
    rows = [(i % 3, i, 100.0 + i * 3.7 % 80, -70.0 + i * 2.9 % 140, float(i)) for i in range(60)]
    t = spark.createDataFrame(rows, "part int, ord int, lon double, lat double, h double")
    zone = geo.utm_zone(F.col("lon"), F.lit(0.0))
    x, y = geo.to_utm(F.col("lon"), F.col("lat"), zone)
    lon, lat = geo.from_utm(F.col("x"), F.col("y"), F.col("z"))
    for r in t.select("lon", "lat", x.alias("x"), y.alias("y"), zone.alias("z")).withColumn("a", lon).withColumn("b", lat).collect():
        assert abs(r.a - r.lon) < 1e-8 and abs(r.b - r.lat) < 1e-8
    track = spark.createDataFrame([(0, i, 116.0 + i / 100, 39.0 + i / 50, 50.0 + i) for i in range(5)], "part int, ord int, lon double, lat double, h double")
    local = geo.to_local(track).orderBy("ord")
    rows = local.collect()
    assert (rows[0].x, rows[0].y, rows[0].z) == (0, 0, 0) and 800 < rows[1].x < 920 and 2100 < rows[1].y < 2300
    for r, q in zip(geo.from_local(local.drop("lon", "lat", "h")).orderBy("ord").collect(), track.orderBy("ord").collect(), strict=True):
        assert abs(r.lon - q.lon) < 1e-9 and abs(r.lat - q.lat) < 1e-9 and abs(r.h - q.h) < 1e-9


def test_tracks_between_records(spark):
    rng = np.random.default_rng(3)
    ord_ = np.array([0, 2, 5, 6, 9, 13], float)
    x, a, v = rng.normal(size=(6, 3)), rng.normal(size=(6, 3)), rng.normal(size=(6, 3))
    rows = [(p, int(o), float(o) / 10, x[i].tolist(), (v[i] if p == 0 or i != 2 else v[i] * 0).tolist(), a[i].tolist()) for p in (0, 1) for i, o in enumerate(ord_)]
    rows += [(2, 0, 0.0, [0.0] * 3, [1.0] * 3, [0.0] * 3), (2, 5, 1.0, [1.0] * 3, [1.0] * 3, [0.0] * 3)]
    kind = "array<double>"
    records = spark.createDataFrame(rows, f"part int, ord int, time double, x {kind}, vx {kind}, a {kind}")
    places = [0.0, 0.5, 2.0, 4.9, 5.0, 7.25, 12.0, 13.0]
    lines = spark.createDataFrame([(p, q) for p in (0, 1, 2) for q in [*places, -1.0, 13.5]], "part int, line double")
    got = {(r.part, r.line): r for r in geo.interpolate_track(records, lines).collect()}
    assert len(got) == 30
    at = np.array(places)
    for i in range(3):
        assert np.allclose([got[0, q].x[i] for q in places], interp.cubic_hermite(ord_, x[:, i], v[:, i] * 0.1, at))
        assert np.allclose([got[1, q].x[i] for q in places], interp.pchip(ord_, x[:, i], at))
        assert np.allclose([got[0, q].a[i] for q in places], interp.pchip(ord_, a[:, i], at))
    assert all(got[p, q].x == [None] * 3 for p in (0, 1) for q in (-1.0, 13.5)) and all(got[2, q].x == [None] * 3 for q in places)


def test_rpc_points_are_independent_and_corrected(spark):
    rng = np.random.default_rng(4)
    line, sample, h = rng.uniform(0, 1000, 50), rng.uniform(0, 800, 50), rng.uniform(0, 200, 50)
    lon, lat = geo.rpc_inverse(RPC, line, sample, h)
    for i in range(0, 50, 7):
        a, b = geo.rpc_inverse(RPC, line[i : i + 1], sample[i : i + 1], h[i : i + 1])
        assert a[0] == lon[i] and b[0] == lat[i]
    grid = {"dx": rng.uniform(-1, 1, (6, 5)), "dy": rng.uniform(-1, 1, (6, 5)), "step": (200, 200)}
    affine = (0.5, 1e-4, -2e-4, -0.7, 3e-4, 1e-4)
    x, y = geo.image_of_photo(sample, line, affine)
    back = geo.photo_of_image(x, y, affine)
    assert np.allclose(back[0], sample) and np.allclose(back[1], line)
    dx, dy = geo.grid_shift(grid, np.array([100.0, 799.0, 900.0, -1.0]), np.array([100.0, 100.0, 1.0, 1.0]))
    assert np.isclose(dx[0], grid["dx"][:2, :2].mean()) and dx[2] == dy[2] == 0 and np.isclose(dy[0], grid["dy"][:2, :2].mean())
    full = RPC | {"grid": grid, "affine": affine}
    ground = spark.createDataFrame([(float(a), float(b), float(c)) for a, b, c in zip(lon, lat, h, strict=True)], "lon double, lat double, h double")
    there = geo.ground_to_photo_frame(ground, full)
    again = geo.photo_to_ground_frame(there.select("line", "sample", "h", F.col("lon").alias("p"), F.col("lat").alias("q")), full).collect()
    assert max(abs(r.lon - r.p) + abs(r.lat - r.q) for r in again) < 2e-5  # the grid is taken off where it was not added, some thousandths of a pixel away
    other = RPC | {"samp_num": [0.02, 1.0, 0.01, 0.4, 0.002, *[0.0] * 15]}
    third = RPC | {"line_num": [0.01, 0.02, -1.0, 0.3, 0.001, *[0.0] * 15]}
    rpcs, rows = {"a": RPC, "b": other, "c": third}, []
    for i in range(20):
        for name in ("a", "b", "c")[: 1 + i % 3]:
            v, u = geo.rpc_forward(rpcs[name], lon[i], lat[i], h[i])
            rows.append((i, name, float(v), float(u)))
    for r in geo.intersect_frame(spark.createDataFrame(rows, "id int, image string, line double, sample double"), rpcs).collect():
        if r.id % 3:
            assert r.images == 1 + r.id % 3 and abs(r.lon - lon[r.id]) < 1e-7 and abs(r.lat - lat[r.id]) < 1e-7 and abs(r.h - h[r.id]) < 1e-3 and r.rms < 1e-6
        else:
            assert r.lon is None and r.images == 1
    p = geo.camera_matrix(np.diag([1000.0, 1000.0, 1.0]), geo.rotation((0.01, 0.02, 0.3)), np.zeros(3), np.eye(3), np.array([5.0, 6.0, 700.0]))
    for r in geo.to_plane_frame(spark.createDataFrame([(12.0, -7.0, 20.0), (1.0, 2.0, 30.0)], "u double, v double, h double"), p).collect():
        assert np.allclose(geo.to_plane(p, (r.u, r.v), r.h), (r.x, r.y, r.h))
    (r,) = geo.track_similarity(spark.createDataFrame([(0.0, 0.0, 3.0, 1.0, 5.0, 5.0, 4.0, 9.0)], "px double, py double, qx double, qy double, ux double, uy double, wx double, wy double")).collect()
    assert np.allclose((r.a, r.b, r.c, r.d), geo.track_affine((0, 0), (3, 1), (5, 5), (4, 9)))


def test_rectangles_of_all_sizes(spark):
    from prismcube.operators import tables as T

    rng = np.random.default_rng(6)
    size = 2.0 ** rng.uniform(-4, 6, (60, 2))
    boxes = [(i, float(x), float(y), float(x + w), float(y + h)) for i, (x, y, w, h) in enumerate(np.column_stack([rng.uniform(-50, 50, (60, 2)), size]).tolist())]
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-60, 100, (400, 2)).tolist())]
    p = spark.createDataFrame(points, "id int, x double, y double")
    got = sorted((r.id, r.box) for r in T.in_rectangles(p, spark.createDataFrame(boxes, "box int, x0 double, y0 double, x1 double, y1 double")).collect())
    assert got == sorted((i, b) for i, x, y in points for b, x0, y0, x1, y1 in boxes if x0 < x < x1 and y0 < y < y1) and got
    rect = [(b, x0, y0, x1 - x0, y1 - y0) for b, x0, y0, x1, y1 in boxes] + [(100, 0.0, 0.0, 0.0, 0.0), (101, 0.0, 0.0, 8.0, 8.0), (102, 8.0, 8.0, 4.0, 4.0)]
    df = spark.createDataFrame(rect, "id int, x double, y double, w double, h double")
    got = sorted((r.a_id, r.b_id) for r in T.intersecting(df, df.filter("id % 2 = 0 OR id > 99")).collect())
    want = sorted((a[0], b[0]) for a in rect for b in rect if (b[0] % 2 == 0 or b[0] > 99) and a[1] <= b[1] + b[3] and b[1] <= a[1] + a[3] and a[2] <= b[2] + b[4] and b[2] <= a[2] + a[4])
    assert got == want and (101, 102) in got
    assert T.in_rectangles(p, spark.createDataFrame([], "box int, x0 double, y0 double, x1 double, y1 double")).count() == 0


@pytest.mark.parametrize("pixels", [7, 25, 56, 97])
def test_gauss_query_with_a_short_last_line_equals_its_sql(spark, tmp_path, pixels):
    # cells that are not there have no share in the sum, as in the SQL; few lines, too
    import duckdb
    import pyarrow as pa
    import pyarrow.parquet as pq

    from prismcube.queries import ORACLES, QUERIES

    values = np.random.default_rng(2).normal(size=(pixels, 64)).astype(np.float32)
    table = pa.table({"vec_id": pa.array(range(pixels), pa.int64()), "embedding": pa.array(values.tolist(), pa.list_(pa.float32()))})
    pq.write_table(table, tmp_path / "embeddings.parquet")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet'")
    want = {(k, r, x): v for k, r, x, v in c.execute(ORACLES["w4_gauss"]).fetchall()}
    got = {(r.k, r.r, r.c): r.v for r in QUERIES["w4_gauss"](spark, str(tmp_path)).collect()}
    assert set(got) == set(want) and max(abs(got[x] - want[x]) for x in want) < 2e-6


def test_unpacking_holds_a_bounded_part_of_a_batch(spark):
    import pyarrow as pa

    rng = np.random.default_rng(6)
    data = [None, b"", b"a", b"ab", *(rng.bytes(int(n)) for n in rng.integers(0, 3 << 12, 2000)), rng.bytes(3 << 20), None]
    want = [files.unpack12(x or b"").tolist() for x in data]
    got = list(M._unpacked(iter([pa.array(data, pa.binary()), pa.array([], pa.binary()), pa.array(data[:5], pa.binary())])))
    assert [x for a in got for x in a.to_pylist()] == want + want[:5]
    threes = [None, b"", *(rng.bytes(3 * int(n)) for n in rng.integers(0, 9, 300))]
    assert [x for a in M._unpacked(iter([pa.array(threes, pa.binary())])) for x in a.to_pylist()] == [files.unpack12(x or b"").tolist() for x in threes]
    # a part has no more bytes than UNPACKED, but for a row that is longer
    assert len(got) > 10 and all(len(a) == 1 or len(a.values) * 3 // 2 <= M.UNPACKED for a in got)
    rows = spark.createDataFrame([(i, None if x is None else bytearray(x)) for i, x in enumerate(data[:50])], "i int, x binary").withColumn("s", M.unpack12("x"))
    assert {r.i: r.s for r in rows.collect()} == dict(enumerate(want[:50]))
