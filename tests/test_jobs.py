"""Task lists of every shape, files in and out, jobs and the command line."""

import json
import warnings

import numpy as np
import pytest

from prismcube import __main__ as command
from prismcube.cube import Cube
from prismcube.functions import interp
from prismcube.operators import aggregates as A
from prismcube.plans import jobs, tasks
from prismcube.sources import files, raster


def write(folder, name, cube, kind="f4"):
    """A flat raster of an array (bands, lines, samples)."""
    np.asarray(cube).astype("<" + kind).tofile(folder / f"{name}.img")
    b, y, x = np.shape(cube)
    (folder / f"{name}.hdr").write_text(files.envi_text(x, y, b, kind, tags={"map info": "{here}"}))
    return str(folder / f"{name}.img")


def read(path, kind):
    h = files.envi_header(open(path.rsplit(".", 1)[0] + ".hdr").read())
    return np.fromfile(path, "<" + kind).reshape(h["bands"], h["lines"], h["samples"])


def cube_of(spark, m):
    b, y, x = m.shape
    cells = [(i, j, k, float(m[i, j, k])) for i in range(b) for j in range(y) for k in range(x)]
    return Cube(spark.createDataFrame(cells, "b int, y int, x int, v double"), (x, y, b))


def array(cube):
    m = np.full(cube.size[::-1], np.nan)
    for r in cube.cells.collect():
        m[r.b, r.y, r.x] = np.nan if r.v is None else r.v
    return m


LISTS = {
    # the shapes of lists that users have: name -> (order, tasks)
    "extractor": ("0,1,2", "<task name='removal'><interval>10</interval></task><task name='anomaly'><ksize>3</ksize></task><task name='extractor'><type>peak</type><length_min>4</length_min><length_max>20</length_max><dimension>5 5</dimension><matrix>\n0.1 0.1 0.1 0.1 0.1 0.1   1   1   1 0.1 0.1   1 2   1 0.1 0.1   1   1   1 0.1 0.1 0.1 0.1 0.1 0.1\n</matrix></task>"),
    "background": ("0,1,2", "<task name='removal'><background>bg.img</background><interval>10</interval></task>"),
    "badpixel": ("0,1,2", "<task name='dpc'><file>mask.img</file></task>"),
    "badtext": ("0,1,2", "<task name='dpc'><file>marks.txt</file><dim_prior>0,2,1</dim_prior></task>"),
    "clahe": ("0,1,2", "<task name='render'><src_min>0</src_min><src_umax>256</src_umax><dst_min>0</dst_min><dst_max>255</dst_max><resample_col_step>1</resample_col_step><resample_row_step>1</resample_row_step><grid_x>2</grid_x><grid_y>2</grid_y><hist_clip>2</hist_clip><cut_lower>-1</cut_lower><cut_upper>-1</cut_upper><mode>clip|hist|tile</mode></task>"),
    "wallis": ("0,1,2", "<task name='render'><src_min>1</src_min><src_umax>4000</src_umax><dst_mean>127</dst_mean><dst_std>70</dst_std><resample_col_step>2</resample_col_step><resample_row_step>2</resample_row_step><tile_cols>6</tile_cols><tile_rows>5</tile_rows><mode>clip|wallis|tile</mode></task>"),
    "render": ("0,1,2", "<task name='render'><src_min>0</src_min><src_umax>4000</src_umax><resample_col_step>5</resample_col_step><resample_row_step>5</resample_row_step><mode>tile|hist|global</mode></task>"),
    "plain": ("0,1,2", "<task name='render'></task>"),
    "global": ("0,1,2", "<task name='render'><mode>cut|global</mode><src_min>0</src_min></task>"),
    "nuc": ("1,0,2", "<task name='nuc'><tile_size>5</tile_size><debug>true</debug></task>"),
    "uniform": ("0,2,1", "<task name='uniform'><a>a.txt</a><b>b.txt</b><dst_min>0</dst_min></task>"),
    "dark": ("0,2,1", "<task name='dark'><b>b.txt</b></task><task name='dark'><a>a.txt</a><b>b.txt</b><index>i.txt</index></task>"),
    "extend": ("0,2,1", "<task name='extend'><file>a.txt</file></task>"),
    "median": ("0,1,2", "<task name='median'><ksize>3</ksize></task><task name='median'><method>adapt</method><hist_min>0</hist_min><hist_max>400</hist_max></task><task name='gauss'><dim>2</dim></task>"),
    "statistic": ("0,1,2", "<task name='statistic'><cut_lower>0.1</cut_lower><nuc apply='false'>true</nuc></task><task name='statistic'><method>median</method></task>"),
    "sort": ("1,0,2", "<task name='sort'/><task name='destripe'><tile_size>5</tile_size></task>"),
    "interp": ("0,1,2", "<task name='interp'><wl0>1,2,3,4</wl0><wl1>1.5 2.5</wl1><type>makima</type></task>"),
    "lines": ("0,1,2", "<task name='extractor'><type>lsd</type><length_min>2</length_min><length_max>-1</length_max><thickness_max>9</thickness_max></task>"),
    "kept": ("0,1,2", "<task name='background'><ksize>3</ksize><method>median</method><removal>false</removal></task>"),
}


@pytest.mark.parametrize("name", sorted(LISTS))
def test_list_of_every_shape(spark, tmp_path, name):
    rng = np.random.default_rng(3)
    m = rng.uniform(10, 250, (4, 12, 13))
    m[:, 4:7] += 200
    image = write(tmp_path, "m", m)
    write(tmp_path, "bg", np.full((1, 12, 13), 5.0))
    mask = np.zeros((4, 12, 13))
    mask[1, 3, 4] = mask[2, 5, 5] = 1
    write(tmp_path, "mask", mask, "u1")
    (tmp_path / "marks.txt").write_text("2 3\n")  # band 2, column 3
    for n, k in (("a", 1.5), ("b", 2.0)):
        (tmp_path / f"{n}.txt").write_text("\n".join("\t".join([str(k)] * 13) for _ in range(4)))
    (tmp_path / "i.txt").write_text("\n".join(f"{i} x" for i in range(12)))
    order, body = LISTS[name]
    (tmp_path / "t.xml").write_text(f"<HSP><dim_prior>{order}</dim_prior>{body}</HSP>")
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        result, paths = jobs.process(spark, image, str(tmp_path / "t.xml"), str(tmp_path / "out.dat"), background=str(tmp_path / "bg.img") if name == "extractor" else None, keep_lines=True)
    m = m.astype("f4").astype(float)
    if name == "background":
        assert np.allclose(read(paths[-1], "f4"), m - 5, atol=1e-4) and result.kind == "float32"
    if name == "badpixel":
        out = read(paths[-1], "f4")
        assert np.array_equal(np.argwhere(~np.isclose(out, m)), [[1, 3, 4], [2, 5, 5]])
    if name == "badtext":
        assert set(map(tuple, np.argwhere(~np.isclose(read(paths[-1], "f4"), m))[:, [0, 2]].tolist())) == {(1, 2)}
    if name in ("clahe", "wallis", "render", "plain", "global"):
        assert read(paths[-1], "u1").shape == m.shape and result.kind == "byte"
    if name == "uniform":
        assert np.allclose(read(paths[-1], "f4"), 1.5 * m + 2)
    if name == "dark":
        assert np.allclose(read(paths[-1], "f4"), np.maximum(m - 2 - (1.5 * np.arange(12)[None, :, None] + 2), 0), atol=1e-3)
    if name == "extend":
        assert np.allclose(read(paths[-1], "f4"), 1.5)
    if name == "interp":
        want = interp.makima([1, 2, 3, 4], m.transpose(1, 2, 0), [1.5, 2.5]).transpose(2, 0, 1)
        assert np.allclose(read(paths[-1], "f4"), want, rtol=1e-5) and result.cube.size == (13, 12, 2)
    if name == "nuc":
        assert {p.rsplit("_", 1)[1] for p in paths} >= {"a.txt", "b.txt", "badpixels.txt", "uniform.xml", "hi.txt", "lo.txt"} or "out_a.txt" in str(paths)
        again = tasks.read_tasks((tmp_path / "out_uniform.xml").read_text(), str(tmp_path))
        assert [t.name for t in again] == ["uniform", "dpc"] and again[0].order == (0, 2, 1) and again[0].params["a"].endswith("out_a.txt") and "/" in again[0].params["a"]
        assert np.loadtxt(tmp_path / "out_a.txt").shape == (4, 13)
    if name == "statistic":
        s = np.sort(m, axis=2)[:, :, 1:]
        assert np.allclose(np.loadtxt(tmp_path / "out_mean.txt"), s.mean(2), rtol=1e-5) and np.allclose(np.loadtxt(tmp_path / "out_mean_std.txt"), s.std(2), rtol=1e-5)
        assert np.allclose(np.loadtxt(tmp_path / "out_median.txt"), np.sort(m, axis=2)[:, :, 6], rtol=1e-5) and not (tmp_path / "out.dat").exists()
    if name == "extractor":
        text = (tmp_path / "out_peak_points.txt").read_text().split("\n")
        assert text[0] == "2" and (tmp_path / "out_peak_lines.txt").exists() and result.cube.size == (13, 12, 2)
    if name == "lines":
        assert len((tmp_path / "out_lsd.txt").read_text().split("\n")) >= 5
    if name == "kept":
        got = read(str(tmp_path / "out_background.dat"), "f4")
        assert got.shape == (2, 12, 13) and np.allclose(got[0], np.median(m[:3], axis=0)) and np.allclose(got[1], m[3])


def test_windows_and_types(spark, tmp_path):
    m = np.arange(2 * 6 * 5).reshape(2, 6, 5) * 10
    image = write(tmp_path, "m", m, "u2")
    (tmp_path / "t.xml").write_text("<HSP><task name='sort'/></HSP>")
    _, (whole,) = jobs.process(spark, image, str(tmp_path / "t.xml"), window="1|3;2,2", nodata="5 nan,7")
    assert whole == str(tmp_path / "m_mod.img") and read(whole, "u2").shape == (2, 6, 5) and read(whole, "u2")[1, 3, 1:4].tolist() == m[1, 3, 1:4].tolist() and not read(whole, "u2")[:, :2].any()
    assert "here" in (tmp_path / "m_mod.hdr").read_text()
    paths = command.main(["process", image, "-task", str(tmp_path / "t.xml"), "-o", str(tmp_path / "c.dat"), "-srcwin", "1,3,2,-1", "-oc", "-ot", "byte"])
    assert read(paths[0], "u1").shape == (2, 3, 3) and read(paths[0], "u1")[0, 0].tolist() == [110, 120, 130]
    with pytest.raises(ValueError, match="another shape"):
        jobs.process(spark, image, str(tmp_path / "t.xml"), str(tmp_path / "c.dat"))
    with pytest.raises(ValueError, match="no tasks"):
        jobs.process(spark, image, [])
    with pytest.raises(ValueError, match="needs a background"):
        tasks.run(cube_of(spark, m), [tasks.Task("removal")])


def test_unknown_parameters_are_named():
    with pytest.warns(UserWarning, match="nuc does not read cut_lower, cut_upper"):
        tasks.read_tasks("<HSP><task name='nuc'><cut_lower>0.1</cut_lower><cut_upper>0.1</cut_upper></task></HSP>")
    t = tasks.Task("extractor", {"dimension": "3 1", "matrix": "0.5 40 0.25"})
    assert tasks.peak_test(t) == ([[0.5, 0.0, 0.25]], 40.0)
    assert tasks.peak_test(tasks.Task("extractor", {"matrix": "1 2 x"}))[1] == 100.0
    assert tasks.peak_test(tasks.Task("extractor", {"dimension": "1 1", "matrix": "0"}))[1] < -1e38
    with pytest.raises(ValueError, match="fewer numbers"):
        tasks.peak_test(tasks.Task("extractor", {"dimension": "3 3", "matrix": "1 2"}))


def test_wavelengths_of_each_column(spark):
    m = np.random.default_rng(2).normal(size=(5, 2, 3))
    wl0 = [float(100 * x + b) for x in range(3) for b in range(5)]
    wl1 = [100 * x + b + 0.5 for x in range(3) for b in range(2)]
    cells, bands = interp.resample_frames(cube_of(spark, m).cells.filter("NOT (b = 2 AND y = 0 AND x = 0)"), wl0, wl1, (3, 2, 5))
    got = {(r.b, r.y, r.x): r.v for r in cells.collect()}
    assert bands == 2 and len(got) == 10
    for (b, y, x), v in got.items():
        assert np.isclose(v, interp.pchip(wl0[x * 5 : x * 5 + 5], m[:, y, x], [100 * x + b + 0.5])[0])
    with pytest.raises(ValueError, match="differ in length"):
        interp.resample_frames(cube_of(spark, m).cells, [1.0], [1.0], (3, 2, 5))


def test_calibration_tiles(spark):
    m = np.random.default_rng(4).uniform(90, 500, (1, 12, 60))
    f = cube_of(spark, m).frames()
    got = {}
    for rows in (None, 12, 13):  # two lines beyond the second tile of five go to it, three are a tile
        got[rows] = sorted(tuple(x) for x in A.calibrate(f, tile_size=5, interpolate=interp.pchip, rows=rows).collect())
        assert len(got[rows]) == 12
    assert got[None] == got[12] != got[13]


def test_jobs_and_extraction(spark, tmp_path):
    write(tmp_path, "x", np.arange(24).reshape(2, 3, 4) * 1.0)
    (tmp_path / "sort.xml").write_text("<HSP><task name='sort'/></HSP>")
    (tmp_path / "s.xml").write_text("<HSP><task name='statistic'/></HSP>")
    (tmp_path / "job.json").write_text(json.dumps({"dstdir": "o", "data": [{"img": "x.img"}], "tasklist": [{"type": "sort"}, {"template": "s.xml"}]}))
    done = jobs.run_job(spark, str(tmp_path / "job.json"), str(tmp_path))
    assert [p for _, p in done] == [[str(tmp_path / "o" / "x_0.dat")], [str(tmp_path / "o" / "x_1_mean.txt"), str(tmp_path / "o" / "x_1_mean_std.txt")]] and done[1][0].endswith("x_0.dat")
    raw = lambda first, n: b"".join(files.packet(4, 0, 0, first + i, files.pack12([32, *b"ab", 0])) + files.packet(6, 7, 0, first + i, files.pack12([first + i] * 6)) for i in range(n))
    (tmp_path / "p.dat").write_bytes(raw(10, 3))
    (tmp_path / "q.dat").write_bytes(raw(20, 2))
    (tmp_path / "r.dat").write_bytes(raw(11, 2))
    paths = command.main(["extract", *(str(tmp_path / f"{n}.dat") for n in "pq"), "-o", str(tmp_path / "all.img")])
    assert read(paths[0], "u2")[0, :, 0].tolist() == [10, 11, 12, 20, 21] and (tmp_path / "all.pos").read_text().split("\n")[3] == "20\tab"
    paths = jobs.extract(spark, [str(tmp_path / f"{n}.dat") for n in "pqr"], str(tmp_path / "g.img"), splice=2)
    assert [read(p, "u2")[0, :, 0].tolist() for p in paths if p.endswith(".img")] == [[10, 11, 12], [11, 12, 20, 21]] or [read(p, "u2")[0, :, 0].tolist() for p in paths if p.endswith(".img")] == [[10, 11, 12, 20, 21], [11, 12]]
    assert raster.output_path("a.img", None, "") == "a.img"
