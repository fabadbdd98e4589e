"""Shapes and scans that cross tiles, against whole frames."""

import numpy as np
import pytest

from prismcube.operators import graph, kernels, scans, shapes
from prismcube.sources import store


def frame(spark, *frames, keep=None):
    rows = [(k, int(r), int(c), float(m[r, c])) for k, m in enumerate(frames) for r, c in np.ndindex(m.shape) if keep is None or keep[r, c]]
    return spark.createDataFrame(rows, "k int, r int, c int, v double")


def spiral(n):
    m, y, x, dy, dx = np.zeros((n, n)), 0, 0, 0, 1
    while True:
        m[y, x] = 1
        a, b = y + dy, x + dx
        far = y + 2 * dy, x + 2 * dx
        if not (0 <= a < n and 0 <= b < n) or (0 <= far[0] < n and 0 <= far[1] < n and m[far]):
            dy, dx = dx, -dy
            a, b = y + dy, x + dx
            if m[a, b] or (0 <= y + 2 * dy < n and 0 <= x + 2 * dx < n and m[y + 2 * dy, x + 2 * dx]):
                return m
        y, x = a, b


def filled(m):
    """The first cell of each cell's part, by a flood fill."""
    out = np.full(m.shape, -1)
    for start in zip(*np.nonzero(m > 0), strict=True):
        if out[start] >= 0:
            continue
        name, todo = start[0] * m.shape[1] + start[1], [start]
        out[start] = name
        while todo:
            y, x = todo.pop()
            for a in range(max(y - 1, 0), min(y + 2, m.shape[0])):
                for b in range(max(x - 1, 0), min(x + 2, m.shape[1])):
                    if m[a, b] > 0 and out[a, b] < 0:
                        out[a, b] = name
                        todo.append((a, b))
    return out


def test_labels_equal_the_fill():
    rng = np.random.default_rng(3)
    for share in (0.2, 0.4, 0.6, 1.0):
        m = (rng.random((37, 41)) < share).astype(float)
        assert (shapes.labelled(m > 0) == filled(m)).all()
    assert (shapes.labelled(spiral(60) > 0) == filled(spiral(60))).all()
    assert (shapes.labelled(np.zeros((4, 5), bool)) == -1).all()


@pytest.mark.parametrize("tile", [1, 3, 8, 512])
def test_shapes_across_tiles(spark, tile):
    rng = np.random.default_rng(tile)
    frames = [spiral(21), (rng.random((21, 21)) < 0.45).astype(float), np.eye(21)[::-1], np.zeros((21, 21))]
    got = shapes.label_shapes(frame(spark, *frames), 21, 21, tile).collect()
    want = {(k, r, c): n for k, m in enumerate(frames) for (r, c), n in np.ndenumerate(filled(m)) if n >= 0}
    assert {(x.k, x.r, x.c): x.shape for x in got} == want


@pytest.mark.parametrize("tile", [4, 512])
def test_lines_across_tiles_equal_whole_frames(spark, tile):
    m = np.zeros((30, 40))
    m[3, 2:17] = 5
    m[6:21, 30] = 7
    for i in range(12):
        m[10 + i, 3 + i] = 2 + i
    m[25, 5:30], m[24, 30:34] = 1, 1  # longer than 20
    m[14:18, 20:25] = 3  # no line
    m[28, 20] = 9  # a point
    rng = np.random.default_rng(1)
    n = np.where(rng.random((30, 40)) < 0.12, 1.0, 0.0)
    for shortest, longest in ((11, 20), (2, -1), (-1, 5)):
        got = shapes.peak_lines(frame(spark, m, n), 30, 40, shortest, longest, tile).collect()
        want = {(k, *s) for k, x in enumerate((m, n)) for s in kernels.line_shapes(x, shortest, longest)}
        assert {(r.k, r.x1, r.y1, r.x2, r.y2) for r in got} == want and len(got) == len(want)
        assert all((m, n)[r.k][r.y1, r.x1] == r.v1 and (m, n)[r.k][r.y2, r.x2] == r.v2 for r in got)


@pytest.mark.parametrize("tile,ksize", [(4, 3), (5, 2), (512, 3)])
def test_despeckling_across_tiles_equals_the_scan(spark, tile, ksize):
    rng = np.random.default_rng(tile)
    frames = [rng.uniform(0, 12, (13, 17)) for _ in range(2)]
    frames[0][2, 3], frames[0][5], frames[1][:, 4] = np.nan, 20.0, np.inf
    got = {(r.k, r.r, r.c): r.v for r in kernels.despeckle(frame(spark, *frames), 13, 17, ksize, 2.0, 9.0, 0.5, tile).collect()}
    for k, m in enumerate(frames):
        want = kernels.despeckle_frame(m, ksize, 2.0, 9.0, 0.5)
        assert np.allclose([[got[k, r, c] for c in range(17)] for r in range(13)], want, equal_nan=True)
    assert kernels.despeckle(frame(spark, frames[0]).limit(0), 13, 17, 3).collect() == []


@pytest.mark.parametrize("tile", [4, 512])
def test_despeckling_without_some_cells(spark, tile):
    # cells that the cube does not have are passed over by the scan, as those that are not finite
    rng = np.random.default_rng(0)
    m, there = rng.uniform(0, 12, (11, 14)), rng.random((11, 14)) < 0.6
    there[:, 4:8], there[3] = False, False
    got = {(r.r, r.c): r.v for r in kernels.despeckle(frame(spark, m, keep=there), 11, 14, 3, 2.0, 9.0, 0.5, tile).collect()}
    want = kernels.despeckle_frame(np.where(there, m, np.nan), 3, 2.0, 9.0, 0.5)
    assert got.keys() == {(r, c) for r, c in np.argwhere(there).tolist()} and all(np.isclose(v, want[p]) for p, v in got.items())


@pytest.mark.parametrize("fan", [2, 5, 256])
def test_entry_states_equal_the_scan(spark, fan):
    rng = np.random.default_rng(fan)
    rows, want = [], {}
    for k in range(3):
        state = 2
        for i in sorted(rng.choice(200, 60, replace=False).tolist()):
            step = rng.integers(1, 5, 4).tolist()
            rows.append((k, i, step))
            want[k, i] = state
            state = step[state - 1]
    got = scans.entry_states(spark.createDataFrame(rows, "k int, i int, step array<int>").repartition(5), ["k"], 2, store.Kept(spark), fan)
    assert {(r.k, r.i): r.entry for r in got.collect()} == want


def test_components_of_links(spark):
    rng = np.random.default_rng(5)
    links = [(i, i + 1) for i in range(100, 180)] + [(500, i) for i in range(501, 560)] + [(int(a), int(b)) for a, b in rng.integers(1000, 1100, (60, 2))] + [(7, 7), (1, 0), (0, 1)]
    root = {}
    for a, b in links:
        root.setdefault(a, a), root.setdefault(b, b)
    for _ in range(200):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.id: r.part for r in graph.components(spark.createDataFrame(links, "a long, b long"), store.Kept(spark)).collect()}
    alone = {a for a, b in links if a == b} - {x for a, b in links if a != b for x in (a, b)}
    assert got == {i: r for i, r in root.items() if i not in alone}
    assert graph.components(spark.createDataFrame([], "a long, b long"), store.Kept(spark)).collect() == []
