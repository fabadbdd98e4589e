"""Line segments over tiles and shapes, compared with one loop over a whole matrix."""

import numpy as np
import pytest
from whole_frame import find_segments

from prismcube.operators import segments as S


def frames(spark, *ms):
    rows = [(k, r, c, float(v)) for k, m in enumerate(ms) for (r, c), v in np.ndenumerate(m)]
    return spark.createDataFrame(rows, "k int, r int, c int, v double").repartition(5)


def scene(seed, rows=96, cols=120):
    """Bars, an edge across all tiles, a disc and noise, so that shapes cross borders and rectangles hold cells of other shapes."""
    rng = np.random.default_rng(seed)
    y, x = np.mgrid[:rows, :cols]
    m = rng.normal(scale=4.0, size=(rows, cols))
    m += np.where(2 * y - x > 10 + seed, 90, 0) + np.where(np.hypot(y - 30, x - 85) < 18, 120, 0)
    m[70:74, 20:100] += 150
    m[:, 60:63] -= 80
    m += np.where(np.abs(y + 0.3 * x - 60) < 2, 60, 0)
    return m


@pytest.mark.parametrize("scale, tile", [(0.8, 16), (0.8, 512), (1, 24), (0.5, 16)])
def test_tiles_equal_one_loop(spark, scale, tile):
    ms = [scene(s) for s in range(2)] + [np.zeros((96, 120))]
    found = S.line_segments(frames(spark, *ms), 96, 120, (-1, -1), (-1, -1), scale=scale, tile=tile).collect()
    for k, m in enumerate(ms):
        got = sorted(tuple(r)[1:] for r in found if r.k == k)
        want = sorted(find_segments(m, scale=scale))
        assert len(got) == len(want) and (len(want) > 5 or k == 2)
        if want:
            assert np.allclose(got, want, rtol=1e-7, atol=1e-6)


def test_bounds_and_small_frames(spark):
    bar = np.zeros((60, 60))
    bar[:, 30:] = 255
    f = frames(spark, bar)
    found = S.line_segments(f, 60, 60, (-1, -1), (30, -1)).collect()
    assert found and all(abs(r.x1 - 30) < 2 and abs(r.x2 - 30) < 2 and r.nfa > 0 for r in found)
    assert S.line_segments(f, 60, 60, (-1, -1), (-1, 10)).count() == 0
    assert S.line_segments(f.filter("r < 1"), 1, 60).count() == 0 and S.line_segments(f.limit(0), 60, 60).count() == 0
    noise = frames(spark, np.random.default_rng(0).normal(size=(40, 40)) * 0.1)
    assert S.line_segments(noise, 40, 40, (-1, -1), (-1, -1)).count() == 0


def test_tail_of_false_alarms():
    """Terms that are left out do not change the sum."""
    from math import comb, log10

    for n, k, p in ((100, 20, 0.125), (400, 30, 0.125), (300, 200, 0.0625), (50, 1, 0.03), (250, 200, 0.125)):
        exact = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k, n + 1))
        assert abs(S.log_nfa(n, k, p, 3.0) - (-log10(exact) - 3.0)) < 1e-9
