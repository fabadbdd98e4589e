"""Poses of lines as columns, compared with matrices."""

import numpy as np

from prismcube.functions import geo


def test_pixels_to_plane_equal_the_matrices(spark):
    rng = np.random.default_rng(5)
    intrinsic, own, shift = np.array([[1500.0, 2.0, 300.0], [0, 1400.0, 20.0], [0, 0, 1]]), geo.rotation((0.02, -0.1, 0.3)), np.array([0.3, -0.2, 0.6])
    rows = [(i, *rng.uniform(-200, 200, 2).tolist(), float(rng.uniform(0, 50)), rng.uniform(900, 2000, 3).tolist(), rng.uniform(-0.2, 0.2, 3).tolist()) for i in range(50)]
    extra = [(50, None, 1.0, 0.0, [0.0, 0.0, 9.0], [0.0] * 3), (51, 1.0, 1.0, 0.0, None, [0.0] * 3), (52, 1.0, 1.0, 0.0, [1.0], []), (53, 1.0, 1.0, None, [0.0, 0.0, 9.0], [0.0] * 3)]
    df = spark.createDataFrame([*rows, *extra], "id int, u double, v double, h double, place array<double>, a array<double>")
    got = {r.id: (r.x, r.y) for r in geo.pixels_to_plane(df, intrinsic, own, shift).collect()}
    for i, u, v, h, place, a in rows:
        want = geo.to_plane(geo.camera_matrix(intrinsic, own, shift, geo.rotation(a), np.array(place)), (u, v), h)
        assert np.allclose(got[i], want[:2], rtol=1e-9, atol=1e-6)
    assert all(got[i] == (None, None) for i in range(50, 54))
    assert geo.pixels_to_plane(df.limit(0), intrinsic, own, shift).count() == 0


def test_quaternions_equal_the_matrices(spark):
    rng = np.random.default_rng(6)
    angles = [rng.uniform(-1.2, 1.2, 3).tolist() for _ in range(30)]
    df = spark.createDataFrame([(i, a) for i, a in enumerate([*angles, [np.pi, 0.0, 0.0], None])], "id int, a array<double>")
    got = {r.id: r.q for r in df.select("id", geo.quaternion_column(df.a).alias("q")).collect()}
    assert all(np.allclose(got[i], geo.to_quaternion(geo.rotation(a))) for i, a in enumerate(angles))
    assert got[30] is None and got[31] is None
