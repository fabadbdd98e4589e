"""Splines along tracks in blocks, compared with one dense solution."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from prismcube.functions import interp, splines


@pytest.mark.parametrize("degree", [2, 3, 5])
def test_blocks_equal_the_dense_solution(spark, degree):
    rng = np.random.default_rng(degree)
    tracks = {name: rng.normal(size=n).cumsum() for name, n in (("long", 400), ("one block", 27), ("two", 28), ("uneven", 69), ("least", degree + 2))}
    knots = spark.createDataFrame([(p, i, float(v)) for p, y in tracks.items() for i, v in enumerate(y)], "part string, i int, y double").orderBy(F.rand(1))
    at = {p: np.concatenate([rng.uniform(0, len(y) - 1, 60), [0, len(y) - 1, 1.5]]) for p, y in tracks.items()}
    places = spark.createDataFrame([(p, float(t)) for p, ts in at.items() for t in ts], "part string, t double")
    got = splines.along(knots, places, degree, block=14, fan=3).collect()
    assert len(got) == 63 * len(tracks)
    for p, y in tracks.items():
        rows = sorted((r.t, r.v) for r in got if r.part == p)
        want = interp.cardinal_spline(np.arange(len(y)), y, np.array([t for t, _ in rows]), degree)
        assert np.abs(want - [v for _, v in rows]).max() < 1e-8


def test_tracks_without_a_spline(spark):
    """Nulls, gaps, few knots, places outside and empty tables give null, and further columns stay."""
    good = [("a", i, float(i * i)) for i in range(40)]
    rows = [*good, *(("gap", i, 1.0) for i in range(40) if i != 7), *(("null", i, None if i == 3 else 1.0) for i in range(40)), *(("few", i, 1.0) for i in range(4)), *((None, i, 1.0) for i in range(9)), *(("unnumbered", None if i == 39 else i, 1.0) for i in range(40))]
    knots = spark.createDataFrame(rows, "part string, i int, y double")
    places = spark.createDataFrame([("a", 2.5, 1), ("a", 2.5, 1), ("a", -0.1, 2), ("a", 39.1, 3), ("a", None, 4), ("gap", 2.0, 5), ("null", 2.0, 6), ("few", 1.0, 7), (None, 1.0, 8), ("unnumbered", 1.0, 9)], "part string, t double, n int")
    got = sorted(((r.n, r.v) for r in splines.along(knots, places, block=14).collect()), key=str)
    assert [n for n, v in got if v is not None] == [1, 1] and all(abs(v - 6.25) < 1e-9 for n, v in got if n == 1) and len(got) == 10
    assert splines.along(knots.limit(0), places).filter("v IS NOT NULL").count() == 0
    assert splines.along(knots, places.limit(0)).count() == 0


def test_a_number_twice_is_an_error(spark):
    knots = spark.createDataFrame([("a", i, 1.0) for i in [0, 1, 1, *range(3, 20)]], "part string, i int, y double")
    with pytest.raises(Exception, match="comes twice"):
        splines.coefficients(knots, block=14).collect()
