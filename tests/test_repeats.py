"""Chains of kept records over many blocks against the scan in order."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from prismcube.operators import repeats


def scan(times, tolerance):
    out, last = [], None
    for i, t in enumerate(times):
        if last is None or abs(t - last) > tolerance:
            out.append(i)
            last = t
    return out


def tracks(n):
    rng = np.random.default_rng(n)
    return {
        "walk": np.cumsum(rng.normal(size=n)) * 0.3, "steps": np.arange(n) * 0.25, "same": np.full(n, 7.0), "noise": rng.uniform(0, 1.5, n), "back": -np.arange(n) // 40 * 1.0,
        "long still": np.concatenate([[5.0], np.zeros(n - 2) + 0.25, [9.0]]), "edge": np.round(rng.integers(0, 30, n) * 0.1, 1), "two": np.array([1.0, 3.0]), "one": np.array([4.0]),
    }


def test_next_different_equals_the_search():
    for times in tracks(300).values():
        t = times.tolist()
        for tolerance in (0.0, 0.1, 1.0):
            want = [next((j for j in range(i + 1, len(t)) if abs(t[j] - t[i]) > tolerance), len(t)) for i in range(len(t))]
            assert repeats.next_different(t, tolerance) == want
            high, low = np.maximum.accumulate(times), np.minimum.accumulate(times)
            for v in (-3.0, 0.0, 0.3, 5.1, 40.0):
                assert repeats.first_different(high, low, v, tolerance) == next((j for j, x in enumerate(t) if abs(x - v) > tolerance), len(t))


@pytest.mark.parametrize("block", [7, 64, 65_536])
def test_repeats_by_blocks_equal_the_scan(spark, block):
    rows = [(name, i * 3, float(t), "x") for name, times in tracks(500).items() for i, t in enumerate(times)]
    order = np.random.default_rng(0).permutation(len(rows)).tolist()
    df = spark.createDataFrame([rows[i] for i in order] + [("walk", -1, None, "y"), ("walk", -2, float("nan"), "y")], "part string, ord long, time double, b string").repartition(5)
    want = {(name, 3 * i) for name, times in tracks(500).items() for i in scan(times, 0.9)}
    got = repeats.drop_repeats_scan(df, 0.9, block).collect()
    assert {(r.part, r.ord) for r in got} == want and len(got) == len(want) and got[0].b == "x"
    few = df.select("part", "ord", "time")
    assert {(r.part, r.ord) for r in repeats.drop_repeats_scan(few, 0.9, block).collect()} == want
    assert repeats.drop_repeats_scan(df.limit(0), 0.9, block).collect() == []


def test_repeats_of_one_long_part(spark):
    n = 2_000_000
    df = spark.range(n).select(F.lit(1).alias("part"), F.col("id").alias("ord"), (F.floor(F.col("id") / 7) * 0.5).alias("time"))
    got = repeats.drop_repeats_scan(df, 0.7).agg(F.count(F.lit(1)), F.sum("ord"), F.max("ord")).first()
    want = [i * 14 for i in range(n // 14 + 1) if i * 14 < n]  # every other step of seven equal ones
    assert tuple(got) == (len(want), sum(want), want[-1])
