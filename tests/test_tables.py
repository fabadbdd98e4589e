"""Tiles of large regions, and other joins and scans over tracks."""

import numpy as np
from pyspark.sql import functions as F

from prismcube.operators import tables as T
from prismcube.queries import QUERIES


def test_tiles_of_a_region_are_made_by_several_tasks(spark, monkeypatch):
    regions = spark.createDataFrame([(1, 5, 7, 900, 2100), (2, 0, 0, 16_000, 16_000)], "id int, rx long, ry long, rw long, rh long").coalesce(1)
    want = {tuple(r) for r in T.tile_grid(regions, 800).collect()}
    assert len(want) == 1 * 3 + 20 * 20 and (1, 0, 2, 5, 1407, 900, 700) in want
    monkeypatch.setattr(T, "PIECE", 16)
    monkeypatch.setattr(T, "TASK", 100)
    got = T.tile_grid(regions, 800)
    tasks = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert {tuple(r) for r in got.collect()} == want and sum(tasks) == len(want)
    assert len(tasks) > 2 and max(tasks) < 250


def test_grid_neighbours_are_those_of_its_tiles(spark):
    regions = spark.createDataFrame([(1, 5, 7, 900, 2100), (2, 0, 0, 4000, 3000), (3, 0, 0, 100, 100), (None, 0, 0, 4000, 3000)], "id int, rx long, ry long, rw long, rh long")
    got = sorted(tuple(r) for r in T.grid_neighbours(regions, 800).collect())
    assert got == sorted(tuple(r) for r in T.tile_neighbours(T.tile_grid(regions, 800), ("id",)).collect()) and len(got) == 4 + 2 * (4 * 4 + 5 * 3) + 4 * 4 * 3
    holes = T.tile_grid(regions, 800).filter("id = 2 AND NOT (tx = 1 AND ty = 1)")
    assert not any((r.nx, r.ny) == (1, 1) for r in T.tile_neighbours(holes, ("id",)).collect())


def test_tiles_are_not_broadcast(spark, sf):
    plan = QUERIES["j10_tile_neighbours"](spark, sf)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" not in plan and "BroadcastExchange" not in plan
    regions = spark.createDataFrame([(1, 0, 0, 4000, 3000)], "id int, rx long, ry long, rw long, rh long")
    assert "BroadcastHashJoin" not in T.tile_neighbours(T.tile_grid(regions, 800), ("id",))._jdf.queryExecution().toString()


def test_interval_groups_are_not_gathered_and_equal_one_scan(spark):
    rng = np.random.default_rng(4)
    for spread, longest, n in ((3000, 12, 400), (600, 90, 300), (100_000, 3, 50), (50, 2000, 40)):
        first = rng.integers(0, spread, n).tolist()
        files = [(f"f{i:03d}", a, a + int(rng.integers(0, longest))) for i, a in enumerate(first)]
        files += [("open", spread // 3, None), ("none", None, None), ("none2", None, None)]
        rows = {}
        for f in files:
            if f[1] not in rows:
                rows[f[1]] = f
        ends, want = [], {}
        for name, a, b in sorted((f for f in rows.values() if f[1] is not None), key=lambda f: f[1]):
            g = max((i for i, x in enumerate(ends) if x < a), default=len(ends))
            ends[g : g + 1] = [float("inf") if b is None else b]
            want[name] = (a, b, g)
        want["none"] = (None, None, len(ends))
        got = T.group_intervals(spark.createDataFrame(files, "name string, first long, last long"))
        assert {r.name: (r.first, r.last, r.grp) for r in got.collect()} == want
        plan = got._jdf.queryExecution().toString()
        assert "FlatMapGroupsInArrow" not in plan and "SinglePartition" not in plan.split("BroadcastExchange")[0]
