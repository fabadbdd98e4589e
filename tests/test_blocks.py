"""Operators on blocks against those on cells, and what they shuffle."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from prismcube.operators import aggregates, blocks, maps, scans
from prismcube.sources import store


def cells(spark, seed=0, frames=7, rows=23, cols=31, holes=True):
    rng = np.random.default_rng(seed)
    m = np.round(rng.normal(size=(frames, rows, cols)), 3).astype("f4").astype(float)
    if holes:
        m[rng.random(m.shape) < 0.05] = np.nan
        m[2, 5:9, :], m[3, :, 30] = 0.5, np.nan
    there = rng.random(m.shape) < (0.9 if holes else 2)
    if holes:
        there[1, :8, :8] = False  # a whole tile
    rows_ = [(int(k), int(r), int(c), float(m[k, r, c])) for k, r, c in np.argwhere(there)]
    return spark.createDataFrame(rows_, "k int, r int, c int, v double").repartition(4)


def same(got, want, keys=("k", "r", "c")):
    value = [c for c in want.columns if c not in keys]
    a, b = ({tuple(r[k] for k in keys): [np.nan if r[v] is None else r[v] for v in value] for r in df.collect()} for df in (got, want))
    assert a.keys() == b.keys() and len(a)
    assert all(np.allclose(a[k], b[k], rtol=1e-9, atol=1e-9, equal_nan=True) for k in a)


@pytest.mark.parametrize("tile", [(8, 8), (8, 31), (256, 256)])
def test_blocks_equal_cells(spark, tile):
    f = cells(spark)
    b = blocks.to_blocks(f, tile, "double")
    same(blocks.to_cells(b), f)
    across = -(-31 // tile[1])
    same(blocks.line_stats(b, across, 0.1, 0.2, (0.5,)), aggregates.line_stats(f, 0.1, 0.2, (0.5,)), ("k", "r"))
    place = f.select("r", "c").distinct()
    a, c = (blocks.to_blocks(place.select(F.lit(0).alias("k"), "r", "c", v.alias("v")), tile, "double") for v in (1.0 + F.col("c") % 3, F.col("r") - 2.0))
    coef = a.select("ty", "tx", F.col("v").alias("a")).join(c.select("ty", "tx", F.col("v").alias("b")), ["ty", "tx"])
    whole = place.withColumn("a", 1.0 + F.col("c") % 3).withColumn("b", F.col("r") - 2.0)
    full = cells(spark, 3, holes=False)  # coefficients and blocks of one shape
    same(blocks.to_cells(blocks.uniform(blocks.to_blocks(full, tile), coef, (0.5,), -1.0, 3.0, "clamp", 23 * 31)), maps.uniform(full, whole, (0.5,), -1.0, 3.0, "clamp"))
    for method in ("average", "median"):
        g = f.filter(~F.isnan("v"))
        want = aggregates.remove_background(g, 3, method)
        same(blocks.to_cells(blocks.remove_background(_grid(spark, g, tile), 3, method)), want)
    for ksize in (3, 5):
        same(blocks.to_cells(blocks.median_filter(_grid(spark, f, tile), 23, 31, ksize, tile)), aggregates.median_filter(f, 23, 31, ksize))


def _grid(spark, f, tile):
    """Blocks that cover their whole tiles (null where there is no cell), as sources give them."""
    whole = spark.range(7).select(F.col("id").cast("int").alias("k")).withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(22)))).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(30))))
    rows = whole.join(f.withColumn("here", F.lit(True)), ["k", "r", "c"], "left").withColumn("ty", F.floor(F.col("r") / tile[0]).cast("int")).withColumn("tx", F.floor(F.col("c") / tile[1]).cast("int"))
    value = F.when(F.col("here"), F.col("v"))
    out = rows.groupBy("k", "ty", "tx").agg(F.min("r").alias("r0"), F.min("c").alias("c0"), F.countDistinct("r").cast("int").alias("height"), F.countDistinct("c").cast("int").alias("width"), F.array_sort(F.collect_list(F.struct("r", "c", value.alias("v")))).alias("s"))
    return out.select("k", "ty", "tx", "r0", "c0", "height", "width", F.transform("s", lambda x: x["v"]).alias("v"))


def test_empty_blocks(spark):
    b = blocks.to_blocks(cells(spark), (8, 8))
    none = b.limit(0)
    assert blocks.to_cells(none).collect() == [] and blocks.remove_background(none).collect() == [] and blocks.median_filter(none, 5, 5).collect() == [] and blocks.line_stats(none, 2).collect() == []


def shuffled(spark, run):
    """Bytes that an action writes for shuffles."""
    before = {s.stageId() for s in _stages(spark)}
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    return sum(s.shuffleWriteBytes() for s in _stages(spark) if s.stageId() not in before)


def _stages(spark):
    gateway = spark.sparkContext._gateway
    found = spark.sparkContext._jsc.sc().statusStore().stageList(gateway.jvm.java.util.ArrayList(), False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
    return [found.apply(i) for i in range(found.length())]


def test_what_blocks_shuffle(spark, capsys):
    k, n = 8, 256
    rng = np.random.default_rng(0)
    raw = k * n * n * 4
    rows = [(f, y, x, y * 64, x * 64, 64, 64, rng.normal(size=4096).astype("f4").tolist()) for f in range(k) for y in range(n // 64) for x in range(n // 64)]
    b = store.Kept(spark)(spark.createDataFrame(rows, f"{blocks.PLACE}, v array<float>"), "blocks")
    done = lambda df: df.write.format("noop").mode("overwrite").save()
    assert shuffled(spark, lambda: done(blocks.to_cells(b))) == 0
    moved = [shuffled(spark, lambda df=df: done(df)) / raw for df in (blocks.remove_background(b, 4), blocks.remove_background(b, 4, "median"), blocks.line_stats(b, 4, 0.1, 0.1), blocks.median_filter(b, n, n, 3, (64, 64)))]
    long = shuffled(spark, lambda: done(aggregates.remove_background(blocks.to_cells(b), 4))) / raw
    with capsys.disabled():
        print("\nshuffled, by raw cells:", *(f"{x:.3f}" for x in moved), "; background of cells in long form:", f"{long:.2f}")
    assert all(0.5 < x < 1.2 for x in moved) and long > 2


def test_prefix_sums(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), None if i % 50 == 7 else int(rng.integers(-5, 100)), "x") for i in rng.permutation(3000)]
    got = {r.i: r.before for r in scans.prefix_sums(spark.createDataFrame(rows, "i long, n int, total string").repartition(7), ["i"], "n", store.Kept(spark)).collect()}
    at = 0
    for i, n, _ in sorted(rows):
        assert got[i] == at
        at += n or 0
    assert scans.prefix_sums(spark.createDataFrame([], "i long, n int"), ["i"], "n", store.Kept(spark)).collect() == []
