"""Records that differ from the last one kept, in order, without a task that holds a part.

Which record is next kept depends on the one kept before, so the kept ones are a chain of jumps from the first:

1. Records are sorted by range and cut into blocks of one part. Inside a block the next record that differs from each
   by more than the tolerance is found from running extrema, and with it the record at which a chain that begins there ends.
2. The next record behind a block depends on the value at which the chain ends alone. It is searched by doubling: windows
   of 1, 2, 4, ... blocks know their extrema, and a search skips the largest ones that hold nothing that differs.
3. That gives a jump from each (block, end value) to one of a later block. The jumps that lie on the chain from the part's first
   record are found by doubling, too: those reached in up to 2^k jumps, and all jumps of 2^k. Each round is two joins of small rows.
4. So each block on the chain knows at which record the chain enters, and marks its own.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources import store

BLOCK = 65_536


def next_different(t: list[float], tolerance: float) -> list[int]:
    """For each place the first one behind it whose value differs by more than the tolerance; len(t) if there is none."""
    n = len(t)
    out = [n] * n
    # places behind i that are larger (smaller) than all between, nearest last
    up: list[int] = []
    down: list[int] = []
    up_keys: list[float] = []
    down_keys: list[float] = []
    for i in range(n - 1, -1, -1):
        x = t[i]
        for stack, keys, sign in ((up, up_keys, 1), (down, down_keys, -1)):
            k = bisect_left(keys, -(sign * x + tolerance)) - 1
            while k + 1 < len(stack) and sign * (t[stack[k + 1]] - x) > tolerance:  # the sum above may be rounded
                k += 1
            while k >= 0 and not sign * (t[stack[k]] - x) > tolerance:
                k -= 1
            if k >= 0:
                out[i] = min(out[i], stack[k])
            while stack and keys[-1] >= -sign * x:
                stack.pop()
                keys.pop()
            stack.append(i)
            keys.append(-sign * x)
    return out


def first_different(high: np.ndarray, low: np.ndarray, v: float, tolerance: float) -> int:
    """The first place whose value differs from v by more than the tolerance; high and low are running extrema."""
    n, found = len(high), []
    for run, sign in ((high, 1), (-low, -1)):
        k = int(np.searchsorted(run, sign * v + tolerance, side="right"))
        while k > 0 and run[k - 1] - sign * v > tolerance:
            k -= 1
        while k < n and not run[k] - sign * v > tolerance:
            k += 1
        found.append(k)
    return min(found)


def drop_repeats_scan(records: DataFrame, tolerance: float = 1e-5, block: int = BLOCK) -> DataFrame:
    """Records (part, ord, time and others) whose time differs from that of the last one kept by more than the tolerance; the first of a part is kept.

    ord is unique within a part. Records without a part or a time (null, NaN) are left out.
    """
    keep = store.Kept(records.sparkSession)
    types = {f.name: f.dataType.simpleString() for f in records.schema}
    own = records.select("part", "ord", F.col("time").cast("double").alias("time")).filter("part IS NOT NULL AND time IS NOT NULL AND NOT isnan(time)")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def emit(rows: pa.Table) -> pa.RecordBatch:
            t = rows.column("time").to_pylist()
            after = next_different(t, tolerance)
            last = list(range(len(t)))
            for i in range(len(t) - 1, -1, -1):
                if after[i] < len(t):
                    last[i] = last[after[i]]
            ends = sorted({t[i] for i in last})
            one = lambda c: pa.array([rows.column(c).to_pylist()], pa.list_(rows.schema.field(c).type))
            ints = lambda x: pa.array([x], pa.list_(pa.int32()))
            columns = [rows.column("part").combine_chunks().slice(0, 1), rows.column("ord").combine_chunks().slice(0, 1), one("ord"), one("time"), ints(after), ints(last), pa.array([ends], pa.list_(pa.float64())), pa.array([min(t)]), pa.array([max(t)])]
            return pa.RecordBatch.from_arrays(columns, names=["part", "first", "ords", "times", "after", "last", "ends", "low", "high"])

        for b in batches:
            if not b.num_rows:
                continue
            parts = b.column("part").to_pylist()
            cuts = [0, *(i for i in range(1, len(parts)) if parts[i] != parts[i - 1]), len(parts)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                piece = b.slice(lo, hi - lo)
                if held and (held[0].column("part")[0].as_py() != parts[lo] or sum(h.num_rows for h in held) >= block):
                    yield emit(pa.Table.from_batches(held))
                    held = []
                for at in range(0, piece.num_rows, block):
                    held.append(piece.slice(at, block))
                    if sum(h.num_rows for h in held) >= block:
                        yield emit(pa.Table.from_batches(held))
                        held = []
        if held:
            yield emit(pa.Table.from_batches(held))

    schema = f"part {types['part']}, first {types['ord']}, ords array<{types['ord']}>, times array<double>, after array<int>, last array<int>, ends array<double>, low double, high double"
    cutted = keep(own.repartitionByRange("part", "ord").sortWithinPartitions("part", "ord").mapInArrow(cut, schema), "cut")
    # numbers of blocks within their part: a row a block
    number = cutted.select("part", "first", (F.row_number().over(W.partitionBy("part").orderBy("first")) - 1).cast("long").alias("b"))
    blocks = keep(cutted.join(number, ["part", "first"]), "blocks")
    levels = [keep(blocks.select("part", "b", "low", "high"), "level")]
    most = levels[0].agg(F.max("b")).first()[0]
    if most is None:
        return records.limit(0)
    while 1 << len(levels) <= most + 1:
        ahead = levels[-1].select("part", (F.col("b") - (1 << (len(levels) - 1))).alias("b"), F.col("low").alias("l2"), F.col("high").alias("h2"))
        levels.append(keep(levels[-1].join(ahead, ["part", "b"], "left").select("part", "b", F.least("low", "l2").alias("low"), F.greatest("high", "h2").alias("high")), "level"))
    wanted = blocks.select("part", F.col("b").alias("from"), F.explode("ends").alias("v")).withColumn("b", F.col("from") + 1)
    for k in range(len(levels) - 1, -1, -1):
        # a window without anything that differs is skipped; behind the part's end nothing is
        same = F.col("low").isNotNull() & ~(F.abs(F.col("high") - F.col("v")) > tolerance) & ~(F.abs(F.col("low") - F.col("v")) > tolerance)
        wanted = wanted.join(levels[k], ["part", "b"], "left").select("part", "from", "v", F.when(same, F.col("b") + (1 << k)).otherwise(F.col("b")).alias("b"))
    wanted = keep(wanted, "wanted")

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                t = np.array(b.column("times")[r].as_py())
                j = first_different(np.maximum.accumulate(t), np.minimum.accumulate(t), b.column("v")[r].as_py(), tolerance)
                end = float(t[b.column("last")[r].as_py()[j]])
                yield pa.RecordBatch.from_arrays([b.column("part").slice(r, 1), *(pa.array([b.column(c)[r].as_py()], kind) for c, kind in (("from", pa.int64()), ("v", pa.float64()), ("b", pa.int64()))), pa.array([j], pa.int32()), pa.array([end])], names=["part", "from", "v", "b", "j", "w"])

    jumps = wanted.join(blocks.select("part", "b", "times", "last"), ["part", "b"]).select("part", "from", "v", "b", "times", "last")
    jumps = keep(jumps.mapInArrow(enter, f"part {types['part']}, from long, v double, b long, j int, w double"), "jumps")
    reached = keep(blocks.filter("b = 0").select("part", F.col("b").alias("from"), F.element_at("times", F.col("last")[0] + 1).alias("v")), "reached")
    far = jumps.select("part", "from", "v", "b", "w")
    while True:
        more = reached.join(far, ["part", "from", "v"]).select("part", F.col("b").alias("from"), F.col("w").alias("v"))
        more = keep(more.join(reached, ["part", "from", "v"], "left_anti").distinct(), "more")
        if more.isEmpty():
            break
        reached = keep(reached.unionByName(more), "reached")
        twice = far.toDF("part", "f0", "v0", "from", "v").join(far, ["part", "from", "v"]).select("part", F.col("f0").alias("from"), F.col("v0").alias("v"), "b", "w")
        far = keep(twice, "far")
    entries = jumps.join(reached, ["part", "from", "v"], "left_semi").select("part", "b", "j").distinct()
    entries = entries.unionByName(blocks.filter("b = 0").select("part", "b", F.lit(0).alias("j")))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                after, i, own = b.column("after")[r].as_py(), b.column("j")[r].as_py(), []
                while i < len(after):
                    own.append(i)
                    i = after[i]
                at = pa.array(own, pa.int64())
                ords, times = b.column("ords")[r].values.take(at), b.column("times")[r].values.take(at)
                yield pa.RecordBatch.from_arrays([b.column("part").take(pa.array([r] * len(own), pa.int64())), ords, times], names=["part", "ord", "time"])

    on = blocks.join(entries, ["part", "b"]).select("part", "j", "ords", "times", "after")
    kept = on.mapInArrow(mark, f"part {types['part']}, ord {types['ord']}, time double")
    if set(records.columns) == {"part", "ord", "time"} and types["time"] == "double":
        return kept.select(*records.columns)
    return records.join(kept.select("part", "ord"), ["part", "ord"], "left_semi").select(*records.columns)
