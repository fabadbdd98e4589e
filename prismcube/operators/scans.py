"""Scans with a small state, in parallel: what each step does to the state is a table from entry to exit.

A step is an array whose i-th item is the state (from 1) after it, if it was i before. Steps are composed in groups of
`FAN` neighbours, those again, until one is left of each key; then the states at which groups begin are worked out from the top
down. Each level is one shuffle of a small row a step; no key is gathered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

FAN = 256


def _sorted(by: list[str], table: DataFrame, fan: int) -> DataFrame:
    steps = F.array_sort(F.collect_list(F.struct("i", "step"))).alias("steps")
    return table.groupBy(*by, F.floor(F.col("i") / fan).alias("g")).agg(steps)


def _then(state: Column, step: Column) -> Column:
    return F.element_at(step, state)


def entry_states(steps: DataFrame, by: list[str], first: int, keep, fan: int = FAN) -> DataFrame:
    """(by.., i, entry): the state before each of steps (by.., i, step), in the order of i, if it is first before all. keep(df, name) writes a table."""
    levels = [keep(steps.select(*by, F.col("i").cast("long").alias("i"), F.col("step").cast("array<int>").alias("step")), "steps")]
    while (levels[-1].agg(F.max("i")).first()[0] or 0) > 0:
        whole = F.aggregate("steps", F.transform(F.col("steps")[0]["step"], lambda _, i: (i + 1).cast("int")), lambda acc, s: F.transform(acc, lambda x: _then(x, s["step"])))
        levels.append(keep(_sorted(by, levels[-1], fan).select(*by, F.col("g").alias("i"), whole.alias("step")), "steps"))
    entries = levels[-1].select(*by, "i", F.lit(first).cast("int").alias("entry"))
    for level in reversed(levels[:-1]):
        above = entries.withColumnRenamed("i", "g")
        # the state after each step of a group, in order
        states = F.aggregate("steps", F.array("entry"), lambda acc, s: F.concat(acc, F.array(_then(F.element_at(acc, -1), s["step"]))))
        rows = _sorted(by, level, fan).join(above, [*by, "g"]).select(*by, F.explode(F.arrays_zip(F.col("steps.i").alias("i"), F.slice(states, 1, F.size("steps")).alias("entry"))).alias("e"))
        entries = keep(rows.select(*by, "e.i", "e.entry"), "entries")
    return entries


def _prefixes(rows: DataFrame, order: list[str], value: str, keep, add: np.ufunc, total, both) -> DataFrame:
    """rows with before: value (whole numbers, null as 0) of all rows before, added up from 0 by add, in the order of these columns.

    Rows are sorted by range and added up in their tasks; the tasks' totals, a row each, are added up by a window. Sorted rows are
    written once, since their order is used twice. Rows that are equal in the order are each before those behind.
    """
    part, so_far = "_part", "_sum"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, number = 0, TaskContext.get().partitionId()
        for b in batches:
            v = b.column(b.schema.get_field_index(value)).cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
            before = add.accumulate(np.concatenate([[last], v]).astype(np.int64))
            last = int(before[-1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(v), number, np.int64)), pa.array(before[:-1])], names=[*b.schema.names, part, so_far])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), f"{part} long, {so_far} long"])
    done = keep(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema), "sums")
    totals = done.groupBy(part).agg(total(F.coalesce(F.col(value).cast("long"), F.lit(0))).alias("total"))
    ahead = W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)  # a row a task
    firsts = totals.select(part, F.coalesce(total("total").over(ahead), F.lit(0)).alias("_first"))
    return done.join(F.broadcast(firsts), part).withColumn("before", both(F.col(so_far), F.col("_first"))).drop(part, so_far, "_first")


def prefix_sums(rows: DataFrame, order: list[str], value: str, keep) -> DataFrame:
    """rows with before: the sum of value (whole numbers, null as 0) over all rows before, in the order of these columns (see _prefixes)."""
    return _prefixes(rows, order, value, keep, np.add, F.sum, lambda a, b: a + b)


def prefix_max(rows: DataFrame, order: list[str], value: str, keep) -> DataFrame:
    """rows with before: the largest value (whole numbers from 0, null as 0) of all rows before, 0 if there is none."""
    return _prefixes(rows, order, value, keep, np.maximum, F.max, F.greatest)
