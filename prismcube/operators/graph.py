"""Connected parts of a table of links, by hooking and contraction in joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(links: DataFrame, keep) -> DataFrame:
    """(id, part) for every id of links (a, b; longs): part is the smallest id that links reach. keep(df, name) writes a table.

    Each round sends every id to the smallest one beside it and contracts the links by that; at least half of the ids
    of a part go, so rounds are few. The maps are then chained from the last to the first. Minima combine before the
    shuffle, and joins are by id, so no part is gathered.
    """
    left = keep(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    maps: list[DataFrame] = []
    while not left.isEmpty():
        ways = F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("b").alias("other")), F.struct(F.col("b").alias("id"), F.col("a").alias("other"))))
        to = keep(left.select(ways.alias("w")).groupBy("w.id").agg(F.min("w.other").alias("other")).select("id", F.least("id", "other").alias("to")), "hooks")
        maps.append(to)
        moved = left.join(to.toDF("a", "x"), "a").join(to.toDF("b", "y"), "b").filter("x <> y")
        left = keep(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
    if not maps:
        return links.sparkSession.createDataFrame([], "id long, part long")
    out = maps[-1].toDF("id", "part")
    for to in reversed(maps[:-1]):
        out = to.join(out.toDF("to", "last"), "to", "left").select("id", F.coalesce("last", "to").alias("part"))
    return keep(out, "parts")
