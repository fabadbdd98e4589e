"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact budgets.

Sources weigh 1, 2, 3, repeating, in code-point order (null last), and share `share` of all sizes by
weight; no source gets more than `most` times its size, and what it cannot take is shared anew by weight
among the others, round by round, until none is above: each round is one sum over the sources. Documents
get a random key (md5 of seed and id), are range-partitioned and sorted by source and key, so that a large
source spans many partitions; each partition gives running sums, and sums of the partitions before give
the position of each document on its source's line. The line is repeated whole as often as the budget
allows and then cut at the exact rest, so a source's taken sizes are its rounded target. Ranks of sources
come from running counts in the same way, so no table is ordered in one task.

Words are counted once and saved; the query shuffles ids, sources, sizes and keys, never texts. The mix of whole
documents sorts the rows themselves, so that each row is repeated as its own place says.

Defined results: null or empty text has size 0 and takes 0; ties of the key (rows of equal or null id) are ordered
by size and a hash of the text, so reruns agree, and each row is taken by its own place; an empty table gives no
rows; a corpus of size 0 has targets 0; further columns are ignored, or kept with their rows whatever their names;
null sources are a source of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from .common import SPACE_CLASS, Scratch, arrow_rows, count_words, map_arrow, read, texts_of, whole_row

SEED = "mix-1"
MOST = 3
#: Rows up to which a table of sources, or of their parts, is broadcast.
BROADCAST_SOURCES = 100_000


def sizes(docs: DataFrame, carry: bool = False) -> DataFrame:
    """(doc_id, source, size, tie): words of the whole text and a hash of it; with carry, the row itself as _row, too."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.xxhash64("text").alias("tie"), *([whole_row(docs).alias("_row")] if carry else []), "text")
    names = ["doc_id", "source", "size", "tie", *(["_row"] if carry else [])]
    kinds = {f.name: f for f in rows.schema.fields}
    schema = StructType([kinds["doc_id"], kinds["source"]]).add("size", LongType()).add(kinds["tie"])
    if carry:
        schema = schema.add(kinds["_row"])

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            size = pa.array([count_words(t, SPACE_CLASS) for t in texts_of(batch, batch.num_columns - 1)], pa.int64())
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), size, *batch.columns[2:-1]], names=names)

        return run

    return map_arrow(rows, make, schema)


def _running(scratch: Scratch, df: DataFrame, order: list, by: str | None, amount: str | None, name: str) -> DataFrame:
    """df with `before`: the sum of amount (null: the number of rows) over the rows before each in the order, for each value of by.

    Rows are range-partitioned and sorted; each partition runs its sums, partitions' totals are added by a join.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    names = df.columns
    schema = StructType(list(df.schema.fields)).add("part", IntegerType()).add("local", LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, total = TaskContext.get().partitionId(), object(), 0
        for batch in batches:
            keys = batch.column(names.index(by)).to_pylist() if by else [None] * batch.num_rows
            amounts, before = batch.column(names.index(amount)).to_pylist() if amount else [1] * batch.num_rows, []
            for key, n in zip(keys, amounts, strict=True):
                if key != last:
                    last, total = key, 0
                before.append(total)
                total += n
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(before, pa.int64())], names=[*names, "part", "local"])

    with arrow_rows(scratch.spark, 1000):
        local = scratch.save(ordered.mapInArrow(run, schema), name)
    key = F.col(by) if by else F.lit(None).cast("string")
    total = F.sum(amount) if amount else F.count(F.lit(1))
    parts = local.groupBy(key.alias("p_key"), F.col("part").alias("p_part")).agg(total.alias("n"))  # a key's parts: the partitions that it spans
    line = W.partitionBy("p_key").orderBy("p_part")
    parts = parts.select("p_key", "p_part", (F.sum("n").over(line) - F.col("n")).alias("base"))
    if parts.count() <= BROADCAST_SOURCES:
        parts = F.broadcast(parts)
    out = local.join(parts, (F.col("part") == F.col("p_part")) & key.eqNullSafe(F.col("p_key")))
    return out.select(*names, (F.col("local") + F.col("base")).cast("long").alias("before"))


def targets(scratch: Scratch, totals: DataFrame, share: float = 1.0, most: int = MOST) -> DataFrame:
    """(source, source_size, target) of totals (source, source_size).

    A level times its weight is a source's share. With the full sources' caps taken off, the others share what is left at a
    level that rises from round to round, until it fills no more; rounds are at most the sources and mostly few.
    """
    ranked = _running(scratch, totals, [F.col("source").isNull(), F.col("source")], None, None, "sources")
    weight, cap = (F.col("before") % 3 + 1).cast("double"), most * F.col("source_size").cast("double")
    t = scratch.save(ranked.select("source", "source_size", weight.alias("weight"), cap.alias("cap")), "weights")
    total = share * float(t.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, -1
    while True:
        over = F.col("cap") < level * F.col("weight")
        r = t.agg(F.count(F.when(over, 1)).alias("n"), F.sum(F.when(over, F.col("cap"))).alias("caps"), F.sum(F.when(~over, F.col("weight"))).alias("weights")).first()
        if r.n == full or not r.weights:
            break
        full, level = r.n, (total - (r.caps or 0.0)) / r.weights
    target = F.col("cap") if not r.weights else F.least("cap", level * F.col("weight"))
    return t.select("source", "source_size", target.alias("target"))


def positions(items: DataFrame, scratch: Scratch, seed: str = SEED) -> DataFrame:
    """items (doc_id, source, size, tie, ..) with `before`: the sizes before it on its source's line."""
    keyed = scratch.save(items, "sizes").withColumn("key", F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    order = [F.col("source").isNull(), *(F.col(c) for c in ("source", "key", "doc_id", "size", "tie"))]
    return _running(scratch, keyed, order, "source", "size", "line").drop("key")


def mix(items: DataFrame, share: float = 1.0, most: int = MOST, seed: str = SEED, whole: bool = False) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, and _row if it is there) of items (doc_id, source, size, tie).

    whole: documents are taken whole; the one at the cut is, if at least half of it fits.
    """
    scratch = Scratch(items.sparkSession)
    placed = positions(items, scratch, seed)
    goal = targets(scratch, placed.groupBy("source").agg(F.sum("size").alias("source_size")), share, most)
    small = goal.count() <= BROADCAST_SOURCES
    goal = goal.withColumnRenamed("source", "g_source")
    out = placed.join(F.broadcast(goal) if small else goal, F.expr("source <=> g_source"))
    budget = F.round("target").cast("long")
    out = out.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(budget / F.greatest("source_size", F.lit(1)))).otherwise(0).cast("long"))
    rest = budget - F.col("epochs") * F.col("source_size")
    out = out.withColumn("room", F.least(F.greatest(rest - F.col("before"), F.lit(0)), F.col("size")))
    extra = F.when(2 * F.col("room") >= F.col("size"), F.col("size")).otherwise(0) if whole else F.col("room")
    taken = (F.col("epochs") * F.col("size") + extra).cast("long").alias("taken")
    return out.select("doc_id", "source", "size", "source_size", "target", taken, *(c for c in ("_row",) if c in items.columns))


def mixed_documents(docs: DataFrame, share: float = 1.0, most: int = MOST, seed: str = SEED) -> DataFrame:
    """docs in docs' columns, each row as often as the mix takes it whole (never more than `most` times)."""
    with arrow_rows(docs.sparkSession, 1000):
        taken = mix(sizes(docs, carry=True), share, most, seed, whole=True).filter("taken > 0")
    times = F.sequence(F.lit(1), (F.col("taken") / F.col("size")).cast("int"))
    return taken.select("_row", F.explode(times).alias("copy")).select(*(F.col("_row").getField(c).alias(c) for c in docs.columns))


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents by the contract's weights."""
    return mix(sizes(read(spark, sf_dir, "documents"))).select("doc_id", "size", "source_size", "target", "taken")


OP9_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, ((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1) * 1.0e0 AS weight FROM d GROUP BY source),
c AS (SELECT *, 3e0 * source_size AS cap, sum(source_size) OVER () * 1.0e0 AS total,
      sum(3e0 * source_size) OVER o - 3e0 * source_size AS caps_before, sum(weight) OVER () - sum(weight) OVER o + weight AS weights_from
      FROM s WINDOW o AS (ORDER BY 3e0 * source_size / weight, source IS NULL, source ROWS UNBOUNDED PRECEDING)),
l AS (SELECT max((total - caps_before) / weights_from) AS level FROM c),
g AS (SELECT source, source_size, least(cap, level * weight) AS target FROM c, l),
p AS (SELECT d.doc_id, d.size, source_size, target, CAST(round(target) AS BIGINT) AS budget,
      CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('mix-1:' || d.doc_id), d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS BIGINT) - d.size AS before
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size > 0 THEN budget // source_size * size + least(greatest(budget % source_size - before, 0), size) ELSE 0 END AS BIGINT) AS taken FROM p
"""
