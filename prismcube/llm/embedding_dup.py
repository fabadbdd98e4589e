"""Embedding near-duplicates: PCA-ordered tiled comparison inside each label.

1. Rows without label or vector, zero vectors and vectors with null or non-finite components link with
   nothing. Equal vectors of a label are one class, the smallest id, with a count.
2. The second-moment matrix of the unit vectors (a sum of fixed-size matrices over tasks) gives the
   principal directions; unit vectors are rotated into them, largest first, so leading dimensions carry
   most of the products. Rotation keeps products; nothing is dropped.
3. Classes are range-partitioned and sorted by label and leading coordinate, and cut into tiles of at most
   `tile` vectors; up to `SUPER` neighbours are a super-tile, one row. Tiles and super-tiles have the box of their first
   coordinates. Two of a label are compared unless their boxes are farther apart than two unit vectors of that cosine
   can be (sqrt(2 - 2 t)). Each pair of super-tiles meets in one task, which goes through their pairs of tiles; so a
   vector is sent once for each super-tile that its own is compared with. The pairs come from a join of the boxes
   alone, salted on one side, so that a large label spreads.
4. In a pair of tiles, products are accumulated over blocks of dimensions, leading ones first; after each
   block, partial product + product of the suffix norms bounds the cosine, pairs that cannot reach the
   threshold stop, and the rest go on; what is left is decided by the cosine of the vectors as given, in
   double precision.
5. Each pair of super-tiles returns, for its vectors, the links (weighted by class counts) and a spanning forest
   of them, not the links themselves; components come from common.connected_components.

All vectors of a label have to be compared, so work inside a label grows with the pairs of tiles that the
boxes leave; a pair of super-tiles bounds a task's memory, and a large label spans many of them.

Defined results: a vector that links with nothing has 0 links and is its own component; a null id keeps a
null component, has links counted as 0 and is kept; rows of equal id are classes by their vector, and
each counts, and has the links of all vectors of its id's class; vectors are compared only with those of equal length
(a tile holds one length); an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, arrow_rows, connected_components, read

THRESHOLD = 0.93
TILE = 1024
#: Tiles of a super-tile, and parts that one side of their join is dealt over.
SUPER, SALTS = 8, 8
#: Dimensions in each step of the accumulation, and coordinates in a tile's box.
STEP, BOX = 8, 4
#: Room for rounding in bounds; decisions are made by the exact cosine.
SLACK = 1e-9

_TILE = "label long, size int, tile string, ends binary, ids binary, counts binary, raw binary, lo array<double>, hi array<double>"


def _unit(raw: np.ndarray) -> np.ndarray:
    # scaled first, so that squares neither overflow nor vanish
    raw = raw / np.abs(raw).max(axis=1, keepdims=True)
    return raw / np.sqrt((raw * raw).sum(axis=1, keepdims=True))


def _matrix(batch: pa.RecordBatch, column: int, size: int) -> np.ndarray:
    col = batch.column(column)
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def directions(vectors: DataFrame, size: int) -> np.ndarray:
    """Columns: principal directions of the unit vectors (embedding array<double> of that length), largest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            u = _unit(_matrix(batch, 0, size))
            total += u.T @ u
        yield pa.RecordBatch.from_pydict({"m": [total.tobytes()]})

    add = lambda batches: (pa.RecordBatch.from_pydict({"m": [sum((np.frombuffer(m, np.float64) for b in batches for m in b.column(0).to_pylist()), np.zeros(size * size)).tobytes()]}),)
    sums = vectors.select("embedding").mapInArrow(run, "m binary").repartition(8).mapInArrow(add, "m binary").collect()  # 8 matrices
    moment = sum((np.frombuffer(r.m, np.float64) for r in sums), np.zeros(size * size)).reshape(size, size)
    return np.linalg.eigh(moment)[1][:, ::-1].copy()


def _tiles(classes: DataFrame, rotation: np.ndarray, size: int, tile: int) -> DataFrame:
    """Super-tiles of classes (label, id, n, embedding) of one vector length; ends: where each of its tiles ends."""
    first = classes.sparkSession.sparkContext.broadcast(rotation)

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _unit(_matrix(batch, 3, size)) @ first.value[:, 0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(x)], names=["label", "id", "n", "embedding", "lead"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, int, int, np.ndarray]] = []
        part, number = TaskContext.get().partitionId(), count()

        def emit():
            raw = np.stack([r[3] for r in rows])
            box = (_unit(raw) @ first.value)[:, :BOX]
            ids, counts = np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64)
            ends = np.array([*range(tile, len(rows), tile), len(rows)], np.int64)
            out = {"label": [rows[0][0]], "size": [size], "tile": [f"{size}:{part:06d}:{next(number):09d}"], "ends": [ends.tobytes()], "ids": [ids.tobytes()], "counts": [counts.tobytes()]}
            out |= {"raw": [raw.tobytes()], "lo": [box.min(axis=0).tolist()], "hi": [box.max(axis=0).tolist()]}
            rows.clear()
            return pa.RecordBatch.from_pydict(out, schema=_SCHEMA)

        for batch in batches:
            m = _matrix(batch, 3, size)
            for k, (label, i, n) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True)):
                if rows and (rows[0][0] != label or len(rows) == SUPER * tile):
                    yield emit()
                rows.append((label, i, n, m[k]))
        if rows:
            yield emit()

    led = classes.select("label", "id", "n", "embedding").mapInArrow(lead, "label long, id long, n long, embedding array<double>, lead double")
    return led.repartitionByRange("label", "lead").sortWithinPartitions("label", "lead", "id").mapInArrow(cut, _TILE)


_SCHEMA = pa.schema([("label", pa.int64()), ("size", pa.int32()), ("tile", pa.string()), ("ends", pa.binary()), ("ids", pa.binary()), ("counts", pa.binary()), ("raw", pa.binary()), ("lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64()))])


class _Side:
    """Vectors, turned into principal directions, with the norms of what is left after each dimension."""

    def __init__(self, raw: np.ndarray, rotation: np.ndarray):
        self.raw, self.turned = raw, _unit(raw) @ rotation
        tail = np.sqrt(np.maximum(np.cumsum((self.turned * self.turned)[:, ::-1], axis=1)[:, ::-1], 0))
        self.tail = np.pad(tail, ((0, 0), (0, 1)))

    def part(self, a: int, b: int) -> _Side:
        out = _Side.__new__(_Side)
        out.raw, out.turned, out.tail = self.raw[a:b], self.turned[a:b], self.tail[a:b]
        return out

    def box(self) -> tuple[np.ndarray, np.ndarray]:
        return self.turned[:, :BOX].min(axis=0), self.turned[:, :BOX].max(axis=0)


def _apart(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray], threshold: float) -> bool:
    gap = np.maximum(np.maximum(x[0] - y[1], y[0] - x[1]), 0)
    return float(gap @ gap) > 2 - 2 * threshold + SLACK


def linked(a: _Side, b: _Side, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Indices (i in a, j in b) of the pairs with cosine >= threshold; same: a is b, and i < j only."""
    p, q, tp, tq = a.turned, b.turned, a.tail, b.tail
    d = p.shape[1]
    head = min(STEP, d)
    part = p[:, :head] @ q[:, :head].T
    i, j = np.nonzero(part + np.outer(tp[:, head], tq[:, head]) >= threshold - SLACK)
    if same:
        keep = i < j
        i, j = i[keep], j[keep]
    part = part[i, j]
    at = head
    while at < d and len(i):
        if len(i) * 8 > p.shape[0] * q.shape[0]:  # many are left: one product of the rest is cheaper
            part = part + (p[:, at:] @ q[:, at:].T)[i, j]
            at = d
        else:
            to = min(d, at + STEP)
            part = part + np.einsum("ij,ij->i", p[i, at:to], q[j, at:to])
            at = to
        keep = part + tp[i, at] * tq[j, at] >= threshold - SLACK
        i, j, part = i[keep], j[keep], part[keep]
    exact = np.empty(len(i))
    for lo in range(0, len(i), 65536):
        exact[lo : lo + 65536] = _cosine(a.raw[i[lo : lo + 65536]], b.raw[j[lo : lo + 65536]])
    keep = exact >= threshold
    return i[keep], j[keep]


def _cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore", under="ignore"):
        out = (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))
    odd = ~np.isfinite(out)  # squares out of range: scale first
    if odd.any():
        out[odd] = (_unit(x[odd]) * _unit(y[odd])).sum(axis=1)
    return out


class _Forest:
    """Links among 0..n-1 that join parts."""

    def __init__(self, n: int):
        self.root, self.links = list(range(n)), []

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        root, out = self.root, self.links
        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            x, y = a, b
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            while root[y] != y:
                root[y] = root[root[y]]
                y = root[y]
            if x != y:
                root[max(x, y)] = min(x, y)
                out.append((a, b))


def _compare(pairs: DataFrame, rotations: dict[int, np.ndarray], threshold: float) -> DataFrame:
    """(a, b, links): links of id a for b null; else a link of the forest."""
    shared = pairs.sparkSession.sparkContext.broadcast(rotations)

    def one(r: dict) -> pa.RecordBatch | None:
        rotation, same = shared.value[r["size"]], r["tile_x"] == r["tile_y"]
        sides = []
        for s in "x" if same else "xy":
            side = _Side(np.frombuffer(r[f"raw_{s}"], np.float64).reshape(-1, r["size"]), rotation)
            ends = np.frombuffer(r[f"ends_{s}"], np.int64).tolist()
            parts = [(lo, side.part(lo, hi)) for lo, hi in zip([0, *ends[:-1]], ends, strict=True)]
            sides.append((np.frombuffer(r[f"ids_{s}"], np.int64), np.frombuffer(r[f"counts_{s}"], np.int64), [(lo, p, p.box()) for lo, p in parts]))
        x, y = sides[0], sides[-1]
        ids = x[0] if same else np.concatenate([x[0], y[0]])
        counts = x[1] if same else np.concatenate([x[1], y[1]])
        after, weight, forest = 0 if same else len(x[0]), np.zeros(len(ids), np.int64), _Forest(len(ids))
        for k, (lo_x, p, box_x) in enumerate(x[2]):
            for lo_y, q, box_y in y[2][k:] if same else y[2]:
                if _apart(box_x, box_y, threshold):
                    continue
                i, j = linked(p, q, threshold, same and p is q)
                if len(i):
                    i, j = i + lo_x, j + lo_y + after
                    np.add.at(weight, i, counts[j])
                    np.add.at(weight, j, counts[i])
                    forest.add(i, j)
        if not forest.links:
            return None
        at, links = np.flatnonzero(weight), np.array(forest.links, np.int64)
        b = pa.concat_arrays([pa.nulls(len(at), pa.int64()), pa.array(ids[links[:, 1]])])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([ids[at], ids[links[:, 0]]])), b, pa.array(np.concatenate([weight[at], np.zeros(len(links), np.int64)]))], names=["a", "b", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                out = one({name: batch.column(c)[k].as_py() for c, name in enumerate(batch.schema.names)})
                if out is not None:
                    yield out

    return pairs.mapInArrow(run, "a long, b long, links long")


def embedding_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of vectors (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("long").alias("label"))
    fine = F.exists("embedding", lambda x: x != 0) & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fine = F.coalesce(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & fine, F.lit(False))
    key = F.when(fine, F.sha2(F.array_join(F.transform("embedding", lambda x: (x + F.lit(0.0)).cast("string")), ","), 256))
    rows = rows.withColumn("key", key)
    heads = rows.filter("key is not null").groupBy("label", "key").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("n"), F.first("embedding").alias("embedding"))
    classes = scratch.save(heads, "classes")
    lengths = [r[0] for r in classes.select(F.size("embedding")).distinct().collect()]
    rotations, tiles = {}, None
    for size in sorted(lengths):
        part = classes.filter(F.size("embedding") == size)
        rotations[size] = directions(part, size)
        more = _tiles(part, rotations[size], size, tile)
        tiles = more if tiles is None else tiles.unionByName(more)
    if tiles is None:
        links, components = spark.createDataFrame([], "id long, links long"), spark.createDataFrame([], "id long, component long")
    else:
        tiles = scratch.save(tiles, "tiles")
        meta = tiles.select("label", "size", "tile", "lo", "hi")
        x, y = (meta.select("label", "size", *(F.col(c).alias(f"{c}_{s}") for c in ("tile", "lo", "hi"))) for s in "xy")
        x = x.withColumn("salt", F.pmod(F.xxhash64("tile_x"), F.lit(SALTS)))
        y = y.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        gap = F.aggregate(
            F.transform(F.arrays_zip("lo_x", "hi_x", "lo_y", "hi_y"), lambda b: F.greatest(b["lo_x"] - b["hi_y"], b["lo_y"] - b["hi_x"], F.lit(0.0))), F.lit(0.0), lambda s, g: s + g * g
        )
        near = x.join(y, ["label", "size", "salt"]).filter((F.col("tile_x") <= F.col("tile_y")) & (gap <= 2 - 2 * threshold + SLACK)).select("size", "tile_x", "tile_y")
        blobs = lambda s: tiles.select(F.col("tile").alias(f"tile_{s}"), *(F.col(c).alias(f"{c}_{s}") for c in ("ends", "ids", "counts", "raw")))
        n = max(1, spark.sparkContext.defaultParallelism)
        near = scratch.save(near.repartition(4 * n), "near")
        pairs = near.join(blobs("x"), "tile_x").join(blobs("y"), "tile_y")
        with arrow_rows(spark, 4):  # a pair of super-tiles is one row of two large blobs
            found = scratch.save(_compare(pairs.select("size", *(f"{c}_{s}" for s in "xy" for c in ("tile", "ends", "ids", "counts", "raw"))), rotations, threshold), "found")
        links = found.filter("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
        components = connected_components(scratch, found.filter("b is not null").select("a", "b"))
        scratch.drop(tiles, near)
    final = classes.select("label", "key", "id", "n").join(links, "id", "left").join(components, "id", "left")
    final = final.select("label", "key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "id").alias("component"))
    out = rows.select("vec_id", "label", "key").join(final, ["label", "key"], "left")
    component = F.coalesce("component", "vec_id")
    out = out.select("vec_id", F.coalesce("links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
    return out


def op8_embedding_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors of embeddings."""
    return embedding_duplicates(read(spark, sf_dir, "embeddings"))


OP8_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL),
u AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM v WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE a.norm > 0 AND b.norm > 0 AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93),
reach AS (SELECT vec_id, vec_id AS r FROM embeddings UNION SELECT reach.vec_id, y FROM reach JOIN l ON x = r),
comp AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT x AS vec_id, count(*) AS n FROM l GROUP BY x)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept FROM embeddings e JOIN comp USING (vec_id) LEFT JOIN n USING (vec_id)
"""
