"""The cube: a long table of cells and the shape that goes with it.

Cells are (scene, b, y, x, v). Operators see frames: k is the frame (third axis of the priority), r the line
(second), c the place in the line (first). The priority only names columns; no data moves.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AXES = ("x", "y", "b")
FLT_MIN, FLT_MAX, FLT_EPSILON, DBL_EPSILON = 1.1754943508222875e-38, 3.4028234663852886e38, 1.1920928955078125e-07, 2.220446049250313e-16


@dataclass(frozen=True)
class Cube:
    """cells: DataFrame of b, y, x, v (and scene, if there are several); size: extents of x, y, b."""

    cells: DataFrame
    size: tuple[int, int, int]
    nodata: tuple[float, ...] = ()
    order: tuple[int, int, int] = (0, 1, 2)

    def frames(self) -> DataFrame:
        """k, r, c, v in the order of the axes' priority."""
        c, r, k = (AXES[i] for i in self.order)
        return self.cells.select(F.col(k).alias("k"), F.col(r).alias("r"), F.col(c).alias("c"), F.col("v").cast("double").alias("v"))

    def with_frames(self, frames: DataFrame, size: tuple[int, int, int] | None = None) -> Cube:
        """A cube of frames in this cube's axes."""
        c, r, k = (AXES[i] for i in self.order)
        return replace(self, cells=frames.select(F.col("k").alias(k), F.col("r").alias(r), F.col("c").alias(c), "v"), size=size or self.size)

    def ordered(self, order: tuple[int, int, int]) -> Cube:
        return replace(self, order=order)

    def extent(self, axis: int) -> int:
        """Extent of the axis-th of the priority: 0 places, 1 lines, 2 frames."""
        return self.size[self.order[axis]]

    def with_nan(self) -> Cube:
        """The same cells with NaN where v is no data."""
        v = F.when(is_nodata(F.col("v"), self.nodata), float("nan")).otherwise(F.col("v").cast("double"))
        return replace(self, cells=self.cells.withColumn("v", v), nodata=())

    def squeezed(self) -> DataFrame:
        """The cells by the axes of more than one place alone, as a matrix or a line is read."""
        return self.cells.select(*(a for a, n in zip(AXES, self.size, strict=True) if n > 1), "v")

    def window(self, xoff=0, xsize=0, yoff=0, ysize=0, boff=0, bsize=0, rebase: bool = False) -> Cube:
        """The part inside a source window (a size of 0 or less counts from the far end); a filter that reaches the scan. rebase: places count from the window's corner."""
        cells, size = self.cells, []
        for name, n, off, want in zip(AXES, self.size, (xoff, yoff, boff), (xsize, ysize, bsize), strict=True):
            off = max(off, 0)
            if off >= n:
                raise ValueError(f"{name} offset {off} is outside {n}")
            length = min(want, n - off) if want > 0 else n + want - off
            cells = cells.filter((F.col(name) >= off) & (F.col(name) < off + length))
            if rebase:
                cells = cells.withColumn(name, F.col(name) - off)
            size.append(length)
        return replace(self, cells=cells, size=tuple(size))


def is_nodata(v: Column, nodata: tuple[float, ...]) -> Column:
    """NaN, and the listed values."""
    out = F.isnan(v)
    return out | v.isin(*nodata) if nodata else out


def spectral_cube(spark: SparkSession, sf_dir: str) -> Cube:
    """E: embeddings as pixels of 64 bands, 20 wide."""
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", F.posexplode("embedding").alias("b", "v"))
    cells = e.select("b", F.floor(F.col("vec_id") / 20).cast("int").alias("y"), (F.col("vec_id") % 20).cast("int").alias("x"), F.col("v").cast("double").alias("v"))
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").agg(F.max("vec_id")).first()[0]
    return Cube(cells, (20, (rows or 0) // 20 + 1, 64))


def count_cube(spark: SparkSession, sf_dir: str) -> Cube:
    """Q: quantities of lineitem by supplier (x), year (y) and line number (b); whole numbers."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    cells = li.groupBy((F.col("l_linenumber") - 1).alias("b"), (F.year("l_shipdate") - 1995).alias("y"), F.col("l_suppkey").cast("int").alias("x")).agg(F.sum("l_quantity").alias("v"))
    n = spark.read.parquet(f"{sf_dir}/supplier.parquet").agg(F.max("s_suppkey")).first()[0]
    return Cube(cells, (n + 1, 7, 7))


E_SQL = "e AS (SELECT i - 1 AS k, vec_id // 20 AS r, vec_id % 20 AS c, CAST(embedding[i] AS DOUBLE) AS v FROM embeddings, unnest(range(1, 65)) AS t(i))"
Q_SQL = "q AS (SELECT l_linenumber - 1 AS k, year(l_shipdate) - 1995 AS r, l_suppkey AS c, sum(l_quantity) AS v FROM lineitem GROUP BY ALL)"
