"""A Spark data source for flat binary rasters: `spark.dataSource.register(EnviSource)`, then format("envi"), to read and to write (see tiff.RasterWriter).

A file is cut into parts of whole lines (of one band, or of all where bands lie inside lines), each read by offset in its
own task, so a large file spreads over the cluster. The window and the bands are read options (xoff, xsize, ...), never
pushed filters, so that frames built from one reader stay independent.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from . import store
from .files import envi_header
from .lists import header_of

#: Cells of a part, and of a record batch.
PART_CELLS, BATCH_CELLS = 1 << 22, 1 << 18


class Part(InputPartition):
    def __init__(self, bands: tuple[int, int], first: int, last: int):
        self.bands, self.first, self.last = bands, first, last


class EnviReader(DataSourceReader):
    def __init__(self, path: str, options: dict):
        self.path = path
        self.header = h = envi_header(store.read_text(options.get("header", header_of(path))))
        get = lambda k, d: int(options.get(k, d))
        self.x = range(get("xoff", 0), min(get("xoff", 0) + get("xsize", h["samples"]), h["samples"]))
        self.y = range(get("yoff", 0), min(get("yoff", 0) + get("ysize", h["lines"]), h["lines"]))
        self.b = range(get("boff", 0), min(get("boff", 0) + get("bsize", h["bands"]), h["bands"]))

    def partitions(self):
        together = self.header["interleave"] != "bsq"
        step = max(1, PART_CELLS // max(self.header["samples"] * (self.header["bands"] if together else 1), 1))
        bands = [(self.b.start, self.b.stop)] if together else [(b, b + 1) for b in self.b]
        return [Part(b, y, min(y + step, self.y.stop)) for b in bands for y in range(self.y.start, self.y.stop, step)]

    def read(self, part: Part):
        h, kind = self.header, np.dtype(self.header["dtype"])
        samples, lines, bands, way = h["samples"], h["lines"], h["bands"], h["interleave"]
        with store.open_read(self.path) as f:
            # lines of all bands lie together but for bsq, where those of a band do
            line = samples * (1 if way == "bsq" else bands)
            first = part.bands[0] * lines + part.first if way == "bsq" else part.first
            f.seek(h["offset"] + first * line * kind.itemsize)
            step = max(1, BATCH_CELLS // line)
            for y in range(part.first, part.last, step):
                n = min(step, part.last - y)
                data = np.frombuffer(f.read(n * line * kind.itemsize), kind)
                cube = data.reshape({"bsq": (n, 1, samples), "bil": (n, bands, samples), "bip": (n, samples, bands)}[way])
                if way == "bip":
                    cube = cube.transpose(0, 2, 1)
                own = cube if way == "bsq" else cube[:, part.bands[0] : part.bands[1]]
                own = own[:, :, self.x.start : self.x.stop].real.astype(float)
                i, b, x = np.indices(own.shape).reshape(3, -1)
                yield pa.RecordBatch.from_pydict({"b": pa.array((b + part.bands[0]).astype(np.int32)), "y": pa.array((i + y).astype(np.int32)), "x": pa.array((x + self.x.start).astype(np.int32)), "v": pa.array(own.ravel())})


class EnviSource(DataSource):
    @classmethod
    def name(cls):
        return "envi"

    def schema(self):
        return "b int, y int, x int, v double"

    def reader(self, schema):
        return EnviReader(self.options["path"], dict(self.options))

    def writer(self, schema, overwrite):
        from .tiff import RasterWriter

        return RasterWriter(dict(self.options), overwrite, True)
