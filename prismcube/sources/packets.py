"""Raw packet streams parsed by ranges: one file is many tasks', though each packet says where the next may begin.

A search for the next packet begins at some byte, finds the first token from there, and goes on behind that packet's
payload; a token inside a payload is none. Which tokens begin packets is thus known only from the file's start. It is
found without going through the file in order:

1. Each range of `part` bytes lists its tokens, where the search would go on behind each (`after`), and which begin
   frames. A range is one task's, and one row.
2. A range maps the byte at which a search enters it to the byte at which it leaves it. The map is a step function over
   its tokens, worked out from the last token to the first; steps with one result are joined, and since searches soon fall
   into step, few are left. `FAN` ranges' maps are composed into one, and those of `FAN` such again, until a file has one map.
3. From the file's start the entries of all ranges follow, level by level back down.
4. Each range follows its own packets from its entry; packets and frames are numbered by prefix sums over the ranges,
   and payloads are read by the ranges in which packets begin.

What the end of a file cuts off is left out. The bytes are read twice (tokens, payloads); what is shuffled are steps.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import store

#: Fixed value: the token before each packet's header.
TOKEN = bytes.fromhex("0915c000")
#: Bytes behind a token that tell sample count, kind, band and frame.
HEADER = 8
#: Bytes of a range; maps that are composed at a time.
PART, FAN = 1 << 26, 256
#: Where a search goes on that the file's end cuts off.
NEVER = 1 << 62


def header(h: bytes, packed: bool) -> dict:
    """The fields of a packet's header and its payload's length."""
    samples, kind, b0, b1 = int.from_bytes(h[:2], "big"), h[2], h[3], h[4]
    image = kind & 15 == 7
    return {
        "image_type": "SWIR" if kind >> 4 == 1 else "VNIR",
        "data_type": "IMAGE" if image else "META",
        "band": (b0 << 8) + b1 if b0 <= 2 else b1,
        "frame": int.from_bytes(h[5:8], "big"),
        "n_bytes": samples * 3 // 2 if packed or not image else samples * 2,
    }


def tokens_in(data: bytes, at: int, end: int, size: int, token: bytes, packed: bool) -> tuple[list[int], list[int], list[bool]]:
    """Of the tokens that begin in [at, end) of a file of that size: where, where the search goes on, and whether a frame begins. data begins at at."""
    places, after, meta = [], [], []
    pos = data.find(token)
    while 0 <= pos < end - at:
        head = pos + len(token)
        places.append(at + pos)
        if len(data) < head + HEADER:
            after.append(NEVER)
            meta.append(False)
        else:
            h = header(data[head : head + HEADER], packed)
            behind = at + head + HEADER + h["n_bytes"]
            after.append(behind if behind <= size else NEVER)
            meta.append(h["data_type"] == "META")
        pos = data.find(token, pos + 1)
    return places, after, meta


def leave(places: list[int], leaves: list[int], end: int, entry: int) -> int:
    """Where a search that enters a range at entry leaves it; places and leaves are the range's steps."""
    if entry >= end:
        return entry
    k = bisect_left(places, entry)
    return leaves[k] if k < len(places) else end


def joined(places: list[int], leaves: list[int]) -> tuple[list[int], list[int]]:
    """The steps without those that lead where the next one does."""
    keep = [k for k in range(len(places)) if k + 1 == len(places) or leaves[k] != leaves[k + 1]]
    return [places[k] for k in keep], [leaves[k] for k in keep]


def steps_of(places: list[int], after: list[int], end: int) -> tuple[list[int], list[int]]:
    """A range's map, from its tokens."""
    leaves = [0] * len(places)
    for k in range(len(places) - 1, -1, -1):
        if after[k] >= end:
            leaves[k] = after[k]
        else:
            j = bisect_left(places, after[k], k + 1)
            leaves[k] = leaves[j] if j < len(places) else end
    return joined(places, leaves)


def composed(maps: list[tuple[list[int], list[int], int]]) -> tuple[list[int], list[int], int]:
    """One map of those of neighbouring ranges (places, leaves, end), in order."""
    places: list[int] = []
    leaves: list[int] = []
    end = maps[-1][2]
    for own, out, stop in reversed(maps):
        # what leaves this range is led on by the map of all behind it
        on = [leave(places, leaves, end, x) if x < NEVER else x for x in out]
        rest = leave(places, leaves, end, stop)
        places, leaves = joined([*own, *([stop - 1] if not own or own[-1] < stop - 1 else []), *places], [*on, *([rest] if not own or own[-1] < stop - 1 else []), *leaves])
    return places, leaves, end


_RANGES = "file string, size long, i long, start long, end long, places array<long>, after array<long>, meta array<boolean>, steps array<long>, leaves array<long>"
_LEVEL = "file string, i long, steps array<long>, leaves array<long>, end long"


def _scan(spark: SparkSession, path: str, token: bytes, packed: bool, part: int) -> DataFrame:
    """A row for each range of each file."""
    ranges = store.ranges(spark, path, part)
    sizes = ranges.groupBy("file").agg(F.max("end").alias("size"))
    ranges = ranges.join(F.broadcast(sizes), "file").select("file", "size", "i", "start", "end")  # a row a file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, size, i, start, end in zip(*(c.to_pylist() for c in b.columns), strict=True):
                data = store.read_range(file, start, min(end + len(token) + HEADER - 1, size))
                places, after, meta = tokens_in(data, start, end, size, token, packed)
                steps, leaves = steps_of(places, after, end)
                out = {"file": file, "size": size, "i": i, "start": start, "end": end, "places": places, "after": after, "meta": meta, "steps": steps, "leaves": leaves}
                yield pa.RecordBatch.from_pylist([out], schema=_ARROW)

    return ranges.mapInArrow(run, _RANGES)


_LONGS = pa.list_(pa.int64())
_ARROW = pa.schema([("file", pa.string()), ("size", pa.int64()), ("i", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("places", _LONGS), ("after", _LONGS), ("meta", pa.list_(pa.bool_())), ("steps", _LONGS), ("leaves", _LONGS)])


def _above(level: DataFrame, fan: int) -> DataFrame:
    """The maps of groups of fan neighbours."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["i"])
        steps, leaves, end = composed([(r["steps"], r["leaves"], r["end"]) for r in rows])
        return pa.table({"file": [rows[0]["file"]], "i": pa.array([rows[0]["i"] // fan], pa.int64()), "steps": pa.array([steps], _LONGS), "leaves": pa.array([leaves], _LONGS), "end": pa.array([end], pa.int64())})

    return level.groupBy("file", F.floor(F.col("i") / fan).alias("g")).applyInArrow(run, _LEVEL)


def _below(level: DataFrame, entries: DataFrame, fan: int) -> DataFrame:
    """(file, i, entry) of a level, from the entries of the groups above it."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["i"])
        at, found = rows[0]["entry"], []
        for r in rows:
            found.append(at)
            at = leave(r["steps"], r["leaves"], r["end"], at)
        return pa.table({"file": [r["file"] for r in rows], "i": pa.array([r["i"] for r in rows], pa.int64()), "entry": pa.array(found, pa.int64())})

    own = level.select("file", "i", "steps", "leaves", "end", F.floor(F.col("i") / fan).alias("g"))
    above = entries.select("file", F.col("i").alias("g"), "entry")
    return own.join(above, ["file", "g"]).groupBy("file", "g").applyInArrow(run, "file string, i long, entry long")


def entries_of(ranges: DataFrame, keep, fan: int = FAN) -> DataFrame:
    """(file, i, entry): the byte at which the search of each range begins. keep(df, name) writes a table."""
    levels = [ranges.select("file", "i", "steps", "leaves", "end")]
    while levels[-1].agg(F.max("i")).first()[0]:
        levels.append(keep(_above(levels[-1], fan), "maps"))
    entries = levels[-1].select("file", "i", F.lit(0).cast("long").alias("entry"))
    for level in reversed(levels[:-1]):
        entries = keep(_below(level, entries, fan), "entries")
    return entries


def followed(places: list[int], after: list[int], entry: int) -> list[int]:
    """Indices of the tokens that a search from entry meets and the file holds whole."""
    out, k = [], bisect_left(places, entry)
    while k < len(places) and after[k] < NEVER:
        out.append(k)
        k = bisect_left(places, after[k], k + 1)
    return out


_PACKETS = pa.schema([("file", pa.string()), ("ord", pa.int64()), ("line", pa.int64()), ("image_type", pa.string()), ("data_type", pa.string()), ("band", pa.int32()), ("frame", pa.int32()), ("n_bytes", pa.int32()), ("payload", pa.binary())])
PACKETS = "file string, ord long, line long, image_type string, data_type string, band int, frame int, n_bytes int, payload binary"


def _rows(batch: pa.RecordBatch) -> Iterator[list]:
    """The rows of a batch one by one, since each may hold many tokens."""
    return ([c[i].as_py() for c in batch.columns] for i in range(batch.num_rows))


def _batch(packets: list[tuple]) -> pa.RecordBatch:
    """Packets as a batch: file, ord, line, the header's fields, payload."""
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*packets, strict=True), _PACKETS, strict=True)], schema=_PACKETS)


def read_packets(spark: SparkSession, path: str, token: bytes = TOKEN, packed: bool = True, part: int = PART, fan: int = FAN) -> DataFrame:
    """Packets of raw files by ranges: file, ord (from 0), line (frames from 0, -1 before the first), kinds, band, frame, n_bytes, payload.

    A file without a packet has no rows. The tables of tokens and maps are kept in the shared folder until the session ends.
    """
    keep = store.Kept(spark)
    ranges = keep(_scan(spark, path, token, packed, part), "ranges")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, i, entry, places, after, meta in _rows(b):
                own = followed(places, after, entry)
                lines = np.cumsum([meta[k] for k in own]).tolist()
                yield pa.RecordBatch.from_pydict({"file": [file], "i": pa.array([i], pa.int64()), "own": pa.array([[places[k] for k in own]], _LONGS), "lines": pa.array([lines], _LONGS), "n": pa.array([len(own)], pa.int64()), "m": pa.array([lines[-1] if own else 0], pa.int64())})

    joined_in = ranges.join(entries_of(ranges, keep, fan), ["file", "i"]).select("file", "i", "entry", "places", "after", "meta")
    walked = keep(joined_in.mapInArrow(walk, "file string, i long, own array<long>, lines array<long>, n long, m long"), "walked")
    before = Window.partitionBy("file").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)  # two numbers a range
    firsts = walked.select("file", "i", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"), (F.coalesce(F.sum("m").over(before), F.lit(0)) - 1).alias("line"))

    def payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, own, lines, first, line in _rows(b):
                held, total = [], 0
                with store.open_read(file) as f:
                    for k, at in enumerate(own):
                        f.seek(at + len(token))
                        h = header(f.read(HEADER), packed)
                        held.append((file, first + k, line + lines[k], *h.values(), bytes(f.read(h["n_bytes"]))))
                        total += h["n_bytes"] + 100
                        if total > 1 << 24:
                            yield _batch(held)
                            held, total = [], 0
                if held:
                    yield _batch(held)

    rows = walked.filter("n > 0").join(firsts, ["file", "i"]).select("file", "own", "lines", "first", "line")
    n, size = ranges.agg(F.count(F.lit(1)), F.sum(F.col("end") - F.col("start"))).first()  # a row a range
    return rows.repartition(store.tasks(spark, n, size or 0), "file", "first").mapInArrow(payloads, PACKETS)
