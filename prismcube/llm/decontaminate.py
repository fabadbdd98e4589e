"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

Texts are words (A-Z lower-cased, `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`). Every run of `window` words of an item is a
pattern, an item of fewer words one whole pattern. Patterns of one length are searched together: the
shift table maps a block of two words (by a hash of it) to the distance by which the search may move on when the
block stands at the end of the frame, and blocks in no pattern move it by all but one word. Where the shift is 0, a
prefix table tells by the hashes of the frame's first and last blocks whether a pattern may begin and end so; then the
bucket of the hash of all its words is opened, and a direct comparison of bytes confirms. So a position costs as much
with a large benchmark, whose patterns often end in the same common words, as with a small one. Words inside a
confirmed occurrence are hit.

The benchmark is cut into pieces (a long item into overlapping ones) and dealt by a hash over blocks of about
`block_words` words. A block's tables are flat arrays of about 60 bytes a word and three thousand at least, built by one
task and broadcast. One block is one pass over the documents. Several are passes one after another, so that one
block's tables are alive at a time; each writes its hits by a hash of the text, which are merged and joined
at the end. Documents' texts are never shuffled (a row that is carried is, in the join of several blocks).

Defined results: null or empty text has no words and is clean; an item with no words is no pattern; items
with equal windows are all named, repeated ones once; a null item_id is an item, first in item_ids and `null` in
the digest; rows are independent, so repeats, null ids and further columns make no difference;
an empty table gives no rows; with an empty benchmark all documents are clean.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import WORDS, Scratch, bytes_of, count_words, map_arrow, mix64, read, texts_of

WINDOW = 10
#: Benchmark words whose tables are in memory at a time.
BLOCK_WORDS = 1_000_000
#: Windows of a piece of an item.
PIECE = 20_000


def _size(n: int, least: int = 10, most: int = 24) -> int:
    """A power of two of at least n, within bounds."""
    return 1 << min(max((max(n, 1) - 1).bit_length(), least), most)


#: Joins the hashes of a frame's first and last blocks (the golden ratio's odd multiplier of 32 bits).
JOIN = 2654435761


def _frame(length: int, starts: np.ndarray, item_of: np.ndarray, pieces: np.ndarray, word: np.ndarray, single: np.ndarray, pair: np.ndarray, whole: Callable[[np.ndarray, int], np.ndarray]) -> dict:
    """Tables of the patterns of one length: starts and items of all windows; pieces: (first, number of words).

    word: numbers of words; single and pair: hashes of each word, and of it with the one before; whole(starts, length):
    hashes of windows.
    """
    # equal windows are one pattern with several items
    m = word[starts[:, None] + np.arange(length)]
    h = np.full(len(m), length, np.uint64)
    for j in range(length):
        h = mix64(h + m[:, j].astype(np.uint64))
    order = np.argsort(h, kind="stable")
    m, items = m[order], item_of[order]
    new = np.ones(len(m), bool)
    new[1:] = (m[1:] != m[:-1]).any(axis=1)
    first = np.flatnonzero(new)
    pattern = np.cumsum(new) - 1
    named = np.unique(np.stack([pattern, items], 1), axis=0)
    begins = starts[order][first]
    key = single if length == 1 else pair
    # a block that ends j words before the frame's end at least lets the frame move on by j
    default = min(length - 1, 255) if length > 1 else 1
    shift = np.full(_size(8 * int(pieces[:, 1].sum())), default, np.uint8)
    at = np.concatenate([np.arange(a + (length > 1), a + n) for a, n in pieces.tolist()])
    far = np.concatenate([np.maximum(length - 1 - np.arange(length > 1, n), 0) for _, n in pieces.tolist()])
    np.minimum.at(shift, key[at] & np.uint32(len(shift) - 1), np.minimum(far, 255).astype(np.uint8))
    buckets = _size(2 * len(begins), most=22)
    bucket = whole(begins, length) & np.uint32(buckets - 1)
    prefix = np.zeros(_size(16 * len(begins)), np.uint8)
    if length > 1:
        prefix[(pair[begins + 1].astype(np.uint64) * np.uint64(JOIN) + pair[begins + length - 1]) & np.uint64(len(prefix) - 1)] = 1
    entries = np.argsort(bucket, kind="stable")
    return {
        "length": length,
        "default": default,
        "shift": shift.tobytes(),
        "prefix": prefix.tobytes(),
        "bucket": np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=buckets))]).astype(np.int32),
        "entries": entries.astype(np.int32),
        "begins": begins.astype(np.int32),
        "named": np.concatenate([[0], np.cumsum(np.bincount(named[:, 0], minlength=len(begins)))]).astype(np.int32),
        "items": named[:, 1].astype(np.int32),
    }


def pack(pieces: list[tuple[int | None, bytes, int]]) -> bytes:
    """The tables of pieces (item_id, words joined by one space, pattern length), as bytes."""
    ids = sorted({i for i, _, _ in pieces}, key=lambda i: (i is not None, i or 0))
    number = {i: k for k, i in enumerate(ids)}
    words, spans = [], []
    for i, text, length in pieces:
        w = text.split(b" ")
        spans.append((len(words), len(w), length, number[i]))
        words += w
    known: dict[bytes, int] = {}
    word = np.array([known.setdefault(w, len(known)) for w in words], np.int32)
    del known
    single = np.array([crc32(w) for w in words], np.uint32)
    pair = np.array([0, *(crc32(b, a) for a, b in zip(single.tolist(), words[1:], strict=False))], np.uint32)
    spans = np.array(spans, np.int64).reshape(-1, 4)
    blob, offsets = b" ".join(words), np.concatenate([[0], np.cumsum([len(w) + 1 for w in words])]).astype(np.int64)
    del words
    ends = memoryview(offsets)
    whole = lambda starts, length: np.array([crc32(blob[ends[p] : ends[p + length] - 1]) for p in starts.tolist()], np.uint32)
    frames = []
    for length in np.unique(spans[:, 2]).tolist():
        own = spans[spans[:, 2] == length]
        starts = np.concatenate([np.arange(a, a + n - length + 1) for a, n, _, _ in own.tolist()])
        item_of = np.repeat(own[:, 3], own[:, 1] - length + 1)
        frames.append(_frame(length, starts, item_of, own[:, :2], word, single, pair, whole))
    return pickle.dumps({"ids": ids, "blob": blob, "offsets": offsets, "frames": frames})


class Matcher:
    """scan(words) of packed tables."""

    def __init__(self, packed: bytes):
        t = pickle.loads(packed)
        self.ids, self.blob, self.offsets = t["ids"], t["blob"], memoryview(t["offsets"])
        self.frames = [{k: memoryview(v) if isinstance(v, np.ndarray) and k in ("bucket", "entries", "begins") else v for k, v in f.items()} for f in t["frames"]]

    def _search(self, f: dict, words: list[bytes], spans: list[tuple[int, int]]) -> set[int]:
        """The patterns of one length that occur; their places go to spans."""
        length, shift, bucket, entries, begins = f["length"], f["shift"], f["bucket"], f["entries"], f["begins"]
        blob, offsets, mask, last = self.blob, self.offsets, len(f["shift"]) - 1, len(f["bucket"]) - 2
        prefix, low = f["prefix"], len(f["prefix"]) - 1
        found, n, i = set(), len(words), length - 1
        while i < n:
            h = crc32(words[i], crc32(words[i - 1])) if length > 1 else crc32(words[i])
            if step := shift[h & mask]:
                i += step
                continue
            if length > 2 and not prefix[crc32(words[i - length + 2], crc32(words[i - length + 1])) * JOIN + h & low]:
                i += 1
                continue
            text = b" ".join(words[i - length + 1 : i + 1])
            here = crc32(text) & last
            for e in range(bucket[here], bucket[here + 1]):
                p = begins[entries[e]]
                if blob[offsets[p] : offsets[p + length] - 1] == text:
                    found.add(entries[e])
                    spans.append((i - length + 1, i + 1))
            i += 1
        return found

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int | None]]:
        """Merged spans [start, end) of hit words, and the items."""
        spans, items = [], set()
        for f in self.frames:
            for p in self._search(f, words, spans):
                items.update(f["items"][f["named"][p] : f["named"][p + 1]].tolist())
        return merge(spans), {self.ids[i] for i in items}


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def benchmark_blocks(scratch: Scratch, benchmark: DataFrame, window: int, block_words: int) -> tuple[DataFrame, int]:
    """(block, packed) with the tables of each block, and the number of blocks."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, data in zip(batch.column(0).to_pylist(), texts_of(batch), strict=True):
                words = data.translate(WORDS).split()
                length = min(window, len(words))
                rows = [words[lo : lo + PIECE + length - 1] for lo in range(0, len(words) - length + 1, PIECE)] if words else []
                for part in rows:
                    yield pa.RecordBatch.from_pydict({"item_id": pa.array([i], pa.int64()), "words": [b" ".join(part)], "length": pa.array([length], pa.int32()), "n": pa.array([len(part)], pa.int64())})

    pieces = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text is not null").mapInArrow(cut, "item_id long, words binary, length int, n long")
    pieces = pieces.dropDuplicates(["item_id", "words", "length"])
    n = max(1, -(-(pieces.agg(F.sum("n")).first()[0] or 0) // block_words))

    def build(table: pa.Table) -> pa.Table:
        columns = [table.column(c).to_pylist() for c in ("item_id", "words", "length")]
        rows = sorted(zip(*columns, strict=True), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        return pa.table({"block": pa.array([table.column("block")[0].as_py()], pa.int32()), "packed": pa.array([pack(rows)], pa.binary())})

    dealt = pieces.select(F.pmod(F.xxhash64("item_id", "words"), F.lit(n)).cast("int").alias("block"), "item_id", "words", "length")
    packed = dealt.groupBy("block").applyInArrow(build, "block int, packed binary")
    return packed if n == 1 else scratch.save(packed, "packed"), n


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_HITS = "spans array<struct<start: bigint, end: bigint>>, item_ids array<bigint>"


def _found(hits: list[tuple[list[tuple[int, int]], set[int | None]]]) -> list[pa.Array]:
    spans = [[{"start": a, "end": b} for a, b in s] for s, _ in hits]
    ids = [sorted(i, key=lambda x: (x is not None, x or 0)) for _, i in hits]
    return [pa.array(spans, pa.list_(_SPAN)), pa.array(ids, pa.list_(pa.int64()))]


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, carry: bool = False) -> DataFrame:
    """(doc_id, n_words, spans of hit words, item_ids) for every row of docs; with carry, the row itself as _row, too."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    kept = [F.col("doc_id").cast("long").alias("doc_id"), *([F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")] if carry else [])]
    tables, n = benchmark_blocks(scratch, benchmark, window, block_words)

    def shared(block: int):
        row = tables.filter(F.col("block") == block).select("packed").first()  # block_words at most, about
        return spark.sparkContext.broadcast(bytes(row.packed) if row else pack([]))

    if n == 1:
        table = shared(0)
        # a carried row holds the text, so that it is sent once
        rows = docs.select(*kept) if carry else docs.select(*kept, "text")
        names, place = [*(["doc_id", "_row"] if carry else ["doc_id"]), "n_words", "spans", "item_ids"], docs.columns.index("text")

        def make():
            matcher = Matcher(table.value)

            def run(batch: pa.RecordBatch) -> pa.RecordBatch:
                texts = batch.column(1).field(place) if carry else batch.column(1)
                counts, found = [], []
                for text in bytes_of(texts):
                    words = text.translate(WORDS).split()
                    counts.append(len(words))
                    found.append(matcher.scan(words))
                return pa.RecordBatch.from_arrays([*batch.columns[: 1 + carry], pa.array(counts, pa.int64()), *_found(found)], names=names)

            return run

        out = map_arrow(rows, make, StructType(rows.schema.fields[: 1 + carry] + StructType.fromDDL("n_words long, " + _HITS).fields))
    else:
        # the hits of one block after another, by a hash of the text; equal texts once
        key = F.sha2(F.coalesce("text", F.lit("")), 256)
        hits = None
        for block in range(n):
            table = shared(block)

            def hit(batches: Iterator[pa.RecordBatch], table=table) -> Iterator[pa.RecordBatch]:
                matcher = Matcher(table.value)
                for batch in batches:
                    found = [matcher.scan(t.translate(WORDS).split()) for t in texts_of(batch)]
                    at = [k for k, (s, _) in enumerate(found) if s]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *_found([found[k] for k in at])], names=["key", "spans", "item_ids"])

            one = docs.select(key.alias("key"), "text").mapInArrow(hit, f"key string, {_HITS}").dropDuplicates(["key"])
            one = scratch.save(one, "hits")
            table.destroy()
            hits = one if hits is None else hits.unionByName(one)
        gathered = hits.groupBy("key").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("item_ids"))).alias("item_ids"))

        def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [(merge([(x["start"], x["end"]) for x in s]), set(i)) for s, i in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *_found(found)], names=["key", "spans", "item_ids"])

        gathered = scratch.save(gathered.mapInArrow(join, f"key string, {_HITS}"), "merged")
        rows = docs.select(*kept, key.alias("key"), "text")
        names = [*rows.columns[:-1], "n_words"]

        def counter():
            return lambda batch: pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([count_words(t.translate(WORDS), _CLASS) for t in texts_of(batch, batch.num_columns - 1)], pa.int64())], names=names)

        out = map_arrow(rows, counter, _schema(rows, "n_words long")).join(gathered, "key", "left")
        out = out.withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<start: bigint, end: bigint>>"))).withColumn("item_ids", F.coalesce("item_ids", F.array().cast("array<bigint>")))
    return out.select("doc_id", "n_words", "spans", "item_ids", *(["_row"] if carry else []))


#: x for what is no space.
_CLASS = bytes(32 if c == 32 else 120 for c in range(256))


def _schema(rows: DataFrame, more: str) -> StructType:
    """rows' columns but the last, and more."""
    return StructType(rows.schema.fields[:-1] + StructType.fromDDL(more).fields)


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest columns of contamination(); a null item id is `null` there."""
    ids = F.array_sort(F.transform("item_ids", lambda i: F.coalesce(i.cast("string"), F.lit("null"))))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.end - s.start)
    return contamination(docs, benchmark).select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated")
    )


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of all benchmark windows in every whole text of documents."""
    return decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


OP7_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
p AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, list_slice(w, i, i + least(10, len(w)) - 1) AS win
      FROM b, LATERAL unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
lens AS (SELECT DISTINCT n FROM p),
dw AS (SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS win FROM d, lens, LATERAL unnest(range(1, len(w) - n + 2)) AS t(i) WHERE len(w) >= n),
hits AS (SELECT doc_id, i, p.n, item_id FROM dw JOIN p ON dw.n = p.n AND dw.win = p.win),
words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM hits, LATERAL unnest(range(i, i + n)) AS t(k) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
