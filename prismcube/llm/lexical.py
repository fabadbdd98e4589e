"""Ranked lexical search: MaxScore over the shards of an inverted index.

Terms are `[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`, A-Z lower-cased. build_index() reads every text once and
writes an index to the shared folder, without a shuffle: each task cuts its documents into shards of at most
`SHARD_DOCS` documents and about `SHARD_WORDS` words, and a shard is a row for each of its terms (the ordinals of the
documents that hold it, and how often) and a row with the documents' ids and lengths. So no row grows with the corpus,
however common its term.

search() takes the items in blocks of about `BLOCK_TERMS` terms. A block's terms and weights are broadcast; the rows
of its terms alone are read from the index, meet by shard, and each task goes through its shards one after another.
In a shard a term's upper bound is its weight times the largest impact in its list. For each item the lists are
ordered by bound; those whose bounds together stay below the k-th best score so far are non-essential. Candidates
come from the essential lists alone, a range of ordinals at a time; the non-essential lists are probed for them, the
highest bound first, and a candidate is dropped as soon as its score and the bounds that are left stay below the k-th
best. The k best go from shard to shard within a task, so bounds bite from the second shard on. Bounds are compared
strictly, so no document that could win a tie is lost: the result is exact.

Scores are integers, as the formula of `impact` and `weight` says. Defined results: a null or empty text has no term
and is in no statistic; rows of documents are independent, so repeated rows and ids are documents of their own, and a null
doc_id comes last among ties; rows of items with equal id (null is an id) are one item, repeated rows counted once, the
terms of different texts added; an item without terms, or with none that occurs, has no rows; empty tables give none;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORDS, Scratch, read, texts_of, word_pieces

TOP = 10
#: A shard ends at so many documents (ordinals have 16 bits), or at the document with which it has so many words.
SHARD_DOCS, SHARD_WORDS = 1 << 16, 2_000_000
#: Terms of a block of items (an item is never cut).
BLOCK_TERMS = 200_000
#: Ordinals from which candidates are taken at a time.
RANGE = 2048

_INDEX = "shard long, term string, df long, docs binary, tfs binary, ids array<long>, lengths array<long>"


def weight(n: int, df: int) -> int:
    """Of a term that df of n documents hold."""
    return floor(1000 * log((2 * n + 2) / (2 * df + 1)))


def damping(length: int, n: int, total: int) -> int:
    """m of a document of that length, of n documents with total terms."""
    return 100 - 75 + (75 * length * n) // total


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _blobs(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary array whose items are the pieces of values that end at ends."""
    offsets = np.zeros(len(ends) + 1, np.int32)
    offsets[1:] = ends * values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


class _Builder:
    """Collects documents; batch() gives the shard's rows and starts the next."""

    def __init__(self, docs: int, words: int):
        self.most_docs, self.most_words = docs, words
        self.number, self.part = 0, TaskContext.get().partitionId()
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.lengths, self.terms, self.tfs, self.words = [], [], [], [], 0

    def add(self, doc: int | None, data: bytes) -> None:
        known = self.known
        parts = [np.array([known.setdefault(w, len(known)) for w in words], np.int32) for words in word_pieces(data.translate(WORDS))]
        if not parts:
            return
        term, tf = np.unique(parts[0] if len(parts) == 1 else np.concatenate(parts), return_counts=True)
        self.ids.append(doc)
        self.lengths.append(sum(map(len, parts)))
        self.terms.append(term)
        self.tfs.append(tf.astype(np.int32))
        self.words += self.lengths[-1]

    def full(self) -> bool:
        return self.words >= self.most_words or len(self.ids) == self.most_docs

    def batch(self) -> pa.RecordBatch:
        term, tf = np.concatenate(self.terms), np.concatenate(self.tfs)
        doc = np.repeat(np.arange(len(self.ids), dtype=np.uint16), [len(t) for t in self.terms])
        order = np.argsort(term, kind="stable")
        df = np.bincount(term, minlength=len(self.known))
        ends, n = np.cumsum(df), len(df)
        names = pa.array(list(self.known), pa.binary()).cast(pa.string())
        head = [pa.array([self.ids], pa.list_(pa.int64())), pa.array([self.lengths], pa.list_(pa.int64()))]
        none = lambda kind, k: pa.nulls(k, kind)
        columns = [
            pa.array(np.full(n + 1, (self.part << 24) + self.number)),
            pa.concat_arrays([none(pa.string(), 1), names]),
            pa.array(np.concatenate([[len(self.ids)], df])),
            pa.concat_arrays([none(pa.binary(), 1), _blobs(doc[order], ends)]),
            pa.concat_arrays([none(pa.binary(), 1), _blobs(tf[order], ends)]),
            *(pa.concat_arrays([h, none(h.type, n)]) for h in head),
        ]
        self.number += 1
        self.clear()
        return pa.RecordBatch.from_arrays(columns, names=["shard", "term", "df", "docs", "tfs", "ids", "lengths"])


def build_index(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", shard_docs: int = SHARD_DOCS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The index of all docs, written: a row for each term of each shard, and for each shard one without term with ids and lengths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Builder(min(shard_docs, SHARD_DOCS), shard_words)
        for batch in batches:
            for doc, data in zip(batch.column(0).to_pylist(), texts_of(batch), strict=True):
                shard.add(doc, data)
                if shard.full():
                    yield shard.batch()
        if shard.ids:
            yield shard.batch()

    return scratch.save(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, _INDEX), "index")


class ShardSearch:
    """One shard's lists of a block's terms, by the term's number; read: postings looked at as candidates or probed."""

    def __init__(self, ids: list[int | None], lengths: list[int], n: int, total: int, weights: np.ndarray):
        self.ids = np.array([0 if i is None else i for i in ids], np.int64)
        self.no_id = np.array([i is None for i in ids], bool)
        self.m = np.array([damping(x, n, total) for x in lengths], np.int64)
        self.weights, self.lists, self.read = weights, {}, 0
        self.edges = np.arange(0, len(ids) + RANGE, RANGE)

    def add(self, term: int, docs: np.ndarray, tfs: np.ndarray) -> None:
        value = self.weights[term] * impact(tfs.astype(np.int64), self.m[docs])
        self.lists[term] = (docs, value, int(value.max()), np.searchsorted(docs, self.edges).tolist())

    def top(self, terms: list[tuple[int, int]], best: tuple[np.ndarray, np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """best (scores, ids, no_id; sorted) with this shard's documents; terms: (number, how often in the item)."""
        lists = sorted(((self.lists[t][2] * times, times, *self.lists[t]) for t, times in terms if t in self.lists), key=lambda x: x[0])
        bounds = np.cumsum([x[0] for x in lists]).tolist()
        if not bounds or bounds[-1] == 0:
            return best
        for r, lo in enumerate(self.edges[:-1].tolist()):
            need = int(best[0][-1]) if len(best[0]) == k else 1
            if bounds[-1] < need:
                return best
            first = next(i for i, b in enumerate(bounds) if b >= need)  # the lists before it are non-essential
            score = np.zeros(min(RANGE, len(self.ids) - lo), np.int64)
            for _, times, docs, value, _, at in lists[first:]:
                a, b = at[r], at[r + 1]
                if a < b:
                    score[docs[a:b] - np.uint16(lo)] += times * value[a:b]
                    self.read += b - a
            found = np.flatnonzero(score)
            score, found = score[found], found + lo
            for i in range(first - 1, -1, -1):
                keep = score + bounds[i] >= need
                if not keep.all():
                    score, found = score[keep], found[keep]
                if not len(found):
                    break
                _, times, docs, value, _, at = lists[i]
                if at[r] == at[r + 1]:
                    continue
                place = np.searchsorted(docs, found.astype(np.uint16))
                place[place == len(docs)] = 0
                hit = docs[place] == found
                score[hit] += times * value[place[hit]]
                self.read += len(found)
            keep = score >= need
            if keep.any():
                found = found[keep]
                scores, ids, no_id = np.concatenate([best[0], score[keep]]), np.concatenate([best[1], self.ids[found]]), np.concatenate([best[2], self.no_id[found]])
                order = np.lexsort((ids, no_id, -scores))[:k]
                best = scores[order], ids[order], no_id[order]
        return best


def _item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, times) of all items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, data in zip(batch.column(0).to_pylist(), texts_of(batch), strict=True):
                for words in word_pieces(data.translate(WORDS)):
                    term, times = np.unique(np.array(words, object), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(term), pa.int64()), pa.array(term.tolist(), pa.binary()).cast(pa.string()), pa.array(times)], names=["item_id", "term", "times"])

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text")).filter("text is not null").distinct()
    return rows.mapInArrow(run, "item_id long, term string, times long").groupBy("item_id", "term").agg(F.sum("times").alias("times"))


def _search_block(index: DataFrame, items: list[tuple[int | None, list[tuple[int, int]]]], number: DataFrame, weights: np.ndarray, n: int, total: int, k: int) -> DataFrame:
    """(item_id, doc_id, score): the k best of each task for each item; number: (term, t) of the block's terms."""
    shared = index.sparkSession.sparkContext.broadcast((items, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = shared.value
        none = np.zeros(0, np.int64)
        best = [(none, none, none.astype(bool)) for _ in items]
        shard = None

        def finish():
            if shard is not None and shard.lists:
                for i, (_, terms) in enumerate(items):
                    best[i] = shard.top(terms, best[i], k)

        for batch in batches:
            t, docs, tfs, ids, lengths = (batch.column(c) for c in range(1, 6))
            for r, term in enumerate(t.to_pylist()):
                if term < 0:  # the first row of a shard
                    finish()
                    shard = ShardSearch(ids[r].as_py(), lengths[r].as_py(), n, total, weights)
                elif weights[term]:
                    shard.add(term, np.frombuffer(docs[r].as_buffer(), np.uint16), np.frombuffer(tfs[r].as_buffer(), np.int32))
        finish()
        names, sizes = [i for i, _ in items], [len(b[0]) for b in best]
        if sum(sizes):
            item = pa.array(names, pa.int64()).take(pa.array(np.repeat(np.arange(len(items)), sizes)))
            score, doc, no_id = (np.concatenate([b[c] for b in best]) for c in range(3))
            yield pa.RecordBatch.from_arrays([item, pa.array(doc, mask=no_id), pa.array(score)], names=["item_id", "doc_id", "score"])

    lists = index.filter("term is not null").join(F.broadcast(number), "term").select("shard", "t", "docs", "tfs", "ids", "lengths")
    heads = index.filter("term is null").select("shard", F.lit(-1).alias("t"), "docs", "tfs", "ids", "lengths")
    rows = lists.unionByName(heads).repartition("shard").sortWithinPartitions("shard", "t")
    return rows.mapInArrow(run, "item_id long, doc_id long, score long")


def search(index: DataFrame, items: DataFrame, scratch: Scratch, k: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of index that score best for each of items (item_id, text)."""
    spark = index.sparkSession
    n, total = index.filter("term is null").agg(F.sum("df"), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda s, x: s + x))).first()
    asked = scratch.save(_item_terms(items), "asked")
    entries = asked.count()
    out = spark.createDataFrame([], "item_id long, doc_id long, score long")
    blocks = -(-entries // block_terms) if n else 0
    for block in range(blocks):
        mine = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        held = index.filter("term is not null").select("term", "df").join(F.broadcast(mine.select("term").distinct()), "term").groupBy("term").agg(F.sum("df").alias("df"))
        rows = mine.join(F.broadcast(held), "term").select("item_id", "term", "times", "df").collect()  # block_terms, about
        if not rows:
            continue
        df_of = {r.term: r.df for r in rows}
        number = {t: i for i, t in enumerate(sorted(df_of))}
        of: dict[int | None, list[tuple[int, int]]] = {}
        for r in rows:
            of.setdefault(r.item_id, []).append((number[r.term], r.times))
        weights = np.array([weight(n, df_of[t]) for t in number], np.int64)
        numbers = spark.createDataFrame(list(number.items()), "term string, t int")
        found = _search_block(index, list(of.items()), numbers, weights, n, total, k)
        out = out.unionByName(scratch.save(found, "found"))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all documents for each benchmark item."""
    scratch = Scratch(spark)
    return search(build_index(read(spark, sf_dir, "documents"), scratch), read(spark, sf_dir, "benchmark"), scratch)


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents WHERE text IS NOT NULL),
s AS (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n, w FROM d WHERE len(w) > 0),
g AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM s),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM s) GROUP BY ALL),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term
      FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), g),
m AS (SELECT r, doc_id, 100 - 75 + ((75 * n * big_n) // big_l) AS m FROM s, g),
scored AS (SELECT item_id, r, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY item_id, r),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scored JOIN m USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
