"""Spelling variant grouping: words one edit apart, from forward and reversed sorted dictionaries.

Words and their counts come from all whole texts, added up in each task before they are shuffled. Two words are near
if one code point is replaced, inserted or deleted. Where a short word of m code points and its partner first differ
(at i) all before is equal and all after the edit, so one half is intact: they share a prefix or a suffix of half the
length. Entries are made for replacements and for insertions apart:

1. A block is (kind, m, a, b, end): its words agree in their first a and last b code points, and the pairs that it
   owns differ first in [a, end). The two first blocks of a word are its prefix (of the forward dictionary) and its
   suffix (of the reversed one); end keeps a pair from being owned by both.
2. Blocks are counted, with a partial sum before the shuffle. A block of more than `BLOCK` possible pairs is subdivided:
   the part between prefix and suffix is halved again, so each of its words goes on with a longer prefix and with a
   longer suffix. At the end one code point is free (replacement) or none (insertion), and a block holds at most as many
   words as there are letters. So no block is capped, and none that is large is ever gathered.
3. The other blocks are range-partitioned and sorted, and scanned; each possible pair is verified in whole.
4. A word's form is its near word of largest count (ties: smallest in code-point order) if that count is at least
   `RATIO` times its own. Counts grow by that factor along forms, so chains are short; roots are found by doubling.

The number of links is bounded by the alphabet times the words' lengths, so nothing grows with the square of a group.

Defined results: a null text has no words; a null doc_id is the empty string before the colon; rows are independent, so
repeated rows count again; letters other than A-Z keep their case; an empty table gives no words; further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, Scratch, read, word_pieces

#: Fewest code points and occurrences of a word; how much more frequent a form is.
LETTERS, TIMES, RATIO = 6, 5, 5
#: A run whose hash this divides loses a code point.
MODULUS = 199
#: Possible pairs up to which a block is compared whole.
BLOCK = 2048
#: Distinct words after which a task hands its counts on, and cells of a comparison at a time.
HELD, CELLS = 200_000, 1 << 22

#: Latin-1 bytes: A-Z lower-cased, letters as they are, all else a space.
_LETTERS = bytes(LOWER[c] if 65 <= c <= 90 or 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: int = LETTERS, times: int = TIMES) -> DataFrame:
    """(word, n): the words of all texts with at least so many code points and occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                begin = crc32(f"{'' if doc is None else doc}:".encode())
                for words in word_pieces((text or "").encode("latin-1", "replace").translate(_LETTERS)):
                    for w, n in Counter(words).items():
                        h = crc32(w if w.isascii() else w.decode("latin-1").encode(), begin)
                        if h % MODULUS == 0:
                            at = h % len(w)
                            w = w[:at] + w[at + 1 :]
                        if len(w) >= letters:
                            held[w] += n
                    if len(held) >= HELD:
                        yield out()
        if held:
            yield out()

    counts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= times)


def _half(kind, r):
    """Of r free code points of the short word: floor for replacements, ceiling for insertions."""
    return F.when(kind == "r", F.floor(r / 2)).otherwise(F.ceil(r / 2)).cast("int")


def _with_key(entries: DataFrame) -> DataFrame:
    """head and tail: what the block's words begin with and, reversed, end with."""
    tail = F.reverse(F.expr("right(word, b)"))
    return entries.withColumn("head", F.expr("left(word, a)")).withColumn("tail", F.when(F.col("b") == 0, "").otherwise(tail))


_KEY = ["kind", "m", "a", "b", "end", "head", "tail"]


def first_blocks(words: DataFrame) -> DataFrame:
    """Entries of words (word, n): as one of two of a length, as the short one and as the long one of two."""
    length = F.length("word")
    roles = F.array(*(F.struct(F.lit(k).alias("kind"), (length - s).alias("m"), F.lit(bool(s)).alias("long")) for k, s in (("r", 0), ("i", 0), ("i", 1))))
    e = words.select("word", "n", F.explode(roles).alias("e")).select("word", "n", "e.*").filter("m > 0")
    half = _half(F.col("kind"), F.col("m"))
    last = F.when(F.col("kind") == "r", F.col("m")).otherwise(F.col("m") + 1)
    sides = F.array(F.struct(half.alias("a"), F.lit(0).alias("b"), last.alias("end")), F.struct(F.lit(0).alias("a"), half.alias("b"), half.alias("end")))
    return _with_key(e.withColumn("s", F.explode(sides)).select("word", "n", "kind", "m", "long", "s.*").filter("a < end"))


def finer_blocks(entries: DataFrame) -> DataFrame:
    """The entries in the blocks that theirs are subdivided into."""
    half = _half(F.col("kind"), F.col("m") - F.col("a") - F.col("b"))
    more = F.col("a") + half
    sides = F.array(F.struct(more.alias("a2"), F.col("b").alias("b2"), F.col("end").alias("end2")), F.struct(F.col("a").alias("a2"), (F.col("b") + half).alias("b2"), F.least("end", more).alias("end2")))
    e = entries.withColumn("s", F.explode(sides)).filter("s.a2 < s.end2")
    return _with_key(e.select("word", "n", "kind", "m", "long", F.col("s.a2").alias("a"), F.col("s.b2").alias("b"), F.col("s.end2").alias("end")))


def _scan(entries: DataFrame) -> DataFrame:
    """(word, near, n): both directions of the near pairs that the blocks own; n counts near."""

    def compare(kind: str, m: int, words: np.ndarray, low: np.ndarray, high: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the pairs of rows low, high those that are near and differ first before end; words: a letter a column."""
        x, y = words[low, :m], words[high]
        differ = x != y[:, :m]
        at = np.where(differ.any(axis=1), differ.argmax(axis=1), m)
        if kind == "r":
            fine = differ.sum(axis=1) == 1
        else:
            later = x != y[:, 1 : m + 1]
            last = np.where(later.any(axis=1), m - 1 - later[:, ::-1].argmax(axis=1), -1)
            fine = last < at
        fine &= at < end
        return low[fine], high[fine]

    def block_pairs(kind: str, block: np.ndarray, long: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows (low, high) of all possible pairs within blocks, at most about CELLS / 64 at a time; rows are sorted by block, long."""
        begins = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        ends = np.concatenate([begins[1:], [len(block)]])
        end = np.repeat(ends, ends - begins)
        row = np.arange(len(block))
        if kind == "r":
            first = row + 1
        else:
            shorts = np.add.reduceat(~long, begins)
            first = np.where(long, end, np.repeat(begins + shorts, ends - begins))
        size = end - first
        cut = np.searchsorted(np.cumsum(size), np.arange(0, int(size.sum()), CELLS // 64), side="right")
        for lo, hi in zip(cut, [*cut[1:], len(block)], strict=True):
            k = size[lo:hi]
            low = np.repeat(row[lo:hi], k)
            if len(low):
                yield low, np.repeat(first[lo:hi], k) + np.arange(len(low)) - np.repeat(np.cumsum(k) - k, k)

    def scan(rows: pa.Table, kind: str, m: int) -> Iterator[pa.RecordBatch]:
        """Rows of one kind and m, in whole blocks."""
        words = rows.column("word").to_pylist()
        n = rows.column("n").to_numpy()
        key = list(zip(*(rows.column(c).to_pylist() for c in ("a", "b", "end", "head", "tail")), strict=True))
        block = np.cumsum([False, *(x != y for x, y in zip(key, key[1:], strict=False))])
        width = m + (kind == "i")
        letters = np.frombuffer("".join(w.ljust(width) for w in words).encode("latin-1"), np.uint8).reshape(-1, width)
        end = rows.column("end").to_numpy()
        step = max(1, CELLS // max(width, 64))
        for low, high in block_pairs(kind, block, rows.column("long").to_numpy(zero_copy_only=False)):
            for lo in range(0, len(low), step):
                x, y = compare(kind, m, letters, low[lo : lo + step], high[lo : lo + step], end[low[lo : lo + step]])
                if len(x):
                    a, b = np.concatenate([x, y]), np.concatenate([y, x])
                    at = pa.array(words)
                    yield pa.RecordBatch.from_arrays([at.take(pa.array(a)), at.take(pa.array(b)), pa.array(n[b])], names=["word", "near", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def whole(last: bool) -> Iterator[pa.RecordBatch]:
            """Scans what is held but, unless it is the last, its last block, which may go on."""
            nonlocal held, size
            rows = pa.Table.from_batches(held).combine_chunks()
            kinds, ms = rows.column("kind").to_pylist(), rows.column("m").to_pylist()
            stop = len(kinds)
            if not last:
                tail = [tuple(rows.column(c)[-1].as_py() for c in _KEY)] * stop
                while stop and tuple(rows.column(c)[stop - 1].as_py() for c in _KEY) == tail[0]:
                    stop -= 1
            at = 0
            while at < stop:
                to = at
                while to < stop and kinds[to] == kinds[at] and ms[to] == ms[at]:
                    to += 1
                yield from scan(rows.slice(at, to - at), kinds[at], ms[at])
                at = to
            held, size = (rows.slice(stop).to_batches() if stop < len(kinds) else []), len(kinds) - stop

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= 20_000:
                yield from whole(False)
        if held:
            yield from whole(True)

    sorted_rows = entries.repartitionByRange(*_KEY).sortWithinPartitions(*_KEY, "long", "word")
    return sorted_rows.mapInArrow(run, "word string, near string, n long")


def near_words(scratch: Scratch, words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, near, n) for all pairs of words (word, n) one edit apart, both ways; n counts near."""
    entries, out = scratch.save(first_blocks(words), "blocks"), None
    while True:
        short, long = F.sum((~F.col("long")).cast("long")), F.sum(F.col("long").cast("long"))
        pairs = F.when(F.col("kind") == "r", short * (short - 1) / 2).otherwise(short * long)
        sizes = scratch.save(entries.groupBy(*_KEY).agg(pairs.cast("long").alias("pairs")).filter("pairs > 0"), "sizes")
        free = F.col("m") - F.col("a") - F.col("b") > F.when(F.col("kind") == "r", 1).otherwise(0)
        large = (F.col("pairs") > block) & free
        found = scratch.save(_scan(entries.join(sizes.filter(~large), _KEY, "left_semi")), "near")
        out = found if out is None else out.unionByName(found)
        many = sizes.filter(large)
        if many.isEmpty():
            return out
        before, entries = entries, scratch.save(finer_blocks(entries.join(many, _KEY, "left_semi")), "blocks")
        scratch.drop(before, sizes)


def follow_forms(scratch: Scratch, forms: DataFrame) -> DataFrame:
    """(word, root) of forms (word, form): the last word that forms lead to."""
    roots = scratch.save(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = scratch.save(roots.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        more = not moved.filter("moved").isEmpty()
        scratch.drop(roots)
        roots = moved
        if not more:
            return roots.select("word", "root")


def spelling_variants(docs: DataFrame, letters: int = LETTERS, times: int = TIMES, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of docs (doc_id, text)."""
    scratch = Scratch(docs.sparkSession)
    words = scratch.save(count_words(docs, letters=letters, times=times), "words")
    near = near_words(scratch, words)
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), "near")).alias("best"))
    best = best.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))
    with_form = words.join(best, "word", "left")
    frequent = F.col("near_n") >= ratio * F.col("n")
    with_form = scratch.save(with_form.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(frequent, F.col("near")).alias("form"), F.when(frequent, F.col("near_n")).alias("form_n")), "forms")
    roots = follow_forms(scratch, with_form.filter("form is not null"))
    return with_form.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, forms and roots of all documents."""
    return spelling_variants(read(spark, sf_dir, "documents"))


#: crc32 by its table of 256 (polynomial 0xEDB88320, eight shifts each); words one edit apart by what is left without a code point.
OP12_SQL = r"""
WITH RECURSIVE steps AS (SELECT i, i::UBIGINT AS c, 0 AS k FROM range(256) AS t(i) UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
tab AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8),
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS w FROM documents WHERE text IS NOT NULL),
counted AS (SELECT doc_id, w, count(*) AS n FROM runs GROUP BY ALL HAVING length(w) >= 6),
hashed AS (SELECT w, n, xor(list_reduce(list_transform(range(1, octet_length(b) + 1), lambda i: ('0x' || substr(hex(b), 2 * i - 1, 2))::UBIGINT), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255)::INTEGER + 1]), 4294967295::UBIGINT), 4294967295) AS h
  FROM (SELECT w, n, encode(coalesce(doc_id::VARCHAR, '') || ':' || w) AS b FROM counted), tab),
words AS MATERIALIZED (SELECT w AS word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, (h % length(w))::INTEGER) || substr(w, (h % length(w))::INTEGER + 2) ELSE w END AS w, n FROM hashed)
  WHERE length(w) >= 6 GROUP BY ALL HAVING sum(n) >= 5),
cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM words, LATERAL unnest(range(1, length(word) + 1)) AS t(i)),
near AS (SELECT a.word, b.word AS near, b.n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, arg_min(near, (-n, near)) AS near, max(n) AS near_n FROM near GROUP BY word),
forms AS MATERIALIZED (SELECT word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * w.n THEN near END AS form, CASE WHEN near_n >= 5 * w.n THEN near_n END AS form_n FROM words w LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS root FROM forms UNION ALL SELECT walk.word, form FROM walk JOIN forms f ON f.word = root WHERE form IS NOT NULL),
roots AS (SELECT walk.word, root FROM walk JOIN forms f ON f.word = root WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""
