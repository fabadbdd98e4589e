"""Near-duplicate documents: b-bit MinHash, then exact confirmation, then components.

1. Signatures. A document's set is its distinct word shingles (64-bit hashes). 256 linear hash functions
   give 256 minima; two bits of each, mixed, are packed into two bit planes of four longs. Bands of minima
   give bucket keys. This pass reads each text once and shuffles nothing.
2. Exact copies (equal word sequences, by a 128-bit hash) are one node: the smallest id.
3. Candidates. Buckets of one node are dropped. In each bucket, pivots are compared with all members of a
   size that can reach the threshold: first the member that shares most buckets with others, then, in rounds,
   members of components that are the minority in their bucket, more each round. A pivot that was
   compared with a bucket leaves it. Rounds end when every bucket's remaining members are in one component,
   so every pair of a bucket is either compared or already connected: the components are those of all pairs,
   while a group of near copies costs a row or two a member, not a row a pair.
   Documents that share a long common passage, or differ from one text in many places each, also meet in
   buckets, many of them and unlike one another. So after the first round, buckets that are still mixed and
   hold more than `SMALL` members are replaced by a finer, exact rule for their members. Order each set's
   shingles by how few of these members have them. Of two sets of that similarity, the smaller (by size, id)
   has one of its n - ceil(2t/(1+t) n) + 1 first shingles among the m - ceil(t m) + 1 first of the larger
   (prefix filtering), and shingles that set a member apart come first. Those shingles become the buckets of
   the rounds to come; in them only members by the short prefix are pivots, compared with larger members, and
   the places of the shingle in both orders must leave room for the intersection that the threshold takes.
4. b-bit filter. Within that comparison, for each pair, the share of equal two-bit minima, corrected for chance collisions
   ((share - 1/4) / (3/4)), estimates the similarity; pairs five standard errors below the threshold go, unless
   both sets have `SMALL_SET` shingles at most. This holds in the finer buckets, too: their rule is exact, the filter is not.
5. Confirmation. Whole sets of the pairs left are intersected: links are exact.
6. Components by contraction (common.connected_components).

Buckets, pivots and links stay distributed; counts of ids are the only numbers that reach the driver.
Hot buckets and hot pivots meet in equi-joins that adaptive execution splits, and aggregates combine
before the shuffle. Chance of missing a pair at the threshold itself: (1 - t^rows)^bands, 4e-5 for 0.85
with 32 bands of 8 (much less above it, and groups have many pairs). Chance that the filter drops a pair at
the threshold itself, were its errors binomial: 2e-6 for 0.85, 3e-6 for 0.8 (less above it).

Defined results: null or empty text has an empty set, is linked with nothing and keeps its own component;
a null id is linked with nothing, its component is null and it is kept; rows of one id are one document
and give a row each; ties cannot occur (ids order all); an empty table gives an empty result; further
columns are ignored. Whole texts are read, in blocks of shingles, so memory does not grow with 256 times
a long text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, connected_components, fresh, lists, map_arrow, mix64, read, texts_of

HASHES = 256
KEPT_WORDS = 300_000
#: Ids up to which a set of them is broadcast; beyond, it is shuffled.
BROADCAST_IDS = 1_000_000
#: Members up to which a mixed bucket is compared as it is.
SMALL = 16
#: Shingles up to which two sets are confirmed without an estimate.
SMALL_SET = 32
_SEEDS = np.random.default_rng(20_240_117)
_A = _SEEDS.integers(0, 2**31, HASHES, np.uint32) * np.uint32(2) + np.uint32(1)
_B = _SEEDS.integers(0, 2**32, HASHES, np.uint32)


@dataclass(frozen=True)
class Params:
    """Documents are linked if 100 * intersection >= percent * union of their sets of `words`-word shingles."""

    words: int = 5
    percent: int = 80
    bands: int = 42
    rows: int = 6

    @property
    def least_estimate(self) -> float:
        t = self.percent / 100
        p = 0.25 + 0.75 * t
        return t - 5 * (p * (1 - p) / HASHES) ** 0.5 / 0.75


class Shingler:
    """set_of(text bytes): the key of its word sequence and the sorted distinct shingle hashes."""

    def __init__(self, words: int):
        self.words, self.memo = words, {}

    def set_of(self, data: bytes) -> tuple[bytes | None, np.ndarray]:
        words, memo = data.lower().split(), self.memo
        if not words:
            return None, np.zeros(0, np.uint64)
        if len(memo) > KEPT_WORDS:
            memo.clear()
        ids = []
        for w in words:
            h = memo.get(w)
            if h is None:
                h = xxhash.xxh64_intdigest(w)
                if len(w) < 64:
                    memo[w] = h
            ids.append(h)
        v = np.array(ids, np.uint64)
        k = min(self.words, len(v))
        h = np.full(len(v) - k + 1, k, np.uint64)
        for j in range(k):
            h = mix64(h + v[j : len(v) - k + 1 + j])
        return xxhash.xxh128_digest(b" ".join(words)), np.unique(h)


def minima(shingles: np.ndarray, block: int = 2048) -> np.ndarray:
    """The 256 minima of a set that is not empty."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for lo in range(0, len(x), block):
        m = np.multiply.outer(_A, x[lo : lo + block])
        m += _B[:, None]
        np.minimum(out, m.min(axis=1), out=out)
    return out


def band_keys(sigs: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(documents, bands) bucket keys of (documents, 256) minima."""
    s = sigs[:, : bands * rows].reshape(len(sigs), bands, rows).astype(np.uint64)
    h = np.broadcast_to(mix64(np.arange(1, bands + 1, dtype=np.uint64)), s.shape[:2])
    for c in range(rows):
        h = mix64(h ^ (s[:, :, c] + np.uint64(0x9E3779B97F4A7C15)))
    return h.view(np.int64)


def planes(sigs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of a hash of each minimum, each (documents, 4) longs.

    The low bits of the minima themselves would not do: the multipliers are odd, so two given shingles agree or
    differ in them under all functions at once.
    """
    sigs = mix64(sigs.astype(np.uint64) + (np.arange(HASHES, dtype=np.uint64) << np.uint64(32)))
    pack = lambda k: np.ascontiguousarray(np.packbits((sigs >> np.uint64(k) & np.uint64(1)).astype(bool), axis=1)).view(np.int64)
    return pack(0), pack(1)


_WORDS64 = [f"p{plane}{k}" for plane in (0, 1) for k in range(HASHES // 64)]


def signatures(docs: DataFrame, params: Params) -> DataFrame:
    """(doc_id, n_shingles, text_key, bit planes, band keys) for every row of docs."""

    def make():
        shingler = Shingler(params.words)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, keys, sigs, has = [], [], [], []
            for k, data in enumerate(texts_of(batch)):
                key, sh = shingler.set_of(data)
                sizes.append(len(sh))
                keys.append(key)
                if len(sh):
                    has.append(k)
                    sigs.append(minima(sh))
            n = len(sizes)
            packed, bands = np.zeros((2 * HASHES // 64, n), np.int64), [np.zeros(0, np.int64)] * n
            if sigs:
                m = np.stack(sigs)
                p0, p1 = planes(m)
                packed[: HASHES // 64, has], packed[HASHES // 64 :, has] = p0.T, p1.T
                for k, b in zip(has, band_keys(m, params.bands, params.rows), strict=True):
                    bands[k] = b
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), *(pa.array(x) for x in packed), lists(bands, pa.int64())],
                names=["doc_id", "n_shingles", "text_key", *_WORDS64, "bands"],
            )

        return run

    cols = ", ".join(f"{c} long" for c in _WORDS64)
    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make, f"doc_id long, n_shingles long, text_key binary, {cols}, bands array<long>")


def shingle_sets(docs: DataFrame, params: Params) -> DataFrame:
    """(doc_id, shingles) with the whole sets of docs."""

    def make():
        shingler = Shingler(params.words)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([batch.column(0), lists([shingler.set_of(t)[1].view(np.int64) for t in texts_of(batch)], pa.int64())], names=["doc_id", "shingles"])

        return run

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make, "doc_id long, shingles array<long>")


def with_ids(docs: DataFrame, ids: DataFrame, how: str, key: str = "doc_id") -> DataFrame:
    """docs left_semi or left_anti ids(id): ids are broadcast if they are few, else both sides are shuffled."""
    name = fresh(docs, "wanted_id")
    ids = ids.select(F.col("id").alias(name))
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, F.col(key) == F.col(name), how)


def _estimate():
    """The b-bit estimate of similarity from columns p00.. and p_p00..: equal two-bit minima, corrected for chance."""
    half = HASHES // 64
    differ = [F.bit_count(F.col(f"p0{k}").bitwiseXOR(F.col(f"p_p0{k}")).bitwiseOR(F.col(f"p1{k}").bitwiseXOR(F.col(f"p_p1{k}")))) for k in range(half)]
    return (1.0 - sum(differ[1:], differ[0]) / float(HASHES) - 0.25) / 0.75


class _Links:
    """Confirms pairs (x, p) of nodes; keeps the sets that it has computed for the rounds to come."""

    def __init__(self, scratch: Scratch, docs: DataFrame, params: Params):
        self.scratch, self.docs, self.params = scratch, docs, params
        self.sets: DataFrame | None = None

    def fetch(self, ids: DataFrame) -> None:
        """Adds the sets of ids (id) that are not there yet."""
        if self.sets is not None:
            ids = ids.join(self.sets.select(F.col("doc_id").alias("id")), "id", "left_anti")
        ids = self.scratch.save(ids, "wanted")
        if self.sets is None or not ids.isEmpty():
            more = self.scratch.save(shingle_sets(with_ids(self.docs, ids, "left_semi"), self.params), "sets")
            self.sets = more if self.sets is None else self.sets.unionByName(more)
        self.scratch.drop(ids)

    def rare_shared(self, ids: DataFrame) -> DataFrame:
        """(bucket, id, index, directed, at): shingles in the prefixes of at least two of ids; index: it is in the short prefix, too."""
        self.fetch(ids)
        each = self.sets.join(ids, F.col("doc_id") == F.col("id"), "left_semi").dropDuplicates(["doc_id"]).select(F.col("doc_id").alias("id"), F.size("shingles").alias("n"), F.explode("shingles").alias("s"))
        often = each.groupBy("s").agg(F.count(F.lit(1)).alias("df"))
        ranked = each.join(often, "s").groupBy("id").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "s"))).alias("all"))
        t, n = self.params.percent, F.col("n").cast("long")
        ceil = lambda a, b: F.floor((a + b - 1) / b)
        long, short = n - ceil(t * n, 100) + 1, n - ceil(2 * t * n, 100 + t) + 1
        prefix = ranked.select("id", short.alias("short"), F.posexplode(F.slice("all", 1, long.cast("int"))).alias("at", "x")).filter("x.df > 1")
        prefix = self.scratch.save(prefix.select(F.col("x.s").alias("bucket"), "id", (F.col("at") < F.col("short")).alias("index"), F.lit(True).alias("directed"), "at"), "prefix")
        shared = prefix.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.max("index").alias("any")).filter("n > 1 and any").select("bucket")
        return prefix.join(shared, "bucket")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The links (a, b) among distinct pairs (x, p), by their whole sets."""
        likely = self.scratch.save(pairs, "likely")
        ids = likely.select(F.col("x").alias("id")).unionByName(likely.select(F.col("p").alias("id"))).distinct()
        self.fetch(ids)
        a = self.sets.select(F.col("doc_id").alias("x"), F.col("shingles").alias("sx"))
        b = self.sets.select(F.col("doc_id").alias("p"), F.col("shingles").alias("sp"))
        common = F.size(F.array_intersect("sx", "sp")).cast("long")
        union = F.size("sx") + F.size("sp") - common
        links = likely.join(a, "x").join(b, "p").filter(100 * common >= self.params.percent * union)
        out = self.scratch.save(links.select(F.least("x", "p").alias("a"), F.greatest("x", "p").alias("b")), "links")
        self.scratch.drop(likely)
        return out


def _mixed(scratch: Scratch, members: DataFrame, components: DataFrame) -> DataFrame:
    """Members (bucket, id, index, directed) of buckets with more than one component and a pivot to come: with component, rank (0 if it is not the bucket's largest) and the bucket's members."""
    known = members.join(components, "id", "left").select("bucket", "id", "index", "directed", "at", F.coalesce("component", "id").alias("component"))
    known = scratch.save(known, "known")
    sizes = known.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"), F.max("index").alias("index"))
    mixed = sizes.groupBy("bucket").agg(F.count(F.lit(1)).alias("parts"), F.max("index").alias("more"), F.sum("n").alias("members"), F.max(F.struct("n", "component")).alias("top")).filter("parts > 1 and more")
    out = known.join(mixed.select("bucket", "members", F.col("top.component").alias("main")), "bucket")
    out = scratch.save(out.select("bucket", "id", "index", "directed", "at", "component", (F.col("component") == F.col("main")).cast("long").alias("rank"), "members"), "live")
    scratch.drop(known)
    return out


def near_duplicates(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of docs."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    sigs = scratch.save(signatures(docs, params), "signatures")
    classes = scratch.save(sigs.filter("text_key is not null and doc_id is not null").groupBy("text_key").agg(F.min("doc_id").alias("rep")), "classes")
    nodes = sigs.join(classes.select(F.col("rep").alias("doc_id"), "text_key"), ["doc_id", "text_key"], "left_semi").withColumnRenamed("doc_id", "id")
    nodes = scratch.save(nodes.dropDuplicates(["id", "text_key"]), "nodes")
    exploded = nodes.select("id", F.explode("bands").alias("bucket"))
    shared = exploded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = scratch.save(exploded.join(shared, "bucket"), "members")
    popular = members.groupBy("id").agg(F.sum("n").alias("popularity"))
    members = members.select("bucket", "id").join(popular, "id")
    links = _Links(scratch, docs, params)

    live = members.select("bucket", "id", F.lit(True).alias("index"), F.lit(False).alias("directed"), F.lit(0).alias("at"), F.col("id").alias("component"), (-F.col("popularity")).alias("rank"))
    live = scratch.save(live, "live")
    parts = ["id", "at", "component", "n_shingles", *_WORDS64]
    marked = nodes.select("id", "n_shingles", *_WORDS64)
    like = F.col("id") != F.col("p_id")
    like &= F.col("component") != F.col("p_component")
    size, p_size = F.col("n_shingles"), F.col("p_n_shingles")
    like &= ~F.col("directed") | (p_size < size) | ((p_size == size) & (F.col("p_id") < F.col("id")))
    # a shared shingle at these places leaves room for so large an intersection, if it is the first shared one
    like &= ~F.col("directed") | ((100 + params.percent) * F.least(size - F.col("at"), p_size - F.col("p_at")) >= params.percent * (size + p_size))
    like &= 100 * F.least(size, p_size) >= params.percent * F.greatest(size, p_size)
    like &= (F.greatest(size, p_size) <= SMALL_SET) | (_estimate() >= params.least_estimate)
    edges: list[DataFrame] = []
    components, each = None, 1
    while True:
        live = live.join(marked, "id")
        pivots = live.filter("index").groupBy("bucket", F.pmod(F.xxhash64("id"), F.lit(each)).alias("salt")).agg(F.min(F.struct("rank", *parts)).alias("m"))
        pivots = scratch.save(pivots.select("bucket", *(F.col(f"m.{c}").alias(f"p_{c}") for c in parts)), "pivots")
        pairs = live.join(pivots, "bucket").filter(like).select(F.least("id", "p_id").alias("x"), F.greatest("id", "p_id").alias("p")).distinct()
        edges.append(links.confirmed(pairs))
        every = edges[0]
        for e in edges[1:]:
            every = every.unionByName(e)
        if components is None or not edges[-1].isEmpty():
            components = connected_components(scratch, every)
        rest = live.join(pivots.select("bucket", F.col("p_id").alias("id"), F.lit(True).alias("used")), ["bucket", "id"], "left").filter("used is null or directed")
        rest = rest.select("bucket", "id", (F.col("index") & F.col("used").isNull()).alias("index"), "directed", "at")
        live = _mixed(scratch, rest, components)
        if each == 1:
            large = live.filter(F.col("members") > SMALL)
            ids = scratch.save(large.select("id").distinct(), "large")
            if not ids.isEmpty():
                finer = _mixed(scratch, links.rare_shared(ids), components)
                live = scratch.save(live.filter(F.col("members") <= SMALL).unionByName(finer), "live")
        if live.isEmpty():
            break
        each = max(256, 8 * each)

    final = classes.join(components.withColumnRenamed("id", "rep"), "rep", "left").select("text_key", F.coalesce("component", "rep").alias("component"))
    out = sigs.select("doc_id", "n_shingles", "text_key").join(final, "text_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
    out = scratch.save(out, "result")
    scratch.drop(sigs, classes, nodes, *edges)
    return out


def deduplicate(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """The rows of docs, in docs' columns, of which one document of each group stays (the smallest id); a repeated id stays once, rows without id stay."""
    found = near_duplicates(docs, params)
    kept = with_ids(docs, found.filter("not kept").select(F.col("doc_id").alias("id")).distinct(), "left_anti")
    twice = found.filter("kept and doc_id is not null").groupBy(F.col("doc_id").alias("id")).count().filter("count > 1")
    if twice.isEmpty():
        return kept
    return with_ids(kept, twice, "left_anti").unionByName(with_ids(kept, twice, "left_semi").dropDuplicates(["doc_id"]))


#: The contract's set: three words, 85 of 100.
OP3 = Params(words=3, percent=85, bands=32, rows=8)


def op3_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near copies over all documents."""
    return near_duplicates(read(spark, sf_dir, "documents"), OP3)


OP3_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, hash(list_slice(w, i, i + least(3, len(w)) - 1)) AS h FROM d, LATERAL unnest(range(1, len(w) - least(3, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
f AS (SELECT h FROM s GROUP BY h HAVING count(*) > 1),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN f USING (h) JOIN s b USING (h) WHERE a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM c JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * k >= 85 * (nx.n + ny.n - k)),
both_ways AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
reach AS (SELECT doc_id, doc_id AS r FROM d UNION SELECT reach.doc_id, y FROM reach JOIN both_ways ON x = r),
comp AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept FROM d JOIN comp USING (doc_id) LEFT JOIN n USING (doc_id)
"""
