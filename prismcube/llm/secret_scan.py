"""Secret scans: a battery of randomness tests, with false-discovery control by length.

Base patterns (assignments, access keys, hexadecimal runs) are found as they are. The method adds runs of at least
`LEAST` code points of `[A-Za-z0-9+/_-]` (padding behind them included) that are random:

1. Encoding: the smallest alphabet that holds the run (hexadecimal, base 32, base 36, base 64, its URL form). Letters and
   digits must both be there, in base 64 both cases too: words and numbers have none. A run without encoding is
   looked at in its parts between `+/_-`.
2. Battery: chi-squared of the symbols against a uniform alphabet, chi-squared of its classes (capitals, small letters,
   the rest), runs about the median, and correlation of neighbours. The p-values (normal approximations with the exact
   moments under a uniform draw) are joined by Fisher's sum; its distribution over random runs of that alphabet and
   length is simulated (`DRAWS`, fixed seeds), and a run beyond its 1 - `ALPHA` quantile is not random.
3. False discoveries: a second null says what the sum is where text is written in that alphabet and length. Pairs of
   neighbouring characters are counted over all documents outside such runs, and runs drawn from that chain give the mean and
   deviation of the sum's logarithm; so a short run has to look more random than a long one, which text hardly reaches.
   The distinct runs of the corpus are tested against it and Benjamini-Hochberg at `RATE` over all of them gives the
   largest p-value that is a discovery.
A random run that is a discovery, and is not inside a base span, is a span of kind random.

Two passes over the texts; what is gathered are sums: a table of character pairs (at most 66 x 66), and a
histogram of logarithms of p-values in hundredths. Copies of a run count once (by two hashes of it, shuffled with its sum).

Defined results: a null or empty text has no spans; whole texts are scanned; rows are independent but for the corpus-wide
rate, on which repeated rows have no influence beyond the counts of pairs; null ids, empty tables and further columns make no difference.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from math import erfc, exp, log, sqrt
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, map_arrow, read, texts_of

#: Shortest run that is tested; draws of a simulation; level of the battery; rate of false discoveries.
LEAST, DRAWS, ALPHA, RATE = 16, 2000, 0.01, 0.05

ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
#: Kinds in their order at one start.
KINDS = ("assign", "access", "hex", "random")

_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Alphabets in the order in which they are tried.
ALPHABETS = {
    "hex": _DIGITS + "abcdef",
    "HEX": _DIGITS + "ABCDEF",
    "base32": _UPPER + "234567",
    "base36": _DIGITS + _LOWER,
    "BASE36": _DIGITS + _UPPER,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_",
}
_RUN = "".join(sorted(set("".join(ALPHABETS.values()))))


def _marks(characters: str) -> bytes:
    held = set(characters.encode())
    return bytes(120 if c in held else 32 for c in range(256))


_RUN_MARKS, _HEX_MARKS, _LONG = _marks(_RUN), _marks(ALPHABETS["hex"]), b"x" * LEAST
_PARTS = re.compile(rb"[A-Za-z0-9]+")
_SYMBOL = {name: np.array([a.find(chr(c)) for c in range(256)], np.int64) for name, a in ALPHABETS.items()}


def long_runs(data: bytes, marks: bytes) -> list[tuple[int, int]]:
    """Maximal runs of at least LEAST marked bytes."""
    marked, out, at = data.translate(marks), [], 0
    while (at := marked.find(_LONG, at)) >= 0:
        end = marked.find(b" ", at + LEAST)
        out.append((at, len(data) if end < 0 else end))
        at = out[-1][1]
    return out


def base_spans(data: bytes) -> list[tuple[int, int, str]]:
    """(start, end, kind) in bytes."""
    out = []
    low = data.lower()
    if any(k in low for k in (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")):
        out += [(*m.span(), "assign") for m in ASSIGN.finditer(data) if len(m[2]) >= 12]
    if b"AKIA" in data:
        out += [(*m.span(), "access") for m in ACCESS.finditer(data) if len(m[0]) >= 18]
    return out + [(a, b, "hex") for a, b in long_runs(data, _HEX_MARKS)]


def encoding(run: bytes) -> str | None:
    has = [bool(re.search(p, run)) for p in (rb"[0-9]", rb"[a-z]", rb"[A-Z]")]
    if not has[0] or not (has[1] or has[2]):
        return None
    for name, symbol in _SYMBOL.items():
        if (name.startswith("base64") and not all(has)) or (symbol[np.frombuffer(run, np.uint8)] < 0).any():
            continue
        return name
    return None


def candidates(data: bytes) -> Iterator[tuple[int, int, bytes, str]]:
    """(start, end, run without padding, encoding) of the runs to be tested; end is behind the padding."""
    for a, b in long_runs(data, _RUN_MARKS):
        pieces = [(a, b)] if encoding(data[a:b]) else [(a + m.start(), a + m.end()) for m in _PARTS.finditer(data[a:b]) if m.end() - m.start() >= LEAST]
        for x, y in pieces:
            if name := encoding(data[x:y]):
                padded = y
                while y == b and padded < min(len(data), b + 2) and data[padded : padded + 1] == b"=":
                    padded += 1
                yield x, padded, data[x:y], name


def _tail(z: np.ndarray) -> np.ndarray:
    """Upper tail of the normal distribution."""
    return np.array([0.5 * erfc(x / sqrt(2)) for x in np.ravel(z)])


@lru_cache
def _classes(name: str) -> tuple[np.ndarray, np.ndarray]:
    """Class of each symbol, and the classes' shares: capitals, small letters, the rest."""
    of = np.array([0 if c in _UPPER else 1 if c in _LOWER else 2 for c in ALPHABETS[name]])
    _, of = np.unique(of, return_inverse=True)
    return of, np.bincount(of) / len(of)


def battery(symbols: np.ndarray, name: str) -> np.ndarray:
    """Fisher's sum of the tests for each row of symbols: the larger, the less random."""
    rows, n = symbols.shape
    k = len(ALPHABETS[name])
    base = np.arange(rows)[:, None]

    def uneven(values: np.ndarray, share: np.ndarray) -> np.ndarray:
        """Chi-squared, standardised by its exact mean and variance; its cube root is close to normal."""
        cells = len(share)
        count = np.bincount((base * cells + values).ravel(), minlength=rows * cells).reshape(rows, cells)
        t = ((count - n * share) ** 2 / (n * share)).sum(axis=1)
        mean, var = cells - 1, 2 * (cells - 1) + ((1 / share).sum() - cells * cells - 2 * cells + 2) / n
        free = 2 * mean * mean / var  # scaled chi-squared of the same moments
        return _tail((np.cbrt(t / mean) - (1 - 2 / (9 * free))) / sqrt(2 / (9 * free)))

    of, share = _classes(name)
    p = [uneven(symbols, np.full(k, 1 / k)), uneven(of[symbols], share)]
    high = symbols > np.median(symbols, axis=1, keepdims=True)
    n1 = high.sum(axis=1)
    n2 = n - n1
    runs = 1 + (high[:, 1:] != high[:, :-1]).sum(axis=1)
    mean = 2 * n1 * n2 / n + 1
    var = np.maximum((mean - 1) * (mean - 2) / (n - 1), 1e-9)
    p.append(np.minimum(1, 2 * _tail(np.maximum(np.abs(runs - mean) - 0.5, 0) / np.sqrt(var))))
    x = symbols - symbols.mean(axis=1, keepdims=True)
    square = np.maximum((x * x).sum(axis=1), 1e-9)
    r = (x[:, 1:] * x[:, :-1]).sum(axis=1) / square
    p.append(np.minimum(1, 2 * _tail(np.abs(r + 1 / n) * sqrt(n))))
    return -2 * np.log(np.maximum(np.array(p), 1e-300)).sum(axis=0)


def sum_of(run: bytes, name: str) -> float:
    return float(battery(_SYMBOL[name][np.frombuffer(run, np.uint8)][None, :], name)[0])


def grid(n: int) -> int:
    """The length whose simulation stands for n: itself to 64, then steps of a quarter to 1024."""
    while n > 64:
        step = 1 << (n.bit_length() - 3)
        return min(n // step * step, 1024)
    return n


def _draws(name: str, n: int, what: int) -> np.random.Generator:
    return np.random.default_rng(crc32(f"{name}:{n}:{what}".encode()))


@lru_cache(None)
def random_limit(name: str, n: int) -> float:
    """The 1 - ALPHA quantile of the sum over random runs."""
    symbols = _draws(name, n, 0).integers(0, len(ALPHABETS[name]), (DRAWS, n))
    return float(np.quantile(battery(symbols, name), 1 - ALPHA))


def text_null(name: str, n: int, pairs: np.ndarray) -> tuple[float, float]:
    """Mean and deviation of the logarithm of the sum over runs drawn from the chain of pairs (256 x 256 counts)."""
    codes = np.frombuffer(ALPHABETS[name].encode(), np.uint8)
    table = pairs[np.ix_(codes, codes)].astype(float)
    table = table + (table.sum(axis=1, keepdims=True) + 1) * 1e-3 / len(codes)
    first = np.cumsum(table.sum(axis=1) / table.sum())
    step = np.cumsum(table / table.sum(axis=1, keepdims=True), axis=1)
    u = _draws(name, n, 1).random((DRAWS, n))
    out = np.empty((DRAWS, n), np.int64)
    out[:, 0] = np.minimum(np.searchsorted(first, u[:, 0]), len(codes) - 1)
    for j in range(1, n):
        out[:, j] = np.minimum((step[out[:, j - 1]] < u[:, j : j + 1]).sum(axis=1), len(codes) - 1)
    sums = np.log(np.maximum(battery(out, name), 1e-6))
    return float(sums.mean()), float(max(sums.std(), 1e-3))


def log_p(total: float, null: tuple[float, float]) -> float:
    """Natural logarithm of the chance that text has so small a sum."""
    z = (null[0] - log(max(total, 1e-6))) / null[1]
    if z < 20:
        return log(0.5 * erfc(z / sqrt(2)))
    return -z * z / 2 - log(z * sqrt(2 * 3.141592653589793))


def _observed(docs: DataFrame) -> DataFrame:
    """Rows of tasks: counts of pairs (pair, n), and runs (name, grid length, hashes, sum)."""
    keep = np.zeros((256, 256), bool)
    codes = np.frombuffer(_RUN.encode(), np.uint8)
    keep[np.ix_(codes, codes)] = True
    keep = keep.ravel()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros(65536, np.int64)
        for batch in batches:
            names, lengths, h1, h2, sums = [], [], [], [], []
            for data in texts_of(batch, 0):
                at = 0
                for a, b in [*long_runs(data, _RUN_MARKS), (len(data), len(data))]:
                    for lo in range(at, a, 1 << 20):
                        x = np.frombuffer(data, np.uint8, min(a - lo, (1 << 20) + 1), lo).astype(np.int32)
                        code = x[:-1] * 256 + x[1:]
                        np.add.at(pairs, code, 1) if len(code) < 4096 else np.add(pairs, np.bincount(code, minlength=65536), out=pairs)
                    at = b
                for _, _, token, name in candidates(data):
                    names.append(name)
                    lengths.append(grid(len(token)))
                    h1.append(crc32(token))
                    h2.append(crc32(token, 0x5EED) ^ len(token) << 32)
                    sums.append(sum_of(token, name))
            if names:
                yield pa.RecordBatch.from_pydict({"pair": pa.nulls(len(names), pa.int32()), "n": pa.array([1] * len(names), pa.int64()), "name": names, "size": pa.array(lengths, pa.int32()), "h1": pa.array(h1, pa.int64()), "h2": pa.array(h2, pa.int64()), "total": pa.array(sums, pa.float64())})
        at = np.flatnonzero((pairs > 0) & keep)
        none = lambda kind: pa.nulls(len(at), kind)
        yield pa.RecordBatch.from_pydict({"pair": pa.array(at, pa.int32()), "n": pa.array(pairs[at]), "name": none(pa.string()), "size": none(pa.int32()), "h1": none(pa.int64()), "h2": none(pa.int64()), "total": none(pa.float64())})

    return docs.select(F.col("text")).mapInArrow(run, "pair int, n long, name string, size int, h1 long, h2 long, total double")


def largest_log_p(bins: list[tuple[int, int]], rate: float) -> float | None:
    """Benjamini-Hochberg: the largest logarithm of p that is a discovery; bins: (-log p in hundredths, rounded down; count)."""
    m, held, out = sum(n for _, n in bins), 0, None
    for b, n in sorted(bins, reverse=True):
        held += n
        if -b / 100 <= log(rate * held / m):
            out = -b / 100
    return out


def fit(docs: DataFrame, rate: float = RATE) -> dict:
    """{"limit": largest logarithm of p, or None; "nulls": {(name, length): (mean, deviation)}} of all docs."""
    scratch = Scratch(docs.sparkSession)
    seen = scratch.save(_observed(docs.select(F.col("text").alias("text"))), "seen")
    pairs = np.zeros(65536, np.int64)
    for r in seen.filter("pair is not null").groupBy("pair").agg(F.sum("n").alias("n")).collect():  # at most 66 x 66
        pairs[r.pair] = r.n
    pairs = pairs.reshape(256, 256)
    runs = seen.filter("name is not null").select("name", "size", "h1", "h2", "total").dropDuplicates(["h1", "h2"])
    runs = scratch.save(runs, "runs")
    nulls = {(r.name, r.size): text_null(r.name, r.size, pairs) for r in runs.select("name", "size").distinct().collect()}  # alphabets x grid

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True)
        return pa.RecordBatch.from_arrays([pa.array([int(-100 * log_p(t, nulls[n, s])) for n, s, t in found], pa.int32())], names=["bin"])

    bins = map_arrow(runs.select("name", "size", "total"), lambda: run, "bin int").groupBy(F.least("bin", F.lit(20_000)).alias("bin")).count()
    limit = largest_log_p([(r[0], r[1]) for r in bins.collect()], rate)  # 20,001 at most
    scratch.drop(seen, runs)
    return {"limit": limit, "nulls": nulls}


def is_secret(run: bytes, name: str, fitted: dict) -> bool:
    """Random by the battery, and a discovery against text."""
    if fitted["limit"] is None:
        return False
    size, total = grid(len(run)), sum_of(run, name)
    null = fitted["nulls"].get((name, size))
    return null is not None and total <= random_limit(name, size) and int(-100 * log_p(total, null)) >= round(-100 * fitted["limit"])


def spans_of(data: bytes, fitted: dict) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, by start and kind."""
    base = base_spans(data)
    out, reach, k = list(base), 0, 0
    base.sort()
    for a, b, token, name in candidates(data):
        while k < len(base) and base[k][0] <= a:
            reach = max(reach, base[k][1])
            k += 1
        if b > reach and is_secret(token, name, fitted):
            out.append((a, b, "random"))
    if not out or data.isascii():
        return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))
    places, point, at = {}, 0, 0
    for p in sorted({x for s in out for x in s[:2]}):
        point, at = point + len(data[at:p].decode(errors="replace")), p
        places[p] = point
    return sorted(((places[a], places[b], kind) for a, b, kind in out), key=lambda s: (s[0], KINDS.index(s[2])))


def secret_spans(docs: DataFrame, fitted: dict | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans: array of (kind, start, end)) for every row of docs; fitted: fit() of another corpus, else of docs."""
    rows = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(fitted or fit(rows))
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [[{"kind": k, "start": a, "end": b} for a, b, k in spans_of(data, shared.value)] for data in texts_of(batch)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(item))], names=[id_col, "spans"])

    return map_arrow(rows, lambda: run, f"{id_col} long, spans array<struct<kind: string, start: long, end: long>>")


def secret_scan(docs: DataFrame) -> DataFrame:
    """The digest columns of secret_spans."""
    count = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
    base = F.filter("spans", lambda s: s.kind.isin("assign", "access", "hex"))
    return secret_spans(docs).select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text of documents."""
    return secret_scan(read(spark, sf_dir, "documents"))
