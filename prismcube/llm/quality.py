"""Quality classifier: a linear support vector machine over naive Bayes features (NB-SVM).

Features are n-gram indicators, hashed to `dims` columns: words, word pairs, word shapes (letters to a or
A, digits to 0, runs cut at two), pairs of shapes, and n-grams that begin and end with the same word (how many
eighths of the text they are). Class counts of every feature over all labelled
training rows give log-count ratios r (smoothing `alpha`); counts are summed as fixed-size vectors in each
task and then over tasks. Indicators scaled by r, each row to length 1, are the inputs of a hinge-loss
model fitted by dual coordinate descent (Hsieh et al. 2008) with an unpenalised-in-practice bias column.
The fit takes at most about `fit_rows` labelled rows, chosen by a hash of id and text, equal ones once (a documented
bound: rows go to the driver as feature ids, a few MB); counts use all labelled rows, scoring all rows. The score is a
logistic curve of the margin, its slope and offset fitted on the same rows (Platt).

Labels, lang, source and doc_id are never inputs of a score.

Defined results: null or empty text has no features, so its score is that of the bias; without labelled
rows of both classes every score is the share of label 1 (0.5 with none); ids labelled twice, and repeated
rows, count once a row in the counts; rows are independent in scoring, so repeats, null ids and further columns make no difference; whole
texts are read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from .common import Scratch, fresh, lists, map_arrow, mix64, read, texts_of

DIMS = 1 << 18
FIT_ROWS = 8_000
#: Labelled rows up to which their ids and labels are broadcast to the documents; beyond, both are shuffled.
BROADCAST_LABELS = 1_000_000
KEPT_WORDS = 300_000
#: Distances at which a word that comes again makes an indicator, one for each eighth of the words that do.
REPEAT_LAGS = 4
#: Families of indicators. Chosen by cross_validate() on labelled rows that are not held out (see README).
FAMILIES = ("words", "shapes", "pairs", "shape pairs", "repeats")
_LETTERS = bytes(ord("A") if 65 <= c <= 90 else ord("a") if 97 <= c <= 122 or c > 127 else ord("0") if 48 <= c <= 57 else c for c in range(256))
_RUNS = re.compile(rb"(.)\1{2,}", re.S)


class Features:
    """ids(text bytes): the sorted distinct feature columns of a text."""

    def __init__(self, dims: int = DIMS, families: tuple[str, ...] = FAMILIES):
        self.dims, self.families = np.uint64(dims), families
        self.memo: dict[bytes, tuple[int, int]] = {}

    def _of(self, word: bytes) -> tuple[int, int]:
        shape = _RUNS.sub(rb"\1\1", word.translate(_LETTERS))
        return zlib.crc32(word) | zlib.crc32(word, 1) << 32, zlib.crc32(shape, 2) | zlib.crc32(shape, 3) << 32

    def ids(self, data: bytes) -> np.ndarray:
        words, memo = data.split(), self.memo
        if not words:
            return np.zeros(0, np.int32)
        if len(memo) > KEPT_WORDS:
            memo.clear()
        pairs = []
        for w in words:
            p = memo.get(w)
            if p is None:
                p = self._of(w)
                if len(w) < 64:
                    memo[w] = p
            pairs.append(p)
        w, s = np.array(pairs, np.uint64).T
        three, five = np.uint64(3), np.uint64(5)
        made = {
            "words": lambda: w,
            "shapes": lambda: s,
            "pairs": lambda: w[:-1] * three + mix64(w[1:]),
            "shape pairs": lambda: s[:-1] * five + mix64(s[1:] + three),
            "repeats": lambda: np.array([k << 8 | e for k in range(1, REPEAT_LAGS + 1) if k < len(w) for e in range(1, 1 + int((w[k:] == w[:-k]).sum()) * 8 // (len(w) - k))], np.uint64),
        }
        return np.unique(mix64(np.concatenate([made[f]() for f in self.families])) % self.dims).astype(np.int32)


@dataclass
class Model:
    weights: np.ndarray  # of the indicators, r included, before rows are scaled
    ratio2: np.ndarray  # r * r, for the rows' lengths
    bias: float
    slope: float
    offset: float

    def margin(self, ids: np.ndarray) -> float:
        norm = float(np.sqrt(self.ratio2[ids].sum())) if len(ids) else 0.0
        return self.bias + (float(self.weights[ids].sum()) / norm if norm else 0.0)

    def score(self, ids: np.ndarray) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * self.margin(ids) + self.offset, -50, 50))))


def log_count_ratios(ones: np.ndarray, zeros: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    p, q = ones + alpha, zeros + alpha
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_coordinate_descent(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, cost: float = 1.0, epochs: int = 12, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights (in units of scaled indicators) and bias of the hinge-loss SVM; rows are feature ids, labels +1 or -1. The classes weigh alike."""
    w, bias = np.zeros(len(ratio)), 0.0
    scaled, square = [], np.zeros(len(rows))
    for i, ids in enumerate(rows):
        v = ratio[ids]
        norm = np.sqrt((v * v).sum())
        scaled.append((v / norm if norm else v).astype(np.float32))
        square[i] = 1.0 + (norm > 0)  # the bias column is 1
    n1 = max(1, int((labels > 0).sum()))
    top = np.where(labels > 0, cost * len(labels) / (2 * n1), cost * len(labels) / (2 * max(1, len(labels) - n1)))
    a, order, rng = np.zeros(len(rows)), np.arange(len(rows)), np.random.default_rng(seed)
    for _ in range(epochs):
        rng.shuffle(order)
        worst = 0.0
        for i in order:
            ids, x, y = rows[i], scaled[i], labels[i]
            g = y * (w[ids] @ x + bias) - 1.0
            new = min(max(a[i] - g / square[i], 0.0), top[i])
            if d := new - a[i]:
                a[i] = new
                w[ids] += d * y * x
                bias += d * y
                worst = max(worst, abs(d))
        if worst < 1e-3:
            break
    return w, bias


def _platt(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve that best gives label 1 from the margin, by Newton steps with a small ridge."""
    t, theta = (labels > 0).astype(float), np.array([1.0, 0.0])
    x = np.stack([margins, np.ones(len(margins))], 1)
    # classes weigh alike, so that 0.5 stays about where the margin is 0
    n1 = max(1.0, t.sum())
    weight = np.where(t > 0, len(t) / (2 * n1), len(t) / (2 * max(1.0, len(t) - n1)))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        grad = x.T @ (weight * (p - t)) + 1e-2 * (theta - np.array([1.0, 0.0]))
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        theta = theta - np.linalg.solve(hess, grad)
    return float(max(theta[0], 1e-3)), float(theta[1])


def fit(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, seed: int = 7) -> Model:
    """The model of rows of feature ids, labels +1 or -1, under log-count ratios."""
    w, bias = dual_coordinate_descent(rows, labels, ratio, seed=seed)
    model = Model((w * ratio).astype(np.float32), (ratio * ratio).astype(np.float32), float(bias), 1.0, 0.0)
    model.slope, model.offset = _platt(np.array([model.margin(i) for i in rows]), labels)
    return model


def cross_validate(texts: list[bytes], labels: list[int], families: tuple[str, ...] = FAMILIES, folds: int = 5, dims: int = DIMS) -> int:
    """Rows (labels 0 or 1) that models of the other folds predict wrongly. Equal texts are in one fold, by a hash of the text."""
    features, y = Features(dims, families), np.array(labels)
    ids, fold = [features.ids(t) for t in texts], np.array([zlib.crc32(t, 5) % folds for t in texts])
    wrong = 0
    for k in range(folds):
        known, counts = np.flatnonzero(fold != k), np.zeros((2, dims))
        for i in known:
            counts[y[i], ids[i]] += 1
        model = fit([ids[i] for i in known], np.where(y[known] == 1, 1.0, -1.0), log_count_ratios(counts[1], counts[0]))
        wrong += sum((model.score(ids[i]) >= 0.5) != (y[i] == 1) for i in np.flatnonzero(fold == k))
    return int(wrong)


def train(labelled: DataFrame, dims: int = DIMS, fit_rows: int = FIT_ROWS, seed: int = 7) -> Model:
    """The model of labelled rows (doc_id, text, label 0 or 1)."""
    schema = pa.schema([("label", pa.int32()), ("counts", pa.binary()), ("rows", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total, n = Features(dims), np.zeros((2, dims), np.int32), [0, 0]
        for batch in batches:
            for data, y in zip(texts_of(batch, 0), batch.column(1).to_pylist(), strict=True):
                total[y, features.ids(data)] += 1
                n[y] += 1
        for y in (0, 1):
            used = np.flatnonzero(total[y]).astype(np.int32)
            if n[y]:
                yield pa.RecordBatch.from_pydict({"label": [y], "counts": [used.tobytes() + total[y][used].tobytes()], "rows": [n[y]]}, schema=schema)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((2, dims), np.int64), [0, 0]
        for batch in batches:
            for r in batch.to_pylist():
                v = np.frombuffer(r["counts"], np.int32)
                total[r["label"], v[: len(v) // 2]] += v[len(v) // 2 :]
                n[r["label"]] += r["rows"]
        for y in (0, 1):
            used = np.flatnonzero(total[y]).astype(np.int32)
            if n[y]:
                yield pa.RecordBatch.from_pydict({"label": [y], "counts": [used.tobytes() + total[y][used].astype(np.int32).tobytes()], "rows": [n[y]]}, schema=schema)

    rows = labelled.select("text", F.col("label").cast("int").alias("label"), "doc_id").filter("label in (0, 1)")
    sums = rows.mapInArrow(count, "label int, counts binary, rows long").repartition(8).mapInArrow(add, "label int, counts binary, rows long").collect()  # 16 vectors at most
    counts, n = np.zeros((2, dims)), [0, 0]
    for r in sums:
        v = np.frombuffer(r.counts, np.int32)
        counts[r.label, v[: len(v) // 2]] += v[len(v) // 2 :]
        n[r.label] += r.rows
    ratio = log_count_ratios(counts[1], counts[0])
    share = n[1] / sum(n) if sum(n) else 0.5
    logit = float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
    if not all(n):
        return Model(np.zeros(dims, np.float32), np.ones(dims, np.float32), 0.0, 1.0, logit)

    def make():
        features = Features(dims)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([batch.column(1), lists([features.ids(t) for t in texts_of(batch, 0)], pa.int32())], names=["label", "ids"])

        return run

    limit = min(1.0, fit_rows / sum(n))
    # equal rows once, so that a row that is repeated without end takes one place
    picked = rows.withColumn("hash", F.xxhash64("doc_id", "text", F.lit(seed))).filter(F.pmod("hash", F.lit(1_000_003)) < int(limit * 1_000_003) + 1)
    sample = picked.dropDuplicates(["hash", "label"]).select("text", "label")
    chosen = map_arrow(sample, make, "label int, ids array<int>").toArrow().combine_chunks()
    ids = [x.values.to_numpy(zero_copy_only=False) if x.values is not None else np.zeros(0, np.int32) for x in chosen.column("ids")]
    y = np.where(np.array(chosen.column("label").to_pylist()) == 1, 1.0, -1.0)
    order = sorted(range(len(ids)), key=lambda i: (y[i], len(ids[i]), zlib.crc32(ids[i].tobytes())))  # whatever order the rows came in
    ids, y = [ids[i] for i in order], y[order]
    if len(set(y)) < 2:
        return Model(np.zeros(dims, np.float32), np.ones(dims, np.float32), 0.0, 1.0, logit)
    return fit(ids, y, ratio, seed)


def quality_scores(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), score: str = "score") -> DataFrame:
    """The columns keep of every row of docs and its score, in a column of that name."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two vectors of dims floats

    def make():
        features, m = Features(len(shared.value.weights)), shared.value

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            scores = [m.score(features.ids(t)) for t in texts_of(batch, batch.num_columns - 1)]
            return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())], names=[*keep, score])

        return run

    plain = docs.select(*(F.col(f"`{c}`") for c in keep), F.col("text").alias(fresh(docs, "scored_text")))
    return map_arrow(plain, make, StructType(plain.schema.fields[:-1]).add(score, DoubleType()))


def good_documents(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of docs that score at least that much, in docs' columns."""
    score = fresh(docs, "score")
    return quality_scores(docs, model, tuple(docs.columns), score).filter(F.col(score) >= least).select(*(F.col(f"`{c}`") for c in docs.columns))


def held_out(doc_id: str = "doc_id"):
    """Rows whose crc32 of the id as text leaves 1 after division by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def train_on(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of the rows of docs that are labelled and not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("l_id"), F.col("quality").cast("int").alias("label")).filter("label in (0, 1)").filter(~held_out("l_id"))
    if known.count() <= BROADCAST_LABELS:
        known = F.broadcast(known)
    scratch = Scratch(docs.sparkSession)
    rows = scratch.save(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(known, F.col("doc_id") == F.col("l_id")).select("doc_id", "text", "label"), "labelled")
    model = train(rows)
    scratch.drop(rows)
    return model


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text of documents, learned from the labels that are not held out."""
    docs = read(spark, sf_dir, "documents")
    scored = quality_scores(docs, train_on(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
