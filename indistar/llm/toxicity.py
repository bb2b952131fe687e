"""Severity of toxic language by cumulative-link ordinal regression.

``P(grade > j) = sigmoid(w.x - t_j)`` with one weight vector for all ordered
thresholds ``t_0 < t_1 < ...``; a document's severity is the expected grade,
the sum of these probabilities.  Features are hashed words and word starts;
each distinct word of a text adds the log of its count to its features.

The labels say only toxic or not, so grades are derived from them: 0 for
clean, 1 for the toxic labelled documents with a share of tell-tale words up
to the median, 2 above it; a tell-tale word is one much more frequent in toxic
than in clean labelled documents.  The model is fitted on at most
``train_rows`` labelled rows in hash order; scoring is a narrow pass.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indistar.llm.common import utf8
from indistar.llm.decontaminate import words_of
from indistar.llm.langid import held_out

BITS = 18
MASK = (1 << BITS) - 1
TRAIN_ROWS = 6_000
STARTS = (4, 5, 6, 7)  # lengths of the word starts, in characters
MIN_ROWS = 2  # labelled rows that a feature needs
_CACHE = 400_000
STEPS = 200
L2 = 1e-4


def word_features(word: bytes) -> list[int]:
    """Hash slots of a word and its starts."""
    text = word.decode("utf-8", "replace")
    starts = {text[:n] for n in STARTS if n < len(text)}
    return [zlib.crc32(word) & MASK] + [zlib.crc32(b"^" + p.encode("utf-8", "replace")) & MASK for p in sorted(starts)]


def features(raw: bytes | None) -> tuple[np.ndarray, np.ndarray, int]:
    """Slots, their values, and the number of words of a text."""
    words = words_of(raw)
    slots, values = [], []
    for word, n in Counter(words).items():
        own = word_features(word)
        slots += own
        values += [math.log1p(n)] * len(own)
    at, where = np.unique(np.array(slots, np.int64), return_inverse=True)
    return at, np.bincount(where, values, len(at)).astype(np.float32), len(words)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


@dataclass
class OrdinalModel:
    weights: np.ndarray  # one for each hashed word
    thresholds: np.ndarray  # ascending

    def above(self, total: float) -> np.ndarray:
        """P(grade > j) for every threshold j, given w.x."""
        return _sigmoid(total - self.thresholds)


def derived_grades(rows: list[tuple], toxic: np.ndarray) -> np.ndarray:
    """0 for clean, 1 or 2 for toxic rows by their share of tell-tale words."""
    n_toxic, n_clean = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    seen = np.zeros((2, 1 << BITS))
    for (at, _, _), t in zip(rows, toxic):
        seen[int(t), at] += 1
    odds = np.log((seen[1] + 0.5) / (n_toxic + 1)) - np.log((seen[0] + 0.5) / (n_clean + 1))
    tell = (odds > 2.0) & (seen[1] >= 3)
    share = np.array([x[tell[at]].sum() / max(1, size) for at, x, size in rows])
    middle = np.median(share[toxic]) if toxic.any() else 0.0
    return np.where(~toxic, 0, np.where(share <= middle, 1, 2))


def fit_ordinal(rows: list[tuple], grades: np.ndarray, n_grades: int, steps: int = STEPS, l2: float = L2) -> OrdinalModel:
    """Full-batch Adam on the mean negative log likelihood.  Without rows, or
    with one grade only, the model gives every text that grade."""
    weights = np.zeros(1 << BITS)
    if not len(rows) or len(set(grades.tolist())) < 2:
        low = int(grades[0]) if len(grades) else 0
        return OrdinalModel(weights, np.where(np.arange(n_grades - 1) < low, -35.0, 35.0))
    row = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r[0]) for r in rows])
    col = np.concatenate([r[0] for r in rows])
    val = np.concatenate([r[1] for r in rows]).astype(np.float64)
    keep = (np.bincount(col, minlength=1 << BITS) >= MIN_ROWS)[col]
    row, col, val = row[keep], col[keep], val[keep]
    used, col = np.unique(col, return_inverse=True)
    share = np.array([max(1e-3, (grades > j).mean()) for j in range(n_grades - 1)])
    share = np.minimum.accumulate(np.minimum(share, 1 - 1e-3))
    start = np.log1p(-share) - np.log(share)
    gaps = np.maximum(np.diff(start), 0.1)
    x = np.concatenate([np.zeros(len(used)), [start[0]], np.log(gaps)])
    m, v = np.zeros_like(x), np.zeros_like(x)

    def thresholds(x):
        return x[len(used)] + np.concatenate([[0.0], np.cumsum(np.exp(x[len(used) + 1:]))])

    high = grades < n_grades - 1  # has an upper threshold
    low = grades > 0
    for step in range(1, steps + 1):
        t = thresholds(x)
        s = np.bincount(row, val * x[col], len(rows))
        upper = np.where(high, _sigmoid(t[np.minimum(grades, n_grades - 2)] - s), 1.0)
        lower = np.where(low, _sigmoid(t[np.maximum(grades - 1, 0)] - s), 0.0)
        p = np.maximum(upper - lower, 1e-9)
        du, dl = upper * (1 - upper) * high / p, lower * (1 - lower) * low / p
        ds = (du - dl) / len(rows)
        g = np.zeros_like(x)
        g[:len(used)] = np.bincount(col, val * ds[row], len(used)) + l2 * x[:len(used)]
        dt = np.zeros(n_grades - 1)
        np.add.at(dt, grades[high], -du[high] / len(rows))
        np.add.at(dt, grades[low] - 1, dl[low] / len(rows))
        g[len(used)] = dt.sum()
        tails = np.cumsum(dt[::-1])[::-1]
        g[len(used) + 1:] = tails[1:] * np.exp(x[len(used) + 1:])
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        x = x - 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    weights[used] = x[:len(used)]
    return OrdinalModel(weights, thresholds(x))


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, id_col: str = "doc_id",
          text_col: str = "text", toxic_col: str = "toxic") -> OrdinalModel:
    """Fit on labelled documents that are not held out, ``train_rows`` at most
    (the first in hash order); labels that are null or without a document are
    skipped.  Of an id that repeats, the text with the least hash counts, so
    no more than ``train_rows`` rows reach the driver."""
    chosen = labels.where(F.col(id_col).isNotNull() & F.col(toxic_col).isNotNull() & ~held_out(id_col)) \
        .groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(toxic_col).cast("int")).alias("toxic")) \
        .orderBy(F.xxhash64("id"), "id").limit(train_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [features(raw.as_py()) for raw in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([g[0] for g in got], pa.list_(pa.int32())),
                 pa.array([g[1] for g in got], pa.list_(pa.float32())), pa.array([g[2] for g in got], pa.int64())],
                names=["id", "toxic", "at", "n", "size"])

    texts = docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("text"))
    one = F.min(F.when(F.col("text").isNotNull(), F.struct(F.xxhash64("text").alias("h"), "text")))
    rows = texts.join(F.broadcast(chosen), "id").groupBy("id").agg(F.first("toxic").alias("toxic"), one.alias("x")) \
        .select("id", "toxic", "x.text").select(F.col("id").cast("long").alias("id"), "toxic", "text") \
        .mapInArrow(run, "id long, toxic int, at array<int>, n array<float>, size long").toArrow().sort_by("id")
    data = [(a.values.to_numpy().astype(np.int64), x.values.to_numpy(), size.as_py())
            for a, x, size in zip(rows["at"], rows["n"], rows["size"])]
    grades = derived_grades(data, np.array(rows["toxic"].to_pylist(), int) > 0)
    return fit_ordinal(data, grades, 3)


def score(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, held_out, severity, grade, toxic``.

    ``severity`` is the expected grade (0 to 2), ``grade`` the most likely one,
    ``toxic`` says that a grade above 0 is more likely than not.  A text that is null or
    has no words scores 0, is not toxic, and has grade 0.  Null ids and
    repeated rows are scored like any other; other columns are not read.
    """
    holder = docs.sparkSession.sparkContext.broadcast(
        OrdinalModel(model.weights.astype(np.float32), model.thresholds))  # 1 MB whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known, weight = holder.value, {}, np.zeros(1 << 14)
        for b in batches:
            severity, grade, toxic = [], [], []
            for raw in b.column(2):
                words = words_of(raw.as_py())
                above = np.zeros(len(own.thresholds))
                if words:
                    at = list(map(known.get, words))
                    if None in at:
                        if len(known) + len(words) > _CACHE:
                            known.clear()
                        for w in words:
                            if w not in known:
                                if len(known) == len(weight):
                                    weight = np.concatenate([weight, np.zeros_like(weight)])
                                weight[len(known)] = own.weights[word_features(w)].sum()
                                known[w] = len(known)
                        at = list(map(known.get, words))
                    k, n = np.unique(np.array(at), return_counts=True)
                    above = own.above(float(weight[k] @ np.log1p(n)))
                severity.append(float(above.sum()))
                grade.append(int(np.argmax(-np.diff(np.concatenate([[1.0], above, [0.0]])))))
                toxic.append(bool(above[0] >= 0.5))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(severity, pa.float64()), pa.array(grade, pa.int32()),
                 pa.array(toxic, pa.bool_())], names=["doc_id", "held_out", "severity", "grade", "toxic"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"),
                       utf8(text_col).alias("text")) \
        .mapInArrow(run, "doc_id long, held_out boolean, severity double, grade int, toxic boolean")


def toxicity(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Train on the labelled documents and score all; without labels every
    document scores 0."""
    return score(docs, train(docs, labels, train_rows))
