"""Quality classification by regularised quadratic discriminant analysis.

Documents become transformed statistics.  Each class is a Gaussian whose
covariance is shrunk towards a multiple of the identity; its Cholesky factor
is computed once and kept.  The score compares the classes' log densities,
that is Mahalanobis distances and log determinants.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.common import id_and_text, place_of, slices, write_shared

FEATURES = ("log_chars", "word_length", "upper", "digits", "marks", "spaces", "marked_words", "word_variety", "top_word",
            "next_repeat", "line_variety", "line_length", "line_words", "letter_entropy", "compressed")
#: A whole run of marks before white space or the end; starts only where a run does and gives nothing back, so time is linear.
_EDGE = re.compile(r"(?<![^\w\s])[^\w\s]{2,}+(?!\w)")


def _share(part: float, whole: float) -> float:
    """A share as smoothed log odds."""
    return math.log((part + 0.5) / (whole - part + 0.5))


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of a whole text, in the order of :data:`FEATURES`; always finite."""
    text = text or ""
    n = len(text)
    raw = text.encode("utf-8", "surrogatepass")
    words = text.split()
    lines = [x for x in text.split("\n") if x]
    counts = Counter(words)
    nw = len(words)
    codes = np.frombuffer(raw, np.uint8)
    hist = np.bincount(codes, minlength=256)
    upper, digits = int(hist[65:91].sum()), int(hist[48:58].sum())
    spaces = int(hist[[9, 10, 13, 32]].sum())
    letters = int(hist[65:91].sum() + hist[97:123].sum() + hist[128:].sum())
    marks = len(codes) - letters - digits - spaces - int(hist[44] + hist[46])
    p = hist[hist > 0] / max(1, len(codes))
    squeezed = sum(len(zlib.compress(raw[at : at + (1 << 16)], 1)) for at in range(0, len(raw), 1 << 16))
    return [
        math.log1p(n), math.log1p(letters / max(1, nw)), _share(upper, letters), _share(digits, n + digits), _share(max(0, marks), len(codes)),
        _share(spaces, len(codes)), _share(len(_EDGE.findall(text)), 2 * nw + 2), _share(len(counts), nw + 1) / math.log(nw + 3),
        _share(max(counts.values(), default=0), nw + 1), _share(sum(a == b for a, b in zip(words, words[1:], strict=False)), nw + 1),
        _share(len(set(lines)), len(lines) + 1) / math.log(len(lines) + 3), math.log1p(n / max(1, len(lines))), math.log1p(nw / max(1, len(lines))),
        float(-(p * np.log(p)).sum()), math.log((squeezed + 16) / (len(raw) + 16)),
    ]


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics of every document."""
    def run(batches):
        for b in slices(batches):
            x = [statistics(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "x"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, x array<double>")


@dataclass
class Model:
    """Two Gaussians over standardised statistics, with their cached factors."""

    centre: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    inverse_factors: list[np.ndarray]
    constants: list[float]

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -12, 12)
        log = [c - 0.5 * (((z - m) @ f.T) ** 2).sum(1) for m, f, c in zip(self.means, self.inverse_factors, self.constants, strict=True)]
        return 1 / (1 + np.exp(np.clip((log[0] - log[1]) / len(self.centre) ** 0.5, -500, 500)))


def fit(labelled: DataFrame, shrinkage: float = 0.1) -> Model | None:
    """The model of (x, label) rows, or None if a class is missing.

    All rows count: a task sums counts, sums and products per class, so the
    driver gets two small matrices a task at most, summed up by Spark.
    """
    d = len(FEATURES)

    def moments(batches):
        total = np.zeros((2, 1 + d + d * d))
        for b in batches:
            x = np.array(b.column(0).to_pylist(), np.float64).reshape(-1, d)
            y = b.column(1).to_numpy(zero_copy_only=False)
            for c in (0, 1):
                own = x[y == c]
                total[c] += np.concatenate(([len(own)], own.sum(0), (own.T @ own).ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat([0, 1], total.shape[1]).astype(np.int32)), pa.array(np.tile(np.arange(total.shape[1], dtype=np.int32), 2)),
                                          pa.array(total.ravel())], names=["c", "k", "s"])

    sums = labelled.select("x", F.col("label").cast("int")).mapInArrow(moments, "c int, k int, s double").groupBy("c", "k").agg(F.sum("s").alias("s"))
    total = np.zeros((2, 1 + d + d * d))
    for r in sums.collect():  # as many rows as two matrices have numbers
        total[r["c"], r["k"]] = r["s"]
    n = total[:, 0]
    if not n.all():
        return None
    mean = total[:, 1 : d + 1] / n[:, None]
    second = total[:, d + 1 :].reshape(2, d, d) / n[:, None, None]
    centre = (n[:, None] * mean).sum(0) / n.sum()
    spread = (n[:, None] * np.stack([np.diag(s) for s in second])).sum(0) / n.sum() - centre**2
    scale = np.sqrt(np.maximum(spread, 1e-6))
    means, factors, constants = [], [], []
    for c in (0, 1):
        cov = (second[c] - np.outer(mean[c], mean[c])) / np.outer(scale, scale)
        cov = (1 - shrinkage) * cov + shrinkage * max(np.trace(cov) / d, 1e-3) * np.eye(d)
        lower = np.linalg.cholesky(cov)
        means.append((mean[c] - centre) / scale)
        factors.append(np.linalg.inv(lower))
        constants.append(math.log(n[c] / n.sum()) - float(np.log(np.diag(lower)).sum()))
    return Model(centre, scale, means, factors, constants)


def learn(docs: DataFrame, labels: DataFrame, train: "F.Column", shrinkage: float = 0.1) -> tuple[Model | None, DataFrame]:
    """The model and the written statistics (doc_id, x) of all documents."""
    x = write_shared(features(docs), "quality-features")
    known = labels.where(F.col("label").isin(0, 1)).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label"))
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    return fit(x.where(train).join(known, "doc_id"), shrinkage), x


def keep_good(docs: DataFrame, labels: DataFrame, train: "F.Column", threshold: float = 0.3, shrinkage: float = 0.1) -> DataFrame:
    """The documents that :func:`classify` accepts, as they are, with all their columns."""
    held, at = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, train, shrinkage)[0]), place_of(docs, "text")

    def run(batches):
        for b in slices(batches):
            if held.value:
                x = np.array([statistics(t) for t in b.column(at).to_pylist()], np.float64)
                b = b.filter(pa.array(held.value.scores(x) >= threshold))
            yield b

    return docs.mapInArrow(run, docs.schema)


def classify(docs: DataFrame, labels: DataFrame, train: "F.Column", threshold: float = 0.3, shrinkage: float = 0.1) -> DataFrame:
    """(doc_id, score, predicted) for every document; ``predicted`` is 1 from ``threshold`` up.

    ``labels`` has doc_id and label (0 or 1); rows with other or null labels,
    and documents for which ``train`` (a condition on doc_id) does not hold,
    are not learned from.  Several labels of a document count as their largest.
    Only the text decides a score.  Null texts score like empty ones; repeated rows are
    scored row by row; without a label of either class every score is 1
    (nothing is rejected unlearned); an empty table gives no rows; other columns are ignored.

    The statistics are written once (a short row per document) and serve both
    fitting and scoring, so texts are read once and never shuffled.
    """
    model, x = learn(docs, labels, train, shrinkage)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            m = np.array(b.column(1).to_pylist(), np.float64).reshape(-1, len(FEATURES))
            s = held.value.scores(m) if held.value else np.ones(len(m))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return x.mapInArrow(run, "doc_id long, score double, predicted int")
