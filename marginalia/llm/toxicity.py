"""Toxicity scores by a factorization machine over hashed terms.

A text is the set of its hashed words and word beginnings.  A factorization
machine adds to each term's weight a product of factors for each pair of
terms, so it learns what a word means beside another (an insult beside the mention of a group)
which a sum of weights cannot.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.common import id_and_text, slices, write_shared

BITS = 24
_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


def terms(text: str | None) -> np.ndarray:
    """The distinct hashed terms of a whole text, ascending: words, and their first 4 and 5 bytes."""
    ws = set(text.encode().translate(_KEEP).split()) if text else set()
    out = ws | {b"\x01" + w[:4] for w in ws if len(w) > 4} | {b"\x02" + w[:5] for w in ws if len(w) > 5}
    h = xxhash.xxh32_intdigest
    return np.unique(np.fromiter((h(w) >> (32 - BITS) for w in out), np.int64, len(out)))


@dataclass
class Model:
    """Weights and factors of the selected terms (ascending hashes)."""

    hashes: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, ts: np.ndarray) -> float:
        at = np.searchsorted(self.hashes, ts)
        at = at[(at < len(self.hashes)) & (self.hashes[np.minimum(at, len(self.hashes) - 1)] == ts)] if len(self.hashes) else at[:0]
        v = self.factors[at]
        s = v.sum(0)
        y = self.bias + self.weights[at].sum() + 0.5 * float((s * s).sum() - (v * v).sum())
        return float(1 / (1 + np.exp(-np.clip(y, -500, 500))))


def _gain(q, p):
    """What a class share ``q`` tells beyond an expected share ``p``, per row (natural units)."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(q > 0, q * np.log(q / p), 0.0) + np.where(q < 1, (1 - q) * np.log((1 - q) / (1 - p)), 0.0)


def _indexed(sample: DataFrame, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all rows, ordered: the labels, the number of known terms and their places in ``hashes``, one after the other."""
    known = sample.sparkSession.sparkContext.broadcast(hashes)

    def places(batches):
        for b in slices(batches):
            t = b.column(2)
            flat, sizes = t.flatten().to_numpy(zero_copy_only=False), np.diff(t.offsets.to_numpy())
            at = np.minimum(np.searchsorted(known.value, flat), len(known.value) - 1)
            ok = known.value[at] == flat
            n = np.bincount(np.repeat(np.arange(len(sizes)), sizes), ok, len(sizes)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))), pa.int32()), pa.array(at[ok], pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lists], names=["doc_id", "label", "at"])

    rows = sample.select("doc_id", "label", "terms").mapInArrow(places, "doc_id long, label int, at array<int>").toArrow().sort_by([("doc_id", "ascending"), ("label", "ascending")])
    lists = rows.column("at").combine_chunks()
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    known.unpersist()
    return rows.column("label").to_numpy().astype(np.float64), lists.value_lengths().to_numpy(), lists.flatten().to_numpy()


def _paired_terms(sample: DataFrame, hashes: np.ndarray, share: np.ndarray, base: float, min_gain: float, block: int = 2048) -> np.ndarray:
    """The terms of ``hashes`` with a partner beside which the class share differs from what either term and both added up tell.

    All pairs are counted, in blocks of ``block`` times ``block`` terms, one task row each.
    """
    y, n, at = _indexed(sample, hashes)
    sc = sample.sparkSession.sparkContext
    held = sc.broadcast((y.astype(np.float32), np.concatenate(([0], np.cumsum(n))), at, share))
    edges = range(0, len(hashes), block)
    todo = sample.sparkSession.createDataFrame([(i, j) for i in edges for j in edges if i <= j], "i int, j int")
    todo = todo.repartition(max(1, min(sc.defaultParallelism, len(edges) * (len(edges) + 1) // 2)))

    def count(batches):
        y, ends, at, share = held.value
        odds = np.log(share / (1 - share))
        for b in batches:
            found = [np.empty(0, np.int64)]
            for i, j in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                p, q = share[i : i + block], share[j : j + block]
                both, ones = np.zeros((2, len(p), len(q)), np.float32)
                for r in range(0, len(y), 1024):
                    label, stop = y[r : r + 1024], ends[r : r + 1025]
                    own, row = at[stop[0] : stop[-1]], np.repeat(np.arange(len(label)), np.diff(stop))
                    x, z = np.zeros((len(label), len(p)), np.float32), np.zeros((len(label), len(q)), np.float32)
                    for dense, first in ((x, i), (z, j)):
                        ok = (own >= first) & (own < first + dense.shape[1])
                        dense[row[ok], own[ok] - first] = 1
                    both += x.T @ z
                    ones += (x * label[:, None]).T @ z
                u, v = np.nonzero(both)
                m, s = both[u, v].astype(np.float64), ones[u, v] / both[u, v].astype(np.float64)
                added = 1 / (1 + np.exp(-np.clip(odds[i : i + block][u] + odds[j : j + block][v] - np.log(base / (1 - base)), -30, 30)))
                ok = (m * np.minimum(np.minimum(_gain(s, p[u]), _gain(s, q[v])), _gain(s, added)) >= min_gain) & (u + i != v + j)
                found += [np.unique(u[ok]) + i, np.unique(v[ok]) + j]
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(found)), pa.int64())], names=["at"])

    out = np.unique([r["at"] for r in todo.mapInArrow(count, "at long").distinct().collect()]).astype(np.int64)
    held.unpersist()
    return hashes[out]


def select_terms(sample: DataFrame, min_ratio: float, min_gain: float) -> np.ndarray:
    """The terms, ascending, with evidence of their own or beside another term, however many and however rare.

    Own evidence is a log likelihood ratio of ``min_ratio`` at least between
    the classes.  Evidence beside another term is a gain of ``min_gain`` over
    the rows that hold both; a term's rows of one class bound it, so a
    term is left out of the count of pairs only where no pair can reach it.
    """
    rows = sample.select("label", F.explode("terms").alias("term")).groupBy("term").agg(
        F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b"))
    pos, neg = sample.agg(F.sum("label"), F.sum(1 - F.col("label"))).first()
    n, both = float(pos + neg), F.col("a") + F.col("b")

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    ratio = (part(F.col("a"), both * pos / n) + part(F.col("b"), both * neg / n)
             + part(pos - F.col("a"), (n - both) * pos / n) + part(neg - F.col("b"), (n - both) * neg / n))
    share = (F.col("a") + pos / n) / (both + 1)  # drawn to the share of all rows, so never 0 or 1
    reach = F.greatest(-F.col("a") * F.log(share), -F.col("b") * F.log(1 - share))
    top = rows.select("term", share.alias("p"), ratio.alias("g"), reach.alias("r")).where((F.col("g") >= min_ratio) | (F.col("r") >= min_gain)).toArrow()
    term, p, g, r = (top.column(c).to_numpy() for c in ("term", "p", "g", "r"))
    at = np.flatnonzero(r >= min_gain)
    at = at[np.argsort(term[at])]
    pairs = _paired_terms(sample, term[at], p[at], pos / n, min_gain) if len(at) > 1 else term[:0]
    return np.union1d(term[g >= min_ratio], pairs).astype(np.int64)


def fit(sample: DataFrame, min_ratio: float = 6.0, min_gain: float = 20.0, rank: int = 8, steps: int = 150, rate: float = 0.05, decay: float = 2e-4, seed: int = 1) -> Model | None:
    """The machine of (terms, label) rows, a bounded sample; None if a class is missing.

    The driver gets each row's selected terms and descends in numpy, with weights that
    balance the classes by half.
    """
    hashes = select_terms(sample, min_ratio, min_gain) if sample.select("label").distinct().count() == 2 else np.empty(0, np.int64)
    if not len(hashes):
        return None
    y, sizes, at = _indexed(sample, hashes)
    row = np.repeat(np.arange(len(y)), sizes)
    rng = np.random.default_rng(seed)
    w, v = np.zeros(len(hashes)), rng.normal(0, 0.02, (len(hashes), rank))
    weight = np.where(y == 1, (len(y) / (2 * y.sum())) ** 0.5, (len(y) / (2 * (len(y) - y.sum()))) ** 0.5) / len(y)

    parts = [slice(k, k + (1 << 18)) for k in range(0, len(at), 1 << 18)]  # bounds the factors held at once

    def by(index, n, x):
        return np.stack([np.bincount(index, x[:, k], n) for k in range(x.shape[1])], axis=1)

    params = [np.zeros(1), w, v]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        b, w, v = params
        s = sum(by(row[c], len(y), v[at[c]]) for c in parts)
        q = sum(np.bincount(row[c], (v[at[c]] ** 2).sum(1), len(y)) for c in parts)
        raw = b[0] + np.bincount(row, w[at], len(y)) + 0.5 * ((s**2).sum(1) - q)
        e = weight * (1 / (1 + np.exp(-np.clip(raw, -50, 50))) - y)
        grads = [np.array([e.sum()]), np.bincount(at, e[row], len(w)) + decay * w,
                 sum(by(at[c], len(w), e[row[c], None] * (s[row[c]] - v[at[c]])) for c in parts) + decay * v]
        for p, g, m1, m2 in zip(params, grads, first, second, strict=True):
            m1 += 0.1 * (g - m1)
            m2 += 0.001 * (g * g - m2)
            p -= rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
    return Model(hashes, float(params[0][0]), params[1], params[2])


def classify(docs: DataFrame, labels: DataFrame, train: "F.Column", threshold: float = 0.7, sample_rows: int = 10_000, **options) -> DataFrame:
    """(doc_id, score, predicted) for every document; ``predicted`` is 1 from ``threshold`` up.

    Learned from at most ``sample_rows`` labelled documents (the smallest
    hashes of doc_id among those for which ``train`` holds); ``labels`` has doc_id
    and label, rows with other values than 0 and 1 or nulls do not count and several labels
    of a document count as their largest.  Every whole text is scored, and only its text
    decides.  Null and empty texts have no terms and score the bias; without labels of
    both classes every score is 0; repeated rows are scored row by row; an empty table
    gives no rows; other columns are ignored.

    The sampled ids are broadcast (bounded by ``sample_rows``), so texts are
    never shuffled; the model has a weight and factors for each selected term.
    """
    known = labels.where(F.col("label").isin(0, 1) & train).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label"))
    known = known.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    chosen = write_shared(known, "toxicity-sample")
    texts = id_and_text(docs)

    def extract(batches):
        for b in slices(batches):
            ts = [terms(t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ts, pa.list_(pa.int64()))], names=["doc_id", "label", "terms"])

    sample = texts.dropna(subset=["doc_id"]).join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")
    sample = sample.mapInArrow(extract, "doc_id long, label int, terms array<long>")
    sample = sample.groupBy("doc_id").agg(F.max("label").alias("label"), F.min("terms").alias("terms"))  # rows that share an id
    sample = write_shared(sample, "toxicity-terms")
    model = docs.sparkSession.sparkContext.broadcast(fit(sample, **options))

    def run(batches):
        m = model.value
        for b in slices(batches):
            s = np.array([m.score(terms(t)) if m else 0.0 for t in b.column(1).to_pylist()], np.float64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return texts.mapInArrow(run, "doc_id long, score double, predicted int")
