"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  An n-gram is the product of
its letters' vectors, each rotated by its place, so order counts; a text is
the sum of its n-grams and a language the sum of its texts.  A document gets the
language whose profile has the largest cosine with it.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.common import slices

#: a to z have slots of their own, other letters share the slots after them, 0 is whatever stands between words.
SLOTS = 128
NONE = "und"
_CHUNK = 1 << 20


@lru_cache(maxsize=1)
def _slot_of() -> np.ndarray:
    """Slot of every code point."""
    cp = np.arange(0x110000, dtype=np.uint64)
    slot = (27 + ((cp * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(SLOTS - 27)).astype(np.uint8)
    letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    slot[~letter] = 0
    slot[97:123] = np.arange(1, 27)
    slot[65:91] = np.arange(1, 27)
    return slot


@lru_cache(maxsize=2)
def _letters(dims: int, n: int, seed: int) -> list[np.ndarray]:
    """The letter vectors as they stand at each place of an n-gram."""
    v = np.random.default_rng(seed).integers(0, 2, (SLOTS, dims), dtype=np.int8) * 2 - 1
    return [np.roll(v, n - 1 - place, axis=1) for place in range(n)]


def _grams(text: str, n: int) -> np.ndarray:
    """Codes of a text's n-grams over slots; runs of other characters count as one, and a text begins and ends with one.

    A text is taken in chunks; each goes on with the last ``n - 1`` slots of the one before.
    """
    out, text, some = [], text.lower(), False
    carry = np.zeros(1, np.int64)
    for at in range(0, len(text), _CHUNK):
        s = _slot_of()[np.frombuffer(text[at : at + _CHUNK].encode("utf-32-le", "surrogatepass"), np.uint32)]
        some = some or bool(s.any())
        s = np.concatenate((carry, s.astype(np.int64), np.zeros(int(at + _CHUNK >= len(text)), np.int64)))
        s = s[np.concatenate(([True], (s[1:] != 0) | (s[:-1] != 0)))]
        carry = s[-(n - 1) :] if n > 1 else s[:0]
        if len(s) < n:
            continue
        code = s[: len(s) - n + 1]
        for place in range(1, n):
            code = code * SLOTS + s[place : len(s) - n + 1 + place]
        out.append(code)
    return np.concatenate(out) if some and out else np.empty(0, np.int64)


def _vectors(codes: np.ndarray, dims: int, n: int, seed: int) -> np.ndarray:
    """The n-grams' vectors, letters bound by multiplication."""
    letters = _letters(dims, n, seed)
    out = letters[n - 1][codes % SLOTS]
    for place in range(n - 2, -1, -1):
        codes = codes // SLOTS
        out = out * letters[place][codes % SLOTS]
    return out


def _bundles(texts: list, dims: int, n: int, seed: int):
    """(has letters, bundle) of each text; n-gram vectors are made once for all."""
    codes = [_grams(t, n) if t else np.empty(0, np.int64) for t in texts]
    known = np.unique(np.concatenate([np.unique(c) for c in codes])) if codes else np.empty(0, np.int64)
    v = _vectors(known, dims, n, seed).astype(np.float32)
    for c in codes:
        if not len(c):
            yield False, np.zeros(dims, np.float32)
            continue
        gram, count = np.unique(c, return_counts=True)
        yield True, count.astype(np.float32) @ v[np.searchsorted(known, gram)]


def learn_profiles(docs: DataFrame, lang: str = "lang", dims: int = 1024, n: int = 3, seed: int = 7) -> DataFrame:
    """(lang, profile): the sum of all texts of each non-null value of ``lang``.

    A task sums per language before it sends anything, so a language that most rows
    have costs a vector a task.  Texts without letters add nothing.
    """
    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for b in slices(batches):
            langs = b.column(0).to_pylist()
            for name, (some, bundle) in zip(langs, _bundles(b.column(1).to_pylist(), dims, n, seed), strict=True):
                if some:
                    sums[name] = sums.get(name, 0) + bundle.astype(np.float64)
        names = sorted(sums)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(names, dims).tolist(), pa.string()), pa.array(np.tile(np.arange(dims, dtype=np.int32), len(names))),
                                          pa.array(np.concatenate([sums[x] for x in names]) if names else [], pa.float64())], names=["lang", "dim", "x"])

    rows = docs.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    sums = rows.mapInArrow(run, "lang string, dim int, x double").groupBy("lang", "dim").agg(F.sum("x").alias("x"))
    return sums.groupBy("lang").agg(F.transform(F.sort_array(F.collect_list(F.struct("dim", "x"))), lambda s: s["x"]).alias("profile"))


def identify(docs: DataFrame, profiles: DataFrame, dims: int = 1024, n: int = 3, seed: int = 7, max_profiles: int = 5000) -> DataFrame:
    """(doc_id, lang_pred, score) for every document.

    ``score`` is the cosine with the predicted profile, 0 at least; ties go to the
    first language in alphabetical order.  Null texts, texts without a
    letter, and all texts when nothing was learned get ``und`` and 0.  Repeated rows come out
    once each; an empty table gives no rows; other columns are ignored.

    The profiles are broadcast: a vector per language.  More than
    ``max_profiles`` of them are refused, since a language column would not hold that many.
    """
    spark = docs.sparkSession
    rows = sorted((r["lang"], r["profile"]) for r in profiles.limit(max_profiles + 1).collect())
    if len(rows) > max_profiles:
        raise ValueError(f"more than {max_profiles} languages")
    m = np.array([p for _, p in rows], np.float64).reshape(len(rows), dims)
    m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
    model = spark.sparkContext.broadcast(([name for name, _ in rows], m.astype(np.float32)))

    def run(batches):
        names, m = model.value
        for b in slices(batches):
            pred, score = [], []
            for some, bundle in _bundles(b.column(1).to_pylist(), dims, n, seed):
                norm = float(np.linalg.norm(bundle))
                if not some or not names or not norm:
                    pred.append(NONE)
                    score.append(0.0)
                    continue
                cosine = m @ bundle / norm
                best = int(cosine.argmax())
                pred.append(names[best])
                score.append(float(min(1.0, max(0.0, cosine[best]))))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, lang_pred string, score double")
