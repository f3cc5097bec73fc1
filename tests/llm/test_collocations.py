"""Collocations against plain counters, and the count transducers by themselves."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from marginalia.llm import collocations as co

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(rows, min_count, top):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOW)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= min_count}
        found = []
        for p, a in cand.items():
            if len(p) == 2 and any(100 * b >= 50 * a for q, b in cand.items() if len(q) == 3 and p in (q[:2], q[1:])):
                continue
            score, k = min((10**6 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        found.sort()
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(found[:top])]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    word = lambda: rng.choice(["a", "B", "c", "dé", "\x01x", "日"]) + rng.choice(["", "", "", ".", "\n", "\t", "\x0b"])
    out = [(" ".join(word() for _ in range(rng.randint(0, 60))), rng.choice(["en", None, "fr"])) for _ in range(120)]
    out += [(None, "en"), ("", "xx"), (". ,", "en"), ("lone", "one"), ("und und", "und")] + [("same again here", "en")] * 12
    return [*out, (" ".join(rng.choice("abcd") for _ in range(3000)), "en"), ("x" * 5000 + " y z " * 40, "en")]


@pytest.mark.parametrize("how", [{}, {"shard_bytes": 200, "fence": 7, "per_range": 3}, {"shard_bytes": 64, "fence": 3, "per_range": 17, "max_ranges": 4}])
def test_equals_plain_counters(spark, rows, how):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string").selectExpr("*", "'x' as phrase", "1 as a", "'y' as first")
    top = how.get("per_range", 100)
    got = co.collocations(df.repartition(3), min_count=10, top=top, **how).collect()
    assert sorted(map(tuple, got)) == plain(rows, 10, top)


def test_counts_beyond_64_bits_of_product(spark):
    """score = floor(10**6 a a / (l r)) with a a above 2**63 is taken from decimals."""
    df = spark.createDataFrame([(4_000_000_007, 4_000_000_009, 4_000_000_011)], "a long, l long, r long")
    score = co.score_of(*(co.F.col(c) for c in "alr"))
    a, left, right = 4_000_000_007, 4_000_000_009, 4_000_000_011
    assert df.select(score).first()[0] == 10**6 * a * a // (left * right)


def test_nothing(spark):
    assert co.collocations(spark.createDataFrame([], "text string, lang string")).count() == 0
    assert co.collocations(spark.createDataFrame([(None, "en"), ("", None)], "text string, lang string")).count() == 0


def test_transducer_holds_shares_and_unites():
    rng = random.Random(2)
    def grams():
        return collections.Counter(tuple(rng.choice("abcdef") for _ in range(rng.randint(1, 3))) for _ in range(400))

    def build(counts):
        words = sorted({w for p in counts for w in p})
        ids = np.array([[words.index(w) for w in p] + [-1] * (3 - len(p)) for p in sorted(counts)], np.int64)
        return co.CountTransducer.build(pa.array([w.encode() for w in words], pa.large_binary()), ids, np.array([counts[p] for p in sorted(counts)], np.int64))

    def read(t):
        ids, w = t.paths()
        return dict(zip(co._phrases(t.words, ids), w.tolist(), strict=True))

    a, b = grams(), grams()
    for t, c in ((build(a), a), (build(b), b), (co.union([build(a), build(b)]), a + b)):
        t = co.CountTransducer.loads(t.dumps())
        want = {" ".join(p).encode(): n for p, n in c.items()}
        assert read(t) == want and list(read(t)) == sorted(want, key=lambda p: p.split(b" "))
        asked = [*want, b"a z", b"z", b"a a a a", b"f f f"]
        assert t.compose(asked).tolist() == [want.get(p, 0) for p in asked]
    # equal endings are one state: x y 1..9 and every other word before y
    chain = {(x, "y", z): 1 for x in "abcdefgh" for z in "pqr"}
    t = build(chain)
    assert len(t.levels[2][1]) == 3 and len(t.levels[1][1]) == 1 and len(t.levels[0][1]) == 8
    assert read(t) == {" ".join(p).encode(): 1 for p in chain}
