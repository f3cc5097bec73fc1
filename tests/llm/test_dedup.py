"""Near-duplicates, repeats and vectors against brute force, and the cases no input may break."""

import collections
import hashlib
import math
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from marginalia.llm import common, embedding_dedup, simhash_dedup, suffix_dedup
from marginalia.llm.components import connected_components


def roots(n, linked):
    """Smallest index reachable from each of n."""
    root = list(range(n))
    changed = True
    while changed:
        changed = False
        for i, j in linked:
            m = min(root[i], root[j])
            if root[i] != m or root[j] != m:
                root[i] = root[j] = m
                changed = True
    return root


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 3), (5, 6), (7, 7), (6, 5)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 9: 1, 5: 5, 6: 5} | {100 + i: 100 for i in range(41)}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


# SimHash

def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_rows(rng):
    base = [" ".join(f"w{rng.randint(0, 500)}" for _ in range(rng.randint(3, 60))) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(150):
        words = rng.choice(base[:6]).split()
        words[rng.randrange(len(words))] = f"x{rng.randint(0, 3)}"
        rows.append((1000 + i, " ".join(words)))
    return rows + [(2000, None), (2001, ""), (2002, " \n"), (2003, "One"), (2004, "one two"), (2005, "one two É"), (3, base[7]), (2006, base[0]), (2007, base[0])]


@pytest.mark.parametrize("block,segments", [(4096, 16), (4, 16), (4096, 8)])
def test_simhash_links_all_pairs_within_the_distance(docs_of, block, segments):
    rows = near_rows(random.Random(3))
    out = simhash_dedup.near_duplicates(docs_of(rows), block=block, segments=segments).collect()
    assert sorted((r.doc_id, int(r.fingerprint, 16)) for r in out) == sorted((i, plain_fingerprint(t)) for i, t in rows)
    fps = [plain_fingerprint(t) for _, t in rows]
    order = sorted(range(len(rows)), key=lambda k: rows[k][0])
    linked = [(a, b) for a in range(len(order)) for b in range(a) if (fps[order[a]] ^ fps[order[b]]).bit_count() <= 3 or rows[order[a]][0] == rows[order[b]][0]]
    want = {rows[order[k]][0]: rows[order[r]][0] for k, r in enumerate(roots(len(order), linked))}
    same_id = {r.doc_id: r.component_id for r in out if r.doc_id != 3}  # id 3 is on two different texts
    assert same_id == {k: v for k, v in want.items() if k != 3}


def test_pigeonring_finds_every_difference_of_three_bits(spark):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        fp = rng.getrandbits(64)
        other = fp
        for b in rng.sample(range(64), 3):
            other ^= 1 << b
        rows += [(2 * i, fp), (2 * i + 1, other)]
    signed = [(n, fp - (1 << 64) if fp >> 63 else fp) for n, fp in rows]
    links = simhash_dedup._bucket_links(spark.createDataFrame(signed, "node long, fp long"), 3, 16, 4096).distinct().collect()
    assert {tuple(sorted(x)) for x in links} == {(2 * i, 2 * i + 1) for i in range(300)}


def test_simhash_null_ids_empty_table_and_keep_one(docs_of):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(None, text), (7, text), (7, text), (8, text), (None, "quite another text of its own here"), (None, "quite another text of its own here"), (9, None)]
    out = simhash_dedup.near_duplicates(docs_of(rows)).collect()
    assert sum(r.kept for r in out) == 3 and len(out) == 7  # 7 twice and 9
    kept = simhash_dedup.keep_one(docs_of(rows))
    assert kept.columns == docs_of(rows).columns
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == sorted([("7", text), ("9", "None"), ("None", rows[4][1])])
    assert simhash_dedup.near_duplicates(docs_of([])).count() == 0 == simhash_dedup.keep_one(docs_of([])).count()


def near_texts(monkeypatch, prints):
    """Gives texts the fingerprints of a table."""
    monkeypatch.setattr(simhash_dedup, "fingerprints", lambda docs, width=3: docs.select("doc_id", F.element_at(F.create_map(*[F.lit(x) for kv in prints.items() for x in kv]), F.col("text")).alias("fp")))


def test_simhash_links_through_documents_without_id(docs_of, monkeypatch):
    """a and c differ in four bits and meet only through b, which has no id; d's copy is near nothing with an id."""
    near_texts(monkeypatch, {"a": 0b0011, "b": 0b0000, "c": 0b1100, "d": -1, "e": -2})
    got = simhash_dedup.near_duplicates(docs_of([(5, "a"), (None, "b"), (9, "c"), (None, "d"), (None, "e")])).collect()
    assert {r.doc_id: r.component_id for r in got if r.doc_id} == {5: 5, 9: 5}
    assert sorted((r.fingerprint, r.component_id) for r in got if r.doc_id is None) == [("0" * 16, 5), ("f" * 15 + "e", None), ("f" * 16, None)]


def test_keep_one_judges_rows_of_one_id_by_their_texts(docs_of):
    a, b, c, d = (" ".join(f"{w}{i}" for i in range(30)) for w in "abcd")
    rows = [(7, a), (7, b), (7, b), (3, a), (8, c), (8, c), (8, d), (None, d), (None, None), (0, c + " end of text no. " + b)]
    got = [(r.doc_id, r.text) for r in simhash_dedup.keep_one(docs_of(rows)).collect()]
    assert sorted(got, key=str) == sorted([(3, a), (7, b), (8, c), (8, d), (None, None), rows[-1]], key=str)


# embeddings

def plain_cosine(a, b):
    return math.fsum(x * y for x, y in zip(a, b)) / math.sqrt(math.fsum(x * x for x in a) * math.fsum(y * y for y in b))


def vector_rows(rng):
    rows = []
    for i in range(160):
        label = rng.randint(0, 2)
        centre = [((label * 7 + i % 4) * (k + 3) % 11) - 5.0 for k in range(12)]
        rows.append((i, [c + rng.gauss(0, 0.45) for c in centre], label))
    rows += [(200 + i, rows[5][1], rows[5][2]) for i in range(12)] + [(220, [2 * x for x in rows[5][1]], rows[5][2])]
    bad = [None, [], [0.0] * 12, [1.0, None] + [0.0] * 10, [float("nan")] * 12, [float("inf")] + [0.0] * 11]
    rows += [(300 + i, v, 0) for i, v in enumerate(bad)] + [(320, rows[0][1], None), (321, rows[0][1], None), (322, rows[0][1][:6], rows[0][2])]
    return rows


@pytest.mark.parametrize("options", [{}, {"vectors_per_pivot": 15, "block": 16}, {"vectors_per_pivot": 5, "max_pivots": 20, "block": 7}])
def test_embeddings_match_brute_force(spark, options):
    rows = vector_rows(random.Random(4))
    df = spark.createDataFrame([(i, v, l, "x") for i, v, l in rows], "vec_id long, embedding array<double>, label int, node string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(df, **options).collect()}
    good = [k for k, (_, v, l) in enumerate(rows) if l is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    linked = [(a, b) for a in good for b in good if a < b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]) and plain_cosine(rows[a][1], rows[b][1]) >= 0.98]
    n = collections.Counter(x for p in linked for x in p)
    root = roots(len(rows), linked)
    assert got == {rows[k][0]: (n[k], rows[root[k]][0], root[k] == k) for k in range(len(rows))}
    assert len(linked) > 100


@pytest.mark.parametrize("options", [{}, {"vectors_per_pivot": 1, "max_pivots": 2}, {"vectors_per_pivot": 1, "max_pivots": 9, "block": 2}])
def test_embeddings_beside_the_bound(spark, options):
    """Vectors so near a pivot that rounding of their distance exceeds what parts them from the bound."""
    edge = math.acos(0.98)
    angles = [0.0, 1e-8, edge + 8e-9, edge - 2e-9, -1e-8, edge + 1.3e-8]
    rows = [(i, [math.cos(t), math.sin(t)], 0) for i, t in enumerate(angles)]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), **options).collect()
    links = collections.Counter(x for a in rows for b in rows if a[0] < b[0] and plain_cosine(a[1], b[1]) >= 0.98 for x in (a[0], b[0]))
    assert {r.vec_id: r.n_links for r in got} == {i: links[i] for i in range(len(rows))}


def test_embeddings_are_sent_once_a_job(spark, monkeypatch):
    """However many blocks a label has, a job's exchange holds each vector once; what is found is summed between jobs; only two steps stay."""
    rng = random.Random(9)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(12)]
    rows = [(i, [c + rng.gauss(0, 0.06) for c in centres[i * i % 12]], 0) for i in range(96)] + [(300 + i, centres[i], 1) for i in range(9)]
    rows += [(400, rows[7][1], 0), (7, rows[8][1], 0)]  # equal vectors, and two vectors of one id
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    want = sorted(embedding_dedup.near_duplicates(df, 0.995).collect())
    sent, grouped = [], type(df.groupBy("label"))
    apply = grouped.applyInArrow
    monkeypatch.setattr(grouped, "applyInArrow", lambda self, f, schema: (sent.append(self._df.count()), apply(self, f, schema))[1])
    monkeypatch.setattr(embedding_dedup, "SENT", 0, raising=False)
    monkeypatch.setattr(embedding_dedup, "HELD", 3, raising=False)
    mark = common.steps_written()
    got = embedding_dedup.near_duplicates(df, 0.995, vectors_per_pivot=20, block=16)
    left = [p.rpartition("/")[2].partition("-")[0] for p in common._WRITTEN[mark:]]
    assert sent == [105, 96, 96, 96, 96, 96] and left == ["vectors", "named"]  # all but the copies
    assert sorted(got.collect()) == want
    links = [r.n_links for r in want]
    assert sum(links) > 500 and 0 in links and len({r.component_id for r in want}) > 10


def test_embeddings_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.near_duplicates(df).count() == 0


# repeats

def test_run_length_index_matches_direct_comparison():
    rng = random.Random(1)
    for _ in range(40):
        t = [rng.choice([1, 2, 3]) for _ in range(rng.randint(1, 70))] + [9]
        index = suffix_dedup.RunLengthIndex(np.array(t))
        got = index.matching_statistics()
        for p in range(len(t)):
            best = 0
            for q in range(len(t)):
                k = 0
                while q != p and max(p, q) + k < len(t) and t[p + k] == t[q + k]:
                    k += 1
                best = max(best, k)
            assert got[p] == best
    assert len(suffix_dedup.RunLengthIndex(np.array([1, 2] * 500 + [9])).run_start) < 20


def test_aligned_index_equals_the_general_one():
    """Symbols spelt out as (column, group, byte) numbers, ends of their own, give the same statistics and runs."""
    rng = random.Random(2)
    for _ in range(60):
        units = sorted((rng.randrange(3), bytes(rng.choice(b"\0ab") for _ in range(rng.randrange(9))), bytes(rng.choice(b"\0ab") for _ in range(rng.randrange(9))))
                       for _ in range(rng.randint(1, 12)))
        group = np.unique([g for g, _, _ in units], return_inverse=True)[1].astype(np.int64)
        left, right = (np.array([len(u[i]) for u in units], np.int64) for i in (1, 2))
        first = np.cumsum(left + right + 2) - (left + right + 2)
        text = np.frombuffer(b"".join(x for _, l, r in units for x in (l, b"\0", r, b"\0")), np.uint8)
        got = suffix_dedup.AlignedIndex(text, first + left, left, right, group)
        spelt = [((c + 10) * 3 + int(g)) * 300 + (256 + i if c == nr + 1 else int(text[f + nl + c]))
                 for i, (g, f, nl, nr) in enumerate(zip(group, first, left, right)) for c in range(-nl, nr + 2)]
        want = suffix_dedup.RunLengthIndex(np.unique(spelt, return_inverse=True)[1].astype(np.int64))
        assert got.matching_statistics().tolist() == want.matching_statistics().tolist()
        # runs part where symbols of one byte lie in different columns or groups; heads may differ among equal ends only
        assert sorted(got.head_len.tolist()) == sorted(want.head_len.tolist()) and len(got.run_start) == len(want.run_start)
    copies = [bytes(range(50))] * 200
    text, side = np.frombuffer(b"".join(x + b"\0" + x + b"\0" for x in copies), np.uint8), np.full(200, 50)
    assert len(suffix_dedup.AlignedIndex(text, np.arange(200) * 102 + 50, side, side, np.zeros(200, np.int64)).run_start) < 400  # of 20,400 suffixes


def plain_repeats(rows, length):
    count = collections.Counter()
    for _, t in rows:
        raw = (t or "").encode()
        count.update(raw[i : i + length] for i in range(len(raw) - length + 1))
    out = []
    for doc_id, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if count[raw[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for i in range(len(gone)) if gone[i] and not (i and gone[i - 1]))
        out.append((str(doc_id), len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def repeat_rows(rng):
    def words(n):
        return " ".join(rng.choice(["alpha", "bèta", "gamma\n", "δ", "eps"]) + str(rng.randint(0, 30)) for _ in range(n))

    passages = [words(60) for _ in range(4)]
    rows = [(i, words(rng.randint(0, 60)) + (rng.choice(passages)[: rng.randint(150, 400)] if rng.random() < 0.5 else "") + words(rng.randint(0, 40))) for i in range(70)]
    rows += [(200, None), (201, ""), (202, "a" * 1000), (203, "a" * 199), (204, "ab" * 300), (None, rows[0][1]), (5, rows[5][1]), (6, "x" + words(60)), (300, passages[0] * 3)]
    return rows + [(400 + i, words(2) + passages[1] + words(3)) for i in range(40)]


@pytest.mark.parametrize("length,block,ways", [(200, 2_000_000, 8), (200, 3000, 3), (60, 1500, 4)])
def test_repeats_match_brute_force(docs_of, length, block, ways):
    rows = repeat_rows(random.Random(2))
    out = suffix_dedup.remove_repeats(docs_of(rows), length, block, ways).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in out) == plain_repeats(rows, length)
    for r in out:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed


def test_long_text_is_taken_by_runs_of_windows(docs_of, monkeypatch):
    rng = random.Random(8)
    body = "".join(rng.choice("abcdefgh") for _ in range(30_000))
    text = body[:20_000] + body[100:900] + body[20_000:]
    batch = suffix_dedup.slices
    rows = [(1, text)]
    import pyarrow as pa

    whole = pa.RecordBatch.from_pydict({"doc": pa.array([1], pa.int64()), "v": pa.array([0], pa.int32()), "text": pa.array([text])})
    one = [b.to_pydict() for b in suffix_dedup._anchor_rows([whole], 200, 32)]
    monkeypatch.setattr(suffix_dedup, "_SLICE", 1000)
    cut = [b.to_pydict() for b in suffix_dedup._anchor_rows([whole], 200, 32)]
    assert one[0]["pos"] == cut[0]["pos"] and one[0]["around"] == cut[0]["around"] and batch
    out = suffix_dedup.remove_repeats(docs_of(rows)).first()
    assert (out.n_removed, out.n_spans) == (1600, 2)


def test_rows_of_any_columns_pass(spark):
    """Columns named like the operators' own, maps, and a text column in capitals."""
    from marginalia.llm import decontamination, quality

    words = " ".join(f"w{i}" for i in range(60))
    rows = [(1, words + " a", "x", {"k": 1}), (1, words + " a", "x", {"k": 1}), (2, "b " + words, "y", {}), (3, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, TEXT string, __doc string, m map<string,int>").selectExpr("*", "__doc as __v", "1 as __marks", "2 as `row`")
    cut = suffix_dedup.without_repeats(df, length=50).collect()
    assert [(r.doc_id, r.TEXT, r.m) for r in sorted(cut, key=str)] == [(1, "", {"k": 1})] * 2 + [(2, "b ", {}), (3, None, None)]
    one = simhash_dedup.keep_one(df).select("doc_id", "TEXT", "m", "__marks").collect()
    assert sorted((r.doc_id, r.m) for r in one) == [(1, {"k": 1}), (2, {}), (3, None)] and df.columns == simhash_dedup.keep_one(df).columns
    bench = spark.createDataFrame([("q", words)], "item_id string, text string")
    assert [r.doc_id for r in decontamination.drop_contaminated(df, bench).collect()] == [3]
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, label int")
    assert quality.keep_good(df, labels, F.lit(True)).columns == df.columns


def test_repeats_keep_columns_and_empty_table(docs_of):
    rows = repeat_rows(random.Random(6))
    df = docs_of(rows)
    out = suffix_dedup.without_repeats(df)
    assert out.columns == df.columns and out.count() == len(rows)
    assert out.where("doc_id = 200").first().text is None
    assert suffix_dedup.remove_repeats(docs_of([])).count() == 0 == suffix_dedup.without_repeats(docs_of([])).count()


def test_identity_tells_rows_apart(spark, docs_of):
    """No id is not id 0, and among 200,000 texts without id no two share an identity (32 bits let about 5 pairs do)."""
    zero, null = suffix_dedup.keyed(docs_of([(0, "same"), (None, "same")])).select("doc", "v").collect()
    assert zero.doc == 0 and zero.doc != null.doc and zero.v != null.v
    many = spark.range(200_000).select(F.lit(None).cast("long").alias("doc_id"), F.col("id").cast("string").alias("text"))
    for columns in (["doc", "v"], ["v"], ["doc"]):
        assert suffix_dedup.keyed(many).select(*columns).distinct().count() == 200_000


def test_anchors_tie_alike_in_buffers_of_any_size(monkeypatch):
    """Two hashes that differ in their lower bits only: the same string has the same anchor in a short and a long buffer."""
    def hashes(self, data):
        h = np.full(len(data) - self.k + 1, np.iinfo(np.uint64).max)
        h[2], h[5] = 1 << 40 | 1 << 12, 1 << 40 | 1 << 8
        return h

    monkeypatch.setattr(suffix_dedup._Anchors, "hashes", hashes)
    find = suffix_dedup._Anchors(40, 32, suffix_dedup._SLICE + 80)
    short, long = (find(np.zeros(n, np.uint8), np.arange(1))[0].tolist() for n in (40, 100_000))
    assert short == long == [2]
