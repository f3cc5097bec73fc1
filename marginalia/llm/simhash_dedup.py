"""SimHash near-duplicates, found by pigeonring filtering.

Fingerprints are cut into ``m`` segments on a ring.  If two differ in at most
``t`` bits, there is a segment from which every chain of ``l`` consecutive
segments differs in at most ``l * t / m`` bits.  The first segments of that
chain must be equal, the next ones may differ in one bit, and so on.  Equal
beginnings are a join key; the rest of the budgets prunes candidates before
the full distance is counted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.common import id_and_text, slices, write_shared
from marginalia.llm.components import connected_components

BITS = 64
_UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\x0b\x0c\t\n\r", b"abcdefghijklmnopqrstuvwxyz     ")


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of a whole text over its word shingles, repeats included.

    Words are maximal runs without space, tab, LF, VT, FF or CR; A-Z count as
    a-z.  Fewer words than ``width`` are one shingle; no word gives 0.
    """
    ws = text.encode().translate(_UPPER).split() if text else []
    if not ws:
        return 0
    n = max(1, len(ws) - width + 1)
    joined = memoryview(b" ".join(ws))
    ends = np.cumsum([len(w) + 1 for w in ws]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = ends[width - 1 :] if len(ws) >= width else ends[-1:]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter([digest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), last.tolist(), strict=True)], np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):
        ones += np.unpackbits(h[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long."""
    def run(batches):
        for b in slices(batches):
            fp = np.array([fingerprint(t, width) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], names=["doc_id", "fp"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, fp long")


def _chain_keys(fp: "F.Column", max_bits: int, m: int) -> "F.Column":
    """array<struct<k, key>>: what a pair within ``max_bits`` must share at one start of the ring at least.

    The segments whose budget is 0 are equal.  The segments after them, as
    long as the budget is 1, differ in one bit at most, so one half of them
    is equal too.  A key holds the equal part and one half.
    """
    seg = BITS // m
    zero = max(k for k in range(1, m + 1) if k * max_bits < m) if max_bits < m else 0
    one = max(k for k in range(zero, m + 1) if k * max_bits < 2 * m) - zero
    bits_zero, bits_one = zero * seg, one * seg
    half = bits_one // 2
    keys = []
    for start in range(m):
        turned = f"(shiftleft(fp, {start * seg}) | shiftrightunsigned(fp, {BITS - start * seg}))" if start else "fp"
        head = f"shiftrightunsigned({turned}, {BITS - bits_zero})" if bits_zero else "0L"
        for side, (skip, width) in enumerate(((0, half), (half, bits_one - half))):
            tail = f"(shiftrightunsigned({turned}, {BITS - bits_zero - skip - width}) & {(1 << width) - 1}L)"
            keys.append(f"named_struct('k', {2 * start + side}, 'key', shiftleft({head}, {width}) | {tail})")
    return F.expr(f"array({', '.join(keys)})")


def _linked(a: np.ndarray, b: np.ndarray, start: int, max_bits: int, m: int) -> np.ndarray:
    """Which pairs pass every chain from this start, and then the full distance."""
    seg = BITS // m
    x = a ^ b
    turned = (x << np.uint64(start * seg)) | (x >> np.uint64(BITS - start * seg)) if start else x
    ok = np.ones(x.shape, bool)
    for k in sorted({max(j for j in range(1, m + 1) if j * max_bits < (d + 1) * m) for d in range(max_bits)}):
        ok &= np.bitwise_count(turned >> np.uint64(BITS - k * seg)) <= k * max_bits // m
    return ok & (np.bitwise_count(x) <= max_bits)


def _roots(fp: np.ndarray, ids: np.ndarray, start: int, max_bits: int, m: int) -> np.ndarray:
    """For each id the smallest one reachable by links within the group.

    Breadth first: a strip of reached fingerprints is compared with those not
    reached yet, so a dense group shrinks quickly and no list of pairs is kept.
    """
    root, left = ids.copy(), np.arange(len(ids))
    while len(left):
        reached, left = left[:1], left[1:]
        done = 0
        while done < len(reached) and len(left):
            strip = reached[done : done + 256]
            done += len(strip)
            near = _linked(fp[strip][:, None], fp[left][None, :], start, max_bits, m).any(0)
            reached, left = np.concatenate([reached, left[near]]), left[~near]
        root[reached] = ids[reached].min()
    return root


def near_duplicates(docs: DataFrame, width: int = 3, max_bits: int = 3, segments: int = 16, block: int = 4096) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id, kept.

    Documents whose fingerprints differ in ``max_bits`` or less are linked;
    ``component_id`` is the smallest doc_id reachable by links, itself
    included, and ``kept`` marks the document that is its component's id.
    Null, empty and blank texts have fingerprint 0 and are linked like others;
    repeated rows come out once each; documents with null ids get fingerprints
    and link others, but are never the smallest (component null if no id is reached);
    an empty table gives no rows; other columns are ignored.

    Equal fingerprints are one row, with their smallest doc_id, before
    anything is compared: copies cost a partial ``min`` and never meet.  Links
    run between fingerprints, so one without an id links like any other.
    Different fingerprints meet where they share a chain key.  A key held by
    more than ``block`` of them is dealt in pairs of blocks, so a group holds
    two blocks at most; a group writes links to local roots, one per
    fingerprint at most, never its pairs.
    """
    fps = write_shared(fingerprints(docs, width), "fingerprints")
    out = fps.join(_components(fps, max_bits, segments, block), "fp")
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def keep_one(docs: DataFrame, width: int = 3, max_bits: int = 3, segments: int = 16, block: int = 4096) -> DataFrame:
    """One row of each group of :func:`near_duplicates`, with all its columns: the one with the smallest id.

    A row is known by its id and its text (a digest of it), so rows that share an id, or
    have none, are judged by their own texts.  Of a group's rows with the smallest
    id the smallest digest stays, and of equal ones, copies of one text under one id, the row
    whose columns have the smallest digest; a group without any id keeps one row likewise.
    Columns of any type are kept as they are.
    """
    known = docs.select(*_row_key(), F.col("text").cast("string").alias("text"))

    def run(batches):
        for b in slices(batches):
            fp = np.array([fingerprint(t, width) for t in b.column("text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(fp)], names=["no_id", "id", "digest", "fp"])

    fps = write_shared(known.mapInArrow(run, "no_id boolean, id long, digest binary, fp long"), "fingerprints")
    named = _components(fps.select(F.when(~F.col("no_id"), F.col("id")).alias("doc_id"), "fp"), max_bits, segments, block)
    best = fps.groupBy("fp").agg(F.min(F.struct("no_id", "id", "digest")).alias("one")).join(named, "fp")
    best = write_shared(best.groupBy("root").agg(F.min("one").alias("one")).select("one.*"), "kept-rows")
    keys = ["__no_id", "__id", "__digest"]
    best = best.toDF(*keys)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[k.alias(n) for k, n in zip(_row_key(), keys, strict=True)])
    rest = F.sha2(F.to_json("row"), 256)  # maps have no order of their own
    return rows.join(best, keys, "left_semi").groupBy(*keys).agg(F.min_by("row", rest).alias("row")).select("row.*")


def _row_key() -> list:
    """(no_id, id, digest), never null: which rows are the same document."""
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    return [doc_id.isNull().alias("no_id"), F.coalesce(doc_id, F.lit(0)).alias("id"),
            F.coalesce(F.unhex(F.sha2(text, 256)), F.lit(b"")).alias("digest")]


def _components(fps: DataFrame, max_bits: int, segments: int, block: int) -> DataFrame:
    """(fp, root, component_id) of all fingerprints, written: the smallest fingerprint and the smallest id of each component."""
    nodes = write_shared(fps.groupBy("fp").agg(F.min("doc_id").alias("id")), "nodes")
    comp = connected_components(_bucket_links(nodes.select("fp", F.col("fp").alias("node")), max_bits, segments, block))
    comp = comp.select(F.col("node").alias("fp"), "component")
    rooted = write_shared(nodes.join(comp, "fp", "left").select("fp", "id", F.coalesce("component", "fp").alias("root")), "rooted")
    ids = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    return write_shared(rooted.join(ids, "root").select("fp", "root", "component_id"), "named")


def _bucket_links(nodes: DataFrame, max_bits: int, m: int, block: int) -> DataFrame:
    """(u, v): links that connect whatever the buckets' comparisons connect."""
    keyed = nodes.select("node", "fp", F.explode(_chain_keys(F.col("fp"), max_bits, m)).alias("s")).select("node", "fp", "s.k", "s.key")
    sizes = write_shared(keyed.groupBy("k", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "key-sizes")
    blocks = F.ceil(F.col("n") / block).cast("int")
    # a bucket of one block meets itself; of more, every block meets every block
    dealt = keyed.join(sizes, ["k", "key"]).select(
        "k", "key", "node", "fp", blocks.alias("nb"), F.pmod(F.xxhash64("node"), blocks).cast("int").alias("own"))
    dealt = dealt.select("k", "key", "node", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("other"))
    dealt = dealt.select("k", "key", F.least("own", "other").alias("b1"), F.greatest("own", "other").alias("b2"), "node", "fp")
    by = ["k", "key", "b1", "b2"]

    def compare(batches):
        """Groups arrive whole and in order; the last one of a batch may go on in the next."""
        held = []
        for batch in batches:
            t = pa.Table.from_batches([*held, batch])
            groups = np.stack([t.column(c).to_numpy().astype(np.int64) for c in by])
            cuts = np.flatnonzero((groups[:, 1:] != groups[:, :-1]).any(0)) + 1
            whole = int(cuts[-1]) if len(cuts) else 0
            yield _links_of(t, groups, np.concatenate(([0], cuts)), max_bits, m)
            held = t.slice(whole).to_batches()
        if held:
            t = pa.Table.from_batches(held)
            groups = np.stack([t.column(c).to_numpy().astype(np.int64) for c in by])
            yield _links_of(t, groups, np.array([0, t.num_rows]), max_bits, m)

    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(n, *by).sortWithinPartitions(*by).mapInArrow(compare, "u long, v long")


def _links_of(t: pa.Table, groups: np.ndarray, edges: np.ndarray, max_bits: int, m: int) -> pa.RecordBatch:
    """Links to the local roots of the groups between the given edges."""
    node, fp = t.column("node").to_numpy(), t.column("fp").to_numpy().astype(np.int64).view(np.uint64)
    first, size = edges[:-1], np.diff(edges)
    start = groups[0][first] // 2
    us, vs = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for s in np.unique(start):
        at = first[(size == 2) & (start == s)]  # most groups are pairs: all at once
        ok = _linked(fp[at], fp[at + 1], int(s), max_bits, m)
        us.append(node[at][ok])
        vs.append(node[at + 1][ok])
    for a, k, s in zip(first[size > 2].tolist(), size[size > 2].tolist(), start[size > 2].tolist(), strict=True):
        ids = node[a : a + k]
        root = _roots(fp[a : a + k], ids, s, max_bits, m)
        us.append(ids[root != ids])
        vs.append(root[root != ids])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(us), pa.int64()), pa.array(np.concatenate(vs), pa.int64())], names=["u", "v"])
