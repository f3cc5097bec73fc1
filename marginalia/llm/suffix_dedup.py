"""Removal of long repeated byte strings with a run-length compressed suffix index.

Every string of ``length`` bytes contains an anchor: the smallest hash among
the ``k``-byte strings in it.  Two occurrences of the string have the same anchor at
the same place, so it is enough to compare the surroundings of equal anchors.
Anchors that occur once are dropped, equal surroundings are one row with a
count, and what is left is indexed in blocks: a Burrows-Wheeler transform
kept as runs, with the suffix positions and common prefix lengths at the runs'
two ends.  Between run ends these lengths fall by one per position, so
matching statistics stream over the text from the samples alone; positions that
match ``length`` bytes elsewhere are marked.  As surroundings are aligned at
their anchors, the transform is built a column at a time.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.common import place_of, slices, write_shared

ANCHOR = 32
_M = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_SLICE = 1 << 20


def _mixed(x: np.ndarray) -> np.ndarray:
    """A fixed bijective mix of 64-bit values."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Anchors:
    """Anchor positions of the windows of a byte array of limited size."""

    def __init__(self, length: int, k: int, most: int):
        self.length, self.k, self.bits = length, k, np.uint64(most.bit_length())
        self.up, self.down = _powers(_BASE, most + 1), _powers(pow(_BASE, -1, 1 << 64), most + 1)

    def hashes(self, data: np.ndarray) -> np.ndarray:
        """A hash of each ``k``-byte string (rolling, by differences of a prefix sum)."""
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * self.up[: len(data)], out=total[1:])
        return _mixed((total[self.k :] - total[: -self.k]) * self.down[: len(data) - self.k + 1])

    def __call__(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Anchors of the windows at the given starts (ascending): positions, each once, and their hashes."""
        h = self.hashes(data)
        bits = self.bits  # the same for every buffer, so hashes tie everywhere or nowhere
        low = (h >> bits << bits) | np.arange(len(h), dtype=np.uint64)  # ties go to the leftmost
        span, width = 1, self.length - self.k + 1
        while 2 * span <= width:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < width:
            low = np.minimum(low[: len(low) - (width - span)], low[width - span :])
        at = (low[starts] & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
        at = at[np.concatenate(([True], at[1:] != at[:-1]))]
        return at, h[at].view(np.int64)


def _anchor_rows(batches, length: int, k: int):
    """Arrow batches (doc, v, pos, seed, around) of all anchors."""
    find, reach = _Anchors(length, k, _SLICE + 2 * length), length - k
    for b in slices(batches, _SLICE):
        raw = [t.encode() for t in b.column(2).to_pylist()]
        docs, vs = b.column(0).to_pylist(), b.column(1).to_pylist()
        out = []
        group: list[int] = []
        for i in [*range(len(raw)), -1]:
            size = sum(len(raw[g]) for g in group)
            if group and (i < 0 or size + len(raw[i]) > _SLICE):  # short texts together
                data = np.frombuffer(b"".join(raw[g] for g in group), np.uint8)
                first = np.cumsum([0, *[len(raw[g]) for g in group[:-1]]])
                starts = np.concatenate([np.arange(f, f + len(raw[g]) - length + 1) for f, g in zip(first, group, strict=True)])
                at, seed = find(data, starts)
                own = np.searchsorted(first, at, side="right") - 1
                out += [(group[o], p, s) for o, p, s in zip(own.tolist(), (at - first[own]).tolist(), seed.tolist(), strict=True)]
                group = []
            if i < 0 or len(raw[i]) < length:
                continue
            if len(raw[i]) <= _SLICE:
                group.append(i)
                continue
            data, last = np.frombuffer(raw[i], np.uint8), -1
            for s0 in range(0, len(data) - length + 1, _SLICE):  # a long text by runs of windows
                n = min(_SLICE, len(data) - length + 1 - s0)
                at, seed = find(data[s0 : s0 + n + length - 1], np.arange(n))
                out += [(i, p, s) for p, s in zip((at + s0).tolist(), seed.tolist(), strict=True) if p > last]
                last = max(last, int(at[-1]) + s0)
        around = [xxhash.xxh3_64_intdigest(raw[i][max(0, p - reach) : p + length], min(p, reach)) for i, p, _ in out]
        yield pa.RecordBatch.from_arrays(
            [pa.array([docs[i] for i, _, _ in out], pa.int64()), pa.array([vs[i] for i, _, _ in out], pa.int64()), pa.array([p for _, p, _ in out], pa.int32()),
             pa.array([s for _, _, s in out], pa.int64()), pa.array(np.array(around, np.uint64).view(np.int64))], names=["doc", "v", "pos", "seed", "around"])


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Suffix array of a text of symbols below 2**21, by prefix tripling over unresolved suffixes (doubling from 2**21 symbols on)."""
    n = len(t)
    p = np.concatenate([t, np.zeros(2, np.int64)])
    key = (p[:n] + 1 << 42) | (p[1 : n + 1] << 21) | p[2 : n + 2]
    sa = np.argsort(key).astype(np.int32)  # equal keys stay one group, whatever their order
    ordered = key[sa]
    head = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    group = np.maximum.accumulate(np.where(head, np.arange(n, dtype=np.int32), 0))
    rank = np.full(n + 1, -1, np.int32)
    rank[sa] = group
    rank += 1  # 0 beyond the end
    h, triple = 3, n + 1 < 1 << 21  # three ranks fit a key
    while True:
        slots = np.flatnonzero(~(head & np.concatenate((head[1:], [True]))))
        if not len(slots):
            return sa.astype(np.int64)
        sub = sa[slots]
        key = group[slots].astype(np.int64)
        if triple:
            key = (key << 42) | (rank[np.minimum(sub + h, n)].astype(np.int64) << 21) | rank[np.minimum(sub + 2 * h, n)]
        else:
            key = (key << 32) | rank[np.minimum(sub + h, n)]
        order = np.argsort(key)
        sa[slots] = sub = sub[order]
        key = key[order]
        head[slots] = own = np.concatenate(([True], key[1:] != key[:-1]))
        group[slots] = np.maximum.accumulate(np.where(own, slots, 0))
        rank[sub] = group[slots] + 1
        h *= 3 if triple else 2


class RunLengthIndex:
    """A Burrows-Wheeler transform as runs, with samples at both ends of each.

    ``run_symbol`` and ``run_start`` are the transform.  For the first suffix
    of each run ``head_at`` and ``head_len`` hold its position and how far it agrees
    with the suffix before it in suffix order; ``tail_at`` and ``tail_len`` do so for the last
    and the suffix after it.
    """

    def __init__(self, t: np.ndarray):
        sa = suffix_array(t)
        n = len(t)
        bwt = np.where(sa > 0, t[sa - 1], -1)
        change = np.flatnonzero(bwt[1:] != bwt[:-1]) + 1
        self.n, self.run_start = n, np.concatenate(([0], change))
        self.run_symbol = bwt[self.run_start]
        tails = np.concatenate((change - 1, [n - 1]))
        self.head_at, self.tail_at = sa[self.run_start], sa[tails]
        inner = _agree(t, sa[change - 1], sa[change])  # the runs' ends are neighbours
        self.head_len = np.concatenate(([0], inner))
        self.tail_len = np.concatenate((inner, [0]))

    def matching_statistics(self) -> np.ndarray:
        """For each text position, the longest string from there that also starts elsewhere.

        Inside a run, moving one position to the right keeps the neighbour in
        suffix order and shortens the match by one; so each position takes
        the nearest sample at or before it.
        """
        best = np.zeros(self.n, np.int64)
        for at, length in ((self.head_at, self.head_len), (self.tail_at, self.tail_len)):
            near = np.full(self.n, -1, np.int64)
            near[at] = at + length
            end = near[np.maximum.accumulate(np.where(near >= 0, np.arange(self.n), 0))]
            best = np.maximum(best, end - np.arange(self.n))
        return best


def _agree(t: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common prefix lengths of the suffixes at a and b, three symbols a step."""
    p = np.concatenate([t, np.array([-1, -2, -3], np.int64)])
    n, out, live = len(t), np.zeros(len(a), np.int64), np.arange(len(a))
    step = 3
    while len(live):
        x, y = a[live] + out[live], b[live] + out[live]
        x, y = np.minimum(x, n), np.minimum(y, n)
        same = p[x] == p[y]
        for j in range(1, step):
            same &= p[np.minimum(x + j, n)] == p[np.minimum(y + j, n)]
        same &= (x < n) & (y < n)
        out[live[same]] += step
        live = live[same]
    live = np.arange(len(a))
    for _ in range(step - 1):
        x, y = np.minimum(a[live] + out[live], n), np.minimum(b[live] + out[live], n)
        same = (p[x] == p[y]) & (x < n) & (y < n)
        out[live[same]] += 1
        live = live[same]
    return out


class AlignedIndex(RunLengthIndex):
    """The index of texts that are aligned at their middles, built a column at a time.

    A unit is ``left`` bytes, the middle, ``right`` bytes and an end of its own.  Its
    symbols are (column, group, byte), the column being the distance from the
    middle: units agree where they are of one group and have equal bytes in equal
    columns.  So the suffixes that start in a column are ordered by group, byte and their
    order in the column to the right, and only one column's order is held beside the runs.
    """

    def __init__(self, text: np.ndarray, middle: np.ndarray, left: np.ndarray, right: np.ndarray, group: np.ndarray):
        place = np.uint64(int(len(middle)).bit_length())
        by_end, by_start = np.argsort(-right, kind="stable"), int(left.max())
        ends = right[by_end] + 1
        order, columns, added = np.zeros(0, np.int64), [], 0
        high = (group.astype(np.uint64) << np.uint64(9)) << place
        for c in range(int(ends[0]), -by_start - 1, -1):
            if c < 0:
                order = order[left[order] >= -c]
            symbol = text[middle[order] + c].astype(np.uint64)
            more = added + int(np.searchsorted(-ends[added:], -c, side="right"))
            if more > added:  # units that end in this column
                order = np.concatenate((order, by_end[added:more]))
                symbol = np.concatenate((symbol, np.full(more - added, 256, np.uint64)))
                added = more
            key = np.sort(high[order] | (symbol << place) | np.arange(len(order), dtype=np.uint64))
            order = order[(key & np.uint64((1 << int(place)) - 1)).astype(np.int64)]
            at = middle[order] + c
            before = np.where(left[order] > -c, text[at - 1].astype(np.int16), np.int16(-1))  # -1: a unit's first, unlike any other
            change = np.flatnonzero((group[order[1:]] != group[order[:-1]]) | (before[1:] != before[:-1]) | (before[1:] < 0)) + 1
            heads, tails = np.concatenate(([0], change)), np.concatenate((change - 1, [len(order) - 1]))
            u, v = order[change - 1], order[change]
            most = np.where(group[u] == group[v], np.minimum(right[u], right[v]) + 1 - c, 0)
            columns.append((len(order), heads, before[heads], at[heads], at[tails], np.concatenate(([0], most))))
        columns.reverse()
        size, heads, symbols, head_at, tail_at, most = zip(*columns, strict=True)
        self.n = len(text)
        self.run_start = np.concatenate([h + s for h, s in zip(heads, np.cumsum([0, *size[:-1]]), strict=True)])
        self.run_symbol = np.concatenate(symbols)
        self.head_at, self.tail_at = np.concatenate(head_at), np.concatenate(tail_at)
        self.head_len = np.concatenate(([0], _agree_bytes(text, self.tail_at[:-1], self.head_at[1:], np.concatenate(most)[1:])))
        self.tail_len = np.concatenate((self.head_len[1:], [0]))


def _agree_bytes(text: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Common prefix lengths of the bytes from a and b, ``most`` at most, eight bytes a step."""
    words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(np.concatenate((text, np.zeros(7, np.uint8))), 8)).view("<u8").ravel()
    out, live = np.zeros(len(a), np.int64), np.flatnonzero(most > 0)
    while len(live):
        at = out[live]
        x = words[a[live] + at] ^ words[b[live] + at]
        out[live] = at + np.where(x == 0, 8, np.frexp((x & (~x + np.uint64(1))).astype(np.float64))[1] - 1 >> 3)
        live = live[(x == 0) & (out[live] < most[live])]
    return np.minimum(out, most)


_UNIT = "key binary, s int, left binary, right binary, doc long, v long, at long, done boolean"
_MARK = "doc long, v long, start long, end long"


def _index_block(rows: pa.Table, length: int) -> pa.RecordBatch:
    """Marks from one index over whole groups of surroundings.

    A group's common middle is one symbol and every surrounding ends with a
    symbol of its own, so matches stay inside; ``s`` symbols with the middle
    stand for ``length`` bytes.
    """
    keys = np.array(rows.column("key").to_pylist(), object)
    group = np.cumsum(np.concatenate(([0], keys[1:] != keys[:-1])))
    left, right = rows.column("left").to_pylist(), rows.column("right").to_pylist()
    s = rows.column("s").to_numpy().astype(np.int64)
    nl = np.array([len(x) for x in left], np.int64)
    nr = np.array([len(x) for x in right], np.int64)
    sizes = nl + nr + 2
    first = np.cumsum(sizes) - sizes
    text = np.frombuffer(b"".join(x for l, r in zip(left, right, strict=True) for x in (l, b"\0", r, b"\0")), np.uint8)
    middle = first + nl
    long = AlignedIndex(text, middle, nl, nr, group).matching_statistics()
    # windows that hold the middle: they start at most s - 1 before it
    todo = np.flatnonzero(~rows.column("done").to_numpy(zero_copy_only=False))
    lo = np.maximum(first, middle - s + 1)[todo]
    n = middle[todo] - lo + 1
    unit = np.repeat(todo, n)
    start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    hit = long[start] >= s[unit]
    unit, start = unit[hit], start[hit]
    new = np.concatenate(([True], (unit[1:] != unit[:-1]) | (start[1:] != start[:-1] + 1)))[: len(unit)]
    end = np.concatenate((new[1:], [True]))[: len(unit)]
    at = rows.column("at").to_numpy()
    place = at[unit] - (middle[unit] - start)
    return pa.RecordBatch.from_arrays(
        [pa.array(rows.column("doc").to_numpy()[unit[new]], pa.int64()), pa.array(rows.column("v").to_numpy()[unit[new]], pa.int64()),
         pa.array(place[new], pa.int64()), pa.array(place[end] + length, pa.int64())], names=["doc", "v", "start", "end"])


def _index(units: DataFrame, length: int, block: int) -> DataFrame:
    """Marks of groups that fit a block; a task indexes some whole groups at a time."""
    def run(batches):
        held, symbols = [], 0
        for batch in batches:
            t = pa.Table.from_batches([*held, batch])
            keys = t.column("key").to_pylist()
            size = np.array([len(x) + len(y) + 2 for x, y in zip(t.column("left").to_pylist(), t.column("right").to_pylist(), strict=True)])
            cuts = [i for i in range(1, len(keys)) if keys[i] != keys[i - 1]]
            at = 0
            total = np.concatenate(([0], np.cumsum(size)))
            for c, after in zip(cuts, [*cuts[1:], len(keys)], strict=False):
                if total[after] - total[at] > block and c > at:
                    yield _index_block(t.slice(at, c - at).combine_chunks(), length)
                    at = c
            held = t.slice(at).to_batches()
        if held:
            t = pa.Table.from_batches(held)
            if t.num_rows:
                yield _index_block(t.combine_chunks(), length)

    n = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return units.repartition(n, "key").sortWithinPartitions("key").mapInArrow(run, _MARK)


def _split(units: DataFrame, length: int, ways: int) -> DataFrame:
    """Groups too large for a block, by parts of their windows: the middle grows, the sides shrink.

    A part's key holds the bytes that all its windows share, so groups fall apart where
    surroundings differ.  Equal parts become one row; all who hold them are marked.
    """
    def run(batches):
        for b in slices(batches, _SLICE):
            out = []
            for key, s, left, right, doc, v, at, done in zip(*[c.to_pylist() for c in b.columns], strict=True):
                step = -(-s // ways)
                for a in range(0, s, step):
                    e = min(s, a + step)
                    if len(left) < s - e or len(right) < a:
                        continue
                    cut = len(left) - (s - e)
                    k = hashlib.blake2b(b"%d %d %d " % (s, a, e) + key + left[cut:] + right[:a], digest_size=16).digest()
                    out.append((k, e - a, left[max(0, cut - (e - a - 1)) : cut], right[a : a + e - a - 1], doc, v, at - (s - e), done))
            kinds = [pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
            cols = list(zip(*out, strict=True)) or [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in _UNIT.split(", ")])

    return units.mapInArrow(run, _UNIT)


def _whole(units: DataFrame, length: int) -> DataFrame:
    """Marks of all windows of a surrounding that occurs again as it is."""
    side = F.col("s") - 1
    return units.where(~F.col("done") & ((F.octet_length("left") + F.octet_length("right")) >= side)).select(
        "doc", "v", (F.col("at") - F.octet_length("left")).cast("long").alias("start"),
        (F.col("at") + (length - side) + F.octet_length("right")).cast("long").alias("end"))


def repeated_spans(docs: DataFrame, length: int = 200, block: int = 2_000_000, ways: int = 8) -> DataFrame:
    """(doc, v, start, end): byte spans that together cover every repeated string of ``length`` bytes.

    ``docs`` is :func:`keyed`.  Anchors are about one in 85 bytes.  The steps:
    count anchors (partial sums, so a hot one costs a row a task); keep rows
    whose anchor occurs twice; make equal surroundings one row, mark all who
    hold it; fetch the bytes of one holder each; index.  A group of more than
    ``block`` symbols is split by its windows (in ``ways`` parts, again
    and again, at last to single windows, where counting decides), so no anchor is too
    frequent and a task never holds more than a block and a group.
    """
    k = min(ANCHOR, length)
    reach = length - k
    found = docs.select("doc", "v", "text").mapInArrow(lambda bs: _anchor_rows(bs, length, k), "doc long, v long, pos int, seed long, around long")
    found = write_shared(found, "anchors")
    seeds = found.groupBy("seed").agg(F.count(F.lit(1)).alias("n"), F.min("around").alias("lo"), F.max("around").alias("hi")).where("n > 1")
    seeds = write_shared(seeds.select("seed", (F.col("lo") != F.col("hi")).alias("mixed")), "seeds")
    found = write_shared(found.join(seeds, "seed"), "repeated")
    mixed = found.where("mixed")
    around = mixed.groupBy("seed", "around").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "v", "pos")).alias("one"))
    around = write_shared(around, "around")
    again = around.where("n > 1").select("seed", "around", F.lit(True).alias("again"))
    copied = found.join(again, ["seed", "around"], "left").where("not mixed or again").select("doc", "v", "pos")  # one pass over the repeated anchors
    marks = [copied.select("doc", "v", (F.col("pos") - reach).cast("long").alias("start"), (F.col("pos") + length).cast("long").alias("end"))]

    # a document has at most one anchor per byte, so its list is bounded by its text
    wanted = around.select("one.doc", "one.v", F.struct("one.pos", (F.col("n") > 1).alias("done")).alias("w")).groupBy("doc", "v").agg(F.collect_list("w").alias("w"))

    def cut(batches):
        for b in slices(batches, _SLICE):
            out = []
            for doc, v, text, ws in zip(*[c.to_pylist() for c in b.columns], strict=True):
                raw = text.encode()
                for w in ws:
                    p = w["pos"]
                    key = hashlib.blake2b(raw[p : p + k], digest_size=16).digest()
                    out.append((key, reach + 1, raw[max(0, p - reach) : p], raw[p + k : p + length], doc, v, p, w["done"]))
            kinds = [pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
            cols = list(zip(*out, strict=True)) or [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in _UNIT.split(", ")])

    units = docs.join(wanted, ["doc", "v"]).select("doc", "v", "text", "w").mapInArrow(cut, _UNIT)
    units = write_shared(units, "units").dropDuplicates(["key", "doc", "v", "at"])
    level = 0
    while True:
        sizes = units.groupBy("key").agg(F.sum(F.octet_length("left") + F.octet_length("right") + 2).alias("symbols"), F.count(F.lit(1)).alias("n")).where("n > 1")
        sizes = write_shared(sizes, "group-sizes")
        fits, hot = sizes.where(F.col("symbols") <= block), sizes.where(F.col("symbols") > block)
        marks.append(write_shared(_index(units.join(fits.select("key"), "key"), length, block), "marks"))
        if hot.isEmpty():
            break
        level += 1
        parts = write_shared(_split(units.join(hot.select("key"), "key").select(*[x.split()[0] for x in _UNIT.split(", ")]), length, ways), "units")
        same = parts.groupBy("key", "left", "right").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "v", "at")).alias("one"), F.max("s").alias("s"), F.max("done").alias("was"))
        same = write_shared(same, "parts")
        again = same.where("n > 1").select("key", "left", "right")
        marks.append(_whole(parts.join(again, ["key", "left", "right"]), length).select("doc", "v", "start", "end"))
        units = same.select("key", "s", "left", "right", "one.doc", "one.v", "one.at", (F.col("was") | (F.col("n") > 1)).alias("done"))
    out = marks[0]
    for m in marks[1:]:
        out = out.union(m)
    return out


def _identity() -> list:
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    # a null id is replaced by a hash of the text that is independent of v: 128 bits tell such rows apart, and from id 0
    return [F.coalesce(doc_id, F.xxhash64(F.lit("no id"), text)).alias("doc"), F.xxhash64(doc_id.isNull(), doc_id, text).alias("v")]


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and (doc, v): the id with a 64-bit hash that tells rows of one id apart; without id, two such hashes."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *_identity())


def _cleaned(raw: bytes, marks) -> tuple[list[list[int]], bytes]:
    """The maximal marked spans and the bytes outside them."""
    spans: list[list[int]] = []
    for start, end in sorted((max(0, x["start"]), min(len(raw), x["end"])) for x in marks or ()):
        if spans and start <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([start, end])
    edges = [0, *[x for s in spans for x in s], len(raw)]
    return spans, b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True))


def _marks_by_document(docs: DataFrame, length: int, block: int, ways: int) -> DataFrame:
    marks = repeated_spans(docs, length, block, ways)
    return marks.groupBy("doc", "v").agg(F.collect_list(F.struct("start", "end")).alias("m"))  # bounded by the text


def remove_repeats(docs: DataFrame, length: int = 200, block: int = 2_000_000, ways: int = 8) -> DataFrame:
    """One row per document: doc_id, n_bytes, spans, n_removed, n_spans, kept (binary).

    Removed is each byte of the UTF-8 text that lies in a string of ``length``
    bytes which also starts anywhere else in the corpus, the same document and
    overlaps included; what is repeated is judged on the input.  ``spans`` are
    the maximal removed runs as half-open byte offsets.  Null texts are empty;
    texts under ``length`` bytes keep everything; repeated rows, also with
    equal or null ids, are documents of their own and so repeat each other; an
    empty table gives no rows; other columns are ignored.
    """
    docs = keyed(docs)
    by_doc = _marks_by_document(docs, length, block, ways)

    def drop(batches):
        for b in slices(batches, 4 * _SLICE):
            rows = []
            for text, m in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                raw = text.encode()
                spans, kept = _cleaned(raw, m)
                rows.append((len(raw), [{"start": x, "end": y} for x, y in spans], len(raw) - len(kept), len(spans), kept))
            kinds = [pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]],
                                             names=["doc_id", "n_bytes", "spans", "n_removed", "n_spans", "kept"])

    return docs.join(by_doc, ["doc", "v"], "left").select("doc_id", "text", "m").mapInArrow(
        drop, "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, n_removed long, n_spans long, kept binary")


def without_repeats(docs: DataFrame, length: int = 200, block: int = 2_000_000, ways: int = 8) -> DataFrame:
    """The documents with the repeats cut out of ``text``, all rows and columns kept.

    ``n_chars``, if there, follows the new text.  Bytes of a character that a
    cut has torn apart go with the cut.  Null texts stay null.
    """
    by_doc = _marks_by_document(keyed(docs), length, block, ways)
    at = place_of(docs, "text")

    def cut(batches):
        for b in slices(batches, 4 * _SLICE):
            texts, m = b.column(at).to_pylist(), b.column(b.num_columns - 1).to_pylist()
            new = [t if not x else _cleaned(t.encode(), x)[1].decode(errors="ignore") for t, x in zip(texts, m, strict=True)]
            cols = [*b.columns[:at], pa.array(new, pa.string()), *b.columns[at + 1 : -1]]
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names[:-1])

    names = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*names).alias("row"), *_identity())  # no column of the table can clash
    marks = "m"
    while marks.lower() in {c.lower() for c in docs.columns}:
        marks += "_"
    rows = rows.join(by_doc, ["doc", "v"], "left").select("row.*", F.col("m").alias(marks))
    out = rows.mapInArrow(cut, docs.schema)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
