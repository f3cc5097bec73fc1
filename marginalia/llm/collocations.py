"""Phrase collocations from weighted acyclic automata.

A shard of texts is tokenised, its n-grams are sorted and one count transducer
is built from them, level by level: an acyclic automaton over words whose
arcs carry counts and whose equal states are one state.  Shard transducers are
cut at common boundaries, and each prefix range is the union of its pieces
with weights summed.  The parts of candidate phrases are looked up by
composing the range's transducer with the sorted list of parts asked of it.
"""

from __future__ import annotations

import bisect
import pickle
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.llm.common import slices, write_shared

MAX_WORDS = 3
UNKNOWN = "und"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_KIND = np.zeros(256, np.uint8)  # 0 a word's byte, 1 between words, 2 between pieces
_KIND[list(b" \t")] = 1
_KIND[list(_BREAKS)] = 2
_GAP = re.compile(rb"[ \t" + _BREAKS + rb"]")


def tokenize(data: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words as binary, piece number of each, offset of each) of lower-cased text; words of one piece share its number."""
    raw = np.frombuffer(data, np.uint8)
    kind = _KIND[raw]
    inside = np.concatenate(([False], kind == 0, [False]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    piece = np.searchsorted(np.flatnonzero(kind == 2), start)
    ends = np.concatenate(([0], np.cumsum(end - start))).astype(np.int64)
    kept = _FOLD[raw[kind == 0]]
    return _binary(ends, kept), piece, start


def _blocks(texts: list[bytes], size: int) -> Iterator[tuple[bytes, int]]:
    """Blocks of about ``size`` bytes and the number of leading words that the block before has counted.

    A text that is cut goes on with its last two words, so no n-gram is lost or counted twice.
    """
    held, n = [], 0
    for raw in texts:
        if len(raw) <= size:
            held.append(raw)
            n += len(raw) + 1
            if n >= size:
                yield b"\n".join(held), 0
                held, n = [], 0
            continue
        at, seen = 0, b""
        while at < len(raw):
            gap = _GAP.search(raw, at + size)  # a word is never cut
            to = gap.start() if gap else len(raw)
            part = seen + raw[at:to]
            yield part, len(tokenize(seen)[0])
            start = tokenize(part)[2]
            seen, at = part[start[-MAX_WORDS + 1 :][0] :] if len(start) else b"", to
    if held:
        yield b"\n".join(held), 0


class CountTransducer:
    """An acyclic automaton over words with a count on every arc.

    ``words`` are the sorted labels.  Level ``k`` has arcs (label, weight, target
    state of level ``k + 1``, -1 for none), grouped by state: state ``s`` of level
    ``k`` has the arcs ``ends[k][s]`` to ``ends[k][s + 1]``.  States with equal arcs are one.
    """

    def __init__(self, words: pa.Array, levels: list[tuple], total: int):
        self.words, self.levels, self.total = words, levels, total

    @classmethod
    def build(cls, words: pa.Array, ids: np.ndarray, weights: np.ndarray, total: int = 0) -> CountTransducer:
        """From distinct n-grams in ascending order (rows of label numbers, -1 after the end) and their counts.

        The longest n-grams are registered first, so equal states are found below before the states that lead to them.
        A prefix that is no n-gram of the list gets weight 0.
        """
        depth = ids.shape[1] if len(ids) else 0
        levels, lower = [], None
        for k in range(depth - 1, -1, -1):
            has = ids[:, k] >= 0
            rows = np.flatnonzero(has)
            new = np.ones(len(rows), bool)  # the first row of each prefix of k + 1 words
            new[1:] = (ids[rows[1:], : k + 1] != ids[rows[:-1], : k + 1]).any(axis=1)
            first = rows[new]
            here = (ids[first, k + 1] < 0) if k + 1 < ids.shape[1] else np.ones(len(first), bool)
            label, weight = ids[first, k].astype(np.int64), np.where(here, weights[first], 0)
            target = np.full(len(first), -1, np.int64)
            if lower is not None:
                owner, state = lower  # the prefix of each state found below, by its first row
                target[np.searchsorted(first, owner, "right") - 1] = state
            parent = np.ones(len(first), bool)
            if k:
                parent[1:] = (ids[first[1:], :k] != ids[first[:-1], :k]).any(axis=1)
            else:
                parent[1:] = False
            begin = np.flatnonzero(parent)
            state, ends, arcs = _registered(label, weight, target, np.append(begin, len(first)))
            levels.append((ends, *arcs))
            lower = (first[begin], state)
        return cls(words, levels[::-1], total)

    def paths(self) -> tuple[np.ndarray, np.ndarray]:
        """All n-grams with a weight, in ascending order, and their weights."""
        if not self.levels:
            return np.empty((0, MAX_WORDS), np.int32), np.empty(0, np.int64)
        state, prefix = np.zeros(1, np.int64), np.empty((1, 0), np.int32)
        rows, weights = [], []
        for ends, label, weight, target in self.levels:
            n = ends[state + 1] - ends[state]
            arc = np.repeat(ends[state] - np.cumsum(n) + n, n) + np.arange(n.sum())
            prefix = np.column_stack([np.repeat(prefix, n, axis=0), label[arc].astype(np.int32)])
            rows.append(np.pad(prefix, ((0, 0), (0, len(self.levels) - prefix.shape[1])), constant_values=-1))
            weights.append(weight[arc])
            on = target[arc] >= 0
            state, prefix = target[arc][on], prefix[on]
        ids, w = np.concatenate(rows), np.concatenate(weights)
        order = np.flatnonzero(w > 0)
        order = order[_in_order(ids[order], len(self.words))]
        return ids[order], w[order]

    def compose(self, asked: list[bytes]) -> np.ndarray:
        """The weight of each phrase (words joined by a space) that the transducer accepts, 0 for others."""
        if not asked or not self.levels:
            return np.zeros(len(asked), np.int64)
        parts = [_path(a) for a in asked]
        flat = pa.array([w for p in parts for w in p], pa.large_binary())
        known = pc.fill_null(pc.index_in(flat, self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        size = np.array([len(p) for p in parts])
        first = np.cumsum(size) - size
        state, out = np.zeros(len(asked), np.int64), np.zeros(len(asked), np.int64)
        for k, (ends, label, weight, target) in enumerate(self.levels):
            at = np.flatnonzero((size > k) & (state >= 0))
            want = known[first[at] + k]
            owner = np.repeat(np.arange(len(ends) - 1), np.diff(ends))  # arcs ascend by (state, label)
            wide = len(self.words) + 1
            arc = np.searchsorted(owner * wide + label, state[at] * wide + want)
            arc = np.minimum(arc, len(label) - 1)
            found = (owner[arc] == state[at]) & (label[arc] == want)
            last = found & (size[at] == k + 1)
            out[at[last]] = weight[arc[last]]
            state[at] = np.where(found, target[arc], -1)
        return out

    def dumps(self) -> bytes:
        ends, text = _raw(self.words)
        size = np.diff(ends)
        arrays = [size.astype(_least(size)), text, *(x.astype(_least(x)) for level in self.levels for x in level)]
        return zlib.compress(pickle.dumps((self.total, arrays)), 1)

    @classmethod
    def loads(cls, blob: bytes) -> CountTransducer:
        total, (size, text, *arrays) = pickle.loads(zlib.decompress(blob))
        arrays = [x.astype(np.int64) for x in arrays]
        return cls(_binary(np.concatenate(([0], np.cumsum(size, dtype=np.int64))), text), [tuple(arrays[k : k + 4]) for k in range(0, len(arrays), 4)], total)


def _raw(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of large binaries."""
    if not len(words):
        return np.zeros(1, np.int64), np.empty(0, np.uint8)
    _, ends, data = words.buffers()
    ends = np.frombuffer(ends, np.int64)[words.offset : words.offset + len(words) + 1]
    return ends - ends[0], np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]


def _binary(ends: np.ndarray, data: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _least(x: np.ndarray) -> np.dtype:
    return np.promote_types(np.min_scalar_type(x.min(initial=0)), np.min_scalar_type(x.max(initial=0)))


def _registered(label, weight, target, ends):
    """(state number per group of arcs, ends, arcs) with equal groups made one.

    Groups of up to four arcs are compared arc by arc; larger ones, which hardly ever repeat, stay apart.
    """
    size = np.diff(ends)
    state, kept, n = np.zeros(len(size), np.int64), [], 0
    for k in range(1, 5):
        g = np.flatnonzero(size == k)
        if not len(g):
            continue
        arc = ends[g][:, None] + np.arange(k)
        rows = np.concatenate([label[arc], weight[arc], target[arc]], axis=1)
        order = np.lexsort(rows.T)
        new = np.ones(len(g), bool)
        new[1:] = (rows[order[1:]] != rows[order[:-1]]).any(axis=1)
        state[g[order]] = n + np.cumsum(new) - 1
        kept.append(g[order[new]])
        n += int(new.sum())
    g = np.flatnonzero(size > 4)
    state[g] = n + np.arange(len(g))
    groups = np.concatenate([*kept, g])
    count = size[groups]
    arc = np.repeat(ends[groups] - np.cumsum(count) + count, count) + np.arange(count.sum())
    return state, np.concatenate(([0], np.cumsum(count))), (label[arc], weight[arc], target[arc])


def _keys(ids: np.ndarray, n_words: int) -> np.ndarray | None:
    """One integer a row in the order of the rows, or None where 62 bits are too few."""
    if (n_words + 1) ** ids.shape[1] >= 1 << 62:
        return None
    key = ids[:, 0].astype(np.int64) + 1
    for k in range(1, ids.shape[1]):
        key = key * (n_words + 1) + ids[:, k] + 1
    return key


def _in_order(ids: np.ndarray, n_words: int) -> np.ndarray:
    key = _keys(ids, n_words)
    return np.lexsort(ids.T[::-1]) if key is None else np.argsort(key)


def _summed(ids: np.ndarray, weights: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in ascending order, their weights summed."""
    if not len(ids):
        return ids, weights
    order = _in_order(ids, n_words)
    ids = ids[order]
    at = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]).any(axis=1)))
    return ids[at], np.add.reduceat(weights[order], at)


def _sorted_words(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(sorted distinct words, number of each in that order)."""
    coded = words.dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    return coded.dictionary.take(order), rank[coded.indices.to_numpy(zero_copy_only=False)] if len(words) else np.empty(0, np.int64)


def count_shard(data: bytes, skip: int = 0) -> tuple[pa.Array, np.ndarray, np.ndarray, int]:
    """(words, distinct n-grams in ascending order, counts, number of words); n-grams that end in the first ``skip`` words are left out."""
    found, piece, _ = tokenize(data)
    words, ids = _sorted_words(found)
    n, base, cols, keys = len(ids), len(words) + 1, [], []
    for k in range(1, min(MAX_WORDS, n) + 1):
        at = np.flatnonzero(piece[k - 1 :] == piece[: n - k + 1])
        at = at[at + k - 1 >= skip]
        row = [ids[at + j] for j in range(k)] + [np.full(len(at), -1, np.int64)] * (MAX_WORDS - k)
        if base**MAX_WORDS < 1 << 62:
            keys.append(((row[0] + 1) * base + row[1] + 1) * base + row[2] + 1)
        else:
            cols.append(np.column_stack(row))
    total = max(n - skip, 0)
    if cols:
        rows = np.concatenate(cols)
        return words, *_summed(rows, np.ones(len(rows), np.int64), len(words)), total
    key = np.concatenate(keys) if keys else np.empty(0, np.int64)
    del keys, ids, piece, found
    key.sort()
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
    weights, key = np.diff(np.append(first, len(key))), key[first]
    rows = np.empty((len(key), MAX_WORDS), np.int32)
    for k in range(MAX_WORDS - 1, -1, -1):
        rows[:, k] = key % base - 1
        key //= base
    return words, rows, weights, total


def union(pieces: list[CountTransducer]) -> CountTransducer:
    """One transducer of all n-grams, weights summed."""
    if not pieces:
        return CountTransducer(pa.array([], pa.large_binary()), [], 0)
    words, number = _sorted_words(pa.concat_arrays([p.words for p in pieces]))
    rows, weights, at = [], [], 0
    for p in pieces:
        ids, w = p.paths()
        own = np.append(number[at : at + len(p.words)], -1).astype(np.int32)  # -1 stays -1
        at += len(p.words)
        rows.append(np.pad(own[ids], ((0, 0), (0, MAX_WORDS - ids.shape[1])), constant_values=-1))
        weights.append(w)
    ids, w = _summed(np.concatenate(rows), np.concatenate(weights), len(words))
    return CountTransducer.build(words, ids, w, sum(p.total for p in pieces))


def _part(words: pa.Array, ids: np.ndarray, weights: np.ndarray) -> CountTransducer:
    """A transducer of some of the rows, with no other words than theirs."""
    used, inverse = np.unique(ids[ids >= 0], return_inverse=True)
    own = np.full_like(ids, -1)
    own[ids >= 0] = inverse
    return CountTransducer.build(words.take(pa.array(used)), own, weights)


def _phrases(words: pa.Array, ids: np.ndarray) -> list[bytes]:
    used = np.unique(ids[ids >= 0])
    name = dict(zip(used.tolist(), words.take(pa.array(used)).to_pylist(), strict=True))
    return [b" ".join([name[i] for i in row if i >= 0]) for row in ids.tolist()]


def _cuts(names: pa.Array, ids: np.ndarray, bounds: list[bytes]) -> np.ndarray:
    """For each bound the number of rows below it (rows and bounds in order of their words)."""
    size = [len(_path(b)) for b in bounds]
    out, lo = [], 0
    for b, n in zip(bounds, size, strict=True):
        want = _path(b)
        left, right = 0, len(ids)
        for k in range(n):  # narrow to rows that share the bound's words so far
            w = bisect.bisect_left(names, want[k], key=lambda x: x.as_py())
            known = w < len(names) and names[w].as_py() == want[k]
            col = ids[left:right, k]
            a = left + int(np.searchsorted(col, w))
            z = left + int(np.searchsorted(col, w, "right")) if known else a
            left, right = a, z
            if left == right:
                break
        lo = max(lo, left)
        out.append(lo)
    return np.array(out, np.int64)


_PIECE = pa.schema([("lang", pa.string()), ("total", pa.int64()), ("mark", pa.int64()), ("first", pa.binary()), ("blob", pa.binary())])


def shard_transducers(docs: DataFrame, shard_bytes: int, fence: int) -> DataFrame:
    """(lang, total, mark, first, blob): transducers of ``fence`` consecutive n-grams of a shard at most, each with its first n-gram.

    ``total`` is the number of words of the shard, on its first piece only; ``mark`` a checksum of the blob.
    """
    def run(batches):
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}

        def out(lang):
            size.pop(lang)
            for data, skip in _blocks(held.pop(lang), shard_bytes):
                words, ids, w, total = count_shard(data, skip)
                for at in range(0, len(ids), fence):
                    blob = _part(words, ids[at : at + fence], w[at : at + fence]).dumps()
                    row = {"lang": lang, "total": 0 if at else total, "mark": zlib.crc32(blob), "first": _phrases(words, ids[at : at + 1])[0], "blob": blob}
                    yield pa.RecordBatch.from_pylist([row], schema=_PIECE)

        for b in slices(batches):
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held.setdefault(lang, []).append(text)
                size[lang] = size.get(lang, 0) + len(text)
                if size[lang] >= shard_bytes:
                    yield from out(lang)
            while sum(size.values()) >= 2 * shard_bytes:  # many languages: the fullest goes first
                yield from out(max(size, key=size.get))
        for lang in sorted(held):
            yield from out(lang)

    text = F.col("text").cast("string")
    rows = docs.where(text != "").select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), text.cast("binary").alias("text"))
    return rows.mapInArrow(run, "lang string, total long, mark long, first binary, blob binary")


def _path(phrase: bytes) -> list[bytes]:
    return phrase.split(b" ")


def _bounds(pieces: DataFrame, per_range: int, max_ranges: int) -> dict[str, list[bytes]]:
    """The first n-gram of each prefix range but a language's first.

    The pieces hold about equally many n-grams, so their first n-grams divide the whole evenly; up to 16
    of them for each range, chosen by checksum, reach the driver.  There are ``max_ranges`` at most; beyond that, ranges grow instead.
    """
    step = max(per_range, -(-pieces.count() // max_ranges))
    out: dict[str, list[bytes]] = {}
    for r in pieces.where(F.pmod("mark", F.lit(step)) < 16).select("lang", "first").collect():
        out.setdefault(r["lang"], []).append(bytes(r["first"]))
    return {lang: sorted(set(sorted(b, key=_path)[:: min(step, 16)][1:]), key=_path) for lang, b in out.items()}


def _range_of(bounds: dict[str, list[bytes]], lang: str, phrase: bytes) -> int:
    return bisect.bisect_right(bounds.get(lang, []), _path(phrase), key=_path)


def range_transducers(pieces: DataFrame, bounds, min_count: int) -> tuple[DataFrame, DataFrame]:
    """(the frequent n-grams as rows, their transducers by range): pieces are cut at the bounds and each range is a union."""
    def cut(batches):
        for b in batches:
            for lang, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                t = CountTransducer.loads(blob)
                ids, w = t.paths()
                if not len(ids):
                    continue
                low, high = (_range_of(bounds.value, lang, x) for x in _phrases(t.words, ids[[0, -1]]))
                at = [0, *_cuts(t.words, ids, bounds.value.get(lang, [])[low:high]).tolist(), len(ids)]
                for k in range(low, high + 1):
                    a, z = at[k - low], at[k - low + 1]
                    if z > a:
                        part = blob if (a, z) == (0, len(ids)) else _part(t.words, ids[a:z], w[a:z]).dumps()
                        yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([k], pa.int64()), pa.array([part], pa.binary())], names=["lang", "range", "blob"])

    def unite(key, table):
        t = union([CountTransducer.loads(x.as_py()) for x in table.column("blob")])
        ids, w = t.paths()
        kept = w >= min_count
        frequent = _part(t.words, ids[kept], w[kept])
        return pa.table({"lang": [key[0].as_py()], "range": pa.array([key[1].as_py()], pa.int64()), "blob": pa.array([frequent.dumps()], pa.binary())})

    kind = "lang string, range long, blob binary"
    ranges = write_shared(pieces.select("lang", "blob").mapInArrow(cut, kind).groupBy("lang", "range").applyInArrow(unite, kind), "phrase-ranges")

    def listed(batches):
        for b in batches:
            for lang, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                t = CountTransducer.loads(blob)
                ids, w = t.paths()
                size = (ids >= 0).sum(axis=1)
                at = np.flatnonzero(size > 1)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(_phrases(t.words, ids[at]), pa.binary()),
                                                  pa.array(size[at], pa.int32()), pa.array(w[at], pa.int64())], names=["lang", "phrase", "words", "a"])

    grams = ranges.select("lang", "blob").mapInArrow(listed, "lang string, phrase binary, words int, a long")
    return grams.withColumn("phrase", F.col("phrase").cast("string")), ranges


def look_up(parts: DataFrame, ranges: DataFrame, bounds) -> DataFrame:
    """(lang, part, f) for distinct (lang, part): each range's transducer composed with the parts asked of it."""
    def route(batches):
        for b in batches:
            langs, asked = b.column(0).to_pylist(), b.column(1).to_pylist()
            at = [_range_of(bounds.value, x, p) for x, p in zip(langs, asked, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, pa.int64())], names=["lang", "part", "range"])

    def compose(left, right):
        asked = left.column("part").to_pylist()
        f = np.zeros(len(asked), np.int64)
        for blob in right.column("blob").to_pylist():
            f += CountTransducer.loads(blob).compose(asked)
        return pa.table({"lang": left.column("lang").cast(pa.string()), "part": left.column("part").cast(pa.binary()), "f": pa.array(f, pa.int64())})

    routed = parts.select("lang", F.col("part").cast("binary").alias("part")).mapInArrow(route, "lang string, part binary, range long")
    found = routed.groupBy("lang", "range").cogroup(ranges.groupBy("lang", "range")).applyInArrow(compose, "lang string, part binary, f long")
    return found.withColumn("part", F.col("part").cast("string"))


def score_of(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)), in decimals of 38 digits: exact for counts of up to 15 digits."""
    a, left, right = (x.cast("decimal(15,0)") for x in (a, left, right))
    top, low = a * a * F.lit(1_000_000).cast("decimal(7,0)"), left * right
    return F.call_function("div", top, low).cast("long")


def collocations(docs: DataFrame, min_count: int = 10, top: int = 2000, cover: int = 50, shard_bytes: int = 8 << 20,
                 fence: int = 1 << 15, per_range: int = 32, max_ranges: int = 100_000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of two and three words of each language.

    Texts are lower-cased (A-Z), split at ``. , ; : ! ?`` and line ends into pieces and those at
    spaces and tabs into words.  ``n`` counts a language's words, ``a`` a phrase's occurrences within
    pieces.  A cut after the first k words has l and r, the counts of its parts, and
    floor(1000000 a a / (l r)); the lowest score counts, then the smallest k.  A phrase goes if a
    longer candidate that holds it has ``cover`` per cent of its count or more.  Order: score, then
    a, descending, then the phrase's UTF-8 bytes.  Products are decimals of 38 digits, exact while counts have 15.

    A null language is ``und``.  Null and empty texts and texts without words add nothing, repeated rows
    count each time, ids are not read, an empty table gives no rows, other columns are ignored.  Very long
    texts are counted in overlapping blocks, whole.

    Tasks hold ``shard_bytes`` of a language at a time.  A shard's transducer is written in pieces
    of ``fence`` n-grams; a prefix range is about ``per_range`` pieces, whatever word or pair is
    common, since bounds are whole n-grams and a shard holds each n-gram once.
    """
    spark = docs.sparkSession
    pieces = write_shared(shard_transducers(docs, shard_bytes, fence), "phrase-shards")
    bounds = spark.sparkContext.broadcast(_bounds(pieces, per_range, max_ranges))
    grams, ranges = range_transducers(pieces, bounds, min_count)
    grams = write_shared(grams, "phrase-candidates")

    split = F.split("phrase", " ")
    pair = F.struct(F.array_join(F.slice(split, 1, 2), " ").alias("phrase"), F.col("a").alias("_longer"))
    other = F.struct(F.array_join(F.slice(split, 2, 2), " ").alias("phrase"), F.col("a").alias("_longer"))
    inner = grams.where("words = 3").select("lang", F.explode(F.array(pair, other)).alias("x")).groupBy("lang", "x.phrase").agg(F.max("x._longer").alias("_longer"))
    inner = inner.select("lang", "phrase", "_longer", F.lit(2).alias("words"))
    kept = grams.join(inner, ["lang", "phrase", "words"], "left").where(F.col("_longer").isNull() | (100 * F.col("_longer") < cover * F.col("a")))

    k = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    cuts = kept.select("lang", "phrase", "a", "words", k)
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice(split, F.lit(1), F.col("k")), " ").alias("left_part"),
                       F.array_join(F.slice(split, F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("right_part"))
    parts = cuts.select("lang", F.explode(F.array("left_part", "right_part")).alias("part")).distinct()
    counts = write_shared(look_up(parts, ranges, bounds), "phrase-parts")
    scored = cuts.join(counts.select("lang", F.col("part").alias("left_part"), F.col("f").alias("l")), ["lang", "left_part"]).join(
        counts.select("lang", F.col("part").alias("right_part"), F.col("f").alias("r")), ["lang", "right_part"])
    best = scored.withColumn("score", score_of(F.col("a"), F.col("l"), F.col("r")))
    best = best.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("x")).select(
        "lang", "phrase", "x.score", "x.a", "x.l", "x.r")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = best.withColumn("_b", F.pmod(F.xxhash64("phrase"), F.lit(64)))  # a language's top are among the tops of its parts
    some = some.withColumn("_n", F.row_number().over(Window.partitionBy("lang", "_b").orderBy(*order))).where(F.col("_n") <= top)
    out = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    n = pieces.groupBy("lang").agg(F.sum("total").alias("n"))
    return out.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
