"""Benchmark decontamination with an Aho-Corasick automaton.

The windows of all benchmark items (13 consecutive words, or a shorter item
whole) go into one automaton over normalised text.  A document is normalised,
scanned once, and every occurrence is mapped back to words and to character
offsets of the original text.
"""

from __future__ import annotations

import re
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.common import id_and_text, place_of, slices, write_shared

#: Words are runs of anything but ASCII characters other than digits and letters; A-Z count as a-z.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_FOLD = bytes(c + 32 if c in _UPPER else c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


def words(text: str | None) -> list[bytes]:
    """Normalised words of a text, as UTF-8."""
    return text.encode().translate(_FOLD).split() if text else []


def _joined(ws: list[bytes]) -> str:
    """One character per byte, with a space on both sides of every word."""
    return (b" " + b" ".join(ws) + b" ").decode("latin-1")


def item_windows(benchmark: DataFrame, size: int = 13) -> DataFrame:
    """(window, items): the distinct windows, each with the ids of the items that hold it.

    Null ids and null or wordless texts give no windows; repeated rows change nothing.
    """
    def cut(batches):
        for b in slices(batches):
            ids, out = [], []
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ws = words(text)
                if ws and item is not None:
                    own = {_joined(ws[i : i + size]) for i in range(max(1, len(ws) - size + 1))}
                    ids += [item] * len(own)
                    out += own
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), pa.array(ids, pa.string())], names=["window", "item"])

    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(cut, "window string, item string").groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _build(block):
    """The automaton of one block of windows, or None if it has none.

    PySpark keeps a broadcast's value in the worker once it is read; it is let
    go here and read again from the worker's disk when the next slice needs it.
    """
    import ahocorasick

    windows = block.value
    if getattr(block, "_path", None):
        vars(block).pop("_value", None)
    if not windows:
        return None
    a = ahocorasick.Automaton()
    for w, items in windows:
        a.add_word(w, (w.count(" ") - 1, items))
    a.make_automaton()
    return a


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = 13, min_share: float = 0.05,
                  block_bytes: int = 16 << 20) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items, spans, contaminated.

    A word is hit if it lies inside any occurrence of a window.  ``items`` are
    the ids (text, sorted) of the items with an occurring window, ``spans`` the
    runs of hit words as half-open character offsets of the original text,
    and ``contaminated`` is true when some word is hit and hit words make up
    ``min_share`` of all or more.  Documents without words (null, empty, only
    punctuation) have zeros and are clean; repeated rows and ids are judged
    row by row; an empty benchmark hits nothing; other columns are ignored.

    The windows are written to the shared folder and counted in bytes.  They
    go to the workers in blocks of at most ``block_bytes``, one automaton a
    block, and a worker holds one block and one automaton at a time, whatever the
    benchmark's size (with ``spark.io.encryption`` PySpark loads every block at once); its
    disk holds all of them, and the driver passes on block after block.  A
    benchmark of one block (the usual case) takes one automaton and one scan of
    the text.  With more blocks, a task scans each slice of rows against them
    in turn and unites the hits.
    """
    windows = write_shared(item_windows(benchmark, size), "windows")
    blocks = _blocks(windows, block_bytes)
    share = _share(min_share)

    def run(batches):
        for b, rows in _judged(batches, blocks, share, "text"):
            cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _KINDS, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=["doc_id", *_NAMES])

    return id_and_text(docs).mapInArrow(run, _COLUMNS)


def _blocks(windows: DataFrame, block_bytes: int) -> list:
    """Broadcast variables, each with the windows of about ``block_bytes`` at most."""
    total = windows.agg(F.sum(F.octet_length("window") + F.octet_length(F.array_join("items", ",")) + 64)).first()[0] or 0
    n = max(1, -(-2 * total // block_bytes))
    sc = windows.sparkSession.sparkContext
    parts = windows.withColumn("_k", F.pmod(F.xxhash64("window"), F.lit(n)))
    return [sc.broadcast([(r["window"], tuple(r["items"])) for r in (windows if n == 1 else parts.where(F.col("_k") == k)).collect()])
            for k in range(n)]


def _hits(ws: list[bytes], automaton) -> tuple[np.ndarray | None, set]:
    """Which words are hit, and by which items."""
    text = _joined(ws)
    found = [(end, v) for end, v in automaton.iter(text)]
    if not found:
        return None, set()
    spaces = np.flatnonzero(np.frombuffer(text.encode("latin-1"), np.uint8) == 0x20)
    last = np.searchsorted(spaces, [end for end, _ in found])  # the occurrence's last word ends here
    depth = np.zeros(len(ws) + 1, np.int64)
    np.add.at(depth, last - [v[0] for _, v in found], 1)
    np.add.at(depth, last, -1)
    return np.cumsum(depth[:-1]) > 0, {i for _, v in found for i in v[1]}


def _row(text: str | None, n: int, hit: np.ndarray | None, items, share) -> tuple:
    n_hit = 0 if hit is None else int(hit.sum())
    spans = []
    if n_hit:
        at = [m.span() for m in WORD.finditer(text)]
        edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
        spans = [{"start": at[a][0], "end": at[b - 1][1]} for a, b in zip(edge[::2], edge[1::2], strict=True)]
    listed = sorted(items)
    return n, n_hit, len(listed), listed, spans, n_hit > 0 and n_hit >= share * n


_COLUMNS = "doc_id long, n_words long, n_hit long, n_items long, items array<string>, spans array<struct<start: long, end: long>>, contaminated boolean"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), _SPANS, pa.bool_()]
_NAMES = ["n_words", "n_hit", "n_items", "items", "spans", "contaminated"]


def _judged(batches, blocks: list, share, column):
    """Each slice of rows with its judgements."""
    one = _build(blocks[0]) if len(blocks) == 1 else None
    for b in slices(batches, (2 << 20) if len(blocks) == 1 else (32 << 20)):
        texts = b.column(column).to_pylist()
        split = [words(t) for t in texts]
        hits, items = [None] * len(split), [set() for _ in split]
        for block in blocks:
            automaton = None  # lets go of the last one first
            automaton = one or _build(block)
            for k, ws in enumerate(split if automaton else []):
                hit, own = _hits(ws, automaton) if ws else (None, ())
                if hit is not None:
                    hits[k] = hit if hits[k] is None else hits[k] | hit
                    items[k] |= own
        yield b, [_row(t, len(ws), h, i, share) for t, ws, h, i in zip(texts, split, hits, items, strict=True)]


def _share(min_share: float) -> Fraction:
    return Fraction(str(min_share))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = 13, min_share: float = 0.05, block_bytes: int = 16 << 20) -> DataFrame:
    """The documents that :func:`decontaminate` finds clean, as they are, with all their columns."""
    blocks = _blocks(write_shared(item_windows(benchmark, size), "windows"), block_bytes)
    share, at = _share(min_share), place_of(docs, "text")

    def run(batches):
        for b, rows in _judged(batches, blocks, share, at):
            yield b.filter(pa.array([not r[-1] for r in rows]))

    return docs.mapInArrow(run, docs.schema)
