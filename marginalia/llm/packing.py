"""Harmonic packing of token sequences.

A document's ids are cut into whole sequences and a rest; the rest is cut at
reciprocal-capacity lengths ``capacity // j``.  A piece of class ``j`` has that
length, and ``j`` such pieces fill a sequence.  So the place of a piece depends
only on its rank within its class, and every worker fills its own run of
sequences without seeing the others' pieces: a count per (task, class) is all
that is exchanged.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginalia.llm import tokens
from marginalia.llm.common import id_and_text, slices, write_shared

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, class int, local long, part int"


def class_lengths(capacity: int) -> list[int]:
    """The distinct lengths ``capacity // j``, descending; about twice the root of the capacity of them."""
    return sorted({capacity // j for j in range(1, capacity + 1)}, reverse=True)


def cut(n: int, capacity: int, descending: list[int]) -> list[int]:
    """Lengths of the pieces of ``n`` ids: whole sequences, then the largest class length that fits, and so on."""
    out = [capacity] * (n // capacity)
    rest, at = n % capacity, 0
    while rest:
        at = bisect_left(descending, -rest, lo=at, key=lambda x: -x)
        out.append(descending[at])
        rest -= descending[at]
    return out


def pack(docs: DataFrame, capacity: int = 1024, end_id: int = 0, vocabulary: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, class.

    ``start`` is the number of the document's ids before the piece,
    ``doc_tokens`` counts the closing ``end_id``, and ``ids_crc32`` is the
    unsigned crc32 of the piece's ids as little-endian unsigned 32-bit
    integers.  Null and empty texts are one ``end_id``.  Repeated rows and
    repeated or null doc_ids are packed like any other rows; an empty table
    gives no rows; other columns are ignored.

    Only the last sequence of a class can be unfilled; these at most
    ``len(class_lengths(capacity))`` rests are put together, largest first, so
    padding does not grow with the corpus beyond ``capacity % length`` per
    sequence of a class.

    The pieces are written once with the task's number and their rank in
    (task, class); counts per (task, class) give each task the sequences that
    it starts from.  The exchanged table has (tasks x classes) rows.
    """
    sizes = class_lengths(capacity)

    def pieces(batches):
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), {}
        for b in slices(batches):
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = np.append(tokens.encode(text, vocabulary), np.uint32(end_id)).astype("<u4")
                start = 0
                for length in cut(len(ids), capacity, sizes):
                    rank = seen.get(length, 0)
                    seen[length] = rank + 1
                    rows.append((doc_id, start, length, zlib.crc32(ids[start : start + length]), len(ids), capacity // length, rank, part))
                    start += length
            cols = list(zip(*rows, strict=True))
            kinds = [pa.int64()] * 5 + [pa.int32(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                             names=[x.split()[0] for x in _PIECES.split(", ")])

    written = write_shared(id_and_text(docs).mapInArrow(pieces, _PIECES), "pieces")
    before = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = written.groupBy("class", "part").agg(F.count(F.lit(1)).alias("n"), F.max("length").alias("length"))
    counts = write_shared(counts, "class-counts")
    ahead = counts.select("class", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_ahead"))
    homes = _homes(counts, capacity)
    out = written.join(ahead, ["class", "part"]).join(F.broadcast(homes), "class")  # a row per class
    rank = F.col("_ahead") + F.col("local")
    in_full = rank < F.col("_full") * F.col("class")
    place = rank % F.col("class")
    return out.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        F.when(in_full, F.col("_first") + F.floor(rank / F.col("class"))).otherwise(F.col("_rest_sequence")).cast("long").alias("sequence_id"),
        (F.when(in_full, F.lit(0)).otherwise(F.col("_rest_offset")) + place * F.col("length")).cast("long").alias("offset"),
        "class")


def _homes(counts: DataFrame, capacity: int) -> DataFrame:
    """Per class: its first full sequence, their number, and where its unfilled rest goes.

    Collects a row per class: about twice the root of the capacity, whatever
    the corpus holds.
    """
    spark = counts.sparkSession
    totals = sorted(((r["class"], r["n"], r["length"]) for r in counts.groupBy("class").agg(
        F.sum("n").alias("n"), F.max("length").alias("length")).collect()))
    rows, first = [], 0
    for j, n, length in totals:
        rows.append([j, first, n // j, n % j * length])
        first += n // j
    open_sequences: list[list[int]] = []  # [id, used]
    homes = []
    for j, start, full, rest in sorted(rows, key=lambda r: -r[3]):
        home = next((s for s in open_sequences if s[1] + rest <= capacity), None) if rest else [0, 0]
        if home is None:
            open_sequences.append(home := [first + len(open_sequences), 0])
        homes.append((j, start, full, home[0], home[1]))
        home[1] += rest
    return spark.createDataFrame(homes, "class int, _first long, _full long, _rest_sequence long, _rest_offset long")
