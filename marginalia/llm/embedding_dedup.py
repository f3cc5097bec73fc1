"""Near-duplicate vectors by an exact metric range join.

On unit vectors a cosine of ``c`` or more is a distance of ``r = sqrt(2 - 2c)``
or less.  The vectors of a label are dealt to blocks, and every two blocks meet
once, in rounds that send each vector once.  Where two blocks meet, pivots part
the rows: each is at home with its nearest pivot.  By the triangle inequality, a
vector within ``r`` of a vector at home with ``p`` is at most ``2r`` farther from
``p`` than from its own pivot, and at most ``r`` farther than the cell's radius;
only such vectors are compared with the cell's.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from marginalia.llm.common import clear_steps, slices, steps_written, write_shared
from marginalia.llm.components import connected_components


def slack(dims: int) -> float:
    """Room for rounding in the geometric bounds.

    A product of unit vectors is off by at most about ``dims`` units of rounding, and the root of
    2 - 2x turns an error e near zero into the root of 2e; a bound adds up to four such distances.
    """
    return 4 * math.sqrt(2 * (dims + 4) * np.finfo(np.float64).eps)


#: Bytes of vectors that a job sends, or each vector once where that is more; blocks of rows in a group's half at most;
#: rows found for each vector, beyond which they are summed.
SENT, SPAN, HELD = 128 << 20, 16, 6


def _units(x: np.ndarray) -> np.ndarray:
    """Rows of length one in double precision."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(1)[:, None]
    return x / np.sqrt((x * x).sum(1))[:, None]


def _matrix(raw: list[bytes], kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1)


def _kind(vectors: DataFrame) -> str:
    """How components are held: as they come where they are single floats, else as doubles."""
    element = getattr(vectors.select("embedding").schema[0].dataType, "elementType", None)
    return "f4" if isinstance(element, FloatType) else "f8"


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, key, space, raw): key names equal rows of (label, direction), space what may be compared; null for what links with nothing."""
    kind = _kind(vectors)

    def run(batches):
        for b in slices(batches):
            labels, column = b.column(1).to_pylist(), b.column(2)
            sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            values = column.flatten().to_numpy(zero_copy_only=False)  # null components as NaN
            begins = np.cumsum(sizes) - sizes
            keys, spaces, raws = ([None] * b.num_rows for _ in range(3))
            told = np.array([x is not None for x in labels])
            for size in np.unique(sizes[told & (sizes > 0)]):
                at = np.flatnonzero(told & (sizes == size))
                x = values[begins[at][:, None] + np.arange(size)].astype(kind)
                good = np.isfinite(x).all(1) & (x != 0).any(1)
                at, x = at[good], np.ascontiguousarray(x[good])
                for i, u, r in zip(at.tolist(), _units(x) if len(x) else x, x, strict=True):
                    keys[i] = hashlib.blake2b(repr((labels[i], int(size))).encode() + u.tobytes(), digest_size=16).digest()
                    spaces[i], raws[i] = f"{size}:{labels[i]}", r.tobytes()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.binary()), pa.array(spaces, pa.string()), pa.array(raws, pa.binary())],
                                             names=["vec_id", "key", "space", "raw"])

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
                          F.col("embedding").cast("array<float>" if kind == "f4" else "array<double>").alias("embedding"))
    return rows.mapInArrow(run, "vec_id long, key binary, space string, raw binary")


def choose_pivots(reps: DataFrame, most: int, kind: str = "f8") -> dict[str, np.ndarray]:
    """At most ``most`` pivots in all, as a (pivots x dimensions) matrix per space.

    The vectors with the smallest key digests: a sample that does not depend on the
    partitioning.  Spaces without a pivot get a single cell.
    """
    spread: dict[str, list] = {}
    for r in reps.orderBy("key").limit(most).collect():
        spread.setdefault(r["space"], []).append(bytes(r["raw"]))
    return {k: _units(_matrix(v, kind)) for k, v in spread.items()}


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (x @ pivots.T)))


def near_duplicates(vectors: DataFrame, min_cosine: float = 0.98, vectors_per_pivot: int = 2000, max_pivots: int = 256,
                    block: int = 1024) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors link when their labels are equal and not null, they have as many
    components, and their cosine in double precision is ``min_cosine`` or more.
    Null, empty, zero vectors and those with null or non-finite components link
    with nothing.  ``n_links`` counts the other rows linked directly, repeated
    rows included; ``component_id`` is the smallest vec_id reachable, itself
    included; ``kept`` marks that one.  vec_id is the row's identity (rows that
    share one share a component); an empty table gives no rows; other
    columns are ignored.

    Equal directions under one label are one row with a count before anything
    is compared, so copies cost a partial aggregate.  The number of
    pivots follows the number of vectors up to ``max_pivots``, which bounds the
    broadcast at ``max_pivots`` vectors.  A space of many vectors is dealt by
    hash to halves of at most ``SPAN`` times ``block`` rows; a group holds two of them and
    compares ``block`` rows with ``block`` rows at a time.  Halves i and j meet
    in the round (i + j) modulo their number, so a round sends each vector once,
    and a job's exchange, freed as soon as its findings are written, takes no
    more disk than the vectors, or ``SENT`` bytes, whatever their number.
    Written are a count per vector and group, and links to local roots, never
    the pairs; they are summed when they are more than ``HELD`` times the vectors.
    """
    spark = vectors.sparkSession
    kind = _kind(vectors)
    named_rows = distinct_vectors(vectors)
    rows = write_shared(named_rows.select("vec_id", "key"), "vectors")
    mark = steps_written()
    reps = named_rows.where("key is not null and vec_id is not null").groupBy("key").agg(
        F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("space").alias("space"), F.first("raw").alias("raw"))
    reps = write_shared(reps, "directions")
    n, size = reps.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("raw")), F.lit(0))).first()
    pivots = spark.sparkContext.broadcast(choose_pivots(reps, min(max_pivots, max(1, n // vectors_per_pivot)), kind))
    width = block * min(SPAN, max(1, n // (4 * spark.sparkContext.defaultParallelism * block)))
    # a row for each space of more than ``width`` vectors
    wide = [(x["space"], -(-x["n"] // width)) for x in reps.groupBy("space").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > width).collect()]
    halves = F.broadcast(spark.createDataFrame(wide, "space string, nb int"))
    dealt = reps.select("node", "copies", "space", "raw").join(halves, "space", "left").withColumn("nb", F.coalesce("nb", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), "nb").cast("int"))

    def compare(key, t):
        return _compare(t, key[1].as_py(), key[2].as_py(), pivots.value.get(key[0].as_py()), kind, min_cosine, block)

    found, held, links = None, 0, steps_written()
    rounds = max([nb for _, nb in wide], default=1)
    step = min(rounds, max(1, SENT // max(1, size)))
    for t in range(0, rounds, step):
        sent = dealt.where(F.col("nb") > t).withColumn("t", F.explode(F.sequence(F.lit(t), F.least(F.col("nb"), F.lit(t + step)) - 1)))
        sent = sent.withColumn("other", F.pmod(F.col("t") - F.col("own"), "nb"))
        sent = sent.select("node", "copies", "space", "raw", "own", F.least("own", "other").alias("b1"), F.greatest("own", "other").alias("b2"))
        part = write_shared(sent.groupBy("space", "b1", "b2").applyInArrow(compare, "node long, other long, n long"), "found")
        held += part.count()
        found = part if found is None else found.union(part)
        if held > HELD * n and t + step < rounds:
            roots = connected_components(_local_links(found)).where("node <> component")
            found = write_shared(_counts(found).selectExpr("node", "cast(null as long) as other", "n").union(
                roots.selectExpr("node", "component as other", "cast(null as long) as n")), "found")
            clear_steps(spark, links, keep=found)
            held = found.count()
    named = reps.select("key", "node", "copies").join(_counts(found), "node", "left").join(connected_components(_local_links(found)), "node", "left").select(
        "key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    named = write_shared(named, "named")
    clear_steps(spark, mark, keep=named)
    out = rows.join(named, "key", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def _counts(found: DataFrame) -> DataFrame:
    return found.where("n is not null").groupBy("node").agg(F.sum("n").alias("n"))


def _local_links(found: DataFrame) -> DataFrame:
    return found.where("other is not null").select(F.col("node").alias("u"), F.col("other").alias("v"))


def _linked(unit: np.ndarray, own: np.ndarray, b1: int, b2: int, pivots: np.ndarray | None, min_cosine: float, block: int):
    """Positions (i, j) of linked rows of the two halves, each pair once, those of ``block`` by ``block`` rows at a time."""
    same, dims = b1 == b2, unit.shape[1]
    r, room = math.sqrt(max(0.0, 2.0 - 2.0 * min_cosine)), slack(dims)
    dist = np.zeros((len(unit), 1)) if pivots is None else _distances(unit, pivots)
    home, near = dist.argmin(1), dist.min(1)
    rough = unit.astype(np.float32)
    error = (dims + 8) * float(np.finfo(np.float32).eps)  # a cosine of single floats is off by less
    first, second = np.flatnonzero(own == b1), np.flatnonzero(own == b2)
    for cell in np.unique(home[second]):
        here = second[home[second] == cell]
        d = dist[first, cell]
        there = first[(d <= near[here].max() + r + room) & (d <= near[first] + 2 * r + room)]
        if same:  # pairs of two cells meet in the smaller one
            there = np.concatenate([here, there[home[there] > cell]])
        for p in range(0, len(here), block):
            y = here[p : p + block]
            for q in range(p if same else 0, len(there), block):
                x = there[q : q + block]
                cosine = rough[x] @ rough[y].T
                i, j = np.nonzero(cosine >= min_cosine - error)
                if same and q == p:
                    i, j = i[i > j], j[i > j]
                sure = cosine[i, j] >= min_cosine + error
                doubt = np.flatnonzero(~sure)
                for k in range(0, len(doubt), 1 << 14):
                    at = doubt[k : k + (1 << 14)]
                    sure[at] = (unit[x[i[at]]] * unit[y[j[at]]]).sum(1) >= min_cosine
                if sure.any():
                    yield x[i[sure]], y[j[sure]]


def _compare(t: pa.Table, b1: int, b2: int, pivots: np.ndarray | None, kind: str, min_cosine: float, block: int) -> pa.Table:
    """Counts for the vectors of two halves, and links to local roots."""
    t = t.sort_by("node")
    node, copies, own = (t.column(c).to_numpy() for c in ("node", "copies", "own"))
    unit = _units(_matrix(t.column("raw").to_pylist(), kind))
    n, root = np.zeros(len(node), np.int64), np.arange(len(node))
    for i, j in _linked(unit, own, b1, b2, pivots, min_cosine, block):
        np.add.at(n, i, copies[j])
        np.add.at(n, j, copies[i])
        while True:  # the larger of two roots goes to the smaller until the linked have one
            a, b = root[i], root[j]
            if (a == b).all():
                break
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (root[root] != root).any():
                root = root[root]
    low = node[root]
    count, moved = n > 0, low != node
    nothing = np.full(len(node), None)
    return pa.table({"node": np.concatenate([node[count], node[moved]]),
                     "other": pa.array([*nothing[count], *low[moved].tolist()], pa.int64()),
                     "n": pa.array([*n[count].tolist(), *nothing[moved]], pa.int64())})
