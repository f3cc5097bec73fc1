"""Helpers shared by the operators of this package."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.session import checkpoint_dir

#: Frees a written step's shuffle files as soon as the step has been written.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Folders that this session has written and not cleared.
_WRITTEN: list[str] = []


def steps_written() -> int:
    """How many steps the session holds; a mark for :func:`clear_steps`."""
    return len(_WRITTEN)


def clear_steps(spark: SparkSession, since: int = 0, keep: DataFrame | None = None) -> int:
    """Delete the steps written after a mark, but those that ``keep`` reads; how many went.

    For a caller that has written what it needs: results that are still lazy read their steps.
    After a failure the folders stay until this is called or the owner of ``spark.checkpoint.dir`` clears it.
    """
    reads = "".join(keep.inputFiles()) if keep is not None else ""
    gone = [p for p in _WRITTEN[since:] if p.rpartition("/")[2] not in reads]
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in gone:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
        _WRITTEN.remove(p)
    return len(gone)


def write_shared(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage: what follows rereads files that every executor
    sees, so a lost executor costs its running tasks and no earlier step.
    The folder stays until :func:`clear_steps` deletes it.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Let the executors import this library, where it is not installed there.

    Spark serves the zipped code (no data) from the driver, once a session.
    """
    sc, name = spark.sparkContext, "marginalia_code.zip"
    if any(p.endswith(name) for p in sc._python_includes):
        return
    package = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="marginalia-")) / name
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(path))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, under names no other column can shadow."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def place_of(df: DataFrame, name: str) -> int:
    """Where the column is that Spark takes for ``name``: the one so written, else the one that differs in case."""
    names = df.columns
    return names.index(name) if name in names else [c.lower() for c in names].index(name)


def slices(batches: Iterator[pa.RecordBatch], max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows of about ``max_bytes`` (one row at least).

    Bounds what a task holds at once, whatever the rows' sizes are.
    """
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        step = max(1, int(n * max_bytes / max(batch.nbytes, 1)))
        for at in range(0, n, step):
            part = batch.slice(at, step)
            if part.num_rows > 1 and part.get_total_buffer_size() and part.nbytes > 2 * max_bytes:
                for k in range(part.num_rows):
                    yield part.slice(k, 1)
            else:
                yield part


def crc_part(col_name: str, parts: int) -> "F.Column":
    """The documented fold: crc32 of the id as text, modulo ``parts``."""
    return F.crc32(F.col(col_name).cast("string").cast("binary")) % parts
