"""Tables rewritten by partition (I-05, I-08, T-06..T-16).

A table is a folder with ``data/_v=<version>/_p=<partition>`` folders and a
``manifest``: rows (version, part, folder, digest) that say which partitions a
version replaces.  A commit first writes the partitions it touches under its own version and then
appends one small manifest file, so

* a batch costs what it touches: partitions without a row in it are neither read nor written;
* a version is visible when its manifest rows are: a write that fails before leaves the table as it was;
* a version that is already committed is not written again, so a replayed batch changes nothing;
* every older version stays readable until its folders are cleared.

One writer commits at a time.  Nothing here lists or moves files by itself; what the driver
holds is names of partitions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.sources.merge import merge_upsert

MANIFEST = "version bigint, part string, folder string, digest string"


def token(part: Column) -> Column:
    """A partition value as a folder name; values that differ in other characters only share a folder."""
    return F.coalesce(F.regexp_replace(part.cast("string"), "[^A-Za-z0-9.-]", "_"), F.lit("null"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """All commits of a table; empty if there is none."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def state(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(part, version, folder, digest): the partitions of a version, the newest by default."""
    m = manifest(spark, path)
    if version is not None:
        m = m.where(F.col("version") <= version)
    newest = m.groupBy("part").agg(F.max(F.struct("version", "folder", "digest")).alias("x"))
    return newest.select("part", "x.version", "x.folder", "x.digest").where(F.col("folder").isNotNull())


def versions(spark: SparkSession, path: str) -> list[int]:
    """The committed versions."""
    return sorted(r["version"] for r in manifest(spark, path).select("version").distinct().collect())


def read_table(spark: SparkSession, path: str, version: int | None = None, parts: list[str] | None = None) -> DataFrame | None:
    """The rows of a version, or of some of its partitions; None if there are none.  Columns that a partition lacks are NULL."""
    s = state(spark, path, version)
    if parts is not None:
        s = s.where(F.col("part").isin(parts)) if len(parts) < 1000 else s.join(spark.createDataFrame([(p,) for p in parts], "part string"), "part")
    folders = sorted(r["folder"] for r in s.select("folder").collect())
    if not folders:
        return None
    return spark.read.option("mergeSchema", "true").option("basePath", f"{path}/data").parquet(*folders).drop("_v", "_p")


def _folder(path: str, version: int, part: str) -> str:
    return f"{path}/data/_v={version}/_p={part}"


def _commit(spark: SparkSession, path: str, version: int, rows: list[tuple]) -> None:
    spark.createDataFrame([(version, *r) for r in rows], MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifest")


def merge_partitions(batch: DataFrame, path: str, keys: list[str], part: Column, version: int, *, order_cols: list[str] | None = None) -> list[str]:
    """I-05: merge a batch by key into the partitions it touches; the partitions rewritten.

    ``part`` must not change with a row of a key (a hash of the key, the day an order was placed); a
    key that moves leaves its old row behind.  Newest wins as in :func:`merge_upsert`.
    """
    spark = batch.sparkSession
    if version in versions(spark, path):
        return []
    b = batch.withColumn("_p", token(part))
    touched = sorted(r["_p"] for r in b.select("_p").distinct().collect())
    if not touched:
        return []
    old = read_table(spark, path, version - 1, touched)
    old = b.limit(0) if old is None else old.withColumn("_p", token(part))
    merged = merge_upsert(old, b, keys, order_cols=order_cols)
    merged.write.mode("overwrite").partitionBy("_p").parquet(f"{path}/data/_v={version}")
    _commit(spark, path, version, [(p, _folder(path, version, p), None) for p in touched])
    return touched


def digests(df: DataFrame, part: Column, name: str) -> DataFrame:
    """(part, digest): count and sum of the rows' hashes, whatever their order; one partial aggregate."""
    h = F.xxhash64(*[F.col(c) for c in df.columns]).cast("decimal(38,0)")
    return df.groupBy(token(part).alias("part")).agg(F.concat_ws(":", F.lit(name), F.count(F.lit(1)), F.sum(h)).alias("digest"))


def refresh(path: str, sources: dict[str, tuple[DataFrame, Column]], build: Callable[..., DataFrame], part: Column, version: int,
            spark: SparkSession) -> list[str]:
    """T-06..T-16: bring a mart up to date by rewriting the partitions whose sources have changed; the partitions rewritten.

    ``sources`` maps an argument of ``build`` to a frame and the column that says which partition of the mart its
    rows go to; ``part`` is that value on the mart's rows.  Beside every partition stand the
    digests of its sources' rows.  Those that differ now, or are new, are built from their own
    source rows and replaced; those without source rows any more are dropped.
    """
    if version in versions(spark, path):
        return []
    now = None
    for name, (df, by) in sources.items():
        d = digests(df, by, name)
        now = d if now is None else now.unionByName(d)
    now = now.groupBy("part").agg(F.array_join(F.sort_array(F.collect_list("digest")), " ").alias("digest"))
    old = state(spark, path).select("part", F.col("digest").alias("was"))
    diff = now.join(old, "part", "full").where(~F.col("digest").eqNullSafe(F.col("was"))).collect()  # a row for each partition that changed
    changed = {r["part"]: r["digest"] for r in diff if r["digest"] is not None}
    gone = [r["part"] for r in diff if r["digest"] is None]
    if not diff:
        return []
    made: set[str] = set()
    if changed:
        wanted = spark.createDataFrame([(p,) for p in changed], "_p string")
        cut = {name: df.withColumn("_p", token(by)).join(F.broadcast(wanted), "_p", "left_semi").drop("_p") for name, (df, by) in sources.items()}
        mart = build(**cut).withColumn("_p", token(part)).join(F.broadcast(wanted), "_p", "left_semi")
        mart.write.mode("overwrite").partitionBy("_p").parquet(f"{path}/data/_v={version}")
        # what was written says which partitions have rows; asking the mart again would build it a second time
        written = spark.read.schema("_p string").parquet(f"{path}/data/_v={version}")
        made = {r["_p"] for r in written.select("_p").distinct().collect()}
    rows = [(p, _folder(path, version, p) if p in made else None, digest) for p, digest in changed.items()]
    _commit(spark, path, version, rows + [(p, None, None) for p in gone])
    return sorted([*changed, *gone])


def obsolete(spark: SparkSession, path: str, keep: int = 1) -> DataFrame:
    """(folder): folders that none of the last ``keep`` versions reads; the owner of the storage may clear them."""
    vs = versions(spark, path)[-keep:]
    live = state(spark, path, vs[0]).select("folder") if vs else spark.createDataFrame([], "folder string")
    for v in vs[1:]:
        live = live.union(state(spark, path, v).select("folder"))
    return manifest(spark, path).where(F.col("folder").isNotNull()).select("folder").distinct().join(live.distinct(), "folder", "left_anti")
