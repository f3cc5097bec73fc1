"""URL filtering with a sorted digest array.

Rules (host, path, verdict) become one file: 64-bit xxhash keys in ascending
order beside the full strings.  Tasks map the file into memory, so the worker
processes of a machine share its pages, look a batch of candidate strings up
with one vectorised binary search, and compare the stored string wherever a
key is found, so a collision of keys decides nothing.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.llm.common import slices, write_shared

ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?`` or ``#``, A-Z lower-cased; empty if there is none."""
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; empty if there is none."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def entries(rules: DataFrame) -> DataFrame:
    """(entry, verdict, lengths): a row for each rule and each rule's host.

    ``entry`` is host and path as one string, ``verdict`` null for a host without a
    rule of its own, ``lengths`` the distinct byte lengths of its host's other
    rule paths (empty for rules with a path), by which a host says what to look for next.
    Rules with a null host or verdict, an empty host, or a path that is neither empty nor
    begins with ``/`` fit nothing and are left out; a null path is empty.
    Of rules with one host and path, ``block`` outweighs ``allow``.
    """
    r = rules.select(F.translate(F.col("host").cast("string"), _UPPER, _LOWER).alias("host"),
                     F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"), F.col("verdict").cast("string").alias("verdict"))
    r = r.where((F.col("host") != "") & F.col("verdict").isin(ALLOW, BLOCK) & ((F.col("path") == "") | F.col("path").startswith("/")))
    r = r.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    hosts = r.groupBy(F.col("host").alias("entry")).agg(
        F.max(F.when(F.col("path") == "", F.col("verdict"))).alias("verdict"),
        F.sort_array(F.collect_set(F.when(F.col("path") != "", F.octet_length("path")))).alias("lengths"))
    paths = r.where(F.col("path") != "").select(F.concat("host", "path").alias("entry"), "verdict", F.array().cast("array<int>").alias("lengths"))
    return hosts.unionByName(paths)


def _write_array(rows, path: str) -> None:
    """The file: counts, then keys, string ends, verdicts, ends of the length lists, lengths, strings."""
    import xxhash

    rows = sorted((xxhash.xxh64_intdigest(e := r["entry"].encode()), e, r["verdict"], r["lengths"]) for r in rows)
    strings, lengths = [e for _, e, _, _ in rows], [x for r in rows for x in r[3]]
    with open(path, "wb") as f:
        f.write(np.array([len(rows), len(lengths)], np.int64).tobytes())
        f.write(np.array([k for k, *_ in rows], np.uint64).tobytes())
        f.write(np.cumsum([0, *map(len, strings)], dtype=np.int64).tobytes())
        f.write(np.cumsum([0, *(len(r[3]) for r in rows)], dtype=np.int64).tobytes())
        f.write(np.array(lengths, np.int32).tobytes())
        f.write(bytes({None: 0, ALLOW: 1, BLOCK: 2}[r[2]] for r in rows))
        f.write(b"".join(strings))


class DigestArray:
    """The memory-mapped file."""

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        n, m = map(int, raw[:16].view(np.int64))
        at = np.cumsum([16, 8 * n, 8 * (n + 1), 8 * (n + 1), 4 * m, n])
        self.keys = raw[at[0] : at[1]].view(np.uint64)
        self.ends, self.length_ends = raw[at[1] : at[2]].view(np.int64), raw[at[2] : at[3]].view(np.int64)
        self.lengths = raw[at[3] : at[4]].view(np.int32)
        self.verdicts, self.strings = raw[at[4] : at[5]], raw[at[5] :]

    def probe(self, candidates: list[bytes], digest=None) -> np.ndarray:
        """The index of each candidate, -1 where it is not stored."""
        import xxhash

        digest = digest or xxhash.xxh64_intdigest
        keys = np.fromiter(map(digest, candidates), np.uint64, len(candidates))
        left, right = np.searchsorted(self.keys, keys), np.searchsorted(self.keys, keys, "right")
        out = np.full(len(candidates), -1, np.int64)
        for k in np.flatnonzero(right > left):  # keys that are stored: the strings decide
            for i in range(left[k], right[k]):
                if self.strings[self.ends[i] : self.ends[i + 1]].tobytes() == candidates[k]:
                    out[k] = i
        return out

    def path_lengths(self, i: int) -> list[int]:
        return self.lengths[self.length_ends[i] : self.length_ends[i + 1]].tolist()


def host_suffixes(host: bytes, most: int) -> list[bytes]:
    """The host and its parent domains of ``most`` bytes at most, longest first."""
    out = [host] if 0 < len(host) <= most else []
    at = host.find(b".", max(0, len(host) - most - 1))
    while at >= 0:
        if at + 1 < len(host):
            out.append(host[at + 1 :])
        at = host.find(b".", at + 1)
    return out


def longest_rules(array: DigestArray, hosts: list[bytes], paths: list[bytes], most: int) -> list[int]:
    """For each url the index of its longest fitting rule, -1 if none fits."""
    known = list(dict.fromkeys(s for h in dict.fromkeys(hosts) for s in host_suffixes(h, most)))
    place = {s: int(i) for s, i in zip(known, array.probe(known), strict=True) if i >= 0}
    mine, asked = [], []
    for h, p in zip(hosts, paths, strict=True):
        own = [(s, place[s]) for s in host_suffixes(h, most) if s in place]
        mine.append([i for _, i in own if array.verdicts[i]])
        asked.append([s + p[:n] for s, i in own for n in array.path_lengths(i) if n <= len(p)])
    flat = iter(array.probe([c for cs in asked for c in cs]))
    out = []
    for own, cs in zip(mine, asked, strict=True):
        fits = own + [int(i) for i in (next(flat) for _ in cs) if i >= 0]
        out.append(max(fits, key=lambda i: int(array.ends[i + 1] - array.ends[i]), default=-1))
    return out


@lru_cache(maxsize=4)
def _opened(name: str) -> DigestArray:
    return DigestArray(SparkFiles.get(name))


def judge(pages: DataFrame, rules: DataFrame, default: str = ALLOW, max_bytes: int = 256 << 20) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every page.

    A rule fits its host and all subdomains where the url's path starts with the
    rule's.  The longest fitting rule (host and path counted together, in bytes; they
    are all ends of one host with beginnings of one path, and of two of one length the one with the longer
    host wins) gives ``rule`` and ``verdict``; where none fits, ``rule`` is null and the
    verdict ``default``: the array does not hold the url.  Null urls and urls
    without ``://`` have an empty host and path, which no rule fits.  Every row is judged,
    repeated ones and null ids too; an empty table gives no rows; no rules, all ``default``; other columns are ignored.
    Long urls cost no more than their length: only beginnings as long as some rule path of the host are tried.

    Rules that take at most ``max_bytes`` as a file are written by the driver, one file that Spark sends
    to each executor once.  Larger lists stay distributed and meet the distinct urls in joins on the same keys and strings.
    """
    spark = pages.sparkSession
    url = F.col("url").cast("string")
    urls = pages.select(F.col("page_id").alias("page_id"), url_host(url).alias("host"), url_path(url).alias("path"))
    stored = write_shared(entries(rules), "url-rules")
    size = stored.agg(F.sum(F.octet_length("entry") + 4 * F.size("lengths") + 25), F.max(F.when(~F.col("entry").contains("/"), F.octet_length("entry")))).first()
    most = size[1] or 0
    if (size[0] or 0) > max_bytes:
        return _judge_by_join(urls, stored, default, most)
    name = f"url-rules-{uuid.uuid4().hex}"
    path = Path(tempfile.mkdtemp(prefix="marginalia-")) / name
    _write_array(stored.collect(), str(path))
    spark.sparkContext.addFile(str(path))

    def run(batches):
        array = _opened(name)
        for b in slices(batches):
            hosts, paths = ([x.encode() for x in b.column(k).to_pylist()] for k in (1, 2))
            best = longest_rules(array, hosts, paths, most)
            rule = [array.strings[array.ends[i] : array.ends[i + 1]].tobytes().decode() if i >= 0 else None for i in best]
            verdict = [(ALLOW, BLOCK)[array.verdicts[i] - 1] if i >= 0 else default for i in best]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())], names=["page_id", "host", "path", "rule", "verdict"])

    kind = urls.schema["page_id"].dataType.simpleString()
    return urls.mapInArrow(run, f"page_id {kind}, host string, path string, rule string, verdict string")


def _judge_by_join(urls: DataFrame, stored: DataFrame, default: str, most: int) -> DataFrame:
    """The same judgement for a list too large to send: the distinct urls' candidates join the entries."""
    keyed = stored.select(F.xxhash64("entry").alias("_key"), "entry", F.col("verdict").alias("_v"), "lengths")
    seen = urls.select("host", "path").distinct()
    tail = F.right(F.col("host"), F.lit(most + 1))  # no longer domain has a rule
    labels = F.split(tail, r"\.")
    labels = F.when(F.char_length("host") > most + 1, F.slice(labels, F.lit(2), F.size(labels))).otherwise(labels)  # not a label that is cut
    suffix = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."))
    suffix = F.when(F.size(labels) > 0, suffix)
    tried = seen.select("host").distinct().select("host", F.explode(suffix).alias("entry")).withColumn("_key", F.xxhash64("entry"))
    hosts = tried.join(keyed, ["_key", "entry"]).select("host", F.col("entry").alias("_domain"), "_v", "lengths")
    fits = seen.join(hosts, "host")
    raw = F.col("path").cast("binary")
    asked = fits.select("host", "path", F.explode(F.filter("lengths", lambda n: n <= F.octet_length("path"))).alias("_n"), "_domain").select(
        "host", "path", F.concat(F.col("_domain").cast("binary"), F.substring(raw, F.lit(1), F.col("_n"))).cast("string").alias("entry"))
    found = asked.withColumn("_key", F.xxhash64("entry")).join(keyed, ["_key", "entry"]).select("host", "path", "entry", "_v")
    own = fits.where(F.col("_v").isNotNull()).select("host", "path", F.col("_domain").alias("entry"), "_v")
    rank = F.struct(F.octet_length("entry"), F.octet_length(F.substring_index("entry", "/", 1)))
    best = found.unionByName(own).groupBy("host", "path").agg(F.max_by(F.struct("entry", "_v"), rank).alias("_best"))
    return urls.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("_best.entry").alias("rule"), F.coalesce("_best._v", F.lit(default)).alias("verdict"))
