"""Column contracts: what a frame must have, in which order and type (A-02, A-03, S-01..S-66).

A contract is text, ``name:type ...`` in order.  Everything here is decided from schemas, before any row is read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def columns(contract: str) -> list[tuple[str, str]]:
    return [tuple(x.rsplit(":", 1)) for x in contract.split()]


def differences(df: DataFrame, contract: str, key: tuple = ()) -> list[str]:
    """What separates a frame from its contract: missing, unknown, of another type, out of order, a key that is no column."""
    want, have = columns(contract), {f.name: f.dataType.simpleString() for f in df.schema.fields}
    names = [n for n, _ in want]
    out = [f"missing: {n}" for n in names if n not in have] + [f"unknown: {n}" for n in have if n not in names]
    out += [f"type: {n} is {have[n]}, not {t}" for n, t in want if n in have and have[n] != t]
    common = [n for n in df.columns if n in names]
    if common != [n for n in names if n in have]:
        out.append(f"order: {' '.join(common)}")
    return out + [f"key: {k}" for k in key if k not in names]


def align(df: DataFrame, contract: str, padded: dict[str, str] | None = None, dropped: dict[str, str] | None = None) -> DataFrame:
    """The frame's columns in the contract's order and types.

    A column that the frame lacks is NULL where ``padded`` gives a reason for it, and one that the
    contract does not know is left out where ``dropped`` does; any other is an error, so a feed that changes is noticed.
    """
    padded, dropped, want = padded or {}, dropped or {}, columns(contract)
    names = {n for n, _ in want}
    wrong = [f"missing: {n}" for n in names if n not in df.columns and n not in padded] + [f"unknown: {n}" for n in df.columns if n not in names and n not in dropped]
    wrong += [f"padded, but there: {n}" for n in padded if n in df.columns]
    if wrong:
        raise ValueError("; ".join(sorted(wrong)))
    return df.select(*[(F.col(f"`{n}`") if n in df.columns else F.lit(None)).cast(t).alias(n) for n, t in want])


def union_aligned(feeds: list[tuple], contract: str) -> DataFrame:
    """Feeds (frame, padded, dropped) one below the other in the contract's layout; rows are all kept."""
    return reduce(lambda a, b: a.union(b), [align(df, contract, *how) for df, *how in feeds])
