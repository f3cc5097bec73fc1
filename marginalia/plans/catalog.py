"""Named queries: an operator applied to role inputs, plus its SQL oracle.

A ``Query`` carries
* ``build(spark, sf_dir) -> DataFrame``: the Spark plan (lazy),
* ``sql``: an independent DuckDB formulation over the same role CTEs, and
* ``spec``: the output columns with a value class, applied identically on both
  sides so results compare exactly (money to cents, ratios to 6 places,
  counts as bigint, day columns as DATE).

SQL fragments are composable: a body may name role CTEs (``r_*``) and model
CTEs (``m_*``); ``oracle_text`` pulls in what it needs, in dependency order.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.sources.roles import ROLE_SQL

SQL_MODELS: dict[str, str] = {}
QUERIES: dict[str, "Query"] = {}

_SPARK_TYPES = {"i": "bigint", "s": "string", "d": "date", "b": "boolean", "t": "timestamp"}
_SQL_TYPES = {"i": "BIGINT", "s": "VARCHAR", "d": "DATE", "b": "BOOLEAN", "t": "TIMESTAMP"}
_SCALES = {"m": 2, "f": 4, "r": 6}
#: Columns of a result that are rounded in place.
ROUNDED = 8


@dataclass
class Query:
    name: str
    build: Callable
    spec: str
    sql: str | None = None
    survey_id: str = ""

    @property
    def columns(self) -> list[tuple[str, str]]:
        out = []
        for tok in self.spec.split():
            name, kind = tok.rsplit(":", 1)
            out.append((name, kind))
        return out

    def run(self, spark, sf_dir: str) -> DataFrame:
        return normalize(self.build(spark, sf_dir), self.columns)

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        return oracle_text(self.sql, self.columns)


def normalize(df: DataFrame, columns) -> DataFrame:
    """Final projection with the value classes of the spec.

    More than ``ROUNDED`` roundings in one generated method pass the 8,000 bytes up to which the JVM compiles it,
    and each row is then interpreted; so the columns of a wide result are rounded as the elements of one array a class.
    """
    exprs, rounded = [], {}
    scaled = [(name, kind) for name, kind in columns if kind in _SCALES]
    if len(scaled) > ROUNDED:
        for of in dict(map(reversed, scaled)):
            names = [name for name, kind in scaled if kind == of]
            values = F.transform(F.array(*[F.col(f"`{n}`").cast("double") for n in names]), lambda v: _snap(v, _SCALES[of]))
            rounded |= {n: values[i] for i, n in enumerate(names)}
    for name, kind in columns:
        col = F.col(f"`{name}`")
        if name in rounded:
            exprs.append(rounded[name].alias(name))
        elif kind in _SCALES:
            exprs.append(_snap(col.cast("double"), _SCALES[kind]).alias(name))
        elif kind == "a":  # arrays are compared as sorted, joined text
            exprs.append(F.array_join(F.array_sort(col), "|").alias(name))
        else:
            exprs.append(col.cast(_SPARK_TYPES[kind]).alias(name))
    return df.select(*exprs)


def _snap(col, scale: int):
    """Round in floor steps (1e-9 for small values, then 1e-6, then ``scale``).

    Written with floor on IEEE doubles so that Spark and DuckDB compute the
    very same function (their ``round`` differ on binary ties); each finer
    step removes summation-order noise, so an exact decimal tie at a coarser
    step is seen identically by both engines before that step picks a digit.
    """
    nine = F.when(F.abs(col) < 1000000.0, F.floor(col * 1000000000.0 + 0.5) / 1000000000.0).otherwise(col)
    six = F.floor(nine * 1000000.0 + 0.5) / 1000000.0
    if scale == 6:
        return six
    k = float(10 ** scale)
    return F.floor(six * k + 0.5) / k


def _sql_snap(expr: str, scale: int) -> str:
    nine = (f"(case when abs({expr}) < 1000000.0 then floor({expr} * 1000000000.0 + 0.5) / 1000000000.0 "
            f"else {expr} end)")
    six = f"(floor({nine} * 1000000.0 + 0.5) / 1000000.0)"
    if scale == 6:
        return six
    k = f"{float(10 ** scale)}"
    return f"(floor({six} * {k} + 0.5) / {k})"


def _sql_col(name: str, kind: str) -> str:
    q = f'"{name}"'
    if kind in _SCALES:
        return f"cast({_sql_snap(f'cast({q} as DOUBLE)', _SCALES[kind])} as DOUBLE) as {q}"
    if kind == "a":
        return f"array_to_string(list_sort({q}), '|') as {q}"
    return f"cast({q} as {_SQL_TYPES[kind]}) as {q}"


_REF = re.compile(r"\b([rm]_[a-z0-9_]+)\b")


def _deps(text: str, seen: list[str]):
    for ref in _REF.findall(text):
        if ref in seen:
            continue
        body = ROLE_SQL.get(ref) if ref.startswith("r_") else SQL_MODELS.get(ref)
        if body is None:
            continue
        _deps(body, seen)
        if ref not in seen:
            seen.append(ref)


def oracle_text(body: str, columns) -> str:
    order: list[str] = []
    _deps(body, order)
    ctes = []
    for ref in order:
        text = ROLE_SQL[ref] if ref.startswith("r_") else SQL_MODELS[ref]
        ctes.append(f"{ref} as ({text}\n)")
    ctes.append(f"__q as ({body}\n)")
    cols = ", ".join(_sql_col(n, k) for n, k in columns)
    return "with " + ",\n".join(ctes) + f"\nselect {cols} from __q"


def sql_model(name: str, text: str) -> None:
    SQL_MODELS[name] = text


def register(name: str, spec: str, sql: str | None = None, survey_id: str = ""):
    def deco(fn):
        QUERIES[name] = Query(name=name, build=fn, spec=spec, sql=sql, survey_id=survey_id)
        return fn
    return deco
