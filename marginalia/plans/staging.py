"""Every staging contract over raw text derived from parts (S-01..S-66), and the published aliases (V-08..V-30).

A raw table has the columns that a contract reads, as text like the landed feeds', each derived from
the part's size, price or brand by its kind and its place; the SQL states the typed value directly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from marginalia.functions import sql_round_half_away
from marginalia.operators import published as pub
from marginalia.operators import staging as st
from marginalia.plans.catalog import QUERIES, oracle_text, register
from marginalia.sources import roles as R

# columns that contracts pass on as they come and that come as numbers
_NUMBERS = {"impressions", "clicks", "spend", "conversions", "conversion_value", "views", "estimated_minutes_watched", "avg_view_duration_seconds",
            "avg_view_percentage", "likes", "comments", "shares", "subscribers_gained", "subscribers_lost"}
# raw columns of computed entries: output -> (raw columns with their kind, value in SQL over them)
_COMPUTED = {
    "avg_view_duration_minutes": ({}, sql_round_half_away("avg_view_duration_seconds / 60.0"), "m"),
    "avg_view_percentage": ({"avg_view_percentage": "number"}, "avg_view_percentage", "m"),
    "net_subscribers": ({}, "subscribers_gained - subscribers_lost", "m"),
    "published_at": ({"published_at": "timestamp"}, "published_at", "t"),
    "published_date": ({"published_at": "timestamp"}, "cast(published_at as date)", "d"),
    "target_cpa": ({"target_cpa_micros": "bigint"}, "target_cpa_micros / 1000000.0", "r"),
    "maximize_conversions_target_cpa": ({"maximize_conversions_target_cpa_micros": "bigint"}, "maximize_conversions_target_cpa_micros / 1000000.0", "r"),
}
_RATIOS = {"ctr": ("clicks", "impressions"), "cpc": ("cost", "clicks"), "acos": ("cost", "sales"), "roas": ("sales", "cost")}
_PMAX = {"roas": ("conversion_value", "spend"), "cpa": ("spend", "conversions")}
_KIND = {"bigint": "i", "double": "m", st.MONEY: "m", "date": "d", "timestamp": "t", "boolean": "b", "string": "s", "text": "s", "number": "m", "load": "i"}


def _kind(name: str, kind: str | None) -> str:
    return "load" if name == "_loaded_at" else kind or ("number" if name in _NUMBERS else "text")


def _raw(kind: str, j: int):
    """The raw value of a part in the ``j``-th column of its table: text, but for numbers that come as such."""
    size, price = F.col("p_size"), (R.cents("p_retailprice") + j * 100) / 100.0
    if kind == "load":
        return F.col("p_partkey")
    if kind == "number":
        return price
    if kind == "bigint":
        return (size * (j + 2) + j).cast("string")
    if kind in ("double", st.MONEY):
        return F.format_string("%.2f", price)
    if kind == "boolean":
        return F.when(size % 2 == 0, "true").otherwise("false")
    if kind in ("date", "timestamp"):
        day = F.date_add(F.lit("2024-01-01").cast("date"), size.cast("int")).cast("string")
        return day if kind == "date" else F.concat(day, F.lit(" 03:04:05"))
    return F.concat(F.col("p_brand"), F.lit(f"-{j}"))


def _typed(kind: str, j: int) -> str:
    price = f"(cast(round(p_retailprice * 100) as bigint) + {j * 100}) / 100.0"
    return {"load": "p_partkey", "number": price, "bigint": f"cast(p_size * {j + 2} + {j} as bigint)", "double": price, st.MONEY: price, "boolean": "p_size % 2 = 0",
            "date": "date '2024-01-01' + cast(p_size as integer)", "timestamp": "cast(date '2024-01-01' + cast(p_size as integer) as timestamp) + interval '3:04:05'"
            }.get(kind, f"p_brand || '-{j}'")


def _register(name: str) -> None:
    spec = st.SPECS[name]
    raw: dict[str, str] = {}
    for out, src, kind in spec["cols"]:
        if callable(src):
            raw |= {c: k for c, k in _COMPUTED.get(out, ({},))[0].items()}
        else:
            raw.setdefault(src or out, _kind(src or out, kind))
    place = {c: j for j, c in enumerate(sorted(raw))}
    cols, kinds = [], {}
    for out, src, kind in spec["cols"]:
        if out == "ad_product":
            product = name.split("__")[1][:2]
            cols.append(("'SPONSORED_" + {"sp": "PRODUCTS", "sb": "BRANDS", "sd": "DISPLAY"}[product] + "'", out))
            kinds[out] = "s"
        elif callable(src):
            cols.append((_COMPUTED[out][1], out))
            kinds[out] = _COMPUTED[out][2]
        else:
            k = _kind(src or out, kind)
            cast = f'cast("{src or out}" as date)' if kind == "date" and raw[src or out] == "timestamp" else f'"{src or out}"'
            cols.append((cast, out))
            kinds[out] = _KIND[k]
    sql = f"""
with typed as (select {', '.join(f'{_typed(k, place[c])} as "{c}"' for c, k in raw.items())} from part),
staged as (select {', '.join(f'{e} as "{o}"' for e, o in cols)} from typed)
select * from staged"""
    if spec.get("dedup"):
        how, keys, order = spec["dedup"]
        rank = "row_number" if how == "latest" else "dense_rank"
        sql += f" qualify {rank}() over (partition by {', '.join(keys)} order by {order} desc) = 1"
    if name == "amazon__ad_spend":
        kinds.pop("_loaded_at")
    ratios = _RATIOS if name.startswith("amazon_ads__") else _PMAX if name == "google_ads__pmax_insights" else {}
    if ratios:
        sql = f"select *, {', '.join(f'{a} / nullif({b}, 0) as {out}' for out, (a, b) in ratios.items())} from ({sql})"
        kinds |= {out: "r" for out in ratios}

    @register(f"staged_{name}", " ".join(f"{c}:{k}" for c, k in kinds.items()), sql, _IDS[name])
    def build(spark, d):
        part = R.table(spark, d, "part")
        return st.stage(part.select(*[_raw(k, place[c]).alias(c) for c, k in raw.items()]), name)


# the inventory numbers the contracts by name; the order cleaner, S-04, is a query of its own
_IDS = {n: f"S-{k:02d}" for k, n in enumerate(sorted([*st.SPECS, "amazon__orders_clean"]), 1)}
for _name in st.SPECS:
    _register(_name)


def _published() -> dict[str, str]:
    return {alias: model for alias, model in pub.ALIASES.items() if model in QUERIES and QUERIES[model].sql}


def _alias_sql() -> str:
    parts = []
    for alias, model in _published().items():
        q = QUERIES[model]
        parts.append(f"select '{alias}' as alias, (select count(*) from ({oracle_text(q.sql, q.columns)})) as n_rows, '{' '.join(c for c, _ in q.columns)}' as columns")
    return "\nunion all ".join(parts)


@register("published_aliases", "alias:s n_rows:i columns:s", _alias_sql(), "V-08")
def q_aliases(spark, d):
    """Every model that a query builds is published under its alias and read back through it."""
    models = {model: QUERIES[model].run(spark, d) for model in _published().values()}
    views = [spark.table(a).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(a).alias("alias"), "n_rows", F.lit(" ".join(spark.table(a).columns)).alias("columns"))
             for a in pub.publish(models)]
    return reduce(lambda a, b: a.union(b), views)
