import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from marginalia.functions.windows import running_sums


def test_running_sums_match_plain_window(spark):
    rnd = random.Random(7)
    rows = []
    oid = 0
    for cust in range(5):
        # customer 0 is "hot": most of the rows, many per day
        n = 400 if cust == 0 else 20
        for _ in range(n):
            oid += 1
            rows.append((cust, rnd.randint(0, 30), oid, rnd.choice([None, 1.5, 2.0, -3.25])))
    df = spark.createDataFrame(rows, "c int, d int, o int, v double")
    got = running_sums(df, ["c"], ["d", "o"], {"cum": "v"})
    w = Window.partitionBy("c").orderBy("d", "o").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("*", F.sum("v").over(w).alias("cum"))
    a = sorted((r.o, r.cum) for r in got.collect())
    b = sorted((r.o, r.cum) for r in want.collect())
    assert len(a) == len(b)
    for (o1, x), (o2, y) in zip(a, b):
        assert o1 == o2
        assert (x is None and y is None) or abs(x - y) < 1e-9


def test_a_huge_day_of_one_customer_is_split(spark, monkeypatch):
    """A third of the rows in one customer-day: the day falls into ranges of ids, and no window holds it whole."""
    from marginalia.functions import windows

    monkeypatch.setattr(windows, "BUCKET", 10)
    day = dt.date(2024, 1, 5)
    rows = [("hot", day, k, k % 7) for k in range(500)] + [("hot", dt.date(2024, 1, 1 + k), 1000 + k, 1) for k in range(4)]
    rows += [(f"c{k % 40}", dt.date(2024, 1, 1 + k % 9), 5000 + k, k) for k in range(600)] + [(None, day, 9000 + k, 2) for k in range(30)]
    df = spark.createDataFrame(rows, "who string, day date, id long, v long")
    got = windows.running_sums(df, ["who"], ["day", "id"], {"s": "v"}, first_bucket_as="first")
    want, firsts = {}, {}
    for who in {r[0] for r in rows}:
        total, own = 0, sorted((r for r in rows if r[0] == who), key=lambda r: (r[1], r[2]))
        firsts[who] = own[0][1]
        for r in own:
            total += r[3]
            want[r[2]] = total
    out = got.collect()
    assert {r.id: r.s for r in out} == want and {r.who: r["first"] for r in out} == firsts
    sizes = df.select(*[F.col("who"), *windows._buckets(df, ["day", "id"])]).groupBy("who", "_b0", "_b1").count().agg(F.max("count")).first()[0]
    assert sizes <= 10
