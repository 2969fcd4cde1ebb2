"""Exact 40-digit arithmetic against Python integers and fractions."""

from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

from pyspark.sql import functions as F

from chainloom.functions import wide


def numbers():
    rng = random.Random(9)
    out = [0, 1, -1, 9, 10**18, 10**18 - 1, -(10**36), 10**40 - 1, -(10**40 - 1), 10**39, 10**38, 5 * 10**17]
    return out + [rng.choice((1, -1)) * rng.randrange(10 ** rng.randint(1, 40)) for _ in range(120)]


def test_quotient_and_product(spark):
    rng = random.Random(10)
    prices = ["0", "1", "0.000000000000000001", "99999999999999999999.999999999999999999", "0.5", "-2.25", "12345.678901234567890123"]
    factors = [1, 2, 3, 7, 10**6, 10**18, 999_999_999_999_999_989]
    rows = [(str(n), str(rng.choice(factors)), rng.choice(prices)) for n in numbers() for _ in range(3)]
    df = spark.createDataFrame(rows, "a string, f string, p string").repartition(4)
    shown = df.withColumn("d", wide.quotient_text(F.col("a"), F.col("f").cast("decimal(38,0)")))
    got = shown.withColumn("v", wide.product_text(F.col("d"), F.col("p").cast("decimal(38,18)"))).collect()
    assert len(got) == len(rows)
    with localcontext() as c:
        c.prec = 200
        for r in got:
            d = (Decimal(r.a) / Decimal(r.f)).quantize(Decimal(1).scaleb(-18), ROUND_HALF_UP)
            assert Decimal(r.d) == d and len(r.d.split(".")[1]) == 18, r
            v = (d * Decimal(r.p)).quantize(Decimal(1).scaleb(-12), ROUND_HALF_UP)
            assert Decimal(r.v) == v and len(r.v.split(".")[1]) == 12, r
            assert not r.d.startswith("00") and r.d != "-0." + "0" * 18
    none = spark.createDataFrame([("1", "0"), ("1", None), (None, "1"), ("1", str(10**19))], "a string, f string")
    assert none.select(wide.quotient_text(F.col("a"), F.col("f").cast("decimal(38,0)")).alias("d")).where("d is not null").count() == 0


def test_whole_text_order_and_difference(spark):
    cases = {"+007": "7", "-0": "0", "000": "0", "-012": "-12", "1" * 40: "1" * 40, "0" * 9 + "1" * 40: "1" * 40, "1" * 41: None, "": None, "1.0": None, "-": None, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.w for r in df.withColumn("w", wide.whole_text(F.col("t"))).collect()} == cases
    rng = random.Random(11)
    ns = numbers()
    pairs = [(str(a), str(rng.choice(ns))) for a in ns] + [(str(n), str(n)) for n in ns[:20]]
    df = spark.createDataFrame(pairs, "a string, b string").repartition(4)
    for r in df.withColumn("d", wide.difference_text(F.col("a"), F.col("b"))).collect():
        assert int(r.d) == int(r.a) - int(r.b) and r.d == str(int(r.d)), r
    ordered = [int(r.a) for r in df.orderBy(wide.order_key(F.col("a"))).collect()]
    assert ordered == sorted(ordered)
