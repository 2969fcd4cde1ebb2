"""Hard negatives against plain inner products."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from chainloom.llm import negatives

WIDE = "vec_id bigint, embedding array<float>, label int, score string, chunk int, v string, place string, `group` int"


def plain(rows, is_anchor, scale, k, low, high):
    kept = []
    for i, e, label in rows:
        if i is not None and label is not None and e is not None and all(x is not None and np.isfinite(x) for x in e):
            kept.append((i, [int(np.floor(float(np.float32(x)) * scale)) for x in e], label))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for i, a, label in kept:
        if not is_anchor(i):
            continue
        other = sorted((-dot(a, b), j, n == label) for j, b, n in kept if j != i)
        for ps, p, _ in [o for o in other if o[2]][:k]:
            fit = [(j, -s) for s, j, same in other if not same and low * -ps <= 100 * -s <= high * -ps][:k]
            out += [(i, p, r + 1, j, -ps, s) for r, (j, s) in enumerate(fit)]
    return sorted(out)


@pytest.mark.parametrize(("scale", "low", "high", "block", "chunk"), [(256, 80, 100, 4096, 256), (7, -20, 130, 7, 2), (2_000_000, 50, 90, 64, 3)])
def test_hard_negatives_equal_plain_products(spark, scale, low, high, block, chunk):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(0, 0.4, 19).astype(np.float32).tolist(), int(rng.integers(0, 3))) for i in range(150)]
    rows += [(200 + i, rows[i % 4][1], i % 2) for i in range(40)]  # ties
    rows += [(10, [1.0] * 19, 1), (10, [1.0] * 19, 1), (11, [0.5] * 30, 0), (12, [], 2), (0, [-1.0] * 19, 1)]
    bad = [(400, None, 1), (401, [None] * 19, 1), (402, [float("nan")] * 19, 1), (403, [float("inf")], 0), (410, [0.1] * 19, None), (None, [0.1] * 19, 1)]
    df = spark.createDataFrame([(*r, "s", 3, "v", "p", 1) for r in rows + bad], WIDE).repartition(4)
    out = negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, low=low, high=high, scale=scale, block=block, chunk=chunk)
    want = plain(rows + bad, lambda i: i % 10 == 0, scale, 5, low, high)
    assert sorted(tuple(r) for r in out.collect()) == want and len(want) > 50


def test_no_anchors_or_rows(spark):
    empty = spark.createDataFrame([], WIDE)
    assert negatives.hard_negatives(empty, F.col("vec_id") == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0], 1, "", 0, "", "", 0)], WIDE)
    assert negatives.hard_negatives(one, F.col("vec_id") == 0).count() == 0


def test_lookups_are_exact():
    rng = np.random.default_rng(4)
    x, a = rng.integers(-1000, 1000, (50, 24)), rng.integers(-1000, 1000, (9, 24))
    assert np.array_equal(negatives.scores(negatives.subset_sums(a, np.int64), negatives.bit_planes(x, 11)), x @ a.T)
