"""Sides of joins that Spark takes for far smaller than they are don't go through the driver."""

from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from chainloom.llm import jaccard, negatives, topk


@pytest.fixture
def joins(monkeypatch):
    """(kind, keys) of the joins in the plans of the module's stored steps and of a result."""

    def of(module, run):
        plans, put = [], module.stored
        noted = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
        monkeypatch.setattr(module, "stored", lambda df, purpose: noted(df) or put(df, purpose))
        noted(out := run())
        rows = out.collect()
        found = re.findall(r"(\w+Join) \[([^\]]*)\]", re.sub(r"#\d+L?", "", "\n".join(plans)))
        return rows, [(kind, keys) for kind, keys in found]

    return of


def vectors(spark, n, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(0, 1, 8).astype(np.float32).tolist(), i % 3) for i in range(n)]
    return rows, spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")


def test_top_k_shuffles_the_copies_of_its_queries(spark, joins):
    rows, df = vectors(spark, 300, 1)
    got, found = joins(topk, lambda: topk.top_k(df, F.col("vec_id") % 50 == 0, pivots=4, block=32, chunk=4, groups=5))
    assert ("SortMergeJoin", "group") in found and ("BroadcastHashJoin", "group") not in found
    x = np.floor(np.array([r[1] for r in rows], np.float32).astype(float) * 256).astype(int)
    want = [(q, r + 1, v, s) for q in range(0, 300, 50) for r, (s, v) in enumerate(sorted((-int(x[q] @ x[i]), i) for i in range(300) if i != q)[:5])]
    assert sorted((r.query_id, r["rank"], r.vec_id, -r.score) for r in got) == want


def test_hard_negatives_shuffle_the_copies_of_their_anchors(spark, joins):
    _, df = vectors(spark, 300, 2)
    got, found = joins(negatives, lambda: negatives.hard_negatives(df, F.col("vec_id") % 50 == 0, block=16, chunk=2))
    assert [kind for kind, keys in found if keys == "group"] == ["SortMergeJoin", "SortMergeJoin"]
    assert got


def test_jaccard_join_shuffles_index_entries_and_repeated_rows(spark, joins):
    text = lambda n, k, m: " ".join(f"w{n}x{i}" for i in range(k)) + "".join(f" v{m}x{i}" for i in range(3))
    docs = spark.createDataFrame([(i, text(i % 40, 60, i if i % 2 else 0)) for i in range(160)] + [(None, text(1, 60, 1)), (200, None)], "doc_id bigint, text string")
    got, found = joins(jaccard, lambda: jaccard.jaccard_join(docs, size=3, num=80, den=100))
    broad = {keys for kind, keys in found if kind == "BroadcastHashJoin"}
    for keys in ("t, at, block", "leader, salt", "t, band", "t, shifted", "t, band, lead", "t, band_b, lead_b", "id, th"):
        assert ("SortMergeJoin", keys) in found and keys not in broad, keys
    assert {(r.doc_id, r.component_id) for r in got} == {(i, i % 40) for i in range(160)} | {(None, 1), (200, 200)}
