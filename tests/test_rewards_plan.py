"""The amounts of a rewards snapshot are not shuffled by the few names they carry."""

from __future__ import annotations

from chainloom.operators.snapshots import drop_suppressed, resolve_denoms


def test_amounts_stay_where_they_are(spark):
    amounts = spark.createDataFrame([(1, "a"), (2, "bad"), (3, "ibc/H1"), (4, "ibc/H2"), (5, None)], "n bigint, source_denom string")
    metadata = spark.createDataFrame([(1, True), (2, False)], "denom_id int, suppress boolean")
    denoms = spark.createDataFrame([(1, "bad"), (2, "a")], "id int, value string")
    traces = spark.createDataFrame([("H1", "base", None)], "hash string, base_denom string, error string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = drop_suppressed(amounts, metadata, denoms)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin [source_denom" in plan and "hashpartitioning(source_denom" not in plan
        out = resolve_denoms(kept, traces)
        assert "SortMergeJoin [source_denom" not in out._jdf.queryExecution().executedPlan().toString()
        rows = sorted((r.n, r.resolved_denom, r.resolve_error) for r in out.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows == [(1, "a", None), (3, "base", None), (4, None, "resolve ibc ibc/H2: no stored trace"), (5, None, None)]
