"""Texts that meet nothing are not shuffled: a sketch of keys leaves them out, and the exact join follows."""

from __future__ import annotations

import corpus_pipeline
from chainloom.llm.common import marked


def test_marks_every_row_that_meets_one(spark):
    rows = spark.createDataFrame([(i, None if i % 7 == 0 else f"t{i}") for i in range(2000)], "id bigint, text string")
    of = rows.where("id % 100 = 0 or id = 7").select("id", "text").unionByName(rows.where("id = 100").select("id", "text"))
    got = {r.id: r.maybe for r in marked(rows, of, ["id", "text"]).collect()}
    assert len(got) == 2000 and all(got[i] for i in [7, *range(0, 2000, 100)])
    assert sum(got.values()) < 40
    assert not any(r.maybe for r in marked(rows, of.limit(0), ["id", "text"]).collect())


def test_copies_go_without_a_shuffle_of_all_texts(spark):
    words = lambda n, k: " ".join(f"w{n * 100 + i}" for i in range(k))
    docs = [(i, words(i, 30)) for i in range(300)] + [(300 + i, words(i, 30)) for i in range(4)] + [(None, words(1, 30)), (304, None), (304, ""), (5, words(5, 30)), (303, words(900, 30))]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = corpus_pipeline.one_of_each_group(spark, df, "")
        # texts are read through the sketch on both sides of the union
        assert out._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin [_word") == 2
        got = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in out.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # a dropped id takes all rows of that id
    gone = {300, 301, 302, 303}
    assert got == sorted((i is None, i or 0, t or "") for i, t in docs if i not in gone)
