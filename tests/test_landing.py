"""How the catalogue's landed files are made: the same rows as before, in files that grow in number."""

from __future__ import annotations

import datetime

from chainloom.catalog import ingest_side, standins
from chainloom.sources import blocks


def _tables(spark, folder, n):
    at = datetime.datetime(2024, 1, 1)
    rows = [(i, at + datetime.timedelta(seconds=i), i % 7, "view", 1.5 * i, '{"k": %d}' % (i % 100)) for i in range(n)]
    rows += [(None, at, 1, "view", 2.0, '{"k": 5}'), (3, at, 1, "click", 2.0, '{"k": 6}'), (8, at, 1, "click", 2.0, None)]
    spark.createDataFrame(rows, "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string").write.parquet(
        f"{folder}/events.parquet"
    )
    return str(folder)


def test_landed_files_grow_in_number(spark, tmp_path, monkeypatch):
    sf = _tables(spark, tmp_path, 400)
    monkeypatch.setattr(standins, "BLOCKS_PER_FILE", 10)
    assert standins.landed_files(spark, sf) == 41
    folder, files = standins.landed_folder(spark, sf)
    assert files > 2 * spark.sparkContext.defaultParallelism
    landed, built = spark.read.parquet(folder), standins.build_blocks(spark, sf)
    assert landed.exceptAll(built).isEmpty() and built.exceptAll(landed).isEmpty()
    assert ingest_side._landing(spark, sf) == (folder, -(-files // 4))


def test_texts_are_made_after_the_shuffle(spark, tmp_path):
    """The events move, not the JSON of their blocks."""
    sf = _tables(spark, tmp_path, 40)
    for df in (standins.build_blocks(spark, sf, files=3), ingest_side._rest_blocks(spark, sf, 3)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "StructsToJson" in plan.split("Repartition")[0] and "StructsToJson" not in plan.split("Repartition")[1]


def test_replies_need_no_join(spark, tmp_path):
    sf = _tables(spark, tmp_path, 40)
    replies = ingest_side._replies(spark, sf)
    assert replies.where("height is null" if "height" in replies.columns else "first_height is null").isEmpty()
    assert "Join" not in replies._jdf.queryExecution().optimizedPlan().toString()


def test_reply_bodies_are_shuffled_once(spark, tmp_path):
    """Pairs, their failed batches and the decoded blocks of a batch come from one shuffle of the bodies and no sort before it."""
    replies = spark.createDataFrame(
        [(1, 10, 0, "{}", None), (1, 10, 1, "{}", None), (1, 10, 2, None, "boom"), (1, 10, 3, "{}", None), (2, 20, 1, "{}", None), (3, 30, 0, "{}", None), (3, 30, None, None, "full"), (None, 40, 0, "{}", None), (None, 40, 1, "{}", None)],
        "batch_id bigint, first_height bigint, id int, result string, error string",
    )
    good, bad = blocks.pair_batch_replies(replies)
    assert sorted(r.height for r in good.collect()) == [10, 40]
    assert sorted(tuple(r) for r in bad.collect()) == [(11, "block h=11: boom"), (20, "missing reply"), (30, "batch rpc error: full")]
    parsed = blocks.parse_replies(replies)
    lost = {r.height: (r.error, r.events, r.time) for r in parsed.collect()}
    assert lost[11] == ("block h=11: boom", None, None) and lost[10][0] == "block: bad time" and len(lost) == 5
    for df in (good, parsed):
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
        assert plan.count("Exchange hashpartitioning(batch_id") == 2  # the bodies, and the errors of whole batches
        assert "height#" not in "".join(x for x in plan.splitlines() if "Exchange hashpartitioning" in x)
