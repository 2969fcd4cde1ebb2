"""Literal cases of the parsers, classifiers and calendar rules."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from chainloom.functions import classify, numbers, payloads, texts, times
from chainloom.operators import asof
from chainloom.operators import snapshots as sn
from chainloom.plans.prices import price_snapshot
from chainloom.sources import blocks, catalogue, responses


def apply(spark, fn, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select(fn(F.col("v")).alias("o"), "i").orderBy("i").select("o").collect()]


def test_fraction(spark):
    got = apply(spark, numbers.parse_fraction, ["1/2", "0.25", "", "1/0", "1.5d", " 1.5 ", "1e400", "x/2", "-1/4", "1/2/3", None])
    assert got == [0.5, 0.25, None, None, None, None, None, None, -0.25, None, None]


def test_integers(spark):
    assert apply(spark, numbers.parse_int_or_null, ["5", "+5", "-5", " 5", "5\n", "9223372036854775808", "", "1e3"]) == [5, 5, -5, None, None, None, None, None]
    assert apply(spark, numbers.clean_integer, ["123", "-123", "123.0", "123.1", "123.0001", "abc", "", "-", ".0", "-.0", "5."]) == [
        "123", "-123", "123", None, None, None, None, None, "0", "0", "5"
    ]


def test_decimals(spark):
    got = apply(spark, numbers.parse_decimal_text, ["0", "", "0.067812345", "42", "-0.5", "1.23e4", "garbage", ".5", "-.5", " 7 "])
    assert got == ["0", "0", "0.067812345", "42", "-0.5", None, None, "0.5", "-0.5", "7"]


def test_display_amount_is_exact(spark):
    df = spark.createDataFrame([("12345678901234567890", "1000000000000000000"), ("-1500000", "1000000"), ("7", "1000000")], "a string, f string")
    got = [r[0] for r in df.select(numbers.display_amount(F.col("a"), F.col("f"))).collect()]
    assert got == [Decimal("12.345678901234567890"), Decimal("-1.5"), Decimal("0.000007")]
    value = df.select(numbers.display_amount(F.col("a"), F.col("f")).alias("s")).select(numbers.value_usd(F.col("s"), F.lit("0.0000000123450").cast("decimal(38,18)")))
    assert value.first()[0] == Decimal("0.000000152407")


def test_reward_bodies_are_decoded_once(spark, tmp_path):
    """No filter on the entries goes below the steps that decode a body, where it would decode it once for every field."""
    info = '{"info":[{"source":"Pools: A","amount":[{"denom":"u","amount":"5"},{"denom":"v","amount":"6"}]},{"source":"B","amount":[]}]}'
    bodies = [(1, 200, info), (2, 503, info), (3, 200, '{"info":[],"total":[]}'), (4, 200, "{bad"), (5, 200, '{"total":[{"denom":"w","amount":"7"}]}'), (6, 200, None)]
    spark.createDataFrame([(9, "p", i, s, b) for i, s, b in bodies], "height bigint, provider string, position bigint, http_status int, body string").write.parquet(str(tmp_path / "r"))
    amounts = responses.reward_amounts(responses.reward_results(spark.read.parquet(str(tmp_path / "r"))))
    assert amounts._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    got = sorted((r.position, r.entry_pos, r.amount_pos, r.source_kind, r.spec, r.source_denom, r.amount_text) for r in amounts.collect())
    assert got == [(1, 0, 0, 1, "A", "u", "5"), (1, 0, 1, 1, "A", "v", "6"), (5, 0, 0, 3, "", "w", "7")]


def test_long_amounts_are_not_lost(spark):
    body = '{"info":[{"source":"Pools: A","amount":[{"denom":"u","amount":"' + "9" * 41 + '"}]}]}'
    df = spark.createDataFrame([(1, "p", 1, 200, body)], "height bigint, provider string, position bigint, http_status int, body string")
    row = responses.reward_amounts(responses.reward_results(df)).first()
    assert row.amount_text == "9" * 41


def test_source_labels(spark):
    cases = ["Boost: ETH1", "Pools: LAVA", "Subscription: ETH1", "Boost: some: spec", "NoColon", "Unknown: xyz"]
    got = apply(spark, payloads.parse_source, cases)
    assert [tuple(g) for g in got] == [(0, "ETH1"), (1, "LAVA"), (2, "ETH1"), (0, "some: spec"), (2, "NoColon"), (2, "xyz")]


def rewards(spark, *bodies):
    df = spark.createDataFrame([(1, "p", i, s, b) for i, (s, b) in enumerate(bodies)], "height bigint, provider string, position bigint, http_status int, body string")
    return responses.reward_results(df).orderBy("position")


def test_reward_bodies(spark):
    info = '{"info":[{"source":"Boost: ETH1","amount":[{"denom":"ulava","amount":"30737293.000000000000000000"},{"denom":"x","amount":"123"}]},{"source":"Pools: A","amount":[{"denom":"y","amount":"456.0"}]}],"total":[{"denom":"z","amount":"1"}]}'
    rows = rewards(
        spark, (200, info), (200, '{"success":false,"message":"version mismatch"}'), (200, '{"success":false,"message":"something else broke"}'),
        (200, '{"info":[],"total":[]}'), (200, '{"info":[],"total":[{"denom":"ulava","amount":"18124981"}]}'), (200, ""), (200, "{bad"), (404, ""), (503, ""), (429, ""),
        (200, '{"info":[{"source":"a","amount":[{"denom":"d","amount":"1.5"}]}]}'),
    )
    assert [r.outcome for r in rows.collect()] == [
        "fetched", "state_pruned", "no_rewards", "fetched", "fetched", "state_pruned", "state_pruned", "state_pruned", "state_pruned", "failed", "failed"
    ]
    amounts = responses.reward_amounts(rows).orderBy("position", "entry_pos", "amount_pos").collect()
    assert [(a.source_kind, a.spec, a.source_denom, a.amount_text) for a in amounts] == [
        (0, "ETH1", "ulava", "30737293"), (0, "ETH1", "x", "123"), (1, "A", "y", "456"), (3, "", "ulava", "18124981")
    ]


def test_price_bodies(spark):
    usd = lambda n: '{"market_data":{"current_price":{"eur":1,"usd":%s}}}' % n
    cases = [(200, usd("0.0678")), (200, usd("42")), (200, "{}"), (200, '{"market_data":{"current_price":{"eur":1}}}'), (200, ""), (404, "x"), (429, ""), (500, ""), (200, "{bad"), (200, usd("0.0000000123450")), (200, usd("0.123456789012345678"))]
    df = spark.createDataFrame([(date(2025, 1, 17), str(i), s, b) for i, (s, b) in enumerate(cases)], "snapshot_date date, coingecko_id string, http_status int, body string")
    got = {int(r.coingecko_id): (r.price_text, r.error) for r in responses.price_results(df).collect()}
    assert [got[i][0] for i in range(6)] == ["0.0678", "42", "0", "0", "0", "0"]
    assert all(got[i][0] is None and got[i][1] for i in (6, 7, 8))
    assert (got[9][0], got[10][0]) == ("0.0000000123450", "0.123456789012345678")


def test_supply_bodies(spark):
    coin = lambda *cs: '{"supply":[%s]}' % ",".join('{"denom":"%s","amount":"%s"}' % c for c in cs)
    cases = [coin(("uatom", 1), ("ulava", 999)), coin(("uatom", 1)), coin(("ulava", "1.5")), coin(("ulava", 1), ("ulava", " 2 ")), "{bad", coin(("ulava", "9" * 30))]
    df = spark.createDataFrame([(date(2025, 1, i + 1), i, None, 200, b) for i, b in enumerate(cases)], "snapshot_date date, block_height bigint, block_time timestamp, http_status int, body string")
    got = [(int(r.total_supply), r.status) for r in responses.supply_results(df).orderBy("block_height").collect()]
    assert got == [(999, "ok"), (0, "failed"), (0, "failed"), (2, "ok"), (0, "failed"), (int("9" * 30), "ok")]


def slots(spark, genesis, earliest, now):
    df = spark.createDataFrame([(genesis, earliest, now)], "genesis timestamp, earliest timestamp, now timestamp")
    return [r.slot.isoformat() for r in times.expected_slots(df).orderBy("slot").collect()]


def test_slots(spark):
    g, e = datetime(2024, 1, 17, 15), datetime(2025, 1, 17)
    month = lambda *ms: [f"2025-0{m}-17T15:00:00" for m in ms]
    assert slots(spark, g, e, datetime(2025, 4, 20, 16)) == month(1, 2, 3, 4)
    assert slots(spark, g, e, datetime(2025, 3, 17, 14, 59, 59)) == month(1, 2)
    assert slots(spark, g, e, datetime(2025, 2, 18)) == month(1, 2)
    assert slots(spark, None, e, datetime(2025, 2, 18)) == []
    # a missing day rolls over into the next month
    assert slots(spark, datetime(2024, 1, 31, 1), datetime(2024, 1, 1), datetime(2024, 4, 1)) == ["2024-03-02T01:00:00", "2024-03-31T01:00:00"]


def test_nearest_block(spark):
    t0 = datetime(2024, 1, 1)
    heads = spark.createDataFrame([(h, t0 + timedelta(seconds=30 * (h - 1))) for h in range(1, 6001)], "height bigint, time timestamp")
    ask = {t0 - timedelta(days=3): 1, t0: 1, t0 + timedelta(seconds=30 * 99): 100, t0 + timedelta(seconds=45): 2,
           t0 + timedelta(seconds=46): 3, t0 + timedelta(days=90): 6000, t0 + timedelta(seconds=30 * 5999): 6000}
    df = spark.createDataFrame([(a,) for a in ask], "slot timestamp")
    for width in (60_000_000, asof.DAY_MICROS):
        got = {r.slot: r.block_height for r in asof.nearest_asof(df, heads, bucket_micros=width).collect()}
        assert got == ask


@pytest.mark.parametrize(("failed", "total", "status"), [(1, 5, "ok"), (2, 9, "failed"), (0, 3, "ok"), (3, 10, "failed")])
def test_gate_is_exact_at_one_in_five(spark, failed, total, status):
    rows = [(1, i, "failed" if i < failed else "fetched", f"r{i}") for i in range(total)]
    df = spark.createDataFrame(rows, "height bigint, position bigint, outcome string, reason string")
    row = sn.snapshot_gate(df, ["height"]).first()
    assert row.status == status
    assert row.error == (f"{failed}/{total} providers failed to fetch: r0" if status == "failed" else None)


def test_native_price_first(spark):
    df = spark.createDataFrame([(1, "cosmos"), (2, "lava-network"), (3, "osmosis")], "denom_id int, coingecko_id string")
    order = lambda d: [r.coingecko_id for r in sn.load_bearing_first(d).collect()]
    assert order(df) == ["lava-network", "cosmos", "osmosis"]
    assert order(df.where("denom_id <> 2")) == ["cosmos", "osmosis"]


def test_date_without_priced_denoms_is_ok(spark):
    targets = spark.createDataFrame([(1, date(2025, 1, 17), datetime(2025, 1, 17, 15))], "block_height bigint, snapshot_date date, slot timestamp")
    none = spark.createDataFrame([], "block_height bigint, denom_id int")
    meta = spark.createDataFrame([], "denom_id int, coingecko_id string, suppress boolean")
    answers = spark.createDataFrame([], "snapshot_date date, coingecko_id string, http_status int, body string")
    row = price_snapshot(targets, none, meta, answers)["snapshots"].first()
    assert (row.status, row.denom_count) == ("ok", 0)


def test_classes(spark):
    assert apply(spark, classify.classify_http_status, [200, 429, 500, 404, 301], "int") == ["ok", "rate_limited", "server_error", "terminal", "terminal"]
    assert apply(spark, classify.classify_fetch_error, ["no_source_covers", "height_pruned", "rate_limited", None]) == [True, True, False, False]


def test_texts(spark):
    assert apply(spark, texts.redact_userinfo, ["https://u:p@h/x", "https://u@h", "https://h"]) == ["https://u:***@h/x", "https://u@h", "https://h"]
    assert apply(spark, texts.truncate_utf8, ["é" * 200, "a" * 250, "a" * 249 + "é"]) == ["é" * 125 + "…", "a" * 250, "a" * 249 + "…"]
    assert apply(spark, texts.strict_base64, ["YWJj", "YWJ*", "YWI", "YWI=", ""]) == [b"abc", None, None, b"ab", b""]
    row = spark.sql("select 300L h").select(texts.tx_hash_bytes(F.lit(""), F.col("h")), texts.tx_hash_bytes(F.lit("abc"), F.col("h"))).first()
    assert row[0] == b"\xff" * 24 + (300).to_bytes(8, "big") and row[1] is None


def test_block_order_and_repeated_keys(spark):
    block = '{"block":{"header":{"height":"7","time":"2024-01-17T15:00:00.123456789Z"},"data":{"txs":["YWJj"]}}}'
    ev = lambda t: '{"type":"%s","attributes":[{"key":"a","value":"1"},{"key":"a","value":"2"}]}' % t
    results = '{"txs_results":[{"events":[%s]},{"events":[%s]},{"events":null}],"begin_block_events":[%s],"end_block_events":[%s],"finalize_block_events":[%s]}' % tuple(map(ev, ["t0", "t1", "b", "e", "f"]))
    raw = spark.createDataFrame([(7, block, results), (8, block, "{bad"), (9, block.replace("YWJj", "Y*"), results), (10, block, "{}")], "height bigint, block_json string, results_json string")
    parsed = blocks.parse_blocks(raw)
    rows = blocks.explode_events(parsed).orderBy("event_idx").collect()
    assert [(r.type, r.event_idx, bool(r.tx_hash)) for r in rows] == [("b", 0, False), ("t0", 1, True), ("t1", 2, False), ("e", 3, False), ("f", 4, False)]
    assert rows[1].tx_hash == "BA7816BF8F01CFEA414140DE5DAE2223B00361A396177A9CB410FF61F20015AD" and rows[0].attrs == {"a": "2"}
    assert sorted(r.height for r in blocks.decode_errors(parsed).collect()) == [8, 9]


def test_network_check(spark):
    rows = [("same", "net", None), ("other", "x", None), ("none", "", None), ("down", "net", "boom")]
    df = spark.createDataFrame(rows, "source string, network string, probe_error string")
    got = {r.source: (r.disabled, r.reason) for r in catalogue.check_network(df, "net").collect()}
    assert got["same"] == (False, None) and got["down"] == (True, "probe failed: boom")
    assert got["other"] == (True, "chain_id mismatch: expected=net advertised=x")
    assert got["none"] == (True, "endpoint did not report chain_id (expected net)")
    assert not any(r.disabled for r in catalogue.check_network(df.where("probe_error is null"), "").collect())
