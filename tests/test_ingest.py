from decimal import Decimal

from tidemark.operators.ingest import latency_stats, parse_feed_a, parse_feed_b, parsed_feed_b, split_feed_b


def _raw(spark, msgs):
    return spark.createDataFrame([(m, 1000 + i) for i, m in enumerate(msgs)], "value string, received_at long")


TRADE = '"e":"trade","E":1704067200100,"s":"BTCUSDT","t":{t},"p":"{p}","q":"0.5","T":1704067200000,"m":true'


def test_feed_a_rules(spark):
    msgs = [
        '{"stream":"btcusdt@trade","data":{' + TRADE.format(t=1, p="42000.10") + ',"M":true}}',  # envelope
        '{' + TRADE.format(t=2, p="42000.10") + '}',                                              # bare, M missing
        '{' + TRADE.format(t=3, p="1") + ',"M":false}',                                          # dropped
        '{' + TRADE.format(t=4, p="1") + ',"M":null}',                                           # dropped
        '{' + TRADE.format(t=5, p="1").replace('"trade"', '"aggTrade"') + '}',                    # skipped
        '{' + TRADE.format(t=6, p="abc") + '}',                                                  # bad price
        '{' + TRADE.format(t=7, p="1.123456789") + '}',                                          # rounded at 8
        '{"stream":"x","data":{' + TRADE.format(t=8, p="1") + '',                                # broken JSON
        '{' + TRADE.format(t=9, p="1").replace(',"s":"BTCUSDT"', '') + '}',                      # no symbol
    ]
    trades, dead = parse_feed_a(_raw(spark, msgs))
    t = {r.trade_id: r for r in trades.collect()}
    assert sorted(t) == [1, 2, 7]
    assert t[1].price == Decimal("42000.10000000") and t[1].is_buyer_maker is True
    assert t[1].event_time == 1704067200100 and t[1].ingestion_time == 1000
    assert t[7].price == Decimal("1.12345679")
    d = {r.error for r in dead.collect()}
    assert d == {"invalid_price", "malformed_json", "missing_field:s"}
    assert {r.original_topic for r in dead.collect()} == {"raw-binance-trades"}


def test_feed_b_rules(spark):
    tr = '{{"trade_id":"{i}","product_id":"BTC-USD","price":"{p}","size":"0.4","side":"BUY","time":"{t}"}}'
    good = tr.format(i=1, p="42100.00", t="2024-01-01T00:00:03.123456Z")
    bad = tr.format(i=2, p="42100.00", t="yesterday")
    msgs = [
        '{"channel":"market_trades","events":[{"type":"update","trades":[' + good + ',' + bad + ']},'
        '{"type":"snapshot","trades":[' + tr.format(i=3, p="1", t="2024-01-01T00:00:04Z") + ']},'
        '{"type":"other","trades":[' + tr.format(i=4, p="1", t="2024-01-01T00:00:04Z") + ']}]}',
        '{"channel":"heartbeats","events":[{"type":"update","trades":[' + good + ']}]}',
        '{"channel":"market_trades","events":[{"type":"update","trades":[' + tr.format(i=5, p="x", t="2024-01-01T00:00:04Z") + ']}]}',
        'not json',
    ]
    trades, dead = parse_feed_b(_raw(spark, msgs))
    t = {r.trade_id: r for r in trades.collect()}
    assert sorted(t) == ["1", "3"]
    assert t["1"].event_time == 1704067203123 and t["1"].product_id == "BTC-USD"
    d = sorted(((r.original_key, r.error) for r in dead.collect()), key=lambda x: (x[0] or "", x[1]))
    assert d == [(None, "malformed_json"), ("BTCUSDT", "invalid_price"), ("BTCUSDT", "invalid_time")]


def test_latency_stats(spark):
    msgs = ['{' + TRADE.format(t=1, p="1") + '}']
    trades, _ = parse_feed_a(spark.createDataFrame([(msgs[0], 1704067200250)], "value string, received_at long"))
    r = latency_stats(trades).first()
    assert (r.symbol, r.exchange, r.trades, r.min_latency_ms, r.avg_latency_ms) == ("BTCUSDT", "binance", 1, 250, 250.0)


def test_flag_text_is_not_a_literal(spark):
    flags = ['"0"', '"false"', '""', '0', '0.0', '1', 'false', 'true', 'null', '"x"']
    msgs = ['{' + TRADE.format(t=i, p="1") + ',"M" : ' + f + '}' for i, f in enumerate(flags)]
    trades, dead = parse_feed_a(_raw(spark, msgs))
    assert sorted(r.trade_id for r in trades.collect()) == [0, 1, 5, 7, 9] and dead.count() == 0


def test_bad_elements_leave_their_siblings(spark):
    tr = '{{"trade_id":"{i}","product_id":"BTC-USD","price":"1","size":"0.4","side":"BUY","time":"{t}"}}'
    good = [tr.format(i=i, t="2024-01-01T00:00:04Z") for i in range(6)]
    msgs = ['{"channel":"market_trades","events":[{"type":"update","trades":[' + good[0] + ',5,null,"x",' + good[1] + ']},7,'
            '{"type":"update","trades":[' + good[2] + ']},{"type":"update","trades":[]},{"type":"update"}]}',
            '{"channel":"market_trades","events":[{"type":"snapshot","trades":[' + good[3] + ',' + good[4] + ']}]}',
            '{"channel":"market_trades","events":[]}', '{"channel":"market_trades"}', '{"channel":"market_trades","events":[{"type"',
            '{"channel":"market_trades","events":[{"type":"update","trades":[' + tr.format(i=9, t="12:30:00") + ']}]}']
    trades, dead = parse_feed_b(_raw(spark, msgs))
    assert sorted(r.trade_id for r in trades.collect()) == ["0", "1", "2", "3", "4"]
    errors = sorted(r.error for r in dead.collect())
    assert errors == ["invalid_time"] + ["malformed_json"] * 5  # 5, null, "x", event 7, broken text


def test_each_message_is_parsed_once_for_both_outputs(spark):
    parsed = parsed_feed_b(_raw(spark, ["not json"]))
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 3  # message, event, trade
    ready = parsed.persist()
    for part in split_feed_b(ready):
        assert "InMemoryRelation" in part._jdf.queryExecution().withCachedData().toString()
    ready.unpersist()


def test_flag_of_the_message_itself(spark):
    """A text flag is told from a literal by the message's own key, whatever nested objects hold."""
    tails = [(',"M":false,"x":{"M":"y"}', False), (',"x":{"M":"y"},"M":0', False), (',"M":"false","x":{"M":false}', True), (',"M":"0"', True),
             (',"M":"","x":{"M":"y"}', False), (',"x":"\\"M\\":\\"","M":false', False), (',"M":[]', False), (',"M":{"M":"a"}', True), (',"x":{"M":false}', True)]
    msgs = ["{" + TRADE.format(t=i, p="1") + tail + "}" for i, (tail, _) in enumerate(tails)]
    msgs += ['{"data":' + m.replace('"t":', '"t":1') + "}" for m in msgs]
    trades, dead = parse_feed_a(_raw(spark, msgs))
    want = [i for i, (_, kept) in enumerate(tails) if kept]
    assert sorted(r.trade_id for r in trades.collect()) == sorted(want + [int(f"1{i}") for i in want]) and dead.count() == 0
