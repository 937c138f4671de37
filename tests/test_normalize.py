import json

from pyspark.sql import functions as F

from tidewatch.functions import classify_sentiment, ticker_topic
from tidewatch.operators import normalize


def texts(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "json string")


def ticker(**data):
    base = {"s": "BTCUSDT", "c": "103.00", "o": "100.00", "v": "12.5", "E": 1700000000000}
    base.update(data)
    return json.dumps({"stream": "btcusdt@miniTicker",
                       "data": {k: v for k, v in base.items() if v != "absent"}})


def kline(**k):
    base = {"s": "BTCUSDT", "o": "100", "h": "104", "l": "99", "c": "103", "v": "2.5", "x": True,
            "t": 1699999980000}
    base.update(k)
    return json.dumps({"stream": "btcusdt@kline_1m", "data": {"k": base}})


def test_ticker(spark):
    valid, rejects = normalize.tickers(normalize.route(texts(spark, ticker())))
    assert [tuple(r) for r in valid.collect()] == [
        ("BTCUSDT", 103.0, 12.5, 3.0, 1700000000000, "btcusdt-ticker")
    ]
    assert rejects.count() == 0


def test_zero_open_gives_no_percentage(spark):
    valid, _ = normalize.tickers(normalize.route(texts(spark, ticker(o="0"))))
    assert valid.first().change_pct is None


def test_ticker_with_missing_or_unreadable_parts_is_rejected(spark):
    rows = [ticker(c="absent"), ticker(v="abc"), ticker(s=None), ticker(o="absent")]
    valid, rejects = normalize.tickers(normalize.route(texts(spark, *rows)))
    assert valid.count() == 0
    assert {r.json: r.missing for r in rejects.collect()} == dict(
        zip(rows, ["price", "volume_24h", "symbol", "open"])
    )


def test_routing_first_match_wins_and_the_rest_is_ignored(spark):
    both = json.dumps({"stream": "a@miniTicker_kline", "data": {}})
    rows = [both, kline(), '{"stream":"a@depth","data":{}}', '{"data":{}}', "{}",
            "not json", "", "null", '["x"]']
    routed = normalize.route(texts(spark, *rows))
    kinds = {r.json: r.kind for r in routed.collect()}
    assert kinds == dict(
        zip(rows, ["ticker", "kline", None, None, None] + ["unreadable"] * 4)
    )
    assert {r.json for r in normalize.unreadable(routed).collect()} == set(rows[5:])


def test_kline_and_closed_filter(spark):
    rows = texts(spark, kline(), kline(x=False, c="104"), kline(x=None), kline(h="?"))
    valid, rejects = normalize.klines(normalize.route(rows))
    assert sorted((r.close, r.closed) for r in valid.collect()) == [(103.0, True), (104.0, False)]
    assert sorted(r.missing for r in rejects.collect()) == ["closed", "high"]
    assert [r.close for r in normalize.closed_only(valid).collect()] == [103.0]


def test_null_state_is_not_closed(spark):
    rows = spark.createDataFrame([(True,), (False,), (None,)], "closed boolean")
    assert [r.closed for r in normalize.closed_only(rows).collect()] == [True]


def snapshot(spark, *rows):
    valid, rejects = normalize.market(texts(spark, *rows), timestamp=F.lit(7).cast("bigint"))
    return [tuple(r) for r in valid.orderBy("symbol").collect()], [
        tuple(r) for r in rejects.collect()
    ]


def test_snapshot(spark):
    text = (
        '{"bitcoin":{"usd":103.1,"usd_market_cap":2.0e12,"usd_24h_vol":3.0e10,'
        '"usd_24h_change":3.0},"ethereum":{"usd":50,"usd_market_cap":null},"dogecoin":{"usd":1}}'
    )
    valid, rejects = snapshot(spark, text)
    assert valid == [
        ("BTCUSDT", "bitcoin", 103.1, 2.0e12, 3.0e10, 3.0, 7, "coingecko-market"),
        ("ETHUSDT", "ethereum", 50.0, 0.0, 0.0, 0.0, 7, "coingecko-market"),
    ]
    assert rejects == []


def test_snapshot_without_a_coin_and_failed_poll(spark):
    valid, rejects = snapshot(spark, '{"bitcoin":{"usd":1}}', None, "{}")
    assert [v[0] for v in valid] == ["BTCUSDT"] and rejects == []


def test_bad_quote_is_rejected_alone(spark):
    valid, rejects = snapshot(
        spark, '{"bitcoin":{"usd":"x"},"ethereum":{"usd":2}}', '{"bitcoin":5}', "oops"
    )
    assert [(v[0], v[2]) for v in valid] == [("ETHUSDT", 2.0)]
    assert sorted(rejects) == [
        ("5", "price_usd,market_cap,volume_24h,change_24h"),
        ("oops", "snapshot"),
        ('{"usd":"x"}', "price_usd"),
    ]


def test_missing_price_is_zero(spark):
    assert snapshot(spark, '{"bitcoin":{}}')[0][0][2] == 0.0


def test_sentiment(spark):
    good = ('{"data":[{"value":"24","value_classification":"Extreme Fear",'
            '"timestamp":"1700000000"},{"value":"99"}]}')
    bad = ['{"data":[]}', "{}", '{"data":[{"value":"x","value_classification":"F",'
           '"timestamp":"1"}]}', "?"]
    valid, rejects = normalize.sentiment(texts(spark, good, *bad, None), F.lit(9).cast("bigint"))
    assert [tuple(r) for r in valid.collect()] == [
        (24, "Extreme Fear", 1700000000, 9, "feargreed-index")
    ]
    assert {r.json for r in rejects.collect()} == set(bad)


def test_sentiment_bands(spark):
    rows = spark.createDataFrame([(v,) for v in (24, 25, 49, 50, 74, 75, None)], "v bigint")
    bands = [r.b for r in rows.select(classify_sentiment(F.col("v")).alias("b")).collect()]
    assert bands == ["Extreme Fear", "Fear", "Fear", "Greed", "Greed", "Extreme Greed", None]


def test_topic(spark):
    rows = spark.createDataFrame([("BTCUSDT",)], "s string")
    assert rows.select(ticker_topic(F.col("s")).alias("t")).first().t == "btcusdt-ticker"


def test_one_pass_gives_the_same_as_the_single_functions(spark):
    rows = texts(spark, ticker(), ticker(o="0"), ticker(c="x"), ticker(v="absent", s=None),
                 kline(), kline(x=None), '{"stream":"a@depth"}', "junk", "{}", None)
    routed = normalize.route(rows)
    out = normalize.exchange_outcomes(routed).collect()
    sent = [r for r in out if r.missing == ""]
    assert sorted((r.topic, bytes(r.key).decode()) for r in sent) == [
        ("btcusdt-ticker", "BTCUSDT"), ("btcusdt-ticker", "BTCUSDT"), ("crypto-klines", "BTCUSDT")
    ]
    valid = [json.loads(v) for v in normalize.tickers(routed)[0].drop("topic").toJSON().collect()]
    valid += [json.loads(v) for v in normalize.klines(routed)[0].drop("topic").toJSON().collect()]
    bodies = [{k: v for k, v in json.loads(bytes(r.value)).items() if v is not None} for r in sent]
    assert sorted(map(str, bodies)) == sorted(map(str, valid))
    rejects = normalize.tickers(routed)[1].union(normalize.klines(routed)[1]).union(
        normalize.unreadable(routed))
    assert sorted((str(r.json), r.missing) for r in out if r.missing != "") == sorted(
        (str(r.json), r.missing) for r in rejects.collect())
    plan = normalize.exchange_outcomes(routed)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(StructField(stream") == 1
