import datetime as dt

from pyspark.sql import functions as F

from tidewatch import schemas as S
from tidewatch.operators import enrich, parse, publish


def records(spark, *texts):
    rows = [(None, t.encode() if t is not None else None) for t in texts]
    return spark.createDataFrame(rows, "key binary, value binary")


def feed(spark, *texts, schema=S.TICK, required=S.REQUIRED["tick"]):
    valid, rejects = parse.read_feed(records(spark, *texts), schema, required)
    return [r.asDict() for r in valid.collect()], {r.json: r.missing for r in rejects.collect()}


def test_malformed_text_is_rejected(spark):
    texts = ["not json", "", "null", '[{"symbol":"Z"}]', '{"symbol":"A","price":1']
    valid, rejects = feed(spark, *texts)
    assert valid == []
    assert rejects == dict.fromkeys(texts, "symbol,price")


def test_null_message_is_rejected(spark):
    valid, rejects = feed(spark, None)
    assert valid == [] and rejects == {None: "symbol,price"}


def test_bad_required_field_is_rejected_and_named(spark):
    assert feed(spark, '{"symbol":"A","price":"x"}')[1] == {'{"symbol":"A","price":"x"}': "price"}


def test_names_are_case_sensitive(spark):
    assert feed(spark, '{"Symbol":"A","price":1}')[1] == {'{"Symbol":"A","price":1}': "symbol"}


def test_bad_optional_field_becomes_null(spark):
    valid, rejects = feed(spark, '{"symbol":"A","price":1.5,"volume_24h":true,"unknown":[1]}')
    assert rejects == {}
    assert valid == [
        {"symbol": "A", "price": 1.5, "volume_24h": None, "change_pct": None, "timestamp": None}
    ]


def test_prices_keep_their_digits(spark):
    assert feed(spark, '{"symbol":"A","price":67123.4567}')[0][0]["price"] == 67123.4567


def test_encode_then_parse_is_the_identity(spark):
    rows = spark.createDataFrame(
        [("BTCUSDT", 1.25, None, -0.5, 7), ("é\"\\", 1e300, 0.1, None, None)], S.TICK
    )
    sent = publish.encode(rows.withColumn("topic", F.lit("t")), S.TICK.names, key=F.col("symbol"))
    assert [bytes(r.key).decode() for r in sent.collect()] == ["BTCUSDT", "é\"\\"]
    valid, rejects = parse.read_feed(sent.select("key", "value"), S.TICK, ("symbol", "price"))
    assert rejects.count() == 0
    assert sorted(map(tuple, valid.collect())) == sorted(map(tuple, rows.collect()))


def test_message_without_key(spark):
    rows = spark.createDataFrame([(5,)], "value bigint").withColumn("topic", F.lit("t"))
    assert publish.encode(rows, ["value"], key=None).first().key is None


def test_stamp_uses_the_given_time_or_arrival(spark):
    rows = spark.createDataFrame([("A", 1_700_000_000_000)], "symbol string, timestamp bigint")
    row = enrich.stamp(rows, F.timestamp_millis("timestamp")).first()
    assert (row.par, row.fecha) == ("A", dt.date(2023, 11, 14))
    arrived = enrich.stamp(rows, symbol=None)
    assert arrived.columns == ["symbol", "timestamp", "event_time", "fecha"]
    assert arrived.where(F.col("event_time") == F.current_timestamp()).count() <= 1
    assert arrived.first().fecha is not None
