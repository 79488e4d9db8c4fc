import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from msgflow import schemas
from msgflow.functions import envelope as E
from msgflow.operators import envelope as M

REPLY = "$JS.ACK.north.h1.ORDERS.billing.3.812.790.1718000000123456789.17"


def one(spark, *columns):
    return spark.range(1).select(*columns).collect()[0]


def test_reply_subject_metadata(spark):
    wire = spark.createDataFrame(
        [("s", REPLY, bytearray(b"a payload"), None)],
        "subject string, replyTo string, content binary, headers map<string,array<string>>",
    )
    row = M.to_full_envelope(wire).collect()[0]
    assert (row.domain, row.stream, row.consumer) == ("north", "ORDERS", "billing")
    assert (row.delivered, row.streamSeq, row.consumerSeq, row.pending) == (3, 812, 790, 17)
    micros = M.to_full_envelope(wire).select(F.unix_micros("timestamp")).collect()[0][0]
    assert micros == 1718000000123000
    assert bytes(row.content) == b"a payload"
    assert row.headers is None


def test_full_envelope_schema(spark):
    wire = spark.createDataFrame([], "subject string, replyTo string, content binary, headers map<string,array<string>>")
    out = M.to_full_envelope(wire).schema
    assert [(f.name, f.dataType) for f in out] == [(f.name, f.dataType) for f in schemas.ENVELOPE]


def test_broken_reply_subject_gives_nulls(spark):
    row = one(spark, *[E.reply_field(F.lit("a.b.c"), n).alias(n) for n in E.REPLY_FIELDS])
    assert row.domain == "c" and row.stream is None and row.pending is None


def test_reply_subject_round_trip(spark):
    names = ("d", "a", "st", "co")
    reply = E.reply_subject(*[F.lit(n) for n in names], *[F.lit(n) for n in (2, 7, 8, 1718000000123456789, 0)])
    assert one(spark, reply.alias("r")).r == "$JS.ACK.d.a.st.co.2.7.8.1718000000123456789.0"


def test_headers_from_pairs(spark):
    pairs = spark.createDataFrame(
        [(1, [("a", "1"), ("b", "2"), ("a", "3")]), (2, []), (3, None)],
        "id int, pairs array<struct<key:string,value:string>>",
    )
    got = {r.id: r.h for r in pairs.select("id", E.headers_from_pairs(F.col("pairs")).alias("h")).collect()}
    assert got == {1: {"a": ["1", "3"], "b": ["2"]}, 2: None, 3: None}


def test_json_texts_have_fixed_form_and_are_valid(spark):
    plain = E.headers_json(F.create_map(F.lit("k"), F.array(F.lit("v1"), F.lit("v2")), F.lit("x"), F.array(F.lit("y"))))
    assert one(spark, plain.alias("j")).j == '{ "k": "v1,v2", "x": "y" }'
    odd = 'say "hi"\\ \n\t\u0001 é'
    text = one(spark, E.headers_json(F.create_map(F.lit(odd), F.array(F.lit(odd)))).alias("j")).j
    assert json.loads(text) == {odd: odd}
    assert one(spark, E.headers_json(F.lit(None).cast("map<string,array<string>>")).alias("j")).j is None


def test_metadata_and_message_json(spark):
    ts = F.timestamp_micros(F.lit(1718000000123000))
    meta = E.metadata_json(F.lit("st"), F.lit(5), F.lit(6), F.lit(1), F.lit(0), ts)
    text = one(spark, meta.alias("j")).j
    assert text == (
        '{"jsMetaData": {"stream" : "st", "streamSeq" :  5, "consumerSeq" : 6, "delivered" : 1,'
        ' "pending" : 0, "timestamp" : "2024-06-10T06:13:20.123000Z"}}'
    )
    no_headers = F.lit(None).cast("map<string,array<string>>")
    whole = E.message_json(F.lit("s"), F.lit("now"), F.lit('{"a": 1}'), no_headers, meta)
    parsed = json.loads(one(spark, whole.alias("j")).j)
    assert parsed["headers"] is None and parsed["payload"] == '{"a": 1}' and parsed["js-metadata"] == json.loads(text)
    bare = E.message_json(F.lit("s"), F.lit("now"), F.lit(""), no_headers, F.lit(None).cast("string"))
    assert json.loads(one(spark, bare.alias("j")).j)["js-metadata"] is None


def test_times(spark):
    ts = F.timestamp_micros(F.lit(1718000000123456))
    row = one(
        spark,
        E.format_time(ts, "MM/dd/yyyy - HH:mm:ss Z").alias("a"),
        E.iso_time(ts).alias("b"),
        F.unix_micros(E.event_time(F.lit(1718000000123999999))).alias("c"),
    )
    assert row.a == "06/10/2024 - 06:13:20 +0000"
    assert row.b == "2024-06-10T06:13:20.123456Z"
    assert row.c == 1718000000123000


def test_ascii_follows_replacement_rules(spark):
    raw = "aé€\U0001f600z".encode()
    row = one(
        spark,
        E.ascii_text(F.lit(bytearray(raw))).alias("read"),
        E.ascii_bytes(F.lit("aé€\U0001f600z")).alias("written"),
        E.utf8_text(F.lit(bytearray(raw))).alias("utf8"),
    )
    assert row.read == raw.decode("ascii", errors="replace")
    assert bytes(row.written) == b"a???z"
    assert row.utf8.encode() == raw


def test_text_envelopes(spark):
    wire = spark.createDataFrame(
        [("s", REPLY, bytearray("hé".encode()), {"a": ["1", "2"]}), ("t", REPLY, bytearray(b""), None)],
        "subject string, replyTo string, content binary, headers map<string,array<string>>",
    )
    full = M.to_full_envelope(wire)
    five = M.to_text5(full, F.lit(dt.datetime(2024, 1, 2, 3, 4, 5)).cast("timestamp"))
    assert five.columns == schemas.TEXT5.names
    assert all(f.dataType.simpleString() == "string" for f in five.schema)
    rows = five.orderBy("subject").collect()
    assert rows[0].headers == '{ "a": "1,2" }' and rows[1].headers is None
    assert rows[0].dateTime.startswith("01/02/2024 - ") and rows[0].content == "hé"
    three = M.to_text3(full).orderBy("subject").collect()
    assert three[0] == ("s", "2024-06-10T06:13:20.123000Z", "h��")


def test_conform_reorders_drops_and_guards(spark):
    df = spark.createDataFrame([(1, bytearray(b"x"), "s")], "extra int, data binary, subject string")
    out = M.conform_to_sink(df)
    assert out.schema.names == ["subject", "data", "headers"]
    assert [f.nullable for f in out.schema] == [False, False, True]
    assert out.collect()[0].headers is None
    with pytest.raises(ValueError, match="data"):
        M.conform_to_sink(df.drop("data"))
    for bad in ([(None, bytearray(b"x"))], [("s", None)]):
        nulls = spark.createDataFrame(bad, "subject string, data binary")
        with pytest.raises(Exception, match="null (subject|data)"):
            M.conform_to_sink(nulls).collect()


def test_origin_header_and_publish_rows(spark):
    df = spark.createDataFrame(
        [("s", "t0", bytearray(b"m"), {"a": ["1"], "originTimestamp": ["old"]})],
        "subject string, dateTime string, content binary, headers map<string,array<string>>",
    )
    kept = df.select(E.with_origin(F.col("headers"), F.col("dateTime")).alias("h")).collect()[0].h
    assert kept == {"a": ["1"], "originTimestamp": ["t0"]}
    row = M.publish_rows(df).collect()[0]
    assert row.headers == {"originTimestamp": ["t0"]} and bytes(row.data) == b"m"


def test_positional_sink(spark):
    df = spark.createDataFrame([("s", "t", "téxt", "dropped")], "a string, b string, c string, headers string")
    row = M.legacy_sink_rows(df).collect()[0]
    assert (row.subject, bytes(row.data), row.headers) == ("s", "téxt".encode(), {"originTimestamp": ["t"]})
    assert bytes(M.legacy_sink_rows(df, "US-ASCII").collect()[0].data) == b"t?xt"
    with pytest.raises(ValueError):
        M.legacy_sink_rows(df.select("a", "b"))


def test_text_rows(spark):
    row = M.text_rows(spark.createDataFrame([("hé",)], "t string"), "sub", "t").collect()[0]
    assert (row.subject, bytes(row.data), row.headers) == ("sub", "hé".encode(), {})
