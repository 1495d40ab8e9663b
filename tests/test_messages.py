"""Nested messages: every one is accepted or rejected, with the right reasons."""

import json

from pyspark.sql import functions as F

from paylens.sources.messages import FIELDS, accepted, read_messages, rejected


def message(**changes):
    body = {"header": {"type": "MT103", "sender": "ORIODE4B", "receiver": "LYRAFR2P"}, "payment": {"time": "2024-01-02 03:04:05.000000", "amount": 12.5, "currency": "EUR"}}
    for path, value in changes.items():
        part, name = path.split("_")
        if value is ...:
            del body[part][name]
        else:
            body[part][name] = value
    return json.dumps(body)


CASES = [
    (message(), ""), (message(payment_amount="7.25"), ""), (message(payment_amount=3), ""), (message(header_sender=...), ""), (message(header_type=None), ""),
    (message(payment_note="grown", header_sender="É "), ""),
    (message(payment_amount="abc"), "type:amount"), (message(payment_amount=...), "missing:amount"), (message(payment_amount=None, payment_time=...), "missing:timestamp,missing:amount"),
    (message(payment_time={"x": 1}), "type:timestamp"), (message(payment_amount=[1]), "type:amount"), (message()[:-9], "not_json"),
    ("[1, 2]", "not_an_object"), ('"text"', "not_an_object"), ("null", "not_an_object"), ("", "no_message"), ("  ", "no_message"), (None, "no_message"), ("{}", "missing:timestamp,missing:amount"),
]


def test_every_message_is_in_one_table(spark):
    rows = [(i, m) for i, (m, _) in enumerate(CASES)] * 2
    raw = spark.createDataFrame(rows, "id int, message string").withColumn("amount", F.lit("clash"))
    messages = read_messages(raw)
    good, bad = accepted(messages), rejected(messages)
    assert sorted([r.id for r in good.collect()] + [r.id for r in bad.collect()]) == sorted(i for i, _ in rows)
    assert {r.id: r.reasons for r in bad.collect()} == {i: why for i, (_, why) in enumerate(CASES) if why}
    assert {(r.id, r.message) for r in bad.collect()} == {(i, m) for i, (m, why) in enumerate(CASES) if why}
    got = {r.id: r for r in good.collect()}
    assert (got[0].timestamp, got[0].sender_bic, got[0].amount, got[0].msg_type) == ("2024-01-02 03:04:05.000000", "ORIODE4B", 12.5, "MT103")
    assert got[1].amount == 7.25 and got[3].sender_bic is None and got[5].sender_bic == "É "


def test_schema_may_grow(spark):
    raw = spark.createDataFrame([(message(payment_note="grown"),), (message(),)], "message string")
    wider = read_messages(raw, fields={**FIELDS, "note": ("$.payment.note", "string")})
    assert sorted(str(r.note) for r in accepted(wider).collect()) == ["None", "grown"]
    assert read_messages(raw.limit(0)).count() == 0


def test_a_message_is_parsed_once(spark):
    messages = read_messages(spark.createDataFrame([(1, message())], "id int, message string").withColumn("message", F.concat("message", F.lit(" "))))
    for out in (accepted(messages), rejected(messages)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parseJson") == 1 and plan.count("concat(") <= 1
