import random

import pytest

from riskstream import schema
from riskstream.operators import alerts, decode
from riskstream.operators.scoring import with_features

GOOD = (
    '{"transaction_id":"t","user_id":"u","timestamp":"2026-01-01T03:04:05.123456","amount":12.5,'
    '"currency":"TND","location":"Tunis","payment_method":"CARD","merchant_category":"GROCERY",'
    '"is_online":true,"device_id":"d"}'
)
TAIL = '"is_online":true,"timestamp":"2026-01-01T00:00:00"}'


def messages(spark, *values):
    return spark.createDataFrame([(None, v) for v in values], schema.MESSAGE)


@pytest.mark.parametrize(
    "payload, cause",
    [
        (GOOD, None),
        ("not json", decode.CAUSE_MALFORMED),
        ("", decode.CAUSE_EMPTY),
        ("   ", decode.CAUSE_EMPTY),
        (None, decode.CAUSE_EMPTY),
        ('{"amount":"x","transaction_id":"b",' + TAIL, decode.CAUSE_MALFORMED),
        ('{"amount":"12.5","user_id":5,' + TAIL, decode.CAUSE_MALFORMED),
        ('{"amount":3,"is_online":1,"timestamp":"2026-01-01T00:00:00"}', decode.CAUSE_MALFORMED),
        ('{"amount":1e400,' + TAIL, decode.CAUSE_BAD_AMOUNT),
        ('{"amount":-1e400,' + TAIL, decode.CAUSE_BAD_AMOUNT),
        ('{"amount":NaN,' + TAIL, decode.CAUSE_BAD_AMOUNT),
        ('{"amount":null,' + TAIL, decode.CAUSE_NO_AMOUNT),
        ('{"AMOUNT":3,' + TAIL, decode.CAUSE_NO_AMOUNT),
        ('{"amount":3,"timestamp":"2026-01-01T00:00:00"}', decode.CAUSE_NO_CHANNEL),
        ('{"amount":3,"is_online":true}', decode.CAUSE_BAD_TIME),
        ('{"amount":3,"is_online":true,"timestamp":"bogus"}', decode.CAUSE_BAD_TIME),
        ("[" + GOOD + "]", decode.CAUSE_MALFORMED),
    ],
)
def test_causes(spark, payload, cause):
    (row,) = decode.inspect_transactions(messages(spark, payload)).collect()
    assert row.cause == cause
    assert row.value == (payload if cause else None)


def test_split_is_complete(spark):
    frame = messages(spark, GOOD, "not json", None, GOOD)
    assert decode.decode_transactions(frame).count() == 2
    assert decode.quarantine(frame).count() == 2


def test_payload_bytes_and_null_ids(spark):
    frame = spark.createDataFrame([(bytearray(('{"amount":3,' + TAIL).encode()),)], "value binary")
    (row,) = decode.decode_transactions(frame).collect()
    assert row.amount == 3.0 and row.transaction_id is None and row.user_id is None


def test_round_trip(spark):
    decoded = decode.decode_transactions(messages(spark, GOOD))
    again = decode.decode_transactions(alerts.transaction_messages(decoded))
    assert decoded.collect() == again.collect()
    assert alerts.transaction_messages(decoded).first().key == "u"


def test_features(spark):
    zoned = GOOD.replace("2026-01-01T03:04:05.123456", "2026-01-01T23:30:00+05:00")
    plain, shifted = with_features(decode.decode_transactions(messages(spark, GOOD, zoned))).collect()
    assert (plain.is_online, plain.tx_hour, plain.tx_timestamp.microsecond) == (1, 3, 123456)
    assert shifted.tx_hour == 18


def test_alert_text_and_rejects(spark):
    from riskstream.streaming.alerts import read_alerts, rejected_alerts

    good = '{"transaction_id":"t1","user_id":"u1","risk_level":8,"fraud_probability":0.125,"reason":"r"}'
    bare = '{"fraud_probability":0.5}'
    frame = messages(spark, good, bare, '{"transaction_id":"t2"}', "broken", None)
    shown = read_alerts(frame).collect()
    assert shown[0].alert_text == (
        "Transaction ID: t1\nUser ID:        u1\nRisk Level:     8/10\n"
        "Probability:    0.13\nReason:         r"
    )
    assert shown[0].warning == "Fraud alert for user u1 - Score: 8"
    assert shown[1].alert_text.startswith("Transaction ID: None\nUser ID:        None")
    assert [r.cause for r in rejected_alerts(frame).collect()] == [
        "missing fraud_probability", "malformed json", "empty payload",
    ]


def test_damaged_payloads_never_stop_a_batch(spark):
    """Cut, doubled and scrambled payloads end on one side or the other."""
    from riskstream.operators import model
    from riskstream.operators.scoring import score

    rng = random.Random(3)
    values = []
    for _ in range(2000):
        text = list(GOOD)
        for _ in range(rng.randrange(0, 4)):
            at = rng.randrange(len(text))
            kind = rng.randrange(3)
            if kind == 0:
                text[at:] = []
            elif kind == 1:
                text[at] = rng.choice('{}[]":,0eN-\\x\u0000\u00e9')
            else:
                text[at:at] = text[: rng.randrange(20)]
            text = text or ["{"]
        values.append("".join(text))
    inspected = decode.inspect_transactions(messages(spark, *values))
    good = score(decode.usable(inspected), model.pinned(spark)).collect()
    bad = decode.dead_letters(inspected).collect()
    assert len(good) + len(bad) == 2000 and good and bad
    assert all(0.0 <= row.fraud_probability <= 1.0 for row in good)
    assert all(row.value in values or row.value is None for row in bad)
