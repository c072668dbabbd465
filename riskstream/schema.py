"""Declared schemas of the records that cross a process boundary."""

from pyspark.sql import types as T

TRANSACTION_FIELDS = [
    "transaction_id",
    "user_id",
    "timestamp",
    "amount",
    "currency",
    "location",
    "payment_method",
    "merchant_category",
    "is_online",
    "device_id",
]

_JSON_TYPES = {"amount": T.DoubleType(), "is_online": T.BooleanType()}

# The transaction message. Every field is nullable: the producer may omit any.
TRANSACTION = T.StructType(
    [T.StructField(name, _JSON_TYPES.get(name, T.StringType())) for name in TRANSACTION_FIELDS]
)

# Columns the decision step adds, after the transaction and its features.
SCORED = T.StructType(
    [
        T.StructField(f.name, T.IntegerType() if f.name == "is_online" else f.dataType)
        for f in TRANSACTION.fields
    ]
    + [
        T.StructField("tx_timestamp", T.TimestampType()),
        T.StructField("tx_hour", T.IntegerType()),
        T.StructField("fraud_probability", T.DoubleType()),
        T.StructField("rule_score", T.DoubleType()),
        T.StructField("final_fraud_score", T.DoubleType()),
        T.StructField("risk_level", T.IntegerType()),
        T.StructField("prediction", T.StringType()),
        T.StructField("reason", T.StringType()),
    ]
)

SCORED_FIELDS = SCORED.fieldNames()

ALERT = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("risk_level", T.IntegerType()),
        T.StructField("fraud_probability", T.DoubleType()),
        T.StructField("reason", T.StringType()),
    ]
)

ALERT_FIELDS = ALERT.fieldNames()

DEAD_LETTER = T.StructType(
    [T.StructField("value", T.StringType()), T.StructField("cause", T.StringType())]
)

# What a topic carries once keys and payloads are text.
MESSAGE = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]
)

# Raw model inputs; anything trained or scored needs exactly these.
NUMERIC_INPUTS = ["amount", "tx_hour", "is_online"]
CATEGORY_INPUTS = ["location", "merchant_category"]
MODEL_INPUTS = NUMERIC_INPUTS + CATEGORY_INPUTS
