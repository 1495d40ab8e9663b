"""Schemas, column lists and the fixed rule values of the payment checks.

Everything else in the package imports its constants from here, so a rule
change (say, a new currency) is a one-line edit.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: these must stay exactly as listed for results to match. ---
# Accepted ISO 4217 codes, in this order.
VALID_CURRENCIES = (
    "USD", "EUR", "GBP", "JPY", "AUD", "CAD",
    "CHF", "CNY", "SEK", "NZD", "INR", "BRL",
)
# Accepted message types, in this order.
VALID_MESSAGE_TYPES = ("MT103", "MT202", "MT950", "MT940")
# BIC: 4 letters bank, 2 letters country, 2 alphanumerics location,
# optional 3 alphanumerics branch. Case-sensitive; input is only trimmed.
BIC_PATTERN = r"^[A-Z]{4}[A-Z]{2}[A-Z0-9]{2}([A-Z0-9]{3})?$"
# Text form of the raw timestamp column.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
# A row is valid when its quality score (passed checks / 7) reaches this.
VALIDITY_THRESHOLD = 0.85
# Strictly above this amount a payment is "high value".
HIGH_VALUE_AMOUNT = 10_000_000
# Anomaly cut-off in standard deviations.
ANOMALY_SIGMAS = 3
# Rows kept by the top senders / receivers reports.
TOP_PARTIES = 20
# Default directory partitioning of the processed data.
DEFAULT_PARTITION_COLUMNS = ("year", "month", "day")
# Names (and write order) of the analysis result tables.
ANALYSIS_TABLES = (
    "daily_volumes", "top_senders", "top_receivers",
    "country_statistics", "fraud_anomalies",
)
#: Raw payment row as it arrives in CSV (all nullable, no inference).
RAW_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType(), True),
    T.StructField("sender_bic", T.StringType(), True),
    T.StructField("receiver_bic", T.StringType(), True),
    T.StructField("amount", T.DoubleType(), True),
    T.StructField("currency", T.StringType(), True),
    T.StructField("msg_type", T.StringType(), True),
])

RAW_COLUMNS = tuple(RAW_SCHEMA.fieldNames())

#: Columns added by :func:`paylens.operators.clean.clean`.
CLEAN_COLUMNS = RAW_COLUMNS + ("processing_timestamp", "year", "month", "day")

#: Flag columns added by :func:`paylens.operators.validate.validate`, in order.
FLAG_COLUMNS = (
    "has_nulls", "is_amount_valid", "is_sender_bic_valid", "is_receiver_bic_valid",
    "is_currency_valid", "is_msg_type_valid", "is_timestamp_valid", "is_high_value",
    "quality_score", "is_valid",
)

VALIDATED_COLUMNS = CLEAN_COLUMNS + FLAG_COLUMNS

#: Schema of the processed (validated) table as written to Parquet.
VALIDATED_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType(), True),
        T.StructField("sender_bic", T.StringType(), True),
        T.StructField("receiver_bic", T.StringType(), True),
        T.StructField("amount", T.DoubleType(), True),
        T.StructField("currency", T.StringType(), True),
        T.StructField("msg_type", T.StringType(), True),
        T.StructField("processing_timestamp", T.TimestampType(), True),
        T.StructField("year", T.IntegerType(), True),
        T.StructField("month", T.IntegerType(), True),
        T.StructField("day", T.IntegerType(), True),
    ]
    + [T.StructField(c, T.BooleanType(), True) for c in FLAG_COLUMNS[:8]]
    + [
        T.StructField("quality_score", T.DoubleType(), True),
        T.StructField("is_valid", T.BooleanType(), True),
    ]
)

#: Keys of the quality report, in report order.
QUALITY_REPORT_KEYS = (
    "total_records", "valid_records", "invalid_records", "validity_rate",
    "avg_quality_score", "null_count", "invalid_amount_count",
    "invalid_sender_bic_count", "invalid_receiver_bic_count",
    "invalid_currency_count", "invalid_msg_type_count",
    "future_timestamp_count", "high_value_count",
)
# --- end of fixed values ---
