"""DuckDB SQL for every registered query, over the same test tables.

The SQL re-states the payment mapping and the quality rules independently of
the Spark code, so the two are checked against each other. Tables
``lineitem orders customer supplier`` are assumed registered as views.
"""

from __future__ import annotations

# --- Fixed values, stated here again so that a wrong one in the Spark code shows. ---
VALID_CURRENCIES = ("USD", "EUR", "GBP", "JPY", "AUD", "CAD", "CHF", "CNY", "SEK", "NZD", "INR", "BRL")
VALID_MESSAGE_TYPES = ("MT103", "MT202", "MT950", "MT940")
BIC_PATTERN = "^[A-Z]{4}[A-Z]{2}[A-Z0-9]{2}([A-Z0-9]{3})?$"
HIGH_VALUE_AMOUNT = 10000000
FIXTURE_AS_OF = "2001-06-01 00:00:00"
BANK_CODES = "ORIOLYRAVEGANORDALPS"
COUNTRY_CODES = "USGBDEFRJPCNAUCABRINCHSENZITESNLBEPTIEDKNOFIPLATSG"
CURRENCY_CODES = "USDEURGBPJPYAUDCADCHFCNYSEKNZDINRBRL"
MSG_TYPE_CODES = "MT103MT202MT950MT940"
GEN_BICS = ("BOFAUS3NXXX", "CHASUS33XXX", "DEUTDEFFXXX", "BARCGB22XXX", "BNPAFRPPXXX")
GEN_CURRENCIES = ("USD", "EUR", "GBP", "JPY")
GEN_MSG_TYPES = ("MT103", "MT202", "MT950")
GEN_RARE_CURRENCIES = ("AUD", "CAD", "CHF", "CNY")
GEN_ANOMALY_KINDS = ("high_amount", "invalid_bic", "future_date", "duplicate", "wrong_currency")
# --- end of fixed values ---


def _in_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _bic_base(key: str, nation: str) -> str:
    return (
        f"substr('{BANK_CODES}', CAST(1 + 4 * ({key} % 5) AS INTEGER), 4)"
        f" || substr('{COUNTRY_CODES}', CAST(1 + 2 * {nation} AS INTEGER), 2)"
        f" || lpad(CAST({key} % 20 AS VARCHAR), 2, '0') || 'XXX'"
    )


RAW_CTES = f"""
senders AS (
  SELECT o_orderkey, c_custkey, c_nationkey
  FROM orders JOIN customer ON o_custkey = c_custkey
),
joined AS (
  SELECT l.l_orderkey AS k, l.l_extendedprice AS p, l.l_suppkey, l.l_linenumber, l.l_shipdate,
         {_bic_base('s.c_custkey', 's.c_nationkey')} AS sender_base,
         {_bic_base('su.s_suppkey', 'su.s_nationkey')} AS receiver_base
  FROM lineitem l
  JOIN supplier su ON l.l_suppkey = su.s_suppkey
  JOIN senders s ON l.l_orderkey = s.o_orderkey
),
raw AS (
  SELECT
    CASE WHEN k % 43 = 0 THEN NULL
         WHEN k % 47 = 0 THEN 'not-a-date'
         ELSE strftime(l_shipdate + to_seconds(43200 + k % 36000), '%Y-%m-%d %H:%M:%S.%f') END AS "timestamp",
    CASE WHEN k % 37 = 0 THEN NULL
         WHEN k % 13 = 0 THEN 'INVALID' || lpad(CAST(k % 1000 AS VARCHAR), 8, 'A')
         WHEN k % 7 = 0 THEN '  ' || sender_base || ' '
         ELSE sender_base END AS sender_bic,
    CASE WHEN k % 19 = 0 THEN lower(receiver_base) ELSE receiver_base END AS receiver_bic,
    CASE WHEN k % 31 = 0 THEN NULL
         WHEN k % 17 = 0 THEN -p
         WHEN k % 211 = 0 THEN p * 1000
         ELSE p END AS amount,
    CASE WHEN k % 23 = 0 THEN 'XYZ'
         ELSE substr('{CURRENCY_CODES}', CAST(1 + 3 * (l_suppkey % 12) AS INTEGER), 3) END AS currency,
    CASE WHEN k % 41 = 0 THEN NULL
         WHEN k % 29 = 0 THEN 'MT999'
         ELSE substr('{MSG_TYPE_CODES}', CAST(1 + 5 * (l_linenumber % 4) AS INTEGER), 5) END AS msg_type
  FROM joined
)"""

CLEAN_CTES = RAW_CTES + """,
parsed AS (
  SELECT try_strptime("timestamp", '%Y-%m-%d %H:%M:%S.%f') AS "timestamp",
         trim(sender_bic) AS sender_bic, trim(receiver_bic) AS receiver_bic, amount,
         trim(currency) AS currency, trim(msg_type) AS msg_type
  FROM raw
),
clean AS (
  SELECT *, CAST(year("timestamp") AS INTEGER) AS year, CAST(month("timestamp") AS INTEGER) AS month,
         CAST(day("timestamp") AS INTEGER) AS day
  FROM parsed
)"""

VALIDATED_CTES = CLEAN_CTES + f""",
flagged AS (
  SELECT *,
    ("timestamp" IS NULL OR sender_bic IS NULL OR receiver_bic IS NULL OR amount IS NULL OR currency IS NULL) AS has_nulls,
    COALESCE(amount > 0, false) AS is_amount_valid,
    regexp_matches(sender_bic, '{BIC_PATTERN}') AS is_sender_bic_valid,
    regexp_matches(receiver_bic, '{BIC_PATTERN}') AS is_receiver_bic_valid,
    currency IN ({_in_list(VALID_CURRENCIES)}) AS is_currency_valid,
    msg_type IN ({_in_list(VALID_MESSAGE_TYPES)}) AS is_msg_type_valid,
    "timestamp" <= TIMESTAMP '{FIXTURE_AS_OF}' AS is_timestamp_valid,
    COALESCE(amount > {HIGH_VALUE_AMOUNT}, false) AS is_high_value
  FROM clean
),
scored AS (
  SELECT *,
    (CAST(NOT has_nulls AS INTEGER) + CAST(is_amount_valid AS INTEGER) + CAST(is_sender_bic_valid AS INTEGER)
     + CAST(is_receiver_bic_valid AS INTEGER) + CAST(is_currency_valid AS INTEGER)
     + CAST(is_msg_type_valid AS INTEGER) + CAST(is_timestamp_valid AS INTEGER)) / CAST(7.0 AS DOUBLE) AS quality_score
  FROM flagged
),
validated AS (
  SELECT *, COALESCE(quality_score >= 0.85, false) AS is_valid FROM scored
),
valid AS (
  SELECT * FROM validated WHERE is_valid
)"""

SUM = "round(sum(amount), 2)"
AVG = "CAST(avg(amount) AS FLOAT)"
STDDEV = "CAST(stddev_samp(amount) AS FLOAT)"

VALIDATED_SELECT = (
    '"timestamp", sender_bic, receiver_bic, amount, currency, msg_type, year, month, day, '
    "has_nulls, is_amount_valid, is_sender_bic_valid, is_receiver_bic_valid, is_currency_valid, "
    "is_msg_type_valid, is_timestamp_valid, is_high_value, quality_score, is_valid"
)


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


def _top(party: str, suffix: str) -> str:
    return _with(VALIDATED_CTES, f"""
SELECT {party}_bic, CAST(count(*) AS BIGINT) AS transaction_count,
       {SUM} AS total_{suffix}, {AVG} AS avg_{suffix}
FROM valid GROUP BY {party}_bic
ORDER BY transaction_count DESC, {party}_bic ASC LIMIT 20""")


COUNTRY_STATISTICS_BODY = f"""
SELECT substr(sender_bic, 5, 2) AS sender_country, substr(receiver_bic, 5, 2) AS receiver_country, currency,
       CAST(count(*) AS BIGINT) AS transaction_count, {AVG} AS avg_amount, {STDDEV} AS stddev_amount,
       min(amount) AS min_amount, max(amount) AS max_amount, {SUM} AS total_volume
FROM valid GROUP BY 1, 2, 3
ORDER BY transaction_count DESC, sender_country, receiver_country, currency"""

ORACLE_SQL: dict[str, str] = {
    "parse_clean": _with(CLEAN_CTES, """
SELECT "timestamp", sender_bic, receiver_bic, amount, currency, msg_type, year, month, day FROM clean"""),
    "validate_flags": _with(VALIDATED_CTES, f"SELECT {VALIDATED_SELECT} FROM validated"),
    "quality_report": _with(VALIDATED_CTES, """
SELECT CAST(count(*) AS BIGINT) AS total_records,
       CAST(count_if(is_valid) AS BIGINT) AS valid_records,
       CAST(count(*) - count_if(is_valid) AS BIGINT) AS invalid_records,
       CASE WHEN count(*) > 0 THEN CAST(count_if(is_valid) AS DOUBLE) / CAST(count(*) AS DOUBLE) ELSE 0.0 END
         AS validity_rate,
       COALESCE(CAST(sum(CAST(round(quality_score * 7) AS BIGINT)) AS DOUBLE)
                / (CAST(count(quality_score) AS DOUBLE) * 7.0), 0.0) AS avg_quality_score,
       CAST(count_if(has_nulls) AS BIGINT) AS null_count,
       CAST(count_if(NOT is_amount_valid) AS BIGINT) AS invalid_amount_count,
       CAST(count_if(NOT is_sender_bic_valid) AS BIGINT) AS invalid_sender_bic_count,
       CAST(count_if(NOT is_receiver_bic_valid) AS BIGINT) AS invalid_receiver_bic_count,
       CAST(count_if(NOT is_currency_valid) AS BIGINT) AS invalid_currency_count,
       CAST(count_if(NOT is_msg_type_valid) AS BIGINT) AS invalid_msg_type_count,
       CAST(count_if(NOT is_timestamp_valid) AS BIGINT) AS future_timestamp_count,
       CAST(count_if(is_high_value) AS BIGINT) AS high_value_count
FROM validated"""),
    "overall_stats": _with(VALIDATED_CTES, f"""
SELECT CAST(count(*) AS BIGINT) AS total_transactions, {SUM} AS total_volume, {AVG} AS avg_amount,
       {STDDEV} AS stddev_amount, min(amount) AS min_amount, max(amount) AS max_amount
FROM valid"""),
    "by_currency": _with(VALIDATED_CTES, f"""
SELECT currency, CAST(count(*) AS BIGINT) AS transaction_count, {SUM} AS total_volume
FROM valid GROUP BY currency ORDER BY transaction_count DESC, currency"""),
    "by_msg_type": _with(VALIDATED_CTES, """
SELECT msg_type, CAST(count(*) AS BIGINT) AS transaction_count
FROM valid GROUP BY msg_type ORDER BY transaction_count DESC, msg_type"""),
    "daily_volumes": _with(VALIDATED_CTES, f"""
SELECT CAST(date_trunc('day', "timestamp") AS TIMESTAMP) AS date, currency,
       CAST(count(*) AS BIGINT) AS transaction_count, {SUM} AS total_volume, {AVG} AS avg_amount,
       min(amount) AS min_amount, max(amount) AS max_amount
FROM valid GROUP BY 1, 2 ORDER BY 1, 2"""),
    "top_senders": _top("sender", "sent"),
    "top_receivers": _top("receiver", "received"),
    "country_statistics": _with(VALIDATED_CTES, COUNTRY_STATISTICS_BODY),
    "amount_anomalies": _with(VALIDATED_CTES + f""",
stats AS (
  SELECT avg(amount) AS mean_amount, stddev_samp(amount) AS std_amount FROM valid WHERE NOT isnan(amount)
),
scored_amounts AS (
  SELECT v.*, CASE WHEN s.std_amount = 0 THEN NULL ELSE (v.amount - s.mean_amount) / s.std_amount END AS z_score,
         v.amount > s.mean_amount + 3 * s.std_amount AS is_high_value_anomaly
  FROM valid v CROSS JOIN stats s
)""", """
SELECT "timestamp", sender_bic, receiver_bic, amount, currency, CAST(z_score AS FLOAT) AS z_score, is_high_value_anomaly,
       abs(z_score) > 3 AS is_statistical_anomaly, is_high_value
FROM scored_amounts
WHERE COALESCE(is_high_value_anomaly, false) OR COALESCE(abs(z_score) > 3, false) OR COALESCE(is_high_value, false)
ORDER BY z_score DESC NULLS LAST, "timestamp", sender_bic, receiver_bic, amount, currency"""),
    "sender_sequence": _with(VALIDATED_CTES, """
SELECT sender_bic, "timestamp", receiver_bic, amount, currency, msg_type,
       row_number() OVER (PARTITION BY sender_bic ORDER BY "timestamp" ASC NULLS FIRST,
         receiver_bic ASC NULLS FIRST, amount ASC NULLS FIRST, currency ASC NULLS FIRST,
         msg_type ASC NULLS FIRST) AS row_num
FROM valid"""),
    "csv_roundtrip": _with(RAW_CTES, """
SELECT "timestamp", sender_bic, receiver_bic, amount, currency, msg_type FROM raw"""),
    "parquet_partitioned_roundtrip": _with(VALIDATED_CTES, f"SELECT {VALIDATED_SELECT} FROM validated"),
    "analysis_results_roundtrip": _with(VALIDATED_CTES, COUNTRY_STATISTICS_BODY),
    "aggregation_sets": _with(VALIDATED_CTES, f"""
SELECT currency, msg_type, CAST(count(*) AS BIGINT) AS transaction_count, {SUM} AS total_volume, {AVG} AS avg_amount,
       {STDDEV} AS stddev_amount, min(amount) AS min_amount, max(amount) AS max_amount,
       CASE WHEN grouping(currency) = 0 THEN 'currency' WHEN grouping(msg_type) = 0 THEN 'msg_type' ELSE 'overall' END AS grouping_set
FROM valid GROUP BY GROUPING SETS ((), (currency), (msg_type))"""),
    "ingest_rows": _with(VALIDATED_CTES, f"SELECT {VALIDATED_SELECT} FROM validated"),
}


def _u(salt: int) -> str:
    return f"(CAST('0x' || substr(md5(concat_ws(':', CAST(id AS VARCHAR), '42', '{salt}')), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE)"


def _one_of(values: tuple[str, ...], salt: int) -> str:
    return f"list_extract([{_in_list(values)}], CAST(floor({_u(salt)} * {len(values)}) AS INTEGER) + 1)"


_SUFFIX = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789', CAST(floor({_u(20 + i)} * 36) AS INTEGER) + 1, 1)" for i in range(8))
GENERATED_RAW_CTES = f"""
ids AS (SELECT l_orderkey * 8 + l_linenumber AS id FROM lineitem),
kinds AS (
  SELECT id, CASE WHEN {_u(7)} < 0.05
    THEN {_one_of(GEN_ANOMALY_KINDS, 8)} END AS kind FROM ids
),
raw AS (
  SELECT
    strftime(CASE WHEN kind = 'future_date' THEN TIMESTAMP '{FIXTURE_AS_OF}' + to_days(CAST(floor({_u(9)} * 30) AS INTEGER) + 1)
      ELSE TIMESTAMP '{FIXTURE_AS_OF}' - INTERVAL 30 DAY + to_minutes(CAST(floor({_u(1)} * 43200) AS BIGINT) + 1) END,
      '%Y-%m-%d %H:%M:%S.%f') AS "timestamp",
    CASE WHEN kind = 'invalid_bic' THEN 'INVALID' || {_SUFFIX} ELSE {_one_of(GEN_BICS, 2)} END AS sender_bic,
    {_one_of(GEN_BICS, 3)} AS receiver_bic,
    CASE WHEN kind = 'high_amount' THEN round(1e7 + {_u(10)} * 9e7, 2) ELSE round(100.0::DOUBLE + {_u(4)} * 999900, 2) END AS amount,
    CASE WHEN kind = 'wrong_currency' THEN {_one_of(GEN_RARE_CURRENCIES, 11)}
         ELSE {_one_of(GEN_CURRENCIES, 5)} END AS currency,
    {_one_of(GEN_MSG_TYPES, 6)} AS msg_type
  FROM kinds
)"""

ORACLE_SQL |= {
    "generated_payments": _with(VALIDATED_CTES.replace(RAW_CTES, GENERATED_RAW_CTES), f"SELECT {VALIDATED_SELECT} FROM validated"),
    "ingest_report": ORACLE_SQL["quality_report"],
    "written_daily_volumes": ORACLE_SQL["daily_volumes"],
    "written_top_senders": ORACLE_SQL["top_senders"],
    "written_top_receivers": ORACLE_SQL["top_receivers"],
    "written_fraud_anomalies": ORACLE_SQL["amount_anomalies"],
}

# Queries by time, and the order of ordered results.

_RESENT = VALIDATED_CTES + """,
resent AS (
  SELECT "timestamp" + to_seconds(copy * (600 + cents % 6000)) AS "timestamp", sender_bic, receiver_bic, amount, currency, msg_type
  FROM (SELECT *, unnest(CASE WHEN cents % 5 = 0 THEN range(0, 2 + cents % 3) ELSE [0] END) AS copy
        FROM (SELECT *, CAST(abs(round(amount * 100)) AS BIGINT) AS cents FROM valid))
),
whole AS (
  SELECT *, row_number() OVER w AS number,
         coalesce("timestamp" - lag("timestamp") OVER w > INTERVAL 1 HOUR, true) AS starts
  FROM resent WHERE "timestamp" IS NOT NULL AND sender_bic IS NOT NULL AND receiver_bic IS NOT NULL AND amount IS NOT NULL AND currency IS NOT NULL
  WINDOW w AS (PARTITION BY sender_bic, receiver_bic, amount, currency ORDER BY "timestamp", msg_type NULLS FIRST)
),
runs AS (
  SELECT *, sum(CAST(starts AS INTEGER)) OVER (PARTITION BY sender_bic, receiver_bic, amount, currency ORDER BY number) AS run FROM whole
)"""
_POSITION = "CAST(row_number() OVER (ORDER BY {}) AS BIGINT) AS position"


def _ordered(name: str, order: str) -> str:
    return f"SELECT *, {_POSITION.format(order)} FROM ({ORACLE_SQL[name]})"


ORACLE_SQL |= {
    "sender_velocity": _with(VALIDATED_CTES, """
SELECT "timestamp", sender_bic, receiver_bic, amount, currency, msg_type,
       CASE WHEN known THEN CAST(count(*) OVER month AS BIGINT) END AS velocity_count,
       CASE WHEN known THEN round(coalesce(sum(amount) OVER month, 0), 2) END AS velocity_sum,
       CASE WHEN known THEN date_diff('microsecond', max("timestamp") OVER before, "timestamp") / 1e6::DOUBLE END AS seconds_since_previous
FROM (SELECT *, sender_bic IS NOT NULL AND "timestamp" IS NOT NULL AS known FROM valid)
WINDOW month AS (PARTITION BY known, sender_bic ORDER BY "timestamp" RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW),
       before AS (PARTITION BY known, sender_bic ORDER BY "timestamp" RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)"""),
    "near_duplicates": _with(_RESENT, """
SELECT "timestamp", sender_bic, receiver_bic, amount, currency, msg_type,
       min("timestamp") OVER (PARTITION BY sender_bic, receiver_bic, amount, currency, run) AS run_start,
       CAST(row_number() OVER (PARTITION BY sender_bic, receiver_bic, amount, currency, run ORDER BY number) AS BIGINT) AS run_position,
       NOT starts AS is_duplicate
FROM runs
UNION ALL
SELECT "timestamp", sender_bic, receiver_bic, amount, currency, msg_type, "timestamp", CAST(1 AS BIGINT), false
FROM resent WHERE "timestamp" IS NULL OR sender_bic IS NULL OR receiver_bic IS NULL OR amount IS NULL OR currency IS NULL"""),
    "events_asof_orders": """
SELECT e.event_id, e.user_id, e.at, e.event_type, o.o_orderdate, o.o_orderkey, o.o_totalprice
FROM (SELECT *, ts - INTERVAL 9500 DAY AS at FROM events) e
ASOF LEFT JOIN (
  SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1) o
ON e.user_id = o.o_custkey AND e.at >= o.o_orderdate""",
    "payments_in_periods": _with(VALIDATED_CTES + f""",
periods AS (
  SELECT {_bic_base('c_custkey', 'c_nationkey')} AS sender, o_orderkey AS period_id, o_orderdate AS valid_from,
         o_orderdate + to_days(CAST(CASE WHEN o_orderkey % 50 = 0 THEN 7300 ELSE o_orderkey % 400 + 1 END AS INTEGER)) AS valid_to
  FROM orders JOIN customer ON o_custkey = c_custkey
)""", """
SELECT sender_bic, "timestamp", receiver_bic, amount, currency, period_id, valid_from, valid_to
FROM valid JOIN periods ON sender_bic = sender AND "timestamp" BETWEEN valid_from AND valid_to"""),
    "ordered_daily_volumes": _ordered("daily_volumes", "date, currency"),
    "ordered_by_currency": _ordered("by_currency", "transaction_count DESC, currency"),
    "ordered_country_statistics": _ordered("country_statistics", "transaction_count DESC, sender_country, receiver_country, currency"),
    "ordered_anomalies": _with(VALIDATED_CTES + """,
stats AS (SELECT avg(amount) AS mean_amount, stddev_samp(amount) AS std_amount FROM valid WHERE NOT isnan(amount)),
scored_amounts AS (
  SELECT v.*, CASE WHEN s.std_amount = 0 THEN NULL ELSE (v.amount - s.mean_amount) / s.std_amount END AS z_score FROM valid v CROSS JOIN stats s
),
anomalies AS (SELECT * FROM scored_amounts WHERE COALESCE(abs(z_score) > 3, false) OR COALESCE(is_high_value, false))""", """
SELECT amount, CAST(row_number() OVER (ORDER BY amount DESC) AS BIGINT) AS position FROM anomalies"""),
    "ingest_aggregates": ORACLE_SQL["aggregation_sets"],
}

_SNAPSHOT_COLUMNS = '"timestamp", sender_bic, receiver_bic, amount, currency, msg_type, year'
_SNAPSHOTS = VALIDATED_CTES + f""",
before AS (SELECT {_SNAPSHOT_COLUMNS} FROM validated),
after AS (
  SELECT "timestamp", sender_bic, receiver_bic, CASE WHEN cents % 17 = 0 THEN amount + 1 ELSE amount END AS amount, currency, msg_type, year
  FROM (SELECT *, unnest(range(0, CASE WHEN cents % 11 = 0 THEN 0 WHEN cents % 13 = 0 THEN 2 ELSE 1 END)) AS copy
        FROM (SELECT *, CAST(abs(round(amount * 100)) AS BIGINT) AS cents FROM before WHERE year >= 1998))
  UNION ALL SELECT {_SNAPSHOT_COLUMNS} FROM before WHERE year < 1998 OR year IS NULL
)"""

ORACLE_SQL |= {
    "snapshot_changes": _with(_SNAPSHOTS, f"""
SELECT {_SNAPSHOT_COLUMNS}, CAST(-count(*) AS BIGINT) AS n_change FROM (SELECT * FROM before EXCEPT ALL SELECT * FROM after) GROUP BY ALL
UNION ALL
SELECT {_SNAPSHOT_COLUMNS}, CAST(count(*) AS BIGINT) AS n_change FROM (SELECT * FROM after EXCEPT ALL SELECT * FROM before) GROUP BY ALL"""),
    "snapshot_applied": _with(_SNAPSHOTS, f"SELECT {_SNAPSHOT_COLUMNS} FROM after"),
    "monthly_states": _with(VALIDATED_CTES, f"""
SELECT CAST(date_trunc('month', "timestamp") AS TIMESTAMP) AS month, currency, CAST(count(*) AS BIGINT) AS transaction_count,
       {SUM} AS total_volume, {AVG} AS avg_amount, {STDDEV} AS stddev_amount, min(amount) AS min_amount, max(amount) AS max_amount
FROM valid GROUP BY 1, 2"""),
    "streamed_sessions": _with(VALIDATED_CTES + """,
delivered AS (
  SELECT sender_bic, "timestamp" AS paid_at, coalesce(amount, 0) AS amount, sender_bic IS NOT NULL AND "timestamp" IS NOT NULL AS placed,
         coalesce(least(3, greatest(0, CAST((year("timestamp") - 1995) // 2 AS INTEGER)
           + coalesce(CAST(CAST(abs(round(amount * 100)) AS BIGINT) % 40 = 0 AS INTEGER), 0))), 0) AS delivery
  FROM valid
),
clocked AS (
  SELECT *, max(paid_at) OVER (PARTITION BY placed, sender_bic ORDER BY delivery RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS clock FROM delivered
),
judged AS (SELECT *, coalesce(paid_at < clock - INTERVAL 10 DAY, false) AS late FROM clocked),
numbered AS (
  SELECT *, coalesce(paid_at - lag(paid_at) OVER (PARTITION BY sender_bic ORDER BY paid_at) > INTERVAL 15 DAY, true) AS starts FROM judged WHERE placed AND NOT late
),
runs AS (SELECT *, sum(CAST(starts AS INTEGER)) OVER (PARTITION BY sender_bic ORDER BY paid_at RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM numbered)""", """
SELECT 'session' AS kind, sender_bic AS party, min(paid_at) AS session_start, max(paid_at) AS session_end,
       CAST(count(*) AS BIGINT) AS payments, round(sum(amount), 2) AS total_amount
FROM runs GROUP BY sender_bic, run
UNION ALL
SELECT CASE WHEN placed THEN 'late' ELSE 'unplaced' END, sender_bic, paid_at, paid_at, CAST(1 AS BIGINT), round(amount, 2) FROM judged WHERE late OR NOT placed"""),
}

_ROBUST = VALIDATED_CTES + """,
statistics AS (
  SELECT currency, CAST(count(*) AS BIGINT) AS n, median(amount) AS median_amount, mad(amount) AS mad_amount
  FROM valid WHERE amount IS NOT NULL AND NOT isnan(amount) GROUP BY currency
)"""

ORACLE_SQL |= {
    "robust_statistics": _with(_ROBUST, "SELECT * FROM statistics"),
    "robust_anomalies": _with(_ROBUST, """
SELECT sender_bic, "timestamp", v.currency, amount, median_amount, mad_amount,
       CAST(0.6745::DOUBLE * (amount - median_amount) / mad_amount AS FLOAT) AS robust_score
FROM valid v JOIN statistics s ON v.currency IS NOT DISTINCT FROM s.currency
WHERE mad_amount > 0 AND amount IS NOT NULL AND NOT isnan(amount) AND abs(0.6745::DOUBLE * (amount - median_amount) / mad_amount) > 3.5"""),
}

_MESSAGES = RAW_CTES + """,
sent AS (SELECT *, CAST(abs(round(amount * 100)) AS BIGINT) % 50 AS kind FROM raw),
judged AS (
  SELECT *, CASE WHEN kind = 1 THEN 'not_json' WHEN kind = 3 THEN 'not_an_object'
                 ELSE concat_ws(',', CASE WHEN "timestamp" IS NULL THEN 'missing:timestamp' END,
                                CASE WHEN amount IS NULL THEN 'missing:amount' WHEN kind = 2 THEN 'type:amount' END) END AS reasons
  FROM sent
)"""

ORACLE_SQL |= {
    "messages_accepted": _with(_MESSAGES, """
SELECT "timestamp", sender_bic, receiver_bic, amount, currency, msg_type FROM judged WHERE reasons = ''"""),
    "messages_rejected": _with(_MESSAGES, """
SELECT "timestamp" AS received, reasons, coalesce(kind <> 1, true) AS is_long FROM judged WHERE reasons <> ''"""),
}
