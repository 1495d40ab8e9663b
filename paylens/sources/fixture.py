"""Payments derived from the TPC-H style test tables.

The test data holds no payments, so one payment is made per ``lineitem`` row,
with sender fields from the order's customer and receiver fields from the
supplier. Every rule is a pure function of the joined row, so the result is
deterministic and the same rules are written as SQL for the DuckDB oracle
(:mod:`paylens.plans.oracle`). Key ``k`` is ``l_orderkey``, ``p`` is
``l_extendedprice``; the first matching rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.config import TIMESTAMP_FORMAT, VALID_CURRENCIES, VALID_MESSAGE_TYPES

# --- Fixed values of the test-data mapping (must match the oracle SQL). ---
BANK_CODES = "ORIOLYRAVEGANORDALPS"  # 5 invented banks x 4 letters
COUNTRY_CODES = "USGBDEFRJPCNAUCABRINCHSENZITESNLBEPTIEDKNOFIPLATSG"  # nation key 0..24
CURRENCY_CODES = "".join(VALID_CURRENCIES)
MSG_TYPE_CODES = "".join(VALID_MESSAGE_TYPES)
#: Fixed "now" for the future-timestamp check on this data.
FIXTURE_AS_OF = "2001-06-01 00:00:00"
# --- end of fixed values ---


def _pick(codes: str, index: Column, width: int) -> Column:
    return F.substr(F.lit(codes), index * width + 1, F.lit(width))


def _bic_base(key: Column, nation: Column) -> Column:
    return F.concat(
        _pick(BANK_CODES, key % 5, 4),
        _pick(COUNTRY_CODES, nation, 2),
        F.lpad((key % 20).cast("string"), 2, "0"),
        F.lit("XXX"),
    )


#: Columns the mapping reads, with their types (the same at every scale factor).
#: Declaring them skips a footer-reading inference job per table and per query.
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_extendedprice DOUBLE, "
                "l_shipdate TIMESTAMP_NTZ",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT",
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "supplier": "s_suppkey BIGINT, s_nationkey INT",
}


def payment_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four input tables, read with only the columns the mapping uses."""
    return {
        name: spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet")
        for name, schema in TABLE_SCHEMAS.items()
    }


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw payments (the CSV schema: all text except the amount), one per line item.

    Each side of the final join derives its own fields first: the order side
    (``o_orderkey`` is the same key ``k``) builds the sender text from the
    customer, the line-item side builds everything else with the supplier.
    The final equi-join on the order key then only pairs finished columns.

    Join order is chosen by hand: ``orders`` meets ``customer`` first (the
    narrow side, a quarter of the line items), line items meet suppliers
    (AQE broadcasts ``supplier`` while its measured size is under the
    broadcast threshold, otherwise both sides shuffle on the supplier key),
    so ``lineitem`` is shuffled at most twice. AQE's skew-join split covers a
    hot order or supplier key.
    """
    t = payment_tables(spark, sf_dir)
    ko = F.col("o_orderkey")
    sender = _bic_base(F.col("c_custkey"), F.col("c_nationkey"))
    senders = (
        t["orders"]
        .join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
        .select(
            ko.alias("_sender_key"),
            F.when(ko % 37 == 0, F.lit(None).cast("string"))
            .when(ko % 13 == 0, F.concat(F.lit("INVALID"), F.lpad((ko % 1000).cast("string"), 8, "A")))
            .when(ko % 7 == 0, F.concat(F.lit("  "), sender, F.lit(" ")))
            .otherwise(sender)
            .alias("sender_bic"),
        )
    )
    k, p = F.col("l_orderkey"), F.col("l_extendedprice")
    receiver = _bic_base(F.col("s_suppkey"), F.col("s_nationkey"))
    midday = F.timestamp_add("SECOND", F.lit(43200) + k % 36000, F.col("l_shipdate"))
    items = (
        t["lineitem"]
        .join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            k.alias("_item_key"),
            F.when(k % 43 == 0, F.lit(None).cast("string"))
            .when(k % 47 == 0, F.lit("not-a-date"))
            .otherwise(F.date_format(midday, TIMESTAMP_FORMAT))
            .alias("timestamp"),
            F.when(k % 19 == 0, F.lower(receiver)).otherwise(receiver).alias("receiver_bic"),
            F.when(k % 31 == 0, F.lit(None).cast("double"))
            .when(k % 17 == 0, -p)
            .when(k % 211 == 0, p * 1000)
            .otherwise(p)
            .alias("amount"),
            F.when(k % 23 == 0, F.lit("XYZ"))
            .otherwise(_pick(CURRENCY_CODES, F.col("l_suppkey") % 12, 3))
            .alias("currency"),
            F.when(k % 41 == 0, F.lit(None).cast("string"))
            .when(k % 29 == 0, F.lit("MT999"))
            .otherwise(_pick(MSG_TYPE_CODES, F.col("l_linenumber") % 4, 5))
            .alias("msg_type"),
        )
    )
    return items.join(senders, F.col("_item_key") == F.col("_sender_key")).select(
        "timestamp", "sender_bic", "receiver_bic", "amount", "currency", "msg_type"
    )


def validated_payments(spark: SparkSession, sf_dir: str, as_of: str = FIXTURE_AS_OF) -> DataFrame:
    """Raw payments run through :func:`clean` and :func:`validate` at ``as_of``."""
    from paylens.operators.clean import clean
    from paylens.operators.validate import validate

    return raw_payments(spark, sf_dir).transform(clean, as_of=as_of).transform(validate, as_of=as_of)


def resent_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid payments, and one to three later copies of those whose amount in cents is a multiple of five.

    Copies follow each other in steps of 600 to 6,599 seconds, so some lie
    within an hour of the one before and some do not.
    """
    columns = ["timestamp", "sender_bic", "receiver_bic", "amount", "currency", "msg_type"]
    valid = validated_payments(spark, sf_dir).where("is_valid").select(*columns)
    cents = F.abs(F.round(F.col("amount") * 100)).cast("long")
    copy = F.explode(F.when(cents % 5 == 0, F.sequence(F.lit(0), 1 + cents % 3)).otherwise(F.array(F.lit(0).cast("long"))))
    sent = valid.withColumn("copy", copy)
    again = F.timestamp_add("SECOND", F.col("copy") * (600 + cents % 6000), F.col("timestamp"))
    return sent.withColumn("timestamp", again).select(*columns)


def validity_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One period a sender may pay in per order: from its date, for 1 to 400 days (every 50th order: for 20 years)."""
    t = payment_tables(spark, sf_dir)
    orders = spark.read.schema("o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ").parquet(f"{sf_dir}/orders.parquet")
    key = F.col("o_orderkey")
    days = F.when(key % 50 == 0, 7300).otherwise(key % 400 + 1)
    start = F.col("o_orderdate").cast("timestamp")
    return orders.join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).select(
        _bic_base(F.col("c_custkey"), F.col("c_nationkey")).alias("sender_bic"), key.alias("period_id"),
        start.alias("valid_from"), F.timestamp_add("DAY", days, start).alias("valid_to"),
    )


def payment_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw payments as nested JSON messages beside the time they name; some are cut off or have a wrong type.

    By the amount in cents: of every 50, one is cut in the middle, one has text
    for its amount, one is a list.
    """
    cents = F.abs(F.round(F.col("amount") * 100)).cast("long") % 50
    header = F.struct(F.col("msg_type").alias("type"), F.col("sender_bic").alias("sender"), F.col("receiver_bic").alias("receiver"))
    good = F.to_json(F.struct(header.alias("header"), F.struct(F.col("timestamp").alias("time"), "amount", "currency").alias("payment")))
    wrong = F.to_json(F.struct(header.alias("header"), F.struct(F.col("timestamp").alias("time"), F.lit("much").alias("amount"), "currency").alias("payment")))
    message = (
        F.when(cents == 1, F.substring(good, 1, 40))
        .when(cents == 2, wrong)
        .when(cents == 3, F.concat(F.lit("["), good, F.lit("]")))
        .otherwise(good)
    )
    return raw_payments(spark, sf_dir).select(F.col("timestamp").alias("received"), message.alias("message"))
