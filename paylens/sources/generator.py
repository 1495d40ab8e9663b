"""Synthetic raw payments as a parallel, repeatable Spark job.

Every column is a pure function of ``(id, seed, column salt)`` through
MD5, which any engine has, so any id range can be generated on any executor, a retried
task reproduces its rows exactly, and the row count scales with the id
input (``spark.range(n)`` or ids taken from an existing table).

Row recipe: a time in the 30 days before ``as_of`` (whole minutes), two of
five BICs, an amount uniform in [100, 1e6) with 2 decimals, one of four
currencies and three message types. With probability ``anomaly_rate`` the
row is one of five anomaly kinds, drawn uniformly: a high amount in
[1e7, 1e8); a sender ``INVALID`` + 8 random alphanumerics; a time 1-30 days
after ``as_of``; "duplicate", which is a fresh normal row (no copy is made);
or a currency from AUD/CAD/CHF/CNY (all of which pass validation).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.config import TIMESTAMP_FORMAT
from paylens.functions.rules import as_of_column

# --- Fixed values of the generator recipe. ---
GEN_BICS = ("BOFAUS3NXXX", "CHASUS33XXX", "DEUTDEFFXXX", "BARCGB22XXX", "BNPAFRPPXXX")
GEN_CURRENCIES = ("USD", "EUR", "GBP", "JPY")
GEN_MSG_TYPES = ("MT103", "MT202", "MT950")
GEN_RARE_CURRENCIES = ("AUD", "CAD", "CHF", "CNY")
GEN_ANOMALY_KINDS = ("high_amount", "invalid_bic", "future_date", "duplicate", "wrong_currency")
GEN_BIC_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
GEN_WINDOW_MINUTES = 43200  # 30 days
# --- end of fixed values ---

#: Salts of the numbers that nearly every row uses.
EVERY_ROW = range(1, 8)
#: Hex digits of a digest that make a number, and how many such numbers there are.
_DIGITS = 13
_RANGE = float(16**_DIGITS)


def _uniform(seed: int, salt: int) -> Column:
    """Deterministic uniform double in [0, 1) per (id, seed, salt), from a digest of its own."""
    digest = F.md5(F.concat_ws(":", F.col("id").cast("string"), F.lit(str(seed)), F.lit(str(salt))))
    return F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("double") / _RANGE


def _pick(values: tuple[str, ...], u: Column) -> Column:
    idx = (F.floor(u * len(values)) + 1).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx)


def generate_payments(
    spark: SparkSession,
    num_records: int | None = None,
    ids: DataFrame | None = None,
    seed: int = 42,
    anomaly_rate: float = 0.05,
    as_of: Column | str | None = None,
    with_kind: bool = False,
) -> DataFrame:
    """Raw payments (CSV schema), one per id.

    Give either ``num_records`` (ids ``0..n-1`` via ``spark.range``) or an
    ``ids`` DataFrame with a long ``id`` column.
    """
    if ids is None:
        if num_records is None:
            raise ValueError("give num_records or ids")
        ids = spark.range(num_records)
    # the numbers that every row needs are made once, those of rare rows where they are used
    ids = ids.select("id", *[_uniform(seed, salt).alias(f"_u{salt}") for salt in EVERY_ROW])

    def u(salt: int) -> Column:
        return F.col(f"_u{salt}") if salt in EVERY_ROW else _uniform(seed, salt)

    now = as_of_column(as_of)
    start = F.timestamp_add("DAY", F.lit(-30), now)
    minute = F.floor(u(1) * GEN_WINDOW_MINUTES) + 1
    normal_ts = F.timestamp_add("MINUTE", minute, start)
    amount = F.round(F.lit(100.0) + u(4) * (1_000_000 - 100), 2)
    ids = ids.withColumn("_kind", F.when(u(7) < anomaly_rate, _pick(GEN_ANOMALY_KINDS, u(8))))
    kind = F.col("_kind")
    suffix = F.concat_ws(
        "",
        *[F.substr(F.lit(GEN_BIC_ALPHABET), (F.floor(u(20 + i) * 36) + 1).cast("int"), F.lit(1))
          for i in range(8)],
    )
    future_ts = F.timestamp_add("DAY", F.floor(u(9) * 30) + 1, now)
    rows = ids.select(
        F.col("id"),
        F.when(kind == "future_date", future_ts).otherwise(normal_ts).alias("_ts"),
        F.when(kind == "invalid_bic", F.concat(F.lit("INVALID"), suffix))
        .otherwise(_pick(GEN_BICS, u(2)))
        .alias("sender_bic"),
        _pick(GEN_BICS, u(3)).alias("receiver_bic"),
        F.when(kind == "high_amount", F.round(F.lit(1e7) + u(10) * 9e7, 2))
        .otherwise(amount)
        .alias("amount"),
        F.when(kind == "wrong_currency", _pick(GEN_RARE_CURRENCIES, u(11)))
        .otherwise(_pick(GEN_CURRENCIES, u(5)))
        .alias("currency"),
        _pick(GEN_MSG_TYPES, u(6)).alias("msg_type"),
        F.coalesce(kind, F.lit("normal")).alias("anomaly_kind"),
    )
    out = rows.select(
        F.date_format("_ts", TIMESTAMP_FORMAT).alias("timestamp"),
        "sender_bic", "receiver_bic", "amount", "currency", "msg_type",
        *(["anomaly_kind"] if with_kind else []),
    )
    return out
