"""Typing and cleaning of raw payment rows (raw -> clean)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.config import TIMESTAMP_FORMAT
from paylens.functions.rules import as_of_column, parse_timestamp

TRIMMED_COLUMNS = ("sender_bic", "receiver_bic", "currency", "msg_type")


def clean(
    df: DataFrame,
    as_of: Column | str | None = None,
    strict: bool = False,
    fmt: str = TIMESTAMP_FORMAT,
) -> DataFrame:
    """Parse ``timestamp``, trim the four text fields, add processing metadata.

    Adds ``processing_timestamp`` (``as_of`` or the query's current time) and
    the ``year``/``month``/``day`` partition keys of the payment time (NULL
    when the time is missing or unparseable). One projection, no shuffle.
    """
    typed = df.withColumns(
        {"timestamp": parse_timestamp("timestamp", fmt, strict)}
        | {c: F.trim(F.col(c)) for c in TRIMMED_COLUMNS}
    )
    return typed.withColumns({
        "processing_timestamp": as_of_column(as_of),
        "year": F.year("timestamp"),
        "month": F.month("timestamp"),
        "day": F.dayofmonth("timestamp"),
    })
