"""The seven row-level quality checks, the quality score and the validity flag."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.config import (
    BIC_PATTERN,
    HIGH_VALUE_AMOUNT,
    VALID_CURRENCIES,
    VALID_MESSAGE_TYPES,
    VALIDITY_THRESHOLD,
)
from paylens.functions import rules as R

#: Fields whose absence sets ``has_nulls``. ``msg_type`` is deliberately not
#: one of them: a missing message type only fails its own check (as NULL).
NULL_CHECKED_COLUMNS = ("timestamp", "sender_bic", "receiver_bic", "amount", "currency")


def quality_flags(
    as_of: Column | str | None = None,
    currencies: Iterable[str] = VALID_CURRENCIES,
    msg_types: Iterable[str] = VALID_MESSAGE_TYPES,
    high_value: float = HIGH_VALUE_AMOUNT,
    bic_pattern: str = BIC_PATTERN,
) -> dict[str, Column]:
    """Name -> expression of the eight row flags, in output order."""
    return {
        "has_nulls": R.any_null(NULL_CHECKED_COLUMNS),
        "is_amount_valid": R.amount_is_valid("amount"),
        "is_sender_bic_valid": R.bic_is_valid("sender_bic", bic_pattern),
        "is_receiver_bic_valid": R.bic_is_valid("receiver_bic", bic_pattern),
        "is_currency_valid": R.currency_is_valid("currency", currencies),
        "is_msg_type_valid": R.msg_type_is_valid("msg_type", msg_types),
        "is_timestamp_valid": R.timestamp_not_future("timestamp", as_of),
        "is_high_value": R.is_high_value("amount", high_value),
    }


def scored_checks() -> list[Column]:
    """The seven checks that make up the quality score (high value is not one)."""
    return [
        ~F.col("has_nulls"),
        F.col("is_amount_valid"),
        F.col("is_sender_bic_valid"),
        F.col("is_receiver_bic_valid"),
        F.col("is_currency_valid"),
        F.col("is_msg_type_valid"),
        F.col("is_timestamp_valid"),
    ]


def validate(
    df: DataFrame,
    as_of: Column | str | None = None,
    currencies: Iterable[str] = VALID_CURRENCIES,
    msg_types: Iterable[str] = VALID_MESSAGE_TYPES,
    high_value: float = HIGH_VALUE_AMOUNT,
    threshold: float = VALIDITY_THRESHOLD,
    bic_pattern: str = BIC_PATTERN,
) -> DataFrame:
    """Append ``has_nulls`` .. ``is_high_value``, ``quality_score`` and ``is_valid``.

    Three-valued logic is kept on purpose: a NULL BIC, currency, message type
    or timestamp makes its flag NULL, hence the score NULL and the row
    invalid. Catalyst collapses the three projections into one.
    """
    flagged = df.withColumns(quality_flags(as_of, currencies, msg_types, high_value, bic_pattern))
    scored = flagged.withColumn("quality_score", R.quality_score(scored_checks()))
    return scored.withColumn("is_valid", R.is_valid("quality_score", threshold))
