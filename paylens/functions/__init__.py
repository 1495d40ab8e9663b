"""Column-level building blocks (row rules and aggregate expressions)."""

from paylens.functions.rules import (
    amount_is_valid,
    any_null,
    as_of_column,
    bic_is_valid,
    country_of,
    currency_is_valid,
    is_high_value,
    is_valid,
    msg_type_is_valid,
    parse_timestamp,
    quality_score,
    score_points,
    timestamp_not_future,
)
from paylens.functions.stats import money_avg, money_stddev, money_sum

__all__ = [
    "amount_is_valid", "any_null", "as_of_column", "bic_is_valid", "country_of",
    "currency_is_valid", "is_high_value", "is_valid", "msg_type_is_valid",
    "parse_timestamp", "quality_score", "score_points", "timestamp_not_future",
    "money_avg", "money_stddev", "money_sum",
]
