"""Row-level column expressions: parsing, the seven quality checks, derived keys.

All of these are plain :class:`~pyspark.sql.Column` builders over built-in
functions, so they stay inside whole-stage codegen and Catalyst can fold and
push them like any other predicate.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from paylens.config import (
    BIC_PATTERN,
    HIGH_VALUE_AMOUNT,
    TIMESTAMP_FORMAT,
    VALID_CURRENCIES,
    VALID_MESSAGE_TYPES,
    VALIDITY_THRESHOLD,
)

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_of_column(as_of: ColumnOrName | None = None) -> Column:
    """The "now" used by the future-timestamp check.

    ``None`` means the query's ``current_timestamp()`` (read once per query, as
    Spark does); a string is parsed as a session-zone timestamp literal.
    """
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, str):
        return F.lit(as_of).cast("timestamp")
    return as_of


def parse_timestamp(c: ColumnOrName, fmt: str = TIMESTAMP_FORMAT, strict: bool = False) -> Column:
    """Text to ``timestamp``. Unparseable text becomes NULL unless ``strict``.

    With ``strict=True`` a single bad value fails the query (ANSI behaviour of
    ``to_timestamp``); the default keeps the row and lets the null checks
    reject it.
    """
    if strict:
        return F.to_timestamp(_col(c), fmt)
    return F.try_to_timestamp(_col(c), F.lit(fmt))


def any_null(cols: Iterable[ColumnOrName]) -> Column:
    """True when any column is NULL; never NULL itself."""
    return reduce(lambda a, b: a | b, [_col(c).isNull() for c in cols])


def amount_is_valid(c: ColumnOrName = "amount") -> Column:
    """``amount > 0``; NULL amount counts as a failed check (false, not NULL)."""
    return F.when(_col(c) > 0, F.lit(True)).otherwise(F.lit(False))


def bic_is_valid(c: ColumnOrName, pattern: str = BIC_PATTERN) -> Column:
    """Regex check of a BIC. NULL stays NULL (three-valued logic)."""
    return _col(c).rlike(pattern)


def currency_is_valid(c: ColumnOrName = "currency", allowed: Iterable[str] = VALID_CURRENCIES) -> Column:
    return _col(c).isin(list(allowed))


def msg_type_is_valid(c: ColumnOrName = "msg_type", allowed: Iterable[str] = VALID_MESSAGE_TYPES) -> Column:
    return _col(c).isin(list(allowed))


def timestamp_not_future(c: ColumnOrName = "timestamp", as_of: ColumnOrName | None = None) -> Column:
    return _col(c) <= as_of_column(as_of)


def is_high_value(c: ColumnOrName = "amount", limit: float = HIGH_VALUE_AMOUNT) -> Column:
    """Strictly above ``limit``; NULL amount is not high value."""
    return F.when(_col(c) > limit, F.lit(True)).otherwise(F.lit(False))


def score_points(flags: Iterable[ColumnOrName]) -> Column:
    """Number of passed checks as int; NULL if any check is NULL."""
    return reduce(lambda a, b: a + b, [_col(f).cast("int") for f in flags])


def quality_score(flags: Iterable[ColumnOrName]) -> Column:
    """Passed checks divided by the number of checks (double)."""
    flags = list(flags)
    return score_points(flags) / F.lit(float(len(flags)))


def is_valid(score: ColumnOrName = "quality_score", threshold: float = VALIDITY_THRESHOLD) -> Column:
    """Score reaches the threshold; a NULL score is invalid (false, not NULL)."""
    return F.when(_col(score) >= threshold, F.lit(True)).otherwise(F.lit(False))


def country_of(bic: ColumnOrName) -> Column:
    """Characters 5-6 of a BIC, unchecked (malformed BICs give junk codes)."""
    return _col(bic).substr(5, 2)
