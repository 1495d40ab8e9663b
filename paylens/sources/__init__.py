"""Sources: CSV and Parquet payment readers, the test-data view, the generator."""

from paylens.sources.fixture import FIXTURE_AS_OF, raw_payments, validated_payments
from paylens.sources.payments import read_payments_csv, read_processed, with_row_count

__all__ = [
    "FIXTURE_AS_OF", "raw_payments", "validated_payments",
    "read_payments_csv", "read_processed", "with_row_count",
]
