import pytest

from paylens.config import QUALITY_REPORT_KEYS
from paylens.operators import clean, quality_report_dict, validate
from tests.conftest import AS_OF, INVALID8


def validated(raw, rows):
    return raw(rows).transform(clean, as_of=AS_OF).transform(validate, as_of=AS_OF)


def test_invalid8_report(raw):
    rep = quality_report_dict(validated(raw, INVALID8))
    assert list(rep) == list(QUALITY_REPORT_KEYS)
    expected = dict(total_records=8, valid_records=7, invalid_records=1, null_count=1, invalid_amount_count=2,
                    invalid_sender_bic_count=1, invalid_receiver_bic_count=0, invalid_currency_count=1,
                    invalid_msg_type_count=1, future_timestamp_count=1, high_value_count=1)
    assert {k: rep[k] for k in expected} == expected
    assert rep["validity_rate"] == pytest.approx(7 / 8)
    assert rep["avg_quality_score"] == pytest.approx(0.875)


def test_empty_report_is_zero(raw):
    rep = quality_report_dict(validated(raw, []))
    assert rep["total_records"] == 0 and rep["validity_rate"] == 0 and rep["avg_quality_score"] == 0.0


def test_null_flag_not_counted_by_own_counter(raw):
    rows = [("2024-12-01 10:30:00.000000", None, "LYRAFR2PXXX", 1.0, "USD", None)]
    rep = quality_report_dict(validated(raw, rows))
    assert rep["invalid_sender_bic_count"] == 0 and rep["invalid_msg_type_count"] == 0
    assert rep["null_count"] == 1 and rep["valid_records"] == 0
