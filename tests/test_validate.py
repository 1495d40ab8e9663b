import pytest
from pyspark.sql import functions as F

from paylens.config import BIC_PATTERN, FLAG_COLUMNS, RAW_COLUMNS, VALID_CURRENCIES, VALID_MESSAGE_TYPES
from paylens.operators import clean, validate
from tests.conftest import AS_OF, FUTURE, INVALID8, VALID5

BASE = ("2024-12-01 10:30:00.000000", "ORIODE4BXXX", "LYRAFR2PXXX", 1000.00, "USD", "MT103")


def run(raw, rows, **kw):
    return raw(rows).transform(clean, as_of=AS_OF, **kw).transform(validate, as_of=AS_OF)


def one(raw, **changes):
    row = dict(zip(RAW_COLUMNS, BASE)) | changes
    return run(raw, [tuple(row[c] for c in RAW_COLUMNS)]).first()


def test_clean_adds_metadata_and_parses(raw):
    df = raw(VALID5).transform(clean, as_of=AS_OF)
    assert df.columns == list(RAW_COLUMNS) + ["processing_timestamp", "year", "month", "day"]
    r = df.orderBy("timestamp").first()
    assert (r.year, r.month, r.day) == (2024, 3, 11)
    assert str(r.timestamp) == "2024-03-11 08:05:10"
    assert str(r.processing_timestamp) == AS_OF


def test_clean_trims_spaces_only(raw):
    r = raw([("2024-12-01 10:30:00.000000", "  ORIODE4BXXX ", "\tLYRAFR2PXXX", 1.0, " USD ", "MT103 ")]) \
        .transform(clean).first()
    assert r.sender_bic == "ORIODE4BXXX"
    assert r.receiver_bic == "\tLYRAFR2PXXX"
    assert (r.currency, r.msg_type) == ("USD", "MT103")


def test_unparseable_timestamp_is_null_not_error(raw):
    r = run(raw, [("not-a-date", "ORIODE4BXXX", "LYRAFR2PXXX", 1.0, "USD", "MT103"),
                  ("2024-02-30 10:00:00.000000", "ORIODE4BXXX", "LYRAFR2PXXX", 1.0, "USD", "MT103")]).collect()
    assert all(x.timestamp is None and x.has_nulls and not x.is_valid for x in r)
    assert all(x.year is None for x in r)


def test_strict_timestamp_parse_fails_query(raw, spark):
    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        pytest.skip("strict parsing raises only under ANSI mode")
    with pytest.raises(Exception):
        raw([("not-a-date", "ORIODE4BXXX", "LYRAFR2PXXX", 1.0, "USD", "MT103")]).transform(clean, strict=True).collect()


def test_validation_columns_and_all_valid(raw):
    df = run(raw, VALID5)
    assert df.columns[-len(FLAG_COLUMNS):] == list(FLAG_COLUMNS)
    rows = df.collect()
    assert [r.quality_score for r in rows] == [1.0] * 5
    assert all(r.is_valid for r in rows)


@pytest.mark.parametrize(
    "change,flag,value",
    [
        ({"amount": None}, "has_nulls", True),
        ({"amount": -1000.0}, "is_amount_valid", False),
        ({"sender_bic": "INVALID"}, "is_sender_bic_valid", False),
        ({"currency": "XXX"}, "is_currency_valid", False),
        ({"timestamp": FUTURE}, "is_timestamp_valid", False),
        ({"amount": 15_000_000.0}, "is_high_value", True),
        ({"msg_type": "MT999"}, "is_msg_type_valid", False),
    ],
)
def test_single_rule(raw, change, flag, value):
    assert one(raw, **change)[flag] is value


def test_single_failure_stays_valid_two_failures_invalid(raw):
    r = one(raw, currency="XYZ")
    assert r.quality_score == pytest.approx(6 / 7) and r.is_valid
    r = one(raw, currency="XYZ", msg_type="MT999")
    assert r.quality_score == pytest.approx(5 / 7) and not r.is_valid


@pytest.mark.parametrize(
    "field,score",
    [("timestamp", None), ("sender_bic", None), ("receiver_bic", None), ("amount", 5 / 7),
     ("currency", None), ("msg_type", None)],
)
def test_null_truth_table(raw, field, score):
    r = one(raw, **{field: None})
    assert r.has_nulls is (field != "msg_type")
    assert (r.quality_score is None) if score is None else r.quality_score == pytest.approx(score)
    assert r.is_valid is False


def test_high_value_boundary(raw):
    rows = [BASE[:3] + (a,) + BASE[4:] for a in (9_999_999.99, 10_000_000.00, 10_000_000.01)]
    assert run(raw, rows).where("is_high_value").count() == 1


def test_nan_amount_passes_amount_check(raw):
    r = one(raw, amount=float("nan"))
    assert r.is_amount_valid and r.is_high_value


def test_invalid8_flags(raw):
    rows = run(raw, INVALID8).collect()
    assert [r.is_valid for r in rows] == [True, True, True, True, True, False, True, True]


def test_empty_input(raw):
    assert run(raw, []).count() == 0


def test_bic_pattern_in_spark(spark):
    good = ["ORIODE4B", "ORIODE4BXXX", "LYRAFR2P001", "VEGASE22ABC", "ZZZZZZ99", "ALPSCH0A9Z9"]
    bad = ["", "ORIODE4", "ORIODE4BX", "ORIODE4BXXXX", "0RIODE4BXXX", "ORIO4E4BXXX", "oriode4bxxx", "ORIODE-BXXX", " ORIODE4B"]
    df = spark.createDataFrame([(b,) for b in good + bad], "b string")
    got = {r.b: r.ok for r in df.select("b", F.col("b").rlike(BIC_PATTERN).alias("ok")).collect()}
    assert all(got[b] for b in good) and not any(got[b] for b in bad)


def test_fixed_lists():
    assert {"USD", "EUR", "GBP", "JPY"} <= set(VALID_CURRENCIES) and len(VALID_CURRENCIES) == 12
    assert {"MT103", "MT202", "MT950", "MT940"} == set(VALID_MESSAGE_TYPES)
