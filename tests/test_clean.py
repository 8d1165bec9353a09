from __future__ import annotations

from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from acctmart.functions import clean


def apply(spark, values, function, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    out = df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()
    return [r["out"] for r in out]


def test_dates_from_text(spark):
    got = apply(spark, ["2024-01-05", "2024-1-5", None], clean.parse_date)
    assert got == [date(2024, 1, 5), date(2024, 1, 5), None]


def test_date_prefix_drops_the_time(spark):
    got = apply(spark, ["2024-01-05 23:59:59", "2024-01-05"], clean.parse_date_prefix)
    assert got == [date(2024, 1, 5)] * 2


@pytest.mark.parametrize("text", ["2024-13-01", "05/01/2024", "", "2024-01-05 10:00:00"])
def test_bad_dates_fail_or_give_null(spark, text):
    with pytest.raises(PySparkException, match="not a date"):
        apply(spark, [text], clean.parse_date)
    assert apply(spark, [text], lambda c: clean.parse_date(c, clean.LENIENT)) == [None]


def test_strictness_does_not_depend_on_ansi(spark, settings):
    settings({"spark.sql.ansi.enabled": "false"})
    with pytest.raises(PySparkException):
        apply(spark, ["x"], clean.parse_date)
    with pytest.raises(PySparkException):
        apply(spark, ["x"], clean.text_to_long)


def test_unknown_mode_is_refused():
    with pytest.raises(ValueError):
        clean.parse_date(None, "other")


def test_tax_id_split(spark):
    ids = ["", "7", "42", "12345678901", "12345678000195", None]
    assert apply(spark, ids, clean.check_digits) == [None, 7, 42, 1, 95, None]
    assert apply(spark, ids, clean.tax_id_root) == [
        None, None, None, 123456789, 123456780001, None,
    ]


def test_tax_id_with_other_characters(spark):
    with pytest.raises(PySparkException, match="not a number"):
        apply(spark, ["1234567890X"], clean.check_digits)
    assert apply(spark, ["1X42"], lambda c: clean.tax_id_root(c, clean.LENIENT)) == [None]


def test_phone_split(spark):
    phones = ["11987654321", "1198765432", "119876543210", None, ""]
    assert apply(spark, phones, clean.area_code) == ["11", "", "11", "", ""]
    assert apply(spark, phones, clean.local_number) == ["987654321", "", "9876543210", "", ""]


def test_truncate_counts_characters(spark):
    assert apply(spark, ["ação" * 20, "ab", None], lambda c: clean.truncate(c, 5)) == [
        "açãoa", "ab", None,
    ]


def test_flags_are_never_null(spark):
    assert apply(spark, ["S", "N", "s", None], clean.yes_no) == [1, 0, 0, 0]
    assert apply(spark, ["S", "", None], clean.present) == [1, 1, 0]


def test_person_hash(spark):
    plain, missing = apply(spark, ["12345678901", None], clean.person_hash)
    assert (plain, missing) == ("BFD81EE3ED27AD31C95CA75E21365973", None)
    salted, _ = apply(spark, ["12345678901", None], lambda c: clean.person_hash(c, "s"))
    assert salted != plain


def test_month_key_has_no_padding(spark):
    days = [date(2024, 1, 31), date(2024, 11, 1)]
    assert apply(spark, days, clean.month_key, "date") == ["20241", "202411"]
