"""Cleaning of text, dates, tax ids and phones, all as built-in column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STRICT = "strict"
LENIENT = "lenient"

# One- and two-digit months and days are both read, as in the %Y-%m-%d notation.
_DATE_PATTERN = "yyyy-M-d"


def _check_mode(mode: str) -> None:
    if mode not in (STRICT, LENIENT):
        raise ValueError(f"mode must be {STRICT!r} or {LENIENT!r}, not {mode!r}")


def _parsed_date(text: Column) -> Column:
    return F.try_to_date(text, _DATE_PATTERN)


def _parsed_number(text: Column) -> Column:
    return text.try_cast("bigint")


def bad_date(text: Column) -> Column:
    """True where there is text that is not a date, empty text included."""
    return text.isNotNull() & _parsed_date(text).isNull()


def bad_number(text: Column) -> Column:
    """True where there is text, other than empty, that is not a whole number."""
    return text.isNotNull() & (text != "") & _parsed_number(text).isNull()


def _or_fail(parsed: Column, bad: Column, text: Column, message: str, mode: str) -> Column:
    """``parsed``; in strict mode, a bad text ends the job."""
    if mode == LENIENT:
        return parsed
    failure = F.raise_error(F.concat(F.lit(message + ": "), text))
    return F.when(bad, failure).otherwise(parsed)


def parse_date(text: Column, mode: str = STRICT) -> Column:
    """Date from the whole text. Bad text fails (strict) or gives null (lenient)."""
    _check_mode(mode)
    return _or_fail(_parsed_date(text), bad_date(text), text, "not a date", mode)


def date_prefix(text: Column) -> Column:
    """The first ten characters, where a text with a time has its date."""
    return F.substring(text, 1, 10)


def parse_date_prefix(text: Column, mode: str = STRICT) -> Column:
    """Date from the first ten characters, for text that also carries a time."""
    return parse_date(date_prefix(text), mode)


def truncate(text: Column, length: int) -> Column:
    """The first ``length`` characters."""
    return F.substring(text, 1, length)


def truncate_columns(df: DataFrame, lengths: Mapping[str, int]) -> DataFrame:
    """Cut the named columns in place."""
    return df.withColumns({name: truncate(F.col(name), n) for name, n in lengths.items()})


def text_to_long(text: Column, mode: str = STRICT) -> Column:
    """Whole number from text. Empty text is null in both modes."""
    _check_mode(mode)
    return _or_fail(_parsed_number(text), bad_number(text), text, "not a number", mode)


def last_two(text: Column) -> Column:
    """The last two characters, or all of a shorter text."""
    return F.right(text, F.lit(2))


def all_but_last_two(text: Column) -> Column:
    """The text without its last two characters; empty if there are no more."""
    return F.left(text, F.greatest(F.length(text) - 2, F.lit(0)))


def check_digits(tax_id: Column, mode: str = STRICT) -> Column:
    """Number made of the last two characters."""
    return text_to_long(last_two(tax_id), mode)


def tax_id_root(tax_id: Column, mode: str = STRICT) -> Column:
    """Number made of all but the last two characters."""
    return text_to_long(all_but_last_two(tax_id), mode)


def _full_phone(phone: Column, part: Column) -> Column:
    return F.when(F.length(phone) >= 11, part).otherwise(F.lit(""))


def area_code(phone: Column) -> Column:
    """First two digits of a full phone number, else empty text."""
    return _full_phone(phone, F.substring(phone, 1, 2))


def local_number(phone: Column) -> Column:
    """A full phone number without its first two digits, else empty text."""
    return _full_phone(phone, F.right(phone, F.length(phone) - 2))


def yes_no(flag: Column) -> Column:
    """1 for 'S', 0 for anything else, null included."""
    return F.when(flag == "S", 1).otherwise(0)


def present(value: Column) -> Column:
    """1 where there is a value, else 0."""
    return value.isNotNull().cast("int")


def person_hash(tax_id: Column, salt: str = "") -> Column:
    """Upper-case MD5. Unsalted, tax ids can be found again by trying them all."""
    return F.upper(F.md5(F.concat(F.lit(salt), tax_id) if salt else tax_id))


def month_key(day: Column) -> Column:
    """Year and month as joined digits, without padding."""
    return F.concat(F.year(day).cast("string"), F.month(day).cast("string"))
