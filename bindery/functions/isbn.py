"""ISBN cleaning, check digits, conversion and key building as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bindery.functions.binding import bound
from bindery.functions.text import clean_missing_text, strip


def _digit(c: Column, i: int) -> Column:
    return F.substring(c, i, 1).try_cast("int")


def _weighted(c: Column, weights: list[int]) -> Column:
    total = F.lit(0)
    for i, w in enumerate(weights, start=1):
        total = total + _digit(c, i) * w
    return total


def isbn10_check_digit(first9: Column) -> Column:
    """Modulus-11 digit of nine digits; 10 is written 'X'."""
    value = F.pmod(-_weighted(first9, list(range(10, 1, -1))), F.lit(11))
    return F.substring(F.lit("0123456789X"), value + 1, F.lit(1))


def isbn13_check_digit(first12: Column) -> Column:
    """Modulus-10 digit of twelve digits with weights 1 and 3."""
    return F.pmod(-_weighted(first12, [1, 3] * 6), F.lit(10)).cast("string")


def _with_check_digit(first9: Column) -> Column:
    first12 = F.concat(F.lit("978"), first9)
    return F.concat(first12, isbn13_check_digit(first12))


def _keep_digits_and_x(c: Column) -> Column:
    return F.regexp_replace(F.upper(c), "[^0-9X]", "")


def _valid10(s: Column) -> Column:
    shaped = s.rlike("^[0-9]{9}[0-9X]$")
    return F.coalesce(shaped & (isbn10_check_digit(s) == F.substring(s, 10, 1)), F.lit(False))


def _valid13(s: Column) -> Column:
    shaped = s.rlike("^[0-9]{13}$")
    return F.coalesce(shaped & (isbn13_check_digit(s) == F.substring(s, 13, 1)), F.lit(False))


def is_valid_isbn10(c: Column) -> Column:
    return bound(_keep_digits_and_x(clean_missing_text(c)), _valid10)


def is_valid_isbn13(c: Column) -> Column:
    return bound(F.regexp_replace(clean_missing_text(c), "[^0-9]", ""), _valid13)


def clean_isbn10_padded(c: Column) -> Column:
    """The first valid of: the text as it is, the text left-padded with zeros to ten characters."""

    def first_valid(s: Column) -> Column:
        padded = F.when(F.length(s).between(1, 9), F.lpad(s, 10, "0"))
        return F.coalesce(F.when(_valid10(s), s), bound(padded, lambda p: F.when(_valid10(p), p)))

    return bound(_keep_digits_and_x(clean_missing_text(c)), first_valid)


def isbn10_to_13_valid(c: Column) -> Column:
    """ISBN-13 of a valid ISBN-10, else null."""
    s = _keep_digits_and_x(clean_missing_text(c))
    return bound(s, lambda x: F.when(_valid10(x), _with_check_digit(F.substring(x, 1, 9))))


def clean_isbn13_valid(c: Column) -> Column:
    """Digits of a valid ISBN-13, else null."""
    s = F.regexp_replace(clean_missing_text(c), "[^0-9]", "")
    return bound(s, lambda x: F.when(_valid13(x), x))


def clean_isbn13_len(c: Column) -> Column:
    """Digits without a trailing '.0'; 13 of them, without a check-digit test."""
    s = F.regexp_replace(F.regexp_replace(strip(c), r"\.0$", ""), "[^0-9]", "")
    return F.when(F.length(s) == 13, s)


def norm_isbn13_loose(c: Column) -> Column:
    """Part before the first point, digits and X only, accepted at length 13."""
    s = _keep_digits_and_x(F.substring_index(F.trim(c), ".", 1))
    return bound(s, lambda x: F.when(F.length(x) == 13, x))


def norm_isbn10_loose(c: Column) -> Column:
    """Part before the first point, digits and X only, zero-padded, accepted at length 10."""
    s = _keep_digits_and_x(F.substring_index(F.trim(c), ".", 1))
    return bound(s, lambda x: F.when(F.length(x) <= 10, F.lpad(x, 10, "0")))


def _loose13(x: Column) -> Column:
    fits = (F.length(x) == 10) & x.rlike("^[0-9]{9}")
    return F.when(fits, _with_check_digit(F.substring(x, 1, 9)))


def isbn10_to_13_loose(c: Column) -> Column:
    """Conversion without validating the ISBN-10; null if the first nine are not digits."""
    return bound(c, _loose13)


def oclc_isbn_loose(c: Column) -> Column:
    """ISBN-13 of a mixed column by length alone."""
    return bound(_keep_digits_and_x(c), lambda x: F.when(F.length(x) == 13, x).otherwise(_loose13(x)))


def split_mixed_isbn(c: Column) -> tuple[Column, Column]:
    """(ISBN-10, ISBN-13) of a mixed column, without padding."""
    s = _keep_digits_and_x(F.substring_index(c, ".", 1))
    ten = bound(s, lambda x: F.when(F.length(x) == 10, x))
    return ten, bound(s, lambda x: F.when(F.length(x) == 13, x).otherwise(_loose13(x)))


def extract_isbn_candidates(c: Column) -> Column:
    """ISBN-13-like, then ISBN-10-like digit runs of a free text, each once, in order."""
    s = F.regexp_replace(F.upper(clean_missing_text(c)), r"[\s\-]", "")
    thirteen = F.regexp_extract_all(s, F.lit(r"97[89]\d{10}"), F.lit(0))
    ten = F.regexp_extract_all(s, F.lit(r"(?<!\d)\d{1,9}[\dX](?!\d)"), F.lit(0))
    return F.coalesce(F.array_distinct(F.concat(thirteen, ten)), F.array().cast("array<string>"))


def oclc_to_isbn13(c: Column) -> Column:
    """The first candidate that is a valid ISBN-13, or a valid (padded) ISBN-10 as ISBN-13."""
    as13 = F.transform(
        extract_isbn_candidates(c),
        lambda x: F.coalesce(F.when(_valid13(x), x), _key_from_isbn10(x)),
    )
    return F.get(F.filter(as13, lambda x: x.isNotNull()), F.lit(0))


def build_isbn_key(isbn10: Column, isbn13: Column) -> Column:
    """Key from the ISBN-10 column, else from a valid ISBN-13 column."""
    return F.coalesce(_key_from_isbn10(isbn10), clean_isbn13_valid(isbn13))


def _key_from_isbn10(c: Column) -> Column:
    return bound(
        clean_isbn10_padded(c), lambda x: F.when(x.isNotNull(), _with_check_digit(F.substring(x, 1, 9)))
    )
