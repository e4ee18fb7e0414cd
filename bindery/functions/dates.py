"""Publication month from mixed date text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bindery.functions.binding import bound

# Accepted date patterns, month first as in the source texts, each with its shape.
# A pattern is only tried on text of its shape, since a failed parse costs far more than a match.
DATE_PATTERNS = {
    "M/d/yy": r"^\d{1,2}/\d{1,2}/\d{2}$",
    "M/d/yyyy": r"^\d{1,2}/\d{1,2}/\d{4}$",
    "MMMM d yyyy": r"^[A-Za-z]{3,} \d{1,2} \d{4}$",
    "MMM d yyyy": r"^[A-Za-z]{3} \d{1,2} \d{4}$",
    "MMMM d, yyyy": r"^[A-Za-z]{3,} \d{1,2}, \d{4}$",
    "MMM d, yyyy": r"^[A-Za-z]{3} \d{1,2}, \d{4}$",
    "MMMM yyyy": r"^[A-Za-z]{3,} \d{4}$",
    "MMM yyyy": r"^[A-Za-z]{3} \d{4}$",
    "d MMMM yyyy": r"^\d{1,2} [A-Za-z]{3,} \d{4}$",
    "d MMM yyyy": r"^\d{1,2} [A-Za-z]{3} \d{4}$",
    "yyyy-M-d": r"^\d{4}-\d{1,2}-\d{1,2}$",
    "yyyy-M": r"^\d{4}-\d{1,2}$",
    "yyyy/M/d": r"^\d{4}/\d{1,2}/\d{1,2}$",
    "M-d-yyyy": r"^\d{1,2}-\d{1,2}-\d{4}$",
    # day first, for dates that have no such month
    "d/M/yy": r"^\d{1,2}/\d{1,2}/\d{2}$",
    "d/M/yyyy": r"^\d{1,2}/\d{1,2}/\d{4}$",
    "d-M-yyyy": r"^\d{1,2}-\d{1,2}-\d{4}$",
    "yyyy-MM-dd HH:mm:ss": r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$",
}


def pub_month(c: Column) -> Column:
    """Month 1..12, or 0 when it is missing (also when only a year is given).

    Reads tuple text such as ``('6', '1', '2006')``, drops ordinal endings ('6th') and then tries
    the date patterns in order.
    """
    s = F.trim(c)
    is_tuple = s.startswith("(") & s.endswith(")")
    first = F.regexp_extract(s, r"^\(\s*['\"]?(\d{1,2})['\"]?\s*,", 1).try_cast("int")
    plain = F.regexp_replace(s, r"(\d+)(st|nd|rd|th)", "$1")

    def parsed(text: Column) -> Column:
        return F.coalesce(
            *[
                F.when(text.rlike(shape), F.month(F.try_to_timestamp(text, F.lit(pattern))))
                for pattern, shape in DATE_PATTERNS.items()
            ]
        )

    month = F.when(is_tuple, F.when(first.between(1, 12), first)).otherwise(bound(plain, parsed))
    return F.coalesce(month, F.lit(0))


def pub_month_features(c: Column, one_hot: bool = True) -> dict[str, Column]:
    month = pub_month(c)
    out = {"pub_month": month, "pub_month_missing": (month == 0).cast("int")}
    if one_hot:
        out |= {f"pub_month_{m}": (month == m).cast("int") for m in range(1, 13)}
    return out
