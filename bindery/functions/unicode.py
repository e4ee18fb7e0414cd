"""Unicode normal forms. Spark has no built-in for them, so one Arrow function handles them, and
only text with non-ASCII characters is sent to it."""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Send the functions themselves, so that executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_NON_ASCII = r"[^\x00-\x7F]"


@F.pandas_udf(StringType())
def _nfd(text: pd.Series) -> pd.Series:
    return text.str.normalize("NFD")


@F.pandas_udf(StringType())
def _nfkd(text: pd.Series) -> pd.Series:
    return text.str.normalize("NFKD")


def _only_non_ascii(text: Column, fn) -> Column:
    return F.coalesce(fn(F.when(text.rlike(_NON_ASCII), text)), text)


def strip_diacritics(text: Column) -> Column:
    """Decompose and drop combining marks: 'é' becomes 'e', 'ß' stays."""
    return F.regexp_replace(_only_non_ascii(text, _nfd), r"\p{Mn}+", "")


def fold_to_ascii(text: Column) -> Column:
    """Compatibility-decompose and drop everything outside ASCII."""
    return F.regexp_replace(_only_non_ascii(text, _nfkd), f"{_NON_ASCII}+", "")
