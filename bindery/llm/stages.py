"""Small helpers shared by the operators: row numbers, written stages, bounded Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindery.session import materialize

SPACES = " \t\n\x0b\f\r"  # the class [\x20\x09-\x0D]
WORD = r"[^\x20\x09-\x0D]+"
BATCH_BYTES = 4 << 20


def keep(df: DataFrame, name: str) -> DataFrame:
    """A written stage in the shared folder, compressed well because it is written once."""
    return materialize(df, name, compression="zstd")


def row_number(row: str | None) -> Column:
    """The caller's unique row number, or one that is fixed when the stage is written."""
    return F.col(row).cast("long") if row else F.monotonically_increasing_id()


def at_most(df: DataFrame, rows: int, *by: str) -> DataFrame:
    """About ``rows`` rows, chosen by the hash of the columns ``by``; all, if there are no more."""
    n = df.count()
    if n <= rows:
        return df
    return df.filter(F.pmod(F.xxhash64(*by), F.lit(1 << 40)) < int((1 << 40) * rows / n))


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the text of one slice stays under ``most`` bytes (one row at least)."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start = held = 0
        for i, n in enumerate(lengths):
            if held and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(lengths):
            yield batch.slice(start)
