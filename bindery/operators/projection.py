"""Row-local projections."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindery.functions.text import strip


def standardize_names(df: DataFrame) -> DataFrame:
    """Lower-cased, stripped column names with spaces as underscores."""
    return df.toDF(*[re.sub(r"\s+", "_", c.strip().lower()) for c in df.columns])


def select_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in order, each once."""
    return df.select(*[c for c in dict.fromkeys(wanted) if c in df.columns])


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns, but leave a source alone whose target name is already taken."""
    return df.withColumnsRenamed({a: b for a, b in names.items() if b not in df.columns})


def coalesce_blank_aware(a: Column, b: Column) -> Column:
    """``a`` unless it is null or blank and ``b`` has text."""
    has_a = F.coalesce(strip(a), F.lit("")) != ""
    has_b = F.coalesce(strip(b), F.lit("")) != ""
    return F.when(~has_a & has_b, b).otherwise(a)


def match_method_case(exact: Column, fuzzy: Column) -> Column:
    return (
        F.when(exact, "exact_isbn").when(fuzzy, "fuzzy_title_author").otherwise("unmatched")
    )


def is_match(method: Column) -> Column:
    return (method != "unmatched").cast("int")


def finalize_labels(
    df: DataFrame, label: str, zero_if_missing: Sequence[str], null_if_negative: Sequence[str]
) -> DataFrame:
    """Missing label becomes 0, counts become 0, and outcome details are null for label 0."""
    positive = F.coalesce(F.col(label), F.lit(0)) == 1
    return df.withColumns(
        {
            **{c: F.when(positive, F.col(c)) for c in null_if_negative if c in df.columns},
            **{c: F.coalesce(F.col(c), F.lit(0)).cast("int") for c in zero_if_missing if c in df.columns},
            label: F.coalesce(F.col(label), F.lit(0)).cast("int"),
        }
    )


def define_target(weeks: Column, best_rank: Column, rank_limit: int = 1000) -> Column:
    """1 if ever listed or ever ranked within the limit, else 0."""
    hit = F.coalesce(weeks > 0, F.lit(False)) | F.coalesce(best_rank <= rank_limit, F.lit(False))
    return hit.cast("int")


def bucket_capped(count: Column, cap: int = 5) -> Column:
    """Counts below the cap as text, the rest as 'cap+'."""
    return F.when(count >= cap, f"{cap}+").otherwise(count.cast("string"))


def capped_domain(cap: int = 5) -> list[str]:
    return [*map(str, range(cap)), f"{cap}+"]


def map_dictionary(c: Column, mapping: Mapping, default=None) -> Column:
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, c), F.lit(default))


def expand_vector(vector: Column, size: int, prefix: str) -> dict[str, Column]:
    return {f"{prefix}{i}": F.get(vector, F.lit(i)) for i in range(size)}


def top_n_dummies(
    df: DataFrame, tags: str, n: int, prefix: str, fit_on: DataFrame | None = None
) -> dict[str, Column]:
    """One boolean per frequent tag. The vocabulary (n rows) is the only thing the driver sees."""
    rows = (
        (df if fit_on is None else fit_on)
        .select(F.explode(tags).alias("_tag"))
        .filter(F.col("_tag").isNotNull())
        .groupBy("_tag")
        .count()
        .orderBy(F.desc("count"), F.asc("_tag"))
        .limit(n)
        .collect()
    )
    out: dict[str, Column] = {}
    for r in rows:
        # Fixed rule: column names of tags. Tags of one name share its column.
        name = prefix + r["_tag"].lower().replace(" ", "_").replace("-", "_")
        has = F.coalesce(F.array_contains(tags, r["_tag"]), F.lit(False))
        out[name] = out[name] | has if name in out else has
    return out
