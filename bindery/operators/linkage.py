"""Exact record linkage: normalised keys, cascades, patches and provenance."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindery.functions.isbn import norm_isbn10_loose, norm_isbn13_loose
from bindery.functions.text import first_author_key, norm_author, norm_title, strip
from bindery.operators.bloom import anti_join
from bindery.operators.keyed import hot_keys, keep_best_per_key, lookup_join
from bindery.operators.projection import coalesce_blank_aware
from bindery.session import materialize


def keyed_left_join(
    base: DataFrame,
    right: DataFrame,
    base_keys: Sequence[Column],
    right_keys: Sequence[Column],
    values: Sequence[str],
    order: Sequence[Column],
    suffix: str = "_right",
    row_id: Sequence[str] | None = None,
) -> DataFrame:
    """Left join on computed keys: null right keys dropped, one right row per key (first in order),
    clashing value names get a suffix. The base keeps its rows and its row count."""
    names = [f"_key{i}" for i in range(len(base_keys))]
    r = right.withColumns(dict(zip(names, right_keys))).dropna(subset=names)
    renamed = {v: v + suffix for v in values if v in base.columns}
    r = keep_best_per_key(r, names, order).select(
        *names, *[F.col(v).alias(renamed.get(v, v)) for v in values]
    )
    b = base.withColumns(dict(zip(names, base_keys)))
    return lookup_join(b, r, names, row_id=row_id).drop(*names)


def join_isbn10(base, right, base_col, right_col, values, order, suffix="_right", row_id=None):
    return keyed_left_join(
        base,
        right,
        [norm_isbn10_loose(F.col(base_col))],
        [norm_isbn10_loose(F.col(right_col))],
        values,
        order,
        suffix,
        row_id,
    )


def join_isbn13(base, right, base_col, right_col, values, order, suffix="_right", row_id=None):
    return keyed_left_join(
        base,
        right,
        [norm_isbn13_loose(F.col(base_col))],
        [norm_isbn13_loose(F.col(right_col))],
        values,
        order,
        suffix,
        row_id,
    )


def author_key(df: DataFrame, author: str) -> Column:
    """First list item or the text itself, normalised."""
    is_list = dict(df.dtypes)[author].startswith("array")
    return first_author_key(F.col(author)) if is_list else norm_author(F.col(author))


def join_title_author(
    base: DataFrame,
    right: DataFrame,
    base_title: str,
    base_author: str,
    right_title: str,
    right_author: str,
    values: Sequence[str],
    order: Sequence[Column],
    *,
    year: str | None = None,
    right_year: str | None = None,
    tolerance: int = 5,
    row_id: Sequence[str] | None = None,
) -> DataFrame:
    """Left join on normalised (title, first author). Keys are never null, so blank keys match.

    With year columns a match is accepted only if the right year is null or within the tolerance.
    """
    carried = [*values, right_year] if year and right_year and right_year not in values else list(values)
    joined = keyed_left_join(
        base,
        right,
        [norm_title(F.col(base_title)), author_key(base, base_author)],
        [norm_title(F.col(right_title)), author_key(right, right_author)],
        carried,
        order,
        row_id=row_id,
    )
    if not (year and right_year):
        return joined
    names = {v: v + "_right" if v in base.columns else v for v in carried}
    near = F.col(names[right_year]).isNull() | (
        F.abs(F.col(names[right_year]) - F.col(year)) <= tolerance
    )
    out = joined.withColumn("_near", F.coalesce(near, F.lit(False)))
    out = out.withColumns({names[v]: F.when(F.col("_near"), F.col(names[v])) for v in carried})
    extra = [names[right_year]] if right_year not in values else []
    return out.drop("_near", *extra)


def match_rate(joined: DataFrame, value: str) -> DataFrame:
    """Matched and total rows, judged by one right value column."""
    return joined.agg(
        F.count(value).alias("n_matched"),
        F.count("*").alias("n_total"),
    ).withColumn("match_share", F.try_divide("n_matched", "n_total"))


def exact_key_merge(
    base: DataFrame, labels: DataFrame, key: str, order: Sequence[Column], row_id: Sequence[str]
) -> DataFrame:
    """Strongest label row per key, joined many-to-one, with ``match_method``."""
    strongest = keep_best_per_key(labels.filter(F.col(key).isNotNull()), [key], order)
    marked = strongest.withColumn("_hit", F.lit(True))
    joined = lookup_join(base, marked, [key], row_id=row_id)
    method = F.when(F.col("_hit"), "exact_isbn").otherwise("unmatched")
    return joined.withColumn("match_method", method).drop("_hit")


def anti_consumed_labels(labels: DataFrame, merged: DataFrame, key: str) -> DataFrame:
    """Label rows whose key the exact pass did not use; rows without a key stay."""
    used = merged.filter(F.col("match_method") == "exact_isbn").select(key).distinct()
    # Rows without a key, or ruled out by the filter, take no part in the join's shuffle.
    return anti_join(labels, materialize(used, "used-keys"), [key])


def apply_match_patch(
    merged: DataFrame, matches: DataFrame, row_id: str, columns: Sequence[str], label: str
) -> DataFrame:
    """Write the columns of the chosen match into rows that are still unmatched.

    ``matches`` has one row per ``row_id`` with the same column names.
    """
    new = matches.select(row_id, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit"))
    open_row = F.col(label).isNull() & F.coalesce("_hit", F.lit(False))
    patched = merged.join(new, row_id, "left").withColumn("_open", open_row)
    return patched.select(
        *[
            F.when(F.col("_open"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            if c in columns
            else F.when(F.col("_open"), "fuzzy_title_author").otherwise(F.col(c)).alias(c)
            if c == "match_method"
            else F.col(c)
            for c in merged.columns
        ]
    )


@dataclass
class CascadePass:
    """One attempt of a cascade: keys on both sides and the rows it may use."""

    name: str
    right: DataFrame
    base_keys: Callable[[], Sequence[Column]]
    right_keys: Callable[[], Sequence[Column]]


def cascade_join(
    base: DataFrame,
    passes: Sequence[CascadePass],
    values: Sequence[str],
    order: Sequence[Column],
    row_id: str,
) -> DataFrame:
    """Try each pass on the rows all earlier passes left open; ``match_pass`` names the pass.

    Keys of a row that is already matched are nulled, so it takes no part in later joins.
    """
    # The passes run on a narrow table of ids and keys, written once; the base itself is shuffled
    # only for the last join. Hot keys are counted on that table, so the plan grows by one join
    # per pass and not by a copy of all earlier passes.
    names = [[f"_key{p}_{i}" for i in range(len(p_.base_keys()))] for p, p_ in enumerate(passes)]
    all_keys = {n: k for ns, p in zip(names, passes) for n, k in zip(ns, p.base_keys())}
    keyed = materialize(base.select(row_id, *[k.alias(n) for n, k in all_keys.items()]), "cascade-keys")
    out = keyed.withColumns(
        {
            **{v: F.lit(None).cast(passes[0].right.schema[v].dataType) for v in values},
            "match_pass": F.lit(None).cast("string"),
        }
    )
    still_open = F.col("match_pass").isNull()
    for p, ns in zip(passes, names):
        right = p.right.withColumns(dict(zip(ns, p.right_keys()))).dropna(subset=ns)
        right = keep_best_per_key(right, ns, order).select(
            *ns, *[F.col(v).alias(f"_p_{v}") for v in values], F.lit(p.name).alias("_p")
        )
        asking = out.withColumns({n: F.when(still_open, F.col(n)) for n in ns})
        joined = lookup_join(asking, right, ns, hot=hot_keys(keyed, ns), row_id=[row_id])
        out = joined.withColumns(
            {
                **{v: F.coalesce(v, f"_p_{v}") for v in values},
                "match_pass": F.coalesce("match_pass", "_p"),
            }
        ).drop(*ns, "_p", *[f"_p_{v}" for v in values])
    return base.join(out, row_id, "left")


def pass_coverage(joined: DataFrame, passes: Sequence[str]) -> DataFrame:
    """Rows matched after each pass."""
    aggs = []
    for i, _ in enumerate(passes):
        hit = F.col("match_pass").isin(*passes[: i + 1])
        aggs.append(F.count_if(hit).alias(passes[i]))
    return joined.agg(*aggs).unpivot([], passes, "match_pass", "n_matched")


def best_edition_lookup(
    base: DataFrame,
    editions: DataFrame,
    available: DataFrame,
    *,
    edition_id: str,
    base_id: str,
    edition_rank: Column,
    base_keys: Sequence[Column],
    edition_keys: Sequence[Column],
    row_id: str,
) -> DataFrame:
    """Fill a missing id from the best-ranked available edition of the same (title, author)."""
    usable = editions.join(available.select(edition_id).distinct(), edition_id, "left_semi")
    filled = keyed_left_join(
        base,
        usable.select("*", F.col(edition_id).alias("_best")),
        base_keys,
        edition_keys,
        ["_best"],
        [edition_rank.asc(), F.col(edition_id).asc()],
        row_id=[row_id],
    )
    return filled.withColumn(base_id, F.coalesce(base_id, "_best")).drop("_best")


def enrich_by_key(
    base: DataFrame,
    source: DataFrame,
    key: str,
    fill: tuple[str, str] | None = None,
    row_id: Sequence[str] | None = None,
) -> DataFrame:
    """Left enrichment by a key that is unique in ``source``; optionally fill a blank text column."""
    out = lookup_join(base, source, [key], row_id=row_id)
    if fill:
        target, other = fill
        out = out.withColumn(target, coalesce_blank_aware(F.col(target), F.col(other))).drop(other)
    return out


def enrich_description_staged(
    base: DataFrame, key: str, target: str, sources: Sequence[tuple[DataFrame, str]]
) -> DataFrame:
    """First non-blank text over source tables (each unique by key), else ''."""
    out = base
    names = []
    hot = hot_keys(base, [key])
    for i, (table, text) in enumerate(sources):
        names.append(f"_src{i}")
        out = lookup_join(out, table.select(key, F.col(text).alias(f"_src{i}")), [key], hot=hot)
    filled = [F.when(strip(F.col(n)) != "", F.col(n)) for n in names]
    return out.withColumn(target, F.coalesce(*filled, F.lit(""))).drop(*names)


def attach_rank_features(
    base: DataFrame, features: DataFrame, key: str, row_id: Sequence[str] | None = None
) -> DataFrame:
    return lookup_join(base, features, [key], row_id=row_id)


def adaptation_join(
    base: DataFrame,
    adaptations: DataFrame,
    base_title: str,
    base_author: str,
    *,
    book_title: str = "book_title",
    movie_title: str = "movie_title",
    author: str = "author",
    row_id: Sequence[str] | None = None,
) -> DataFrame:
    """0/1 flag: an adaptation has this title (book title, else movie title) and author."""
    a = adaptations.select(F.coalesce(book_title, movie_title).alias("_title"), F.col(author).alias("_author"))
    a = a.distinct().withColumn("adapted_to_screen", F.lit(1))
    joined = join_title_author(
        base, a, base_title, base_author, "_title", "_author", ["adapted_to_screen"],
        [F.col("_title"), F.col("_author")], row_id=row_id,
    )
    return joined.withColumn("adapted_to_screen", F.coalesce("adapted_to_screen", F.lit(0)))


def join_features_labels(features: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    return features.join(labels, key, "inner")


def lookup_by_composite_key(
    base: DataFrame, table: DataFrame, keys: Sequence[str], value: str, row_id: Sequence[str]
) -> DataFrame:
    """Bring a per-key value back to each row; missing gives 0."""
    joined = lookup_join(base, table.select(*keys, value), keys, row_id=row_id)
    return joined.withColumn(value, F.coalesce(value, F.lit(0)))
