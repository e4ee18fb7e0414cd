"""The whole jobs: label a catalogue, build the multi-source table, train and publish a model."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindery.functions.isbn import (
    build_isbn_key,
    isbn10_to_13_loose,
    norm_isbn10_loose,
    norm_isbn13_loose,
    oclc_to_isbn13,
    split_mixed_isbn,
)
from bindery.functions.numbers import coerce_double
from bindery.functions.text import first_author_key, norm_author, norm_text_ascii, norm_title
from bindery.operators import filters, linkage, ml
from bindery.operators.evaluate import compare_models, naive_baselines
from bindery.operators.features import attach_embeddings, lexicon_sentiment
from bindery.operators.fuzzy import FuzzyRule, fuzzy_title_author_join
from bindery.operators.keyed import concat_columns, lookup_join
from bindery.operators.history import agg_weekly_list, rank_features
from bindery.operators.projection import coalesce_blank_aware, expand_vector, finalize_labels, is_match, map_dictionary
from bindery.operators.quality import checked_write, expect_row_count, expect_unique, keeps_keys, label_domain, require
from bindery.plans import models
from bindery.plans.registry import TITLE, messy_isbn, query
from bindery.session import materialize, scratch_path

DETAILS = ["weeks_on_list", "best_rank_achieved", "first_year", "debut_rank"]

# Preferred editions, best first.
EDITION_RANK = {"hardcover": 0, "paperback": 1, "mass market paperback": 2, "kindle edition": 3}


def label_catalogue(books: DataFrame, labels: DataFrame, rule: FuzzyRule = FuzzyRule()) -> DataFrame:
    """Label every book: exact key pass, fuzzy pass on the rest, then final labels and checks.

    ``books``: gb_id, title, authors (array), isbn, isbn13, ... ; ``labels``: label_id, title,
    author, oclc_isbn and the outcome details. Every book stays exactly once.
    """
    # Cleaning takes far more time than reading, and a compact file is read in few tasks; so the rows are dealt
    # out first, and the cleaned ones are written, as the exact pass reads them more than once.
    b = books.repartition("gb_id").withColumns(
        {
            "title_norm": norm_text_ascii(F.col("title")),
            "author_norm": norm_text_ascii(F.array_join("authors", " ")),
            "isbn13_key": build_isbn_key(F.col("isbn"), F.col("isbn13")),
        }
    )
    b = materialize(b, "books")
    lab = materialize(
        labels.repartition("label_id", "title").select(
            "label_id", *DETAILS, F.lit(1).alias("label"),
            F.col("title").alias("label_title"), F.col("author").alias("label_author"),
            norm_text_ascii(F.col("title")).alias("label_title_norm"),
            norm_text_ascii(F.col("author")).alias("label_author_norm"),
            oclc_to_isbn13(F.col("oclc_isbn")).alias("isbn13_key"),
        ),
        "labels",
    )
    order = [F.desc_nulls_last("weeks_on_list"), F.asc_nulls_last("best_rank_achieved"), F.asc("label_id")]
    merged = materialize(linkage.exact_key_merge(b, lab, "isbn13_key", order, ["gb_id"]), "exact")
    open_labels = linkage.anti_consumed_labels(lab, merged, "isbn13_key")
    matches = fuzzy_title_author_join(
        merged.filter("match_method = 'unmatched'"), open_labels,
        base_id="gb_id", base_title="title_norm", base_author="author_norm",
        label_id="label_id", label_title="label_title_norm", label_author="label_author_norm", rule=rule,
    )
    chosen = matches.select("gb_id", "label_id")  # many books may share one label row
    found = lookup_join(chosen, lab.drop("isbn13_key"), ["label_id"], row_id=["gb_id"])
    patched = linkage.apply_match_patch(
        merged, found, "gb_id", ["label", "label_id", *DETAILS, "label_title", "label_author"], "label"
    )
    out = finalize_labels(patched, "label", ["weeks_on_list"], DETAILS[1:])
    out = out.withColumn("is_match", is_match(F.col("match_method")))
    require(expect_unique(books, ["gb_id"]), "a book appears twice")
    checks = [keeps_keys(books, ["gb_id"]), label_domain("label")]
    return checked_write(out, "labelled", checks)[0]


def scope_filters(labelled: DataFrame, first_year: int = 1931) -> DataFrame:
    """Rows the label can apply to; run after linkage, so a dropped book may still use up a label."""
    out = filters.filter_min_year_nullsafe(labelled, "pub_year", first_year)
    out = filters.filter_boxset(out, "title")
    return filters.filter_array_tags(out, "genres", "nonfiction", "fiction")


def canonical_table(
    books: DataFrame,
    shop: DataFrame,
    editions: DataFrame,
    history: DataFrame,
    metadata: DataFrame,
    weekly: DataFrame,
    adaptations: DataFrame,
) -> DataFrame:
    """One row per book with shop values, best edition, rank summary, metadata, labels and adaptation flag."""
    ten = norm_isbn10_loose(F.col("isbn"))
    # As in :func:`label_catalogue`, rows are dealt out before they are cleaned, and cleaned once.
    base = books.repartition("book_id").withColumns(
        {"isbn10": ten, "isbn13": F.coalesce(norm_isbn13_loose(F.col("isbn13")), isbn10_to_13_loose(ten))}
    )
    base = materialize(base, "books")
    keys = [norm_title(F.col("title")), first_author_key(F.col("authors"))]

    shop_values = {"rating": "shop_rating", "reviews_count": "shop_reviews", "final_price": "shop_price", "number_of_sellers": "shop_sellers"}
    s10, s13 = split_mixed_isbn(F.col("ISBN10"))
    s = shop.repartition("asin", "ISBN10").select(
        "asin", s10.alias("_s10"), s13.alias("_s13"), *[coerce_double(F.col(a)).alias(b) for a, b in shop_values.items()]
    )
    s = materialize(s, "shop")
    isbn_pass = partial(linkage.CascadePass, right=s)
    base = linkage.cascade_join(
        base,
        [
            isbn_pass("isbn10", base_keys=lambda: [F.col("isbn10")], right_keys=lambda: [norm_isbn10_loose(F.col("_s10"))]),
            isbn_pass("isbn13", base_keys=lambda: [F.col("isbn13")], right_keys=lambda: [F.col("_s13")]),
        ],
        ["asin", *shop_values.values()], [F.asc("asin")], "book_id",
    ).drop("match_pass")
    base = linkage.best_edition_lookup(
        base, editions, history.select("asin"), edition_id="asin", base_id="asin",
        edition_rank=map_dictionary(F.lower("format"), EDITION_RANK, 99),
        base_keys=keys, edition_keys=[norm_title(F.col("title")), norm_author(F.col("author"))], row_id="book_id",
    )
    base = materialize(base, "canonical")
    asked = base.select("asin").filter("asin is not null")
    base = linkage.attach_rank_features(base, rank_features(history, "asin", "ts", "rank", asked), "asin", ["book_id"])

    meta = metadata.select("isbn13", F.col("description").alias("_description"), "publisher")
    base = linkage.enrich_by_key(base, meta, "isbn13", row_id=["book_id"])
    base = base.withColumn("description", coalesce_blank_aware(F.col("description"), F.col("_description")))
    base = materialize(base.drop("_description"), "canonical")

    listed = agg_weekly_list(weekly, "title_id", "title", "author", "oclc_isbn", "rank", "week")
    listed = materialize(listed.select("title_id", "title", "author", "primary_isbn13", "label", "best_rank", "weeks_on_list"), "listed")
    list_pass = partial(linkage.CascadePass, right=listed)
    base = linkage.cascade_join(
        base,
        [
            list_pass("isbn13", base_keys=lambda: [F.col("isbn13")], right_keys=lambda: [F.col("primary_isbn13")]),
            list_pass(
                "title_author", base_keys=lambda: keys,
                right_keys=lambda: [norm_title(F.col("title")), norm_author(F.col("author"))],
            ),
        ],
        ["label", "best_rank", "weeks_on_list"], [F.asc("title_id")], "book_id",
    )
    base = base.withColumn("label", F.coalesce("label", F.lit(0)))
    out = materialize(linkage.adaptation_join(base, adaptations, "title", "authors", row_id=["book_id"]), "canonical")
    require(expect_row_count(books, out), "the number of books changed")
    return out


def train_final(
    features: DataFrame, labels: DataFrame, *, key: str, label: str, year: str, cutoff: int,
    inputs: Sequence[str], recorded_f1: float, path: str,
) -> DataFrame:
    """Join features and labels, split by year, refit the forest, and publish it behind the gate."""
    rows = linkage.join_features_labels(features, labels.select(key, label, year), key)
    train, test = ml.year_split(rows, year, cutoff)
    metrics, _ = ml.retrain_and_compare(
        lambda r: ml.random_forest(r, inputs, label), train, test, label, recorded_f1, path
    )
    return metrics


def model_comparison(
    rows: DataFrame, *, label: str, year: str, cutoff: int, variants: Mapping[str, tuple[Callable, Sequence[str]]]
) -> DataFrame:
    """Every variant (name: fit function and its inputs) and both naive floors on the same test rows.

    The rows are written once, so that all variants share one split. Best macro F1 first, with the
    number of test rows each was scored on.
    """
    rows = materialize(rows, "training-rows")
    train, test = ml.year_split(rows, year, cutoff)
    scored = [ml.evaluate_model(fit(train, inputs, label), test, name, label) for name, (fit, inputs) in variants.items()]
    table = compare_models(*scored, naive_baselines(test, label))
    return table.withColumn("n_test", F.lit(test.count()))


def _catalogue(t) -> DataFrame:
    isbns = messy_isbn(t).select(F.col("p_partkey").alias("gb_id"), F.col("raw").alias("isbn"), F.col("raw").alias("isbn13"))
    rows = t.part.select(
        F.col("p_partkey").alias("gb_id"), F.expr(TITLE).alias("title"), F.array("p_brand").alias("authors"),
        F.when(F.col("p_partkey") % 13 != 0, F.lit(1920) + F.col("p_size")).alias("pub_year"),
        F.transform(F.split("p_name", " "), lambda w: F.when(w == "gear", "nonfiction").when(w == "red", "fiction").otherwise(w)).alias("genres"),
    )
    return rows.join(isbns, "gb_id")


def _label_titles(t) -> DataFrame:
    isbns = messy_isbn(t).select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, F.concat("raw", F.lit(" : PB"))).alias("oclc_isbn"))
    return t.part.join(isbns, "p_partkey").filter("p_size <= 20").select(
        F.col("p_partkey").alias("label_id"), F.col("p_name").alias("title"), F.concat(F.lit("by "), "p_brand").alias("author"),
        "oclc_isbn", F.col("p_size").alias("weeks_on_list"), (F.col("p_partkey") % 15).cast("int").alias("best_rank_achieved"),
        (F.lit(1930) + F.col("p_size")).alias("first_year"), F.lit(None).cast("int").alias("debut_rank"),
    )


@query("label_catalogue")
def _(t):
    return scope_filters(label_catalogue(_catalogue(t), _label_titles(t))).drop("authors", "genres")


@query("canonical_table")
def _(t):
    b = _catalogue(t).withColumnRenamed("gb_id", "book_id").withColumn("description", F.lit(" "))
    m = messy_isbn(t)
    shop = m.filter("p_partkey % 2 = 0").select(
        F.concat(F.lit("A"), "p_partkey").alias("asin"), F.col("raw").alias("ISBN10"),
        *[F.col("p_retailprice").cast("string").alias(c) for c in ("rating", "reviews_count", "final_price", "number_of_sellers")],
    )
    editions = t.part.select(
        F.concat(F.lit("A"), "p_partkey").alias("asin"), F.col("p_name").alias("title"), F.col("p_brand").alias("author"),
        F.when(F.col("p_size") > 25, "Hardcover").otherwise("Kindle Edition").alias("format"),
    )
    history = t.events.select(
        F.concat(F.lit("A"), "user_id").alias("asin"), F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"), F.floor(F.col("value") * 100).cast("int").alias("rank")
    )
    metadata = t.documents.select(
        F.concat(F.lit("978"), F.lpad(F.col("doc_id").cast("string"), 10, "0")).alias("isbn13"), F.col("text").alias("description"), F.col("source").alias("publisher")
    )
    weekly = t.part.filter("p_size < 9").select(
        F.col("p_partkey").cast("string").alias("title_id"), F.col("p_name").alias("title"), F.col("p_brand").alias("author"),
        F.col("p_size").cast("string").alias("rank"), F.col("p_partkey").alias("week"),
    )
    weekly = weekly.join(
        m.select(F.col("p_partkey").cast("string").alias("title_id"), F.when(F.col("p_partkey") % 3 != 0, F.col("raw")).alias("oclc_isbn")), "title_id"
    )
    movies = t.part.filter("p_size > 45").select(
        F.col("p_name").alias("book_title"), F.lit("x").alias("movie_title"), F.col("p_brand").alias("author")
    )
    return canonical_table(b, shop, editions, history, metadata, weekly, movies).drop("authors", "genres")


@query(
    "model_comparison",
    "SELECT model, n_test, TRUE AS in_range FROM (SELECT unnest(['always_0', 'always_1', 'boosting', 'forest', 'logistic', 'logistic_text', 'logistic_vectors']) AS model), "
    f"(SELECT count(*) AS n_test FROM ({models._TEST}))",
)
def _(t):
    rows = models.training_rows(t)
    scores = lexicon_sentiment(t.documents, "doc_id", "text", models.lexicon(t))
    vectors = attach_embeddings(t.documents, "doc_id", "text", t.embeddings.select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector")), 64)
    cells = expand_vector(F.col("vector"), 64, "v")
    rows = concat_columns("doc_id", rows, scores, vectors.select("doc_id", *[c.alias(n) for n, c in cells.items()]))
    plain = models.INPUTS
    text = [*plain, *[c for c in scores.columns if c != "doc_id"]]
    table = model_comparison(
        rows, label=models.LABEL, year=models.YEAR, cutoff=models.CUTOFF,
        variants={
            "logistic": (ml.logistic_baseline, plain),
            "logistic_text": (ml.logistic_baseline, text),
            "logistic_vectors": (ml.logistic_baseline, [*text, *cells]),
            "boosting": (ml.gradient_boosting, plain),
            "forest": (ml.random_forest, plain),
        },
    )
    sound = F.col("f1_macro").between(0, 1) & F.coalesce(F.col("roc_auc"), F.lit(0.5)).between(0, 1)
    return table.select("model", "n_test", sound.alias("in_range"))


@query("train_and_publish", "SELECT 'retrained' AS model, TRUE AS in_range, 'reproduced' AS note")
def _(t):
    rows = materialize(models.training_rows(t), "training-rows")
    train, test = ml.year_split(rows, models.YEAR, models.CUTOFF)
    first = ml.evaluate_model(ml.random_forest(train, models.INPUTS, models.LABEL), test, "recorded", models.LABEL)
    out = train_final(
        rows.select("doc_id", *models.INPUTS), rows.select("doc_id", models.LABEL, models.YEAR),
        key="doc_id", label=models.LABEL, year=models.YEAR, cutoff=models.CUTOFF, inputs=models.INPUTS,
        recorded_f1=first.first()["f1_macro"], path=scratch_path(t.spark, "published"),
    )
    return out.select("model", F.col("f1_macro").between(0, 1).alias("in_range"), "note")
