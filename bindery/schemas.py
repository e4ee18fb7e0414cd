"""Table schemas of the sources, and column roles kept in the schema's metadata."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

# Columns known to hold later outcomes, identifiers, or the label's own details.
LEAKAGE_COLUMNS = (
    "average_rating", "ratings_count", "work_ratings_count", "work_text_reviews_count",
    "ratings_1", "ratings_2", "ratings_3", "ratings_4", "ratings_5",
)
ID_COLUMNS = (
    "gb_id", "best_book_id", "book_id", "goodreads_book_id", "work_id", "isbn", "isbn13",
    "isbn10_clean", "isbn13_from_isbn10", "isbn13_from_isbn13", "isbn13_key", "image_url",
    "small_image_url",
)
TARGET_COLUMNS = (
    "nyt_title", "nyt_author", "nyt_title_norm", "nyt_author_norm", "weeks_on_list",
    "best_rank_achieved", "nyt_first_year", "debut_rank", "match_method", "is_nyt_match",
)

FORBIDDEN = {"leakage", "identifier", "target_detail"}

CATALOGUE = (
    "book_id int, title string, authors string, authors_2 string, original_publication_year string, "
    "language_code string, pages double, description string, genres string, publishdate string, "
    "isbn string, isbn13 string, average_rating double, ratings_count long, work_ratings_count long, "
    "work_text_reviews_count long, ratings_1 long, ratings_2 long, ratings_3 long, ratings_4 long, "
    "ratings_5 long"
)
WEEKLY_LIST = "title_id string, title string, author string, rank string, oclc_isbn string"
SHOP_CATALOGUE = (
    "asin string, ISBN10 string, title string, rating string, reviews_count string, "
    "final_price string, number_of_sellers string, categories array<string>"
)
METADATA_DUMP = (
    "isbn13 string, description string, publisher string, format string, language_code string, num_pages string"
)
RANK_INDEX = "asin string, group string, format string, title string, author string, publisher string"
ADAPTATIONS = "author string, movie_title string, movie_release_date string, book_title string"


def default_roles() -> dict[str, str]:
    return {
        **dict.fromkeys(LEAKAGE_COLUMNS, "leakage"),
        **dict.fromkeys(ID_COLUMNS, "identifier"),
        **dict.fromkeys(TARGET_COLUMNS, "target_detail"),
    }


def with_roles(df: DataFrame, roles: Mapping[str, str] | None = None) -> DataFrame:
    """Tag columns with a role; the tag travels with the column through projections."""
    roles = default_roles() | dict(roles or {})
    for c in df.columns:
        if c in roles:
            df = df.withMetadata(c, {**df.schema[c].metadata, "role": roles[c]})
    return df


def leaked_columns(df: DataFrame, allowed: Sequence[str] = ()) -> list[str]:
    """Columns whose role (by tag or by name) forbids them in a feature matrix."""
    known = default_roles()
    return [
        f.name
        for f in df.schema
        if f.name not in allowed and (f.metadata or {}).get("role", known.get(f.name)) in FORBIDDEN
    ]
