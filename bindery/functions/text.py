"""Text cleaning, normalisation and list parsing as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bindery.functions.unicode import fold_to_ascii, strip_diacritics

# Texts that mean "missing".
MISSING_TEXTS = ("", "nan", "none", "null", "na", "n/a", "<na>")

# Phrases that tell the outcome and are removed before text is scored.
ACCOLADES = (
    "new york times",
    "bestseller",
    "best seller",
    "award-winning",
    "award winning",
    "national bestseller",
)

# Patterns of multi-volume titles (the first is case-sensitive).
VOLUME_RANGE = r"#\d+-\d+"
BOX_SET = r"box\s*set|boxed set|boxset|complete collection|complete series"


SPACES = r"(?U)\s+"


def _blank_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def strip(c: Column) -> Column:
    """Without leading and trailing whitespace of any kind (``trim`` only knows the blank)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def _squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, SPACES, " "))


def clean_missing_text(c: Column) -> Column:
    """Trimmed text without a trailing '.0' on digits; null for any missing marker."""
    s = strip(c)
    return F.when(~F.lower(s).isin(*MISSING_TEXTS), F.regexp_replace(s, r"^(\d+)\.0$", "$1"))


def norm_text_ascii(c: Column) -> Column:
    """Lower-case, keep a-z, 0-9 and spaces, collapse spaces; null gives ''."""
    kept = F.regexp_replace(strip(F.lower(_blank_if_null(c))), r"(?U)[^a-z0-9\s]", "")
    return F.regexp_replace(kept, SPACES, " ")


def clean_author_name(c: Column) -> Column:
    """Like ``norm_text_ascii`` and trimmed at the end."""
    return F.trim(norm_text_ascii(c))


def norm_author(c: Column) -> Column:
    """Lower-case, no diacritics, punctuation to spaces, collapsed; null gives ''."""
    plain = strip_diacritics(F.lower(_blank_if_null(c)))
    return _squeeze(F.regexp_replace(plain, r"(?U)[^\w\s]", " "))


def norm_title(c: Column) -> Column:
    """``norm_author`` without one leading article."""
    return F.regexp_replace(norm_author(c), r"^(the|a|an)\s+", "")


def norm_title_nfkd(c: Column) -> Column:
    """ASCII-folded lower-case title; leading 'the ', 'a ', 'an ' go in that sequence."""
    s = F.lower(fold_to_ascii(_blank_if_null(c)))
    for article in ("the", "a", "an"):
        s = F.regexp_replace(s, f"^{article} ", "")
    return strip(s)


def first_author_key(authors: Column) -> Column:
    """Normalised first name of a list; '' for a null or empty list."""
    return norm_author(F.get(authors, F.lit(0)))


def word_count(c: Column) -> Column:
    """Whitespace-separated words; 0 for null or blank."""
    return F.size(F.filter(F.split(_blank_if_null(c), SPACES), lambda w: w != ""))


def has_description(c: Column, min_words: int = 10) -> Column:
    return c.isNotNull() & (word_count(c) > min_words)


def core_title(c: Column) -> Column:
    """The part before the first parenthesis, trimmed."""
    return strip(F.substring_index(_blank_if_null(c), "(", 1))


def title_features(c: Column) -> dict[str, Column]:
    core = core_title(c)
    return {
        "title_word_count": word_count(core),
        "title_char_count": F.length(core),
        "has_subtitle": core.contains(":"),
        "is_series": is_series(c),
    }


def is_series(c: Column) -> Column:
    return _blank_if_null(c).rlike(r"#\d+")


def is_boxset(c: Column) -> Column:
    title = _blank_if_null(c)
    return title.rlike(VOLUME_RANGE) | title.rlike(f"(?i){BOX_SET}")


def scrub_accolades(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?i)\b({'|'.join(ACCOLADES)})\b", "")


def _json_list(c: Column) -> Column:
    return F.from_json(c, "array<string>", {"allowSingleQuotes": "true"})


def parse_str_list(c: Column, on_failure: str = "empty") -> Column:
    """List-literal text such as ``['a', "b's"]`` to an array of strings.

    ``on_failure`` says what unparsable text gives: ``empty`` list, ``null``, or a ``single``-item
    list holding the text itself (blank text then gives an empty list). Null input gives an empty
    list, except for ``null``.
    """
    s = strip(c)
    as_list = F.when(s.startswith("[") & s.endswith("]"), s)
    # A bare None item is written null; tried only after the text as it stands.
    with_nulls = F.regexp_replace(as_list, r"(?<=[\[,\s])None(?=\s*[,\]])", "null")
    parsed = F.coalesce(_json_list(as_list), _json_list(with_nulls))
    nothing = F.array().cast("array<string>")
    if on_failure == "null":
        return parsed
    if on_failure == "empty":
        return F.coalesce(parsed, nothing)
    if on_failure == "single":
        return F.coalesce(parsed, F.when(s != "", F.array(c)), nothing)
    raise ValueError(f"unknown failure policy: {on_failure}")


def list_size(items: Column) -> Column:
    return F.coalesce(F.size(items), F.lit(0))


def has_tag(items: Column, tag: str) -> Column:
    """Tag present after lower-casing and trimming each item."""
    return F.coalesce(F.exists(items, lambda t: strip(F.lower(t)) == tag), F.lit(False))


def has_any_keyword(c: Column, words: list[str]) -> Column:
    """Any keyword occurs, case-insensitively; null gives false."""
    quoted = "|".join(rf"\Q{w}\E" for w in words)
    return F.coalesce(c.rlike(f"(?i){quoted}"), F.lit(False))
