"""Assembly of feature matrices, text scores and vectors."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import IDF, CountVectorizerModel, IDFModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bindery.functions.numbers import log_pages, pub_decade
from bindery.functions.text import list_size, scrub_accolades, strip, title_features, word_count
from bindery.operators.history import author_history
from bindery.operators.keyed import lookup_join
from bindery.operators.profile import correlation_matrix
from bindery.operators.projection import expand_vector, top_n_dummies
from bindery.schemas import leaked_columns
from bindery.session import materialize


class LeakageError(AssertionError):
    pass


def guard_leakage(features: DataFrame, key: str) -> DataFrame:
    bad = leaked_columns(features, [key])
    if bad:
        raise LeakageError(f"columns not allowed in a feature matrix: {bad}")
    return features


def build_structural_features(
    books: DataFrame,
    *,
    key: str = "gb_id",
    title: str = "title",
    pages: str = "pages",
    year: str = "pub_year",
    genres: str = "genres",
    author: str = "author_norm",
    authors: str = "authors",
    description: str = "description",
    label: str = "label",
    top_n: int = 20,
    vocabulary: DataFrame | None = None,
) -> DataFrame:
    """One row per book with all structural features, in a fixed order.

    One projection for what a row knows itself, one shuffle for the author history, and a small
    aggregate for the tag vocabulary (of ``vocabulary`` rows if given, else of all rows).
    """
    local = {
        **title_features(F.col(title)),
        "log_pages": log_pages(F.col(pages)),
        "pub_decade": pub_decade(F.col(year)),
        **top_n_dummies(books, genres, top_n, "genre_", vocabulary),
        "genre_count": list_size(F.col(genres)),
        "num_credits": list_size(F.col(authors)),
        "has_multiple_credits": list_size(F.col(authors)) > 1,
        "description_word_count": word_count(F.col(description)),
    }
    needed = [F.col(key), F.col(author).alias("_author"), F.col(year).alias("_year"), F.col(label).alias("_label")]
    rows = books.select(*needed, *[c.alias(n) for n, c in local.items()])
    rows = author_history(rows, "_author", "_year", "_label", key)
    names = list(local)
    history = ["author_prior_count", "years_since_last_pub", "is_debut"]
    at = names.index("num_credits")
    return guard_leakage(rows.select(key, *names[:at], *history, *names[at:]), key)


def build_all_features(
    books: DataFrame,
    lexicon: DataFrame,
    *,
    key: str = "gb_id",
    description: str = "description",
    vectors: DataFrame | None = None,
    vector_size: int = 0,
    **structural,
) -> DataFrame:
    """Structural features, text scores and (optionally) description vectors as columns."""
    out = build_structural_features(books, key=key, description=description, **structural)
    out = out.join(lexicon_sentiment(books, key, description, lexicon), key, "inner")
    if vectors is not None:
        vec = attach_embeddings(books, key, description, vectors, vector_size)
        cells = expand_vector(F.col("vector"), vector_size, "desc_emb_")
        out = out.join(vec.select(key, *[c.alias(n) for n, c in cells.items()]), key, "inner")
    return guard_leakage(out, key)


def correlated_to_drop(pairs: Sequence[tuple[str, str, float | None]], threshold: float = 0.9) -> list[str]:
    """Left-to-right greedy choice on the small (a, b, r) list: drop the later of a close pair
    unless one of the two is already gone. A missing r never drops."""
    gone: list[str] = []
    for a, b, r in pairs:
        if a not in gone and b not in gone and r is not None and abs(r) >= threshold:
            gone.append(b)
    return gone


def drop_correlated(
    df: DataFrame, threshold: float = 0.9, exclude: Sequence[str] = (), fit_on: DataFrame | None = None
) -> DataFrame:
    """Drop near-duplicate numeric columns, as judged on ``fit_on`` (by default on ``df`` itself).

    The driver sees one number per column pair.
    """
    kinds = ("int", "bigint", "double", "float", "boolean", "smallint", "tinyint")
    columns = [c for c, t in df.dtypes if (t in kinds or t.startswith("decimal")) and c not in exclude]
    at = {c: i for i, c in enumerate(columns)}
    rows = correlation_matrix(df if fit_on is None else fit_on, columns).collect()
    pairs = sorted(((r["a"], r["b"], r["r"]) for r in rows), key=lambda p: (at[p[0]], at[p[1]]))
    return df.drop(*correlated_to_drop(pairs, threshold))


def _words(text: Column) -> Column:
    """Lower-case words without accolades; null and blank texts have none."""
    plain = F.lower(scrub_accolades(F.coalesce(text, F.lit(""))))
    return F.filter(F.split(plain, r"[^\p{L}\p{N}']+"), lambda w: w != "")


BATCH_WORDS = 1 << 20  # words counted at a time
BATCH_ROWS = 1 << 12


def _batches(batch: pa.RecordBatch, column: str = "_words") -> Iterator[pa.RecordBatch]:
    """Cut a record batch so that a piece has at most ``BATCH_ROWS`` rows and about ``BATCH_WORDS`` words."""
    ends = np.cumsum(pc.list_value_length(batch.column(column)).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(ends):
        done = ends[start - 1] if start else 0
        stop = min(start + BATCH_ROWS, max(start + 1, int(np.searchsorted(ends, done + BATCH_WORDS, "right"))))
        yield batch.slice(start, stop - start)
        start = stop


def _owners(lists: pa.Array) -> np.ndarray:
    """The row of every element of a column of lists."""
    return np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (piece for whole in batches for piece in _batches(whole)):
        lists = batch.column(1)
        coded = lists.flatten().dictionary_encode()
        width = max(len(coded.dictionary), 1)
        cells, n = np.unique(_owners(lists) * width + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
        first = pa.array(np.searchsorted(cells, np.arange(len(lists) + 1) * width).astype(np.int32))
        words = pa.ListArray.from_arrays(first, coded.dictionary.take(pa.array(cells % width)))
        counts = pa.ListArray.from_arrays(first, pa.array(n.astype(np.int64)))
        yield pa.record_batch({batch.schema.names[0]: batch.column(0), "_words": words, "_ns": counts})


def word_bags(df: DataFrame, key: str, text: str) -> DataFrame:
    """Per row: ``key``, the distinct words of the text (``_words``) and how often it holds each (``_ns``).

    The words of a text are counted where the text is read, a bounded batch at a time, so the memory of a
    task does not depend on how many texts it reads. Written once.
    """
    schema = T.StructType([
        df.schema[key],
        T.StructField("_words", T.ArrayType(T.StringType())),
        T.StructField("_ns", T.ArrayType(T.LongType())),
    ])
    words = df.select(key, _words(F.col(text)).alias("_words"))
    return materialize(words.mapInArrow(_count_words, schema), "word-counts", compression="zstd")


def _one_word_a_row(bags: DataFrame, key: str, outer: bool = False) -> DataFrame:
    explode = F.explode_outer if outer else F.explode
    zipped = bags.select(key, explode(F.arrays_zip("_words", "_ns")).alias("_w"))
    return zipped.select(key, F.col("_w._words").alias("word"), F.coalesce("_w._ns", F.lit(0).cast("long")).alias("_n"))


def lexicon_sentiment(df: DataFrame, key: str, text: str, lexicon: DataFrame) -> DataFrame:
    """neg / neu / pos shares and the compound score of each text from a (word, valence) table.

    Accolades are removed first. The words of a text are counted before they meet the lexicon, and
    meet it through :func:`lookup_join`, so a word of every text is spread over the tasks. Texts
    without words score 0.
    """
    counted = _one_word_a_row(word_bags(df, key, text), key, outer=True)
    found = lookup_join(counted, lexicon.select("word", "valence"), ["word"], row_id=[key, "word"])
    v, n = F.coalesce(F.col("valence"), F.lit(0.0)), F.col("_n")
    sums = found.groupBy(key).agg(
        F.sum(v * n).alias("_sum"),
        F.sum(F.when(v > 0, (v + 1) * n).otherwise(0.0)).alias("_pos"),
        F.sum(F.when(v < 0, (1 - v) * n).otherwise(0.0)).alias("_neg"),
        F.sum(F.when(v == 0, n).otherwise(0)).cast("double").alias("_neu"),
    )
    total = F.col("_pos") + F.col("_neg") + F.col("_neu")

    def share(c: str):
        return F.coalesce(F.round(F.try_divide(c, total), 3), F.lit(0.0))

    return sums.select(
        key,
        share("_neg").alias("desc_neg"),
        share("_neu").alias("desc_neu"),
        share("_pos").alias("desc_pos"),
        F.round(F.col("_sum") / F.sqrt(F.col("_sum") * F.col("_sum") + 15), 4).alias("desc_compound"),
    )


def attach_embeddings(df: DataFrame, key: str, text: str, vectors: DataFrame, size: int) -> DataFrame:
    """The precomputed vector of each row; the zero vector for blank text or a missing vector."""
    zero = F.array_repeat(F.lit(0.0).cast("float"), size)
    joined = df.join(vectors.select(key, "vector"), key, "left")
    blank = strip(scrub_accolades(F.coalesce(F.col(text), F.lit("")))) == ""
    return joined.select(key, F.when(blank, zero).otherwise(F.coalesce("vector", zero)).alias("vector"))


class TextVectors:
    """Term weights (count x inverse document frequency) over a fixed vocabulary."""

    def __init__(self, text: str, counts: CountVectorizerModel, weights: IDFModel):
        self.text, self.counts, self.weights = text, counts, weights

    @property
    def vocabulary(self) -> list[str]:
        return self.counts.vocabulary

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``vector``; null and blank texts get the zero vector."""
        counted = self.counts.transform(df.withColumn("_words", _words(F.col(self.text))))
        return self.weights.transform(counted).drop("_words", "_tf")


def fit_text_vectors(df: DataFrame, text: str, size: int = 4096) -> TextVectors:
    """Fit on the texts of ``df``: the ``size`` words that most texts hold, ties in word order.

    Accolades are removed, as they would tell the label. The driver sees the vocabulary only.
    """
    words = df.select(F.explode(F.array_distinct(_words(F.col(text)))).alias("word"))
    common = words.groupBy("word").count().orderBy(F.desc("count"), "word").limit(size).collect()
    vocabulary = [r["word"] for r in common]
    counts = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="_words", outputCol="_tf")
    counted = counts.transform(df.select(_words(F.col(text)).alias("_words")))
    return TextVectors(text, counts, IDF(inputCol="_tf", outputCol="vector").fit(counted))


PLACES = 4  # columns that one word adds to
_DIGITS = 8  # hexadecimal digits of a word's digest per place


HEAD = 1 << 17  # most frequent words whose weights every task holds


def _places(word: Column, size: int) -> Column:
    """The columns a word adds to, counted from 1, negative where it is subtracted."""
    digest = F.md5(word.cast("binary"))

    def place(i: int) -> Column:
        number = F.conv(F.substring(digest, 1 + _DIGITS * i, _DIGITS), 16, 10).cast("long")
        sign = F.when(number >= 1 << 4 * _DIGITS - 1, F.lit(1)).otherwise(F.lit(-1))
        return ((number % size + 1) * sign).cast("int")

    return F.array(*[place(i) for i in range(PLACES)])


def _added(into: np.ndarray, owner: np.ndarray, weights: np.ndarray, places: np.ndarray) -> None:
    """Add each weight to the ``places`` (one row of them per weight) of the vector of its owner."""
    np.add.at(into, (owner[:, None], np.abs(places) - 1), weights[:, None] * np.sign(places))


def _vector_lists(vectors: np.ndarray) -> pa.Array:
    rows, size = vectors.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * size), pa.array(vectors.ravel()))


def _head_vectors(head, size: int):
    """Sum the weights of the words in ``head``, a broadcast (words, rarity, places); pass the others on."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, rarity, places = head.value
        for batch in (piece for whole in batches for piece in _batches(whole)):
            lists, own = batch.column(1), _owners(batch.column(1))
            flat, n = lists.flatten(), batch.column(2).flatten().to_numpy(zero_copy_only=False)
            at = pc.index_in(flat, value_set=words).fill_null(-1).to_numpy(zero_copy_only=False)
            known, other = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
            exact = 1000.0 * n[known] * rarity[at[known]]
            weights = np.floor(exact)
            weights += exact - weights >= 0.5
            vectors = np.zeros((len(lists), size), np.int64)
            _added(vectors, own[known], weights.astype(np.int64), places[at[known]])
            first = pa.array(np.searchsorted(own[other], np.arange(len(lists) + 1)).astype(np.int32))
            rest = [pa.ListArray.from_arrays(first, x) for x in (flat.take(pa.array(other)), pa.array(n[other]))]
            named = zip([batch.schema.names[0], "vector", "_words", "_ns"], [batch.column(0), _vector_lists(vectors), *rest])
            yield pa.record_batch(dict(named))

    return add


def _add_tail(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (piece for whole in batches for piece in _batches(whole, "_weights")):
        lists, vectors = batch.column(2), batch.column(1)
        total = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1).copy()
        places = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, PLACES)
        _added(total, _owners(lists), lists.flatten().to_numpy(zero_copy_only=False), places)
        yield pa.record_batch({batch.schema.names[0]: batch.column(0), "vector": _vector_lists(total)})


def projected_vectors(df: DataFrame, key: str, text: str, size: int = 384) -> DataFrame:
    """Dense vectors from the texts themselves: ``key`` and ``vector``, an array of ``size`` whole numbers.

    A sparse random projection of the term weights (count x inverse document frequency, in thousandths):
    every word adds its weight, with a sign of its own, to ``PLACES`` columns that its digest names. So no
    vocabulary is kept and no word is left out, and inner products are those of the term weights up to
    the noise of the projection. Accolades are removed first. Null and blank texts get the zero vector.
    Rows of one key are one text; without a key there is the zero vector.

    The words of a text are counted where it is read. The ``HEAD`` words that most texts hold, most of all
    words of a text, get their weights there too, from a broadcast; only the others of a text meet the
    table of frequencies, through :func:`lookup_join`, and go back to their text.
    """
    bags = word_bags(df, key, text)
    texts = F.lit(bags.count() + 1)
    rows = bags.groupBy(key).agg(F.count("*").alias("_rows"))
    unique = rows.filter(F.col(key).isNull() | (F.col("_rows") > 1)).isEmpty()
    if not unique:
        merged = _one_word_a_row(bags, key).groupBy(key, "word").agg(F.sum("_n").alias("_n"))
        lists = merged.groupBy(key).agg(F.collect_list(F.struct("word", "_n")).alias("_w"))
        bags = materialize(lists.select(key, F.col("_w.word").alias("_words"), F.col("_w._n").alias("_ns")), "word-counts")
    held = bags.select(F.explode("_words").alias("word")).groupBy("word").agg(F.count("*").alias("_df"))
    rarity = held.select("word", F.ln(texts / (F.col("_df") + 1)).alias("_rarity"))
    rarity = materialize(rarity.withColumn("_places", _places(F.col("word"), size)), "word-rarity")
    head = rarity.orderBy("_rarity", "word").limit(HEAD).toArrow().combine_chunks()
    columns = [head.column(c).combine_chunks() for c in head.column_names]
    places = columns[2].flatten().to_numpy(zero_copy_only=False).reshape(-1, PLACES)
    known = df.sparkSession.sparkContext.broadcast((columns[0], columns[1].to_numpy(zero_copy_only=False), places))

    vector = T.StructField("vector", T.ArrayType(T.LongType()))
    out = bags.mapInArrow(_head_vectors(known, size), T.StructType([bags.schema[key], vector, *bags.schema.fields[1:]]))
    if head.num_rows == HEAD:
        out = materialize(out, "head-vectors", compression="zstd")
        found = lookup_join(_one_word_a_row(out, key), rarity, ["word"], row_id=[key, "word"])
        weight = F.round(F.lit(1000.0) * F.col("_n") * F.col("_rarity")).cast("long")
        cells = found.groupBy(key).agg(F.collect_list(F.struct(weight.alias("w"), F.col("_places").alias("p"))).alias("_c"))
        tail = cells.select(key, F.col("_c.w").alias("_weights"), F.flatten("_c.p").alias("_at"))
        none = [F.coalesce(c, F.array().cast(t)).alias(c) for c, t in (("_weights", "array<bigint>"), ("_at", "array<int>"))]
        both = out.select(key, "vector").join(tail, key, "left").select(key, "vector", *none)
        out = both.mapInArrow(_add_tail, T.StructType([bags.schema[key], vector]))
    out = out.select(key, "vector")
    if unique:
        return out
    zero = F.array_repeat(F.lit(0).cast("long"), size)
    return df.select(key).join(out, key, "left").select(key, F.coalesce("vector", zero).alias("vector"))
