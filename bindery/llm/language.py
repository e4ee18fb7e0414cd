"""Language identification: known words by frequency, unseen words by ever shorter character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bindery.llm.stages import keep, slices
from bindery.llm.words import mix

DOCS_PER_LANGUAGE = 5000
WORDS_PER_LANGUAGE = 20000
GRAMS_PER_LANGUAGE = 5000  # of each length
LONGEST = 5
MAX_LANGUAGES = 1000
EVIDENCE = 32  # words after which more of them make no prediction surer
PRIOR_COUNT = 0.5
UNDETERMINED = "und"
SLICE = 1 << 20  # bytes of text worked on at once; their words and n-grams take many times as much


class Model(NamedTuple):
    languages: list[str]
    prior: np.ndarray
    words: pa.Array
    word_scores: np.ndarray  # words x languages: log frequencies
    grams: list[np.ndarray]  # sorted hashes of the known n-grams, by length
    gram_scores: list[np.ndarray]


def words_of(batch: pa.RecordBatch) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The lower-case words (runs of letters and marks) of all texts, and the document of each."""
    text = pc.utf8_lower(pc.fill_null(batch.column("_text").cast(pa.large_string()), ""))
    lists = pc.split_pattern(pc.utf8_trim(pc.replace_substring_regex(text, r"[^\p{L}\p{M}]+", " "), " "), " ")
    doc = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
    words = lists.flatten()
    real = pc.match_substring_regex(words, r"\p{L}")
    return words.filter(real).dictionary_encode(), doc[real.to_numpy(zero_copy_only=False)]


def character_grams(words: list[str], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the n-grams of all words (with their ends marked), the word of each, and its place
    in the joined text of marked words."""
    text = "".join(f"^{w}$" for w in words)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    count = max(len(points) - n + 1, 0)
    hashes = np.zeros(count, np.uint64)
    for i in range(n):
        hashes = hashes * np.uint64(0x9E3779B97F4A7C15) + points[i : i + count]
    at = np.flatnonzero(np.arange(count) + n <= ends[owner[:count]])
    return mix(hashes[at]), owner[at], at


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words (n = 0) and of n-gram hashes per language, added up per slice."""
    for batch in slices(batches, "_text", SLICE):
        words, doc = words_of(batch)
        if not len(words):
            continue
        names = batch.column("_lang").dictionary_encode()
        lang = names.indices.to_numpy()[doc]
        kinds = len(names.dictionary)
        table = np.bincount(words.indices.to_numpy() * kinds + lang, minlength=len(words.dictionary) * kinds)
        table = table.reshape(-1, kinds)
        vocabulary = words.dictionary.to_pylist()
        for n in range(LONGEST + 1):
            if n:
                keys, owner, _ = character_grams(vocabulary, n)
                item, place = np.unique(keys, return_inverse=True)
                counts = np.stack([np.bincount(place, table[owner, i], len(item)) for i in range(kinds)], axis=1)
                item = item.view(np.int64).astype(str)
            else:
                item, counts = np.array(vocabulary, object), table
            row, kind = np.nonzero(counts)
            yield pa.record_batch(
                {
                    "lang": names.dictionary.take(pa.array(kind)).cast(pa.string()),
                    "n": pa.array(np.full(len(row), n, np.int32)),
                    "item": pa.array(item[row], pa.string()),
                    "count": pa.array(counts[row, kind].astype(np.int64)),
                }
            )


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", seed: Column | None = None) -> Model | None:
    """A model of the labelled rows (null languages are left out); None if there are none.

    Per language it learns from about ``DOCS_PER_LANGUAGE`` documents, chosen by the hash of ``seed``;
    keeps the ``WORDS_PER_LANGUAGE`` most frequent words and, per length, ``GRAMS_PER_LANGUAGE``
    n-grams. These parameters bound what the driver collects and the tasks receive.
    """
    rows = labelled.filter(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text"), (seed if seed is not None else F.xxhash64(text_col)).alias("_seed")
    )
    sizes = {r["_lang"]: r["count"] for r in rows.groupBy("_lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if not sizes:
        return None
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    share = F.element_at(
        F.create_map(*[F.lit(x) for k, v in sizes.items() for x in (k, min(1.0, DOCS_PER_LANGUAGE / v))]), F.col("_lang")
    )
    chosen = F.pmod("_seed", F.lit(1 << 20)) < share * (1 << 20)
    counts = rows.filter(chosen).select("_lang", "_text").mapInArrow(_counter, "lang string, n int, item string, count long")
    counts = keep(counts.groupBy("lang", "n", "item").agg(F.sum("count").alias("count")), "language-counts")
    totals = {(r["lang"], r["n"]): r["total"] for r in counts.groupBy("lang", "n").agg(F.sum("count").alias("total")).collect()}
    best = Window.partitionBy("lang", "n").orderBy(F.desc("count"), "item")
    limit = F.when(F.col("n") == 0, WORDS_PER_LANGUAGE).otherwise(GRAMS_PER_LANGUAGE)
    most = max(WORDS_PER_LANGUAGE, GRAMS_PER_LANGUAGE)
    top = counts.withColumn("_at", F.row_number().over(best)).filter(F.col("_at") <= most).filter(F.col("_at") <= limit)
    # Every language's count of every known item, also where it is not among its own most frequent.
    known = counts.join(top.select("n", "item").distinct(), ["n", "item"], "left_semi").toArrow()

    languages = sorted(sizes)
    place = {x: i for i, x in enumerate(languages)}
    n, item = known.column("n").to_numpy(), known.column("item").to_numpy()
    lang = np.array([place[x] for x in known.column("lang").to_pylist()], np.int64)
    count = known.column("count").to_numpy()
    tables = []
    for size in range(LONGEST + 1):
        at = np.flatnonzero(n == size)
        names, row = np.unique(item[at].astype(str) if size == 0 else item[at].astype(np.int64).view(np.uint64), return_inverse=True)
        table = np.full((len(names), len(languages)), PRIOR_COUNT)
        table[row, lang[at]] += count[at]
        total = np.array([totals.get((x, size), 0) for x in languages]) + PRIOR_COUNT * (len(names) + 1)
        tables.append((names, np.log(table / total).astype(np.float32)))
    prior = np.log(np.array([sizes[x] for x in languages]) / sum(sizes.values()))
    return Model(
        languages, prior, pa.array(tables[0][0].tolist(), pa.string()), tables[0][1],
        [t[0] for t in tables[1:]], [t[1] for t in tables[1:]],
    )


def word_scores(model: Model, vocabulary: pa.Array) -> np.ndarray:
    """Log frequency per language of each word: its own if known, or the mean over its known n-grams
    of the greatest length that has any; nothing if it has none."""
    scores = np.zeros((len(vocabulary), len(model.languages)), np.float32)
    found = pc.index_in(vocabulary, value_set=model.words)
    known = found.is_valid().to_numpy(zero_copy_only=False)
    scores[known] = model.word_scores[found.drop_null().to_numpy()]
    open_rows = np.flatnonzero(~known)
    for n in range(LONGEST, 0, -1):
        if not len(open_rows) or not len(model.grams[n - 1]):
            continue
        keys, owner, _ = character_grams(vocabulary.take(pa.array(open_rows)).to_pylist(), n)
        at = np.searchsorted(model.grams[n - 1], keys)
        hit = model.grams[n - 1][np.minimum(at, len(model.grams[n - 1]) - 1)] == keys
        owner, at = owner[hit], at[hit]
        if len(owner):
            head = np.flatnonzero(np.diff(owner, prepend=-1))
            sums = np.add.reduceat(model.gram_scores[n - 1][at], head)
            scores[open_rows[owner[head]]] = sums / np.diff(head, append=len(owner))[:, None]
            open_rows = np.delete(open_rows, owner[head])
    return scores


def _predictor(shared):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for batch in slices(batches, "_text", SLICE):
            words, doc = words_of(batch)
            n = np.bincount(doc, minlength=batch.num_rows)
            scores = word_scores(model, words.dictionary)[words.indices.to_numpy()] if len(words) else None
            total = np.zeros((batch.num_rows, len(model.languages)))
            for i in range(len(model.languages) if len(words) else 0):
                total[:, i] = np.bincount(doc, scores[:, i], batch.num_rows)
            total = total / np.maximum(n, 1)[:, None] * np.minimum(n, EVIDENCE)[:, None] + model.prior
            odds = np.exp(total - total.max(axis=1, keepdims=True))
            best = odds.argmax(axis=1)
            names = [model.languages[b] if k else UNDETERMINED for b, k in zip(best, n)]
            score = np.where(n > 0, 1 / odds.sum(axis=1), 0.0)
            rest = {c: batch.column(c) for c in batch.schema.names if c != "_text"}
            yield pa.record_batch(rest | {"lang_pred": pa.array(names, pa.string()), "score": pa.array(score)})
            pa.default_memory_pool().release_unused()

    return predict


def identify(docs: DataFrame, model: Model | None, text_col: str = "text", keep_cols: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep_cols`` with lang_pred and score (the posterior of the language, 0 to 1) per row.

    Null text and text without a letter get ``und`` and score 0, as does every row without a model.
    Rows are predicted one by one, whole texts, so repeated rows get equal predictions.
    """
    if model is None:
        return docs.select(*keep_cols, F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    rows = docs.select(*keep_cols, F.col(text_col).alias("_text"))
    kinds = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes if c != "_text")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_predictor(shared), f"{kinds}, lang_pred string, score double")
