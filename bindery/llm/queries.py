"""The queries of the numbered operators, with SQL where SQL can express them."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindery.llm.alignment import alignment_report
from bindery.llm.audit import filter_audit
from bindery.llm.exact import exact_dedup
from bindery.llm.language import fit as fit_language
from bindery.llm.language import identify
from bindery.llm.licences import licence_scan
from bindery.llm.linededup import fuzzy_line_dedup
from bindery.llm.mixing import mix_sources
from bindery.llm.neardup import near_duplicates
from bindery.llm.packing import best_fit_pack
from bindery.llm.quality import quality_scores
from bindery.llm.simhash import simhash_near_duplicates
from bindery.llm.substring import substring_dedup
from bindery.llm.topk import top_k

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


SPACE = r"[\x20\x09-\x0D]"


@query(
    "op10_exact_dedup",
    f"""
    WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS points,
                      regexp_replace(coalesce(text, ''), '{SPACE}', '', 'g') AS body FROM documents),
    n AS (SELECT *, row_number() OVER same AS place, first_value(doc_id) OVER same AS keep_id,
                 count(*) OVER (PARTITION BY body) AS group_size
          FROM t WINDOW same AS (PARTITION BY body ORDER BY points DESC, doc_id))
    SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(body) AS text_sha256 FROM n
    """,
)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(table(spark, folder, "documents"))


@query("op7_source_mixing")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    taken = mix_sources(table(spark, folder, "documents")).taken()
    return taken.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


_WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
# A-Z only, as the operator does it.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op4_near_dedup",
    f"""
    WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
    s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
                 ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM w),
    e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
    c AS (SELECT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny, count(*) AS common
          FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
          GROUP BY ALL),
    l AS (SELECT x, y FROM c WHERE 100 * common >= 80 * (nx + ny - common)),
    u AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
    r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, u.y FROM r JOIN u ON r.y = u.x),
    m AS (SELECT x, min(y) AS component_id FROM r GROUP BY x)
    SELECT s.doc_id, len(s.s) AS n_shingles, component_id, s.doc_id = component_id AS kept
    FROM s JOIN m ON s.doc_id = m.x
    """,
)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(table(spark, folder, "documents"), n=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query(
    "op3_exact_topk",
    """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) AS v FROM embeddings
               WHERE embedding IS NOT NULL AND len(embedding) = len(list_filter(embedding, lambda x: isfinite(x)))),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint AS score
          FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::int AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    def whole(x):  # floor() gives a long; doubles beyond its range are whole already
        y = F.lit(256.0) * x.cast("double")
        return F.when(F.abs(y) < 2.0**52, F.floor(y).cast("double")).otherwise(y)

    vectors = table(spark, folder, "embeddings").select("vec_id", F.transform("embedding", whole).alias("embedding"))
    return top_k(vectors.filter("vec_id % 50 = 0"), vectors)


def vocabulary() -> dict[str, str]:
    """Where the public vocabulary is: the ranks of byte_bpe_50k.json, and its splitting pattern."""
    import public_tokenizers

    return {"vocabulary": public_tokenizers.path("byte_bpe_50k.tiktoken"), "pattern": public_tokenizers.PATTERN}


def special_tokens() -> dict[str, int]:
    """The special tokens that the tokenizer finds in texts, whether or not it adds its own."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}


@query("op1_best_fit_packing")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return best_fit_pack(table(spark, folder, "documents"), **vocabulary(), specials=special_tokens())


@query(
    "op6_substring_dedup",
    f"""
    WITH w AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
    p AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM w),
    g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY w[i : i + 34]) > 1 AS again FROM p),
    c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS j FROM g WHERE again),
    d AS (SELECT doc_id, list(j) AS gone FROM c GROUP BY doc_id),
    k AS (SELECT w.doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
                 CASE WHEN gone IS NULL THEN w
                      ELSE list_filter(w, lambda x, j: NOT list_contains(gone, j)) END AS kept
          FROM w LEFT JOIN d USING (doc_id))
    SELECT doc_id, n_words, n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM k
    """,
)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup(table(spark, folder, "documents")).drop("spans")


def _crc_mod(n: int):
    return F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")), F.lit(n))


@query("op8_language_id")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(
        "doc_id", "text", "lang", F.coalesce(_crc_mod(4) == 2, F.lit(False)).alias("held_out")
    )
    model = fit_language(docs.filter(_crc_mod(4) != 2), seed=F.xxhash64("doc_id"))
    return identify(docs, model, keep_cols=("doc_id", "held_out"))


@query("op9_quality")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scored = quality_scores(docs, labels, learn_from=_crc_mod(5) != 0)
    held_out = F.coalesce(_crc_mod(5) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op2_line_dedup")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return fuzzy_line_dedup(table(spark, folder, "documents")).drop("line")


@query("op5_licence_scan")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return licence_scan(table(spark, folder, "documents"))


@query("op11_tokenizer_alignment")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    pieces = public_tokenizers.path("piece_bpe_32k.model")
    return alignment_report(table(spark, folder, "documents"), pieces=pieces, **vocabulary())


@query("op12_simhash_dedup")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash_near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


@query(
    "op13_filter_audit",
    f"""
    WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS x,
                      {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
    f AS (SELECT doc_id, part,
                 (len(w) < 50)::int + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::int
                 + 4 * (100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 5 * length(x))::int
                 + 8 * regexp_matches(x, '[#$%&*|]')::int
                 + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY x), false)::int AS mask FROM t),
    l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
    c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (l.good) AS good, count(*) FILTER (l.toxic) AS toxic
          FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
    a AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
    o AS (SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM a p, a q, a r, a s, a t
          WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
    k AS (SELECT *, unnest(range(1, 6))::int AS step FROM o),
    b AS (SELECT *, list_transform(string_split(filter_order, ''), lambda y: 1 << (ascii(y) - 65)) AS bits FROM k),
    s AS (SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1 : step - 1]), 0)::int AS earlier FROM b)
    SELECT part, filter_order, step,
           coalesce(sum(n) FILTER (mask & (own | earlier) = 0), 0)::bigint AS kept,
           coalesce(sum(n) FILTER (mask & own > 0 AND mask & earlier = 0), 0)::bigint AS removed,
           coalesce(sum(n) FILTER (mask & own > 0 AND mask & earlier > 0), 0)::bigint AS redundant,
           coalesce(sum(n) FILTER (mask = own), 0)::bigint AS unique_fails,
           coalesce(sum(good) FILTER (mask & own > 0 AND mask & earlier = 0), 0)::bigint AS good_lost,
           coalesce(sum(toxic) FILTER (mask & own > 0 AND mask & earlier = 0), 0)::bigint AS toxic_lost,
           coalesce(sum(n * 120 // greatest(bit_count(mask), 1)) FILTER (mask & own > 0), 0)::bigint AS shapley
    FROM c CROSS JOIN s GROUP BY part, filter_order, step
    """,
)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit(spark, f"{folder.rstrip('/')}/documents.parquet", table(spark, folder, "labels"))
