"""Exact dedup by recipes of content-defined chunks, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bindery.llm.stages import SPACES, keep, row_number
from bindery.operators.keyed import lookup_join

# A chunk ends after two letters of the class, at 1024 characters or later and at 8192 at most.
CHUNKS = r"(?s).{1024,8192}?(?:[ckpvxyzCKPVXYZ2479]{2}|\z)|.{1,8192}"


def sha256_id(chunk: Column) -> Column:
    return F.sha2(chunk, 256)


def normalised(text: str) -> Column:
    return F.translate(F.coalesce(F.col(text), F.lit("")), SPACES, "")


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    row: str | None = None,
    chunk_id: Callable[[Column], Column] = sha256_id,
) -> DataFrame:
    """One row per input row: who stays of the texts that are equal without white space.

    A text is cut where its content says so; its recipe is the ordered list of chunk identifiers.
    Equal texts have equal recipes. The identifiers are verified: every distinct chunk is sent to
    its identifier once, and where one identifier stands for two contents, they are numbered and
    the number becomes part of it. So recipes are equal only for equal texts, whatever the hash,
    and later steps compare recipes without moving a text.

    Of equal texts the row with the most code points stays, then the smallest ``id_col`` (null
    last), then one of the identical rows. Null text counts as empty; all empty texts are equal.
    An empty table gives an empty result. Columns: ``id_col``, keep_id, group_size, kept,
    text_sha256, and ``row`` where given.
    """
    cut = docs.select(
        row_number(row).alias("_row"),
        F.col(id_col).alias("_id"),
        F.char_length(F.coalesce(F.col(text_col), F.lit(""))).alias("_points"),
        normalised(text_col).alias("_text"),
    ).withColumn("_chunks", F.regexp_extract_all("_text", F.lit(CHUNKS), F.lit(0)))
    ids = cut.select(
        "_row",
        "_id",
        "_points",
        F.sha2("_text", 256).alias("_sha"),
        F.array_join(F.transform("_chunks", chunk_id), " ").alias("_recipe"),
    )
    rows = keep(ids, "recipes")

    chunks = cut.select(F.explode("_chunks").alias("_chunk")).select(chunk_id(F.col("_chunk")).alias("_cid"), "_chunk")
    contents = chunks.distinct().groupBy("_cid").agg(F.count("*").alias("_n"))
    shared = keep(contents.filter("_n > 1").select("_cid"), "ambiguous-chunks")
    if not shared.isEmpty():
        rows = keep(_renumbered(rows, cut, chunks, shared, chunk_id), "recipes")

    best = F.min(F.struct((-F.col("_points")).alias("p"), F.col("_id").isNull().alias("n"), "_id", "_row"))
    groups = rows.groupBy("_recipe").agg(best.alias("_best"), F.count("*").alias("_size"))
    out = lookup_join(rows, groups, ["_recipe"], row_id=["_row"])
    return out.select(
        *([F.col("_row").alias(row)] if row else []),
        F.col("_id").alias(id_col),
        F.col("_best._id").alias("keep_id"),
        F.col("_size").alias("group_size"),
        (F.col("_row") == F.col("_best._row")).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def _renumbered(rows, cut, chunks, shared, chunk_id) -> DataFrame:
    """Recipes whose ambiguous identifiers carry the number of the content they stand for."""
    order = Window.partitionBy("_cid").orderBy("_chunk")
    numbered = (
        chunks.join(shared, "_cid", "left_semi").distinct().withColumn("_no", F.row_number().over(order))
    )
    places = cut.select("_row", F.posexplode("_chunks").alias("_pos", "_chunk")).withColumn(
        "_cid", chunk_id(F.col("_chunk"))
    )
    named = places.join(numbered, ["_cid", "_chunk"], "left").select(
        "_row", "_pos", F.concat_ws(":", F.col("_cid").cast("string"), F.col("_no").cast("string")).alias("_name")
    )
    lists = named.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("_pos", "_name"))).alias("_list"))
    recipe = F.array_join(F.transform("_list", lambda x: x["_name"]), " ")
    return rows.drop("_recipe").join(lists, "_row", "left").select(
        "_row", "_id", "_points", "_sha", F.coalesce(recipe, F.lit("")).alias("_recipe")
    )
