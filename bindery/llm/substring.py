"""Substring dedup by content-defined blocks and exact window counts.

Every text is parsed into blocks at content-defined places: a window of ``window`` words belongs to
its anchor, the smallest hash among its k-grams, and a block is a run of windows with one anchor. The
blocks of all documents are joined by hash; where a block is not held elsewhere as a whole but shares
its anchor, its windows are counted one by one, and the words that found windows cover are merged into
spans. Since equal windows have equal anchors, a window is found exactly when it starts anywhere else.
This stands in place of a relative Lempel-Ziv parse: no factors are grown along a reference document,
the spans are the same, and a passage shared by very many texts costs no pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindery.llm.stages import keep, row_number, slices
from bindery.llm.words import Words, document_of, grams, mix, split_words

WINDOW = 35
GRAM = 8


def _encoded(batch: pa.RecordBatch) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in batch.column("_text").to_pylist()]


def parse(words: Words, window: int, k: int) -> dict[str, np.ndarray]:
    """The blocks of all documents: document, first window (word place), windows, anchor and its key."""
    hashes, first = words.hashes, words.first
    if len(hashes) < window:
        empty = np.zeros(0, np.int64)
        return {"doc": empty, "start": empty, "n": empty, "anchor": empty, "key": empty.astype(np.uint64)}
    keys = grams(hashes, k, k)
    lowest, place = keys, np.arange(len(keys))
    width, span = 1, window - k + 1
    while width < span:
        step = min(width, span - width)
        take = lowest[step:] < lowest[:-step]  # the leftmost of equal keys stays
        place = np.where(take, place[step:], place[:-step])
        lowest = np.where(take, lowest[step:], lowest[:-step])
        width += step
    doc = document_of(first)[: len(place)]
    inside = np.flatnonzero(np.arange(len(place)) + window <= first[1:][doc])
    anchor = place[inside]
    head = np.flatnonzero(np.diff(anchor, prepend=-1))  # anchors rise and lie in their own document
    return {
        "doc": doc[inside[head]],
        "start": inside[head],
        "n": np.diff(head, append=len(inside)),
        "anchor": anchor[head],
        "key": keys[anchor[head]],
    }


def _indexer(window: int, k: int):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            texts = _encoded(batch)
            words = split_words(texts)
            blocks = parse(words, window, k)
            ends = np.searchsorted(blocks["doc"], np.arange(len(texts) + 1)).astype(np.int32)
            keys = pa.ListArray.from_arrays(pa.array(ends), pa.array(blocks["key"].view(np.int64)))
            yield pa.record_batch(
                {
                    "_row": batch.column("_row"),
                    "_n": pa.array(np.diff(words.first).astype(np.int64)),
                    "_sha": pa.array([hashlib.sha256(b" ".join(t.split())).hexdigest() for t in texts]),
                    "_keys": keys,
                }
            )

    return index


def _describer(window: int, k: int):
    """The asked blocks of each document with their digest and the hashes of their windows."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            words = split_words(_encoded(batch))
            blocks = parse(words, window, k)
            first = np.searchsorted(blocks["doc"], np.arange(batch.num_rows))
            asked = batch.column("_blocks")
            at = np.repeat(first, asked.value_lengths().to_numpy()) + asked.flatten().to_numpy()
            start, n = blocks["start"][at], blocks["n"][at]
            hashes = grams(words.hashes, window, window)
            begin = np.cumsum(n) - n
            inside = np.arange(n.sum()) - np.repeat(begin, n)
            windows = hashes[np.repeat(start, n) + inside]
            digest = np.add.reduceat(mix(windows + inside.astype(np.uint64)), begin) if len(at) else windows
            digest = mix(digest + (n * 64 + blocks["anchor"][at] - start).astype(np.uint64))
            offsets = np.concatenate([begin, [n.sum()]]).astype(np.int32)
            yield pa.record_batch(
                {
                    "_row": pa.array(batch.column("_row").to_numpy()[blocks["doc"][at]]),
                    "_start": pa.array(start - words.first[blocks["doc"][at]]),
                    "_key": pa.array(blocks["key"][at].view(np.int64)),
                    "_digest": pa.array(digest.view(np.int64)),
                    "_windows": pa.ListArray.from_arrays(pa.array(offsets), pa.array(windows.view(np.int64))),
                }
            )

    return describe


def _remover(window: int):
    """What is left of each document, and the spans that go."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            shas, removed, spans = [], [], []
            for text, found in zip(_encoded(batch), batch.column("_found").to_pylist()):
                words = text.split()
                cover = np.zeros(len(words) + 1, np.int64)
                for block in found:
                    starts = block["_start"] + np.flatnonzero([block["_mask"] >> i & 1 for i in range(64)])
                    np.add.at(cover, starts, 1)
                    np.add.at(cover, starts + window, -1)
                gone = np.cumsum(cover[:-1]) > 0
                edges = np.flatnonzero(np.diff(gone, prepend=False, append=False)).reshape(-1, 2)
                kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g])
                shas.append(hashlib.sha256(kept).hexdigest())
                removed.append(int(gone.sum()))
                spans.append([{"start": int(a), "length": int(b - a)} for a, b in edges])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
            yield pa.record_batch(
                {
                    "_row": batch.column("_row"),
                    "_removed": pa.array(removed, pa.int64()),
                    "_left": pa.array(shas, pa.string()),
                    "spans": pa.array(spans, kind),
                }
            )

    return remove


def substring_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    row: str | None = None,
    window: int = WINDOW,
    k: int = GRAM,
) -> DataFrame:
    """Words covered by a ``window`` of words that also starts anywhere else, the same text included.

    Words are runs of non-space characters; windows lie within one document and are judged on the
    input. Null text has no words; a text shorter than a window loses nothing; repeated rows are rows
    of their own, and so lose everything a window covers; an empty table gives an empty result.
    Blocks are found by 64-bit hashes of an anchor together with 64-bit hashes of the words.

    ``window - k`` must be below 63. Columns: ``id_col``, n_words, n_removed, kept_sha256 (of the kept
    words joined by one space), spans (start and length in words), and ``row`` where given.
    """
    texts = docs.select(
        row_number(row).alias("_row"), F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")
    )
    if not row:
        texts = keep(texts, "texts")
    parsed = texts.select("_row", "_text").mapInArrow(
        _indexer(window, k), "_row long, _n long, _sha string, _keys array<long>"
    )
    parsed = keep(parsed, "parsed")

    # Anchors that occur once belong to windows that occur once.
    keys = parsed.select(F.explode("_keys").alias("_key")).groupBy("_key").agg(F.count("*").alias("_n"))
    shared = keep(keys.filter("_n > 1").select("_key"), "shared-anchors")
    places = parsed.select("_row", F.posexplode("_keys").alias("_block", "_key"))
    asked = places.join(shared.hint("merge"), "_key", "left_semi").groupBy("_row")
    asked = keep(asked.agg(F.sort_array(F.collect_list("_block")).alias("_blocks")), "asked-blocks")
    suspects = keep(texts.select("_row", "_text").join(asked, "_row"), "suspects")
    blocks = keep(
        suspects.mapInArrow(
            _describer(window, k), "_row long, _start long, _key long, _digest long, _windows array<long>"
        ),
        "blocks",
    )

    index = keep(
        blocks.groupBy("_key", "_digest").agg(F.count("*").alias("_n"), F.first("_windows").alias("_windows")), "index"
    )
    whole = index.filter("_n > 1").select(
        "_key", "_digest", F.expr("shiftleft(1L, size(_windows)) - 1").alias("_mask")
    )
    windows = index.select("_key", "_digest", "_n", F.posexplode("_windows").alias("_at", "_window"))
    again = windows.groupBy("_key", "_window").agg(F.sum("_n").alias("_sum")).filter("_sum > 1").drop("_sum")
    ends = (
        windows.filter("_n = 1")
        .join(again, ["_key", "_window"], "left_semi")
        .groupBy("_key", "_digest")
        .agg(F.expr("bit_or(shiftleft(1L, _at))").alias("_mask"))
    )
    masks = keep(whole.unionByName(ends), "repeated-windows")
    found = (
        blocks.select("_row", "_start", "_key", "_digest")
        .join(masks, ["_key", "_digest"])
        .groupBy("_row")
        .agg(F.collect_list(F.struct("_start", "_mask")).alias("_found"))
    )
    cut = keep(
        suspects.select("_row", "_text")
        .join(found, "_row")
        .mapInArrow(
            _remover(window), "_row long, _removed long, _left string, spans array<struct<start:long,length:long>>"
        ),
        "spans",
    )
    out = parsed.select("_row", "_n", "_sha").join(texts.select("_row", "_id"), "_row").join(cut, "_row", "left")
    return out.select(
        *([F.col("_row").alias(row)] if row else []),
        F.col("_id").alias(id_col),
        F.col("_n").alias("n_words"),
        F.coalesce("_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("_left", "_sha").alias("kept_sha256"),
        F.coalesce("spans", F.expr("cast(array() as array<struct<start:bigint,length:bigint>>)")).alias("spans"),
    )
