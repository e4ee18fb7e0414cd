"""Cross-tokenizer alignment: two tokenizations of one text cut at the byte offsets where both end a token."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindery.llm.packing import load_encoder
from bindery.llm.stages import keep, row_number, slices
from bindery.operators.keyed import lookup_join

SLICE_BYTES = 1 << 21
# Two linked tokens end together, so the bytes of one end in the bytes of the other: the public
# vocabularies allow 324,297 such pairs, whatever the corpus.
BROADCAST_PAIRS = 2_000_000


# --- divide and conquer ---------------------------------------------------------------------------


def shared_cuts(
    a_ends: np.ndarray, b_ends: np.ndarray, a_first: np.ndarray, b_first: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Places (in A, in B) of the token pairs that end together, in order.

    ``a_ends`` and ``b_ends`` rise strictly over all texts of a batch; text i has the tokens
    ``a_first[i]`` up to ``a_first[i + 1]`` and ends with both sides. An interval of tokens is cut at the
    common end nearest its middle and both halves are cut in turn; all intervals of one depth are
    handled together. Intervals without a common end inside are leaves, one group each.
    """
    used = a_first[1:] > a_first[:-1]
    a_cuts, b_cuts = [a_first[1:][used] - 1], [b_first[1:][used] - 1]
    low, high = a_first[:-1][used], a_first[1:][used] - 1  # tokens whose ends may be cuts inside
    while len(low):
        a_at, b_at = _cut_near_middle(a_ends, b_ends, low, high)
        found = a_at >= 0
        low, high, a_at = low[found], high[found], a_at[found]
        a_cuts.append(a_at)
        b_cuts.append(b_at[found])
        # Halves stay in the order of the text, which keeps the bisection's reads close together.
        low, high = (np.stack(x, axis=1).reshape(-1) for x in ((low, a_at + 1), (a_at, high)))
        inner = low < high
        low, high = low[inner], high[inner]
    a_cuts, b_cuts = np.concatenate(a_cuts), np.concatenate(b_cuts)
    order = np.argsort(a_cuts, kind="stable")
    return a_cuts[order], b_cuts[order]


def _cut_near_middle(a_ends: np.ndarray, b_ends: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Per interval the token of A nearest the middle that ends with one of B (bisected), or -1.

    The search goes outwards on both sides, in windows that double.
    """
    a_at, b_at = np.full(len(low), -1), np.full(len(low), -1)
    middle, open_ = (low + high) >> 1, np.arange(len(low))
    reach, width = 0, 1
    while len(open_):
        steps = np.arange(reach, reach + width)
        steps = np.stack([steps, -steps], axis=1).reshape(-1) if reach else steps
        place = middle[open_, None] + steps
        inside = (place >= low[open_, None]) & (place < high[open_, None])
        end = a_ends[np.where(inside, place, low[open_, None])]
        partner = np.searchsorted(b_ends, end)  # the text's last end is common, so this is in range
        hit = inside & (b_ends[partner] == end)
        first = hit.argmax(axis=1)
        rows = np.arange(len(open_))
        got = hit[rows, first]
        a_at[open_[got]], b_at[open_[got]] = place[rows, first][got], partner[rows, first][got]
        reach, width = reach + width, min(2 * width, 1 << 12)
        m = middle[open_]
        open_ = open_[~got & ((m + reach < high[open_]) | (m - reach >= low[open_]))]
    return a_at, b_at


def groups_text(a_ids: np.ndarray, b_ids: np.ndarray, a_last: np.ndarray, b_last: np.ndarray, names: np.ndarray):
    """Codes of all tokens, group by group (A's, then B's), as rows of ``names``; see :func:`_names`."""
    a_mark, b_mark = np.zeros(len(a_ids), np.int64), np.zeros(len(b_ids), np.int64)
    a_mark[a_last] = b_mark[b_last] = 1
    a_group, b_group = np.cumsum(a_mark) - a_mark, np.cumsum(b_mark) - b_mark
    codes = np.empty(len(a_ids) + len(b_ids), np.int64)
    before = np.concatenate([[0], b_last + 1])
    codes[np.arange(len(a_ids)) + before[a_group]] = 2 * a_ids + a_mark
    codes[np.arange(len(b_ids)) + a_last[b_group] + 1] = names[0] + 2 * b_ids + b_mark
    return names[1][codes]


# --- vocabularies ---------------------------------------------------------------------------------


class _Pair(NamedTuple):
    a: object
    b: object
    b_bytes: list[bytes]
    a_sizes: np.ndarray
    b_sizes: np.ndarray
    names: tuple[int, np.ndarray]


def piece_bytes(pieces) -> list[bytes]:
    """The bytes of every id of a sentencepiece vocabulary."""
    return [
        bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode()
        for i, p in enumerate(pieces.id_to_piece(i) for i in range(pieces.vocab_size()))
    ]


def _names(n_a: int, n_b: int) -> tuple[int, np.ndarray]:
    """Decimal ids with the sign that follows them: inside a group, and at the end of its part."""
    out = [f"{i}{sign}" for i in range(n_a) for sign in ",|"] + [f"{i}{sign}" for i in range(n_b) for sign in ",;"]
    return 2 * n_a, np.array([x.encode() for x in out])


@lru_cache(maxsize=2)  # once per worker process
def _load(vocabulary: str, pattern: str, pieces: str) -> _Pair:
    import sentencepiece

    a, b = load_encoder(vocabulary, pattern), sentencepiece.SentencePieceProcessor(model_file=pieces)
    a_bytes, b_bytes = [a.decode_single_token_bytes(i) for i in range(a.n_vocab)], piece_bytes(b)
    sizes = [np.array([len(x) for x in table], np.int64) for table in (a_bytes, b_bytes)]
    return _Pair(a, b, b_bytes, *sizes, _names(len(a_bytes), len(b_bytes)))


def _aligner(vocabulary: str, pattern: str, pieces: str):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _load(vocabulary, pattern, pieces)
        nothing = np.zeros(0, np.int64)
        for batch in slices(batches, "_text", SLICE_BYTES):
            texts = [t or "" for t in batch.column("_text").to_pylist()]
            a_parts, b_parts = [], []
            for text, b_ids in zip(texts, pair.b.encode(texts, num_threads=1)):
                whole = " " + text
                a_ids = pair.a.encode_to_numpy(whole, disallowed_special=()) if text else nothing
                data = whole.encode()
                # Tokens of A are runs of the text's own bytes, so no byte is missing if the sizes add up.
                sound = (
                    text != ""
                    and int(pair.a_sizes[a_ids].sum()) == len(data)
                    and b"".join([pair.b_bytes[i] for i in b_ids]) == data
                )
                a_parts.append(a_ids.astype(np.int64) if sound else nothing)
                b_parts.append(np.array(b_ids, np.int64) if sound else nothing)
            n_a, n_b = (np.array([len(x) for x in parts], np.int64) for parts in (a_parts, b_parts))
            a_first, b_first = (np.concatenate([[0], np.cumsum(n)]) for n in (n_a, n_b))
            a_ids, b_ids = np.concatenate([nothing, *a_parts]), np.concatenate([nothing, *b_parts])
            # Both sides of a sound text have the same bytes, so one running sum places all texts.
            a_ends, b_ends = np.cumsum(pair.a_sizes[a_ids]), np.cumsum(pair.b_sizes[b_ids])
            a_last, b_last = shared_cuts(a_ends, b_ends, a_first, b_first)
            n_groups = np.diff(np.searchsorted(a_last, a_first))
            text = groups_text(a_ids, b_ids, a_last, b_last, pair.names)
            at = a_first + b_first
            # Names are padded with zero bytes to one width.
            digests = [
                hashlib.sha256(text[i:j].tobytes().translate(None, b"\0")[:-1]).hexdigest() if j > i else ""
                for i, j in zip(at, at[1:])
            ]
            offsets = pa.array(np.concatenate([[0], np.cumsum(n_groups)]).astype(np.int32))
            ids = [pa.array(x.astype(np.int32)) for x in (a_ids[a_last], b_ids[b_last])]
            yield pa.record_batch(
                {
                    "_row": batch.column("_row"),
                    "_id": batch.column("_id"),
                    "n_a": pa.array(n_a),
                    "n_b": pa.array(n_b),
                    "n_groups": pa.array(n_groups),
                    "groups_sha256": pa.array(digests, pa.string()),
                    "_links": pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(ids, ["a", "b"])),
                }
            )

    return align


class Alignment(NamedTuple):
    rows: DataFrame  # per document: id, n_a, n_b, n_groups, groups_sha256, _row, _links (a, b) in order
    pairs: DataFrame  # per linked id pair: a, b, count, best (count is the highest of its b)

    def links_of_rows(self) -> DataFrame:
        """Per document: _row, n_links, n_best, count_sum; documents without links are not in it."""
        links = self.rows.select("_row", F.explode("_links").alias("_l")).select("_row", "_l.a", "_l.b")
        pairs = self.pairs.select("a", "b", "count", F.col("best").cast("long").alias("_best"))
        if pairs.count() <= BROADCAST_PAIRS:
            told = links.join(F.broadcast(pairs), ["a", "b"])
        else:
            told = lookup_join(links.groupBy("_row", "a", "b").agg(F.count("*").alias("_times")), pairs, ["a", "b"])
        times = F.col("_times") if "_times" in told.columns else F.lit(1)
        return told.groupBy("_row").agg(
            F.sum(times).alias("n_links"),
            F.sum(times * F.col("_best")).alias("n_best"),
            F.sum(times * F.col("count")).alias("count_sum"),
        )


def align_tokenizers(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, row: str | None = None,
    vocabulary: str, pattern: str, pieces: str,
) -> Alignment:
    """Align a byte-level BPE (A, of a space and the text) with a piece vocabulary (B, of the text).

    Special tokens in a text are plain text. Byte offsets where tokens of A and B both end cut the
    tokens into groups, and the two tokens that end there are linked. A text is tokenized and cut
    whole, in one Arrow batch of a few MB (one text at least).

    Texts that are null or empty, or whose tokens don't spell a space and the text on both sides (as
    with the sign U+2581 itself), have no tokens and no links. Repeated rows are rows of their own, and
    their links count each time. Ties for the highest count of a B id are all best. An empty
    table gives empty results. Columns of other names don't matter.
    """
    texts = docs.select(
        row_number(row).alias("_row"), F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")
    )
    schema = (
        "_row long, _id long, n_a long, n_b long, n_groups long, groups_sha256 string, "
        "_links array<struct<a:int,b:int>>"
    )
    rows = keep(texts.mapInArrow(_aligner(vocabulary, pattern, pieces), schema), "aligned")
    links = rows.select(F.explode("_links").alias("_l")).select("_l.a", "_l.b")
    counts = keep(links.groupBy("a", "b").agg(F.count("*").alias("count")), "pair-counts")
    highest = counts.groupBy("b").agg(F.max("count").alias("_highest"))
    pairs = counts.join(highest, "b").select("a", "b", "count", (F.col("count") == F.col("_highest")).alias("best"))
    return Alignment(rows.withColumnRenamed("_id", id_col), keep(pairs, "pairs"))


def alignment_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **vocabularies: str) -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    found = align_tokenizers(docs, id_col, text_col, **vocabularies)
    joined = found.rows.drop("_links").join(found.links_of_rows(), "_row", "left")
    sums = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_links", "n_best", "count_sum")]
    return joined.select(id_col, "n_a", "n_b", "n_groups", *sums, "groups_sha256")
