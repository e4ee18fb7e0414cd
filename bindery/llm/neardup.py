"""MinHash near-dedup: SuperMinHash signatures, banding, exact verification, distributed union-find."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindery.llm.components import linked_roots
from bindery.llm.stages import keep, row_number, slices
from bindery.llm.words import mix, shingle_sets, split_words, super_minhash
from bindery.operators.bloom import semi_join
from bindery.operators.keyed import lookup_join
from bindery.session import discard

BANDS, ROWS = 48, 6
SHINGLE = 5
THRESHOLD = 80  # percent
TILE = 512  # rows and members compared in one task

# Sets of hashes of texts, one after another, with the first place of each.
Sets = Callable[[list[str | None]], tuple[np.ndarray, np.ndarray]]


def _lowered(texts: list[str | None]) -> list[bytes]:
    """UTF-8 texts with A-Z in lower case; null is empty."""
    return [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]


def _signer(n: int, bands: int, rows: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            values, first = _word_sets(n)(batch.column("_text").to_pylist())
            signature = super_minhash(values, first, bands * rows).reshape(-1, bands, rows)
            keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), signature.shape[:2])
            for i in range(rows):
                keys = mix(keys + signature[:, :, i])
            offsets = pa.array(np.arange(0, keys.size + 1, bands, dtype=np.int32))
            same = [hashlib.blake2b(values[a:b].tobytes(), digest_size=16).digest() for a, b in zip(first, first[1:])]
            yield pa.record_batch(
                {
                    "_row": batch.column("_row"),
                    "_n": pa.array(np.diff(first).astype(np.int64)),
                    "_same": pa.array(same, pa.binary()),
                    "_bands": pa.ListArray.from_arrays(offsets, pa.array(keys.reshape(-1).view(np.int64))),
                }
            )

    return sign


def _word_sets(n: int):
    """Distinct ``n``-word shingles per text, sorted."""
    return lambda texts: shingle_sets(split_words(_lowered(texts)), n)


def _verifier(sets: Sets, threshold: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            # Rows come in the order of a, so the hub of many pairs is shingled once per batch.
            other = batch.column("_other").to_pylist()
            hubs = list(dict.fromkeys(other))
            place = {t: i for i, t in enumerate(hubs)}
            right, at = sets(hubs)
            left, first = sets(batch.column("_text").to_pylist())
            linked = []
            for i, t in enumerate(other):
                x, y = left[first[i] : first[i + 1]], right[at[place[t]] : at[place[t] + 1]]
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(both > 0 and 100 * both >= threshold * (len(x) + len(y) - both))
            links = batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))
            if links.num_rows:
                yield links

    return verify


def _linked_tile(sets: Sets, threshold: int, connected: bool):
    """Links between the rows and the members of one tile, by their full sets; one per row if the
    members are connected already."""

    def link(rows: pa.Table, members: pa.Table) -> pa.Table:
        left, at = sets(rows.column("_text_a").to_pylist())
        right, first = sets(members.column("_text_b").to_pylist())
        sizes = np.diff(first)
        a, b = rows.column("a").to_numpy(), members.column("b").to_numpy()
        links = []
        for i in range(len(a)):
            own = left[at[i] : at[i + 1]]
            place = np.minimum(np.searchsorted(own, right), len(own) - 1)
            held = np.concatenate([[0], np.cumsum(own[place] == right)])
            both = held[first[1:]] - held[first[:-1]]
            found = np.flatnonzero(100 * both >= threshold * (len(own) + sizes - both))
            links += [(int(a[i]), int(b[j])) for j in (found[:1] if connected else found[b[found] > a[i]])]
        return pa.table({c: pa.array([x[k] for x in links], pa.int64()) for k, c in enumerate("ab")})

    return link


def crossed_links(
    rows: DataFrame, members: DataFrame, connected: bool, texts: DataFrame, sets: Sets, threshold: int
) -> DataFrame:
    """Links between rows (a, _other) and the members (_other, b) of component _other, tile by tile."""
    sizes = rows.groupBy("_other").agg(F.ceil(F.count("*") / TILE).cast("int").alias("_i")).join(
        members.groupBy("_other").agg(F.ceil(F.count("*") / TILE).cast("int").alias("_j")), "_other"
    )

    some = _asked(texts, rows.select(F.col("a").alias("_row")).unionByName(members.select(F.col("b").alias("_row"))))

    def dealt(side: DataFrame, key: str, own: str, other: str, names: list[str]):
        tile = F.pmod(F.xxhash64(key), F.col(own)).alias(own)
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other)
        placed = side.join(sizes, "_other").select("_other", key, tile, other)
        placed = placed.select("_other", key, own, every)
        text = some.select(F.col("_row").alias(key), "_text")
        both = placed.join(text, key).select(key, "_text", "_other", "_i", "_j")
        return both.toDF(key, f"_text_{key}", *names).groupBy(*names)

    left = dealt(rows, "a", "_i", "_j", ["_component", "_ri", "_rj"])
    right = dealt(members, "b", "_j", "_i", ["_of", "_mi", "_mj"])
    links = keep(left.cogroup(right).applyInArrow(_linked_tile(sets, threshold, connected), "a long, b long"), "links")
    discard(some)
    return links


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    row: str | None = None,
    n: int = SHINGLE,
    threshold: int = THRESHOLD,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """The component of each document under links of Jaccard similarity >= ``threshold`` percent.

    A document's set is its distinct ``n``-word shingles (A-Z in lower case; the whole sequence
    where it has fewer words). Null, blank and wordless texts have the empty set and no links.

    Documents with one set are one class, and one of them stands for it. Classes that share a band
    of the signature meet (see :func:`linked_roots`): every pair that meets in a band is either
    verified on the full sets or connected already. A pair at the
    threshold misses all bands with probability (1 - threshold ** rows) ** bands, 5e-7 here.
    Sets are compared by 64-bit hashes of their shingles.

    Repeated rows are rows of their own. An empty table gives an empty result. Columns: ``id_col``,
    n_shingles, component_id (smallest id reachable, null last), kept (id = component_id), stays
    (the one row of its component to keep), and ``row`` where given.
    """
    texts = docs.select(
        row_number(row).alias("_row"), F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")
    )
    if not row:
        texts = keep(texts, "texts")
    schema = "_row long, _n long, _same binary, _bands array<long>"
    signed = keep(texts.select("_row", "_text").mapInArrow(_signer(n, bands, rows), schema), "signatures")

    stand = signed.filter("_n > 0").groupBy("_same").agg(F.min("_row").alias("_class"))
    named = lookup_join(signed.filter("_n > 0").select("_row", "_same"), stand, ["_same"], row_id=["_row"])
    members = keep(named.select("_row", "_class"), "classes")
    standing = signed.join(members.filter("_row = _class"), "_row", "left_semi").select("_row", "_n", "_bands")
    sets = _word_sets(n)
    roots = linked_roots(
        standing,
        lambda pairs: verified_links(pairs, signed.select("_row", "_n"), texts, sets, threshold),
        lambda a, b, connected: crossed_links(a, b, connected, texts, sets, threshold),
    )

    classed = signed.select("_row", "_n").join(members, "_row", "left")
    rooted = classed.join(roots, classed["_class"] == roots["node"], "left").select(
        "_row", F.col("_n").alias("n_shingles"), F.coalesce("root", "_class", "_row").alias("_root")
    )
    out = keep(rooted.join(texts.select("_row", "_id"), "_row"), "rooted")
    least = F.min(F.struct(F.col("_id").isNull().alias("n"), "_id", "_row"))
    lowest = out.groupBy("_root").agg(least.alias("_least"))
    return lookup_join(out, lowest, ["_root"], row_id=["_row"]).select(
        *([F.col("_row").alias(row)] if row else []),
        F.col("_id").alias(id_col),
        "n_shingles",
        F.col("_least._id").alias("component_id"),
        F.col("_id").eqNullSafe(F.col("_least._id")).alias("kept"),
        (F.col("_row") == F.col("_least._row")).alias("stays"),
    )


def _asked(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """The texts of the given rows, written once. A filter of the rows keeps all other texts where they are."""
    return keep(semi_join(texts.select("_row", "_text"), keep(rows.distinct(), "asked"), ["_row"]), "asked-texts")


def verified_links(
    pairs: DataFrame, sizes: DataFrame | None, texts: DataFrame, sets: Sets, threshold: int
) -> DataFrame:
    """Pairs (a, b) of rows whose full shingle sets are similar enough.

    The sizes of two sets, where given, rule out most pairs before any text is moved: pairs have that of b as ``_nb``, and
    that of a as ``_na`` or from ``sizes`` (_row, _n). The text of a row with many pairs is sent once per ``TILE`` pairs,
    so that they spread over tasks.
    """
    if sizes is not None and "_nb" in pairs.columns:
        if "_na" not in pairs.columns:
            one = sizes.select(F.col("_row").alias("a"), F.col("_n").alias("_na"))
            pairs = lookup_join(pairs, one, ["a"], row_id=["b"])
        pairs = pairs.filter(F.least("_na", "_nb") * 100 >= F.greatest("_na", "_nb") * threshold)
    pairs = keep(pairs.select("a", "b"), "pairs")
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / TILE).cast("int").alias("_parts"))
    hubs = keep(parts.filter("_parts > 1"), "hubs")
    some = _asked(texts, pairs.select(F.explode(F.array("a", "b")).alias("_row")))
    part = F.pmod(F.xxhash64("b"), F.coalesce("_parts", F.lit(1))).cast("int").alias("_part")
    dealt = lookup_join(pairs, hubs, ["a"], row_id=["b"]).select("a", "b", part)
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)).alias("_part")
    first = some.select(F.col("_row").alias("a"), F.col("_text").alias("_other")).join(hubs, "a", "left")
    second = some.select(F.col("_row").alias("b"), "_text")
    both = dealt.join(second, "b").join(first.select("a", copies, "_other"), ["a", "_part"])
    both = both.select("a", "b", "_text", "_other")
    links = keep(both.mapInArrow(_verifier(sets, threshold), "a long, b long"), "links")
    discard(pairs, some, hubs)
    return links
