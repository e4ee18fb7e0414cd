"""SimHash near-dedup: fingerprints, and an exact tiled comparison of all of them within a radius."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindery.llm.components import components
from bindery.llm.stages import keep, row_number, slices
from bindery.operators.keyed import lookup_join

SHINGLE = 4
RADIUS = 4
SEED = 42
PARTS = 4  # a tile knows the range of the population counts of so many parts of its fingerprints
TILES = 64  # tiles aimed at, as long as their size stays within the limits below
TILE_ROWS = (4096, 1 << 18)
BLOCK = 256  # rows compared at once inside a tile pair
FOUND = 1 << 20  # links held before they are reduced to a spanning forest


# --- fingerprints ---------------------------------------------------------------------------------


def _fingerprinter(n: int, seed: int):
    def fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh64_intdigest
        for batch in slices(batches, "_text", 1 << 21):
            hashes, counts = [], []
            for text in batch.column("_text").to_pylist():
                # Splits at exactly [\x20\x09-\x0D], and lowers exactly A-Z.
                words = (text or "").encode("utf-8", "surrogatepass").lower().split()
                whole = b" ".join(words)
                if len(words) <= n:
                    hashes += [digest(whole, seed)] if words else []
                    counts.append(min(len(words), 1))
                    continue
                sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
                ends = np.cumsum(sizes)
                begin, end = (ends - sizes)[: len(words) - n + 1].tolist(), (ends[n - 1 :] - 1).tolist()
                hashes += [digest(whole[i:j], seed) for i, j in zip(begin, end)]
                counts.append(len(begin))
            counts = np.array(counts, np.int64)
            values = np.array(hashes, "<u8")
            bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            some = np.flatnonzero(counts)
            prints = np.zeros(len(counts), np.uint64)
            if len(some):
                ones = np.add.reduceat(bits, (np.cumsum(counts) - counts)[some], axis=0, dtype=np.int64)
                major = (2 * ones > counts[some, None]).astype(np.uint8)
                prints[some] = np.packbits(major, axis=1, bitorder="little").view("<u8").reshape(-1)
            yield pa.record_batch(
                {
                    "_row": batch.column("_row"),
                    "_id": batch.column("_id"),
                    "n_shingles": pa.array(counts),
                    "_print": pa.array(prints.view(np.int64)),
                }
            )

    return fingerprint


# --- tiles ----------------------------------------------------------------------------------------


def part_counts(prints: np.ndarray, parts: int = PARTS) -> np.ndarray:
    """Population counts of the parts of each fingerprint. Their sum of differences is at most the distance."""
    width = 64 // parts
    shifts = np.arange(parts, dtype=np.uint64) * np.uint64(width)
    return np.bitwise_count((prints[:, None] >> shifts) & np.uint64(2**width - 1)).astype(np.int64)


def split(points: np.ndarray, weights: np.ndarray, most: int) -> list[np.ndarray]:
    """Index sets of points that lie close together, of a total weight of at most ``most`` each, by halving
    the longest side at its median; equal points stay together, whatever they weigh."""
    leaves, todo = [], [np.arange(len(points))] if len(points) else []
    while todo:
        at = todo.pop()
        own = points[at]
        side = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
        values = own[:, side]
        if weights[at].sum() <= most or values.min() == values.max():
            leaves.append(at)
            continue
        order = np.argsort(values, kind="stable")
        held = np.cumsum(weights[at][order])
        middle = values[order][np.searchsorted(held, held[-1] / 2)]
        low = values <= (middle if middle < values.max() else middle - 1)
        todo += [at[low], at[~low]]
    return leaves


def gaps(low: np.ndarray, high: np.ndarray, other_low: np.ndarray, other_high: np.ndarray) -> np.ndarray:
    """Least sum of differences of population counts between boxes (one against many)."""
    return np.maximum(0, np.maximum(low - other_high, other_low - high)).sum(axis=-1)


class Plan(NamedTuple):
    """Boxes of population counts that hold the tiles; a box too heavy for one tile is dealt to ``chunks``."""

    box_of: dict[int, int]  # class code -> box
    low: np.ndarray
    high: np.ndarray
    chunks: np.ndarray


def _codes(points: np.ndarray) -> np.ndarray:
    return points @ (65 ** np.arange(points.shape[1], dtype=np.int64))


def plan_tiles(points: np.ndarray, weights: np.ndarray, most: int) -> Plan:
    leaves = split(points, weights, most)
    box_of = {int(c): i for i, at in enumerate(leaves) for c in _codes(points[at])}
    low = np.array([points[at].min(axis=0) for at in leaves]).reshape(-1, points.shape[1])
    high = np.array([points[at].max(axis=0) for at in leaves]).reshape(-1, points.shape[1])
    chunks = np.array([-(-int(weights[at].sum()) // most) for at in leaves], np.int64)
    return Plan(box_of, low, high, chunks)


def _packer(plan: Plan):
    """Fingerprints of one class (in chunks by their own value) to rows of (tile, packed fingerprints)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column("_print").to_numpy().view(np.uint64)
            boxes = np.array([plan.box_of[c] for c in _codes(part_counts(prints)).tolist()], np.int64)
            spread = (prints * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            tiles = boxes << 32 | (spread % plan.chunks[boxes].astype(np.uint64)).astype(np.int64)
            order = np.argsort(tiles, kind="stable")
            own, first = np.unique(tiles[order], return_index=True)
            parts = np.split(prints[order], first[1:])
            yield pa.record_batch(
                {"_tile": pa.array(own), "_prints": pa.array([p.astype("<u8").tobytes() for p in parts], pa.binary())}
            )

    return pack


def _dealer(plan: Plan, radius: int, first: bool):
    """Every tile to the tile pairs (_i <= _j) it takes part in, as their first or as their second.

    Pairs whose population counts differ by more than the radius are skipped.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tile, prints in zip(batch.column("_tile").to_pylist(), batch.column("_prints").to_pylist()):
                box = tile >> 32
                near = np.flatnonzero(gaps(plan.low[box], plan.high[box], plan.low, plan.high) <= radius)
                near = near[near >= box] if first else near[near <= box]
                other = np.concatenate([(b << 32) + np.arange(plan.chunks[b]) for b in near.tolist()])
                other = other[other >= tile] if first else other[other <= tile]
                for part in np.array_split(other, -(-len(other) * len(prints) // (8 << 20))):
                    own = pa.array(np.full(len(part), tile))
                    yield pa.record_batch(
                        {
                            "_i": own if first else pa.array(part),
                            "_j": pa.array(part) if first else own,
                            "_a" if first else "_b": pa.array([prints] * len(part), pa.binary()),
                        }
                    )

    return deal


# --- comparison -----------------------------------------------------------------------------------


def forest(n: int, u: np.ndarray, v: np.ndarray, parent: np.ndarray | None = None) -> np.ndarray:
    """The smallest node each of n nodes can reach over the links (u, v) and an earlier result."""
    parent = np.arange(n) if parent is None else parent
    while True:
        pu, pv = parent[u], parent[v]
        apart = pu != pv
        if not apart.any():
            return parent
        np.minimum.at(parent, np.maximum(pu, pv)[apart], np.minimum(pu, pv)[apart])
        while True:
            above = parent[parent]
            if (above == parent).all():
                break
            parent = above


def _blocks(prints: np.ndarray):
    """The tile's fingerprints in blocks of close population counts: order, block starts, boxes."""
    points = part_counts(prints)
    leaves = split(points, np.ones(len(prints), np.int64), BLOCK)
    leaves = [x for at in leaves for x in np.array_split(at, -(-len(at) // BLOCK))]
    low, high = (np.array([f(points[at], axis=0) for at in leaves]) for f in (np.min, np.max))
    return leaves, low, high


def linked_pairs(a: np.ndarray, b: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """A spanning forest (node, root) of the links within a tile (b is None) or between two tiles."""
    nodes = a if b is None else np.concatenate([a, b])
    left = _blocks(a)
    right, base = (left, 0) if b is None else (_blocks(b), len(a))
    parent, u, v, held = np.arange(len(nodes)), [], [], 0
    for i, at in enumerate(left[0]):
        near = np.flatnonzero(gaps(left[1][i], left[2][i], right[1], right[2]) <= radius)
        for j in near[near >= i].tolist() if b is None else near.tolist():
            other = right[0][j]
            rows, columns = np.nonzero(np.bitwise_count(a[at][:, None] ^ nodes[base + other]) <= radius)
            u.append(at[rows])
            v.append(base + other[columns])
            held += len(rows)
        if held > FOUND:
            parent, u, v, held = forest(len(nodes), np.concatenate(u), np.concatenate(v), parent), [], [], 0
    if u:
        parent = forest(len(nodes), np.concatenate(u), np.concatenate(v), parent)
    below = np.flatnonzero(parent != np.arange(len(nodes)))
    return nodes[below], nodes[parent[below]]


def _comparer(radius: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, a, b in zip(*(batch.column(c).to_pylist() for c in ("_i", "_j", "_a", "_b"))):
                a, b = np.frombuffer(a, "<u8"), None if i == j else np.frombuffer(b, "<u8")
                found = linked_pairs(a, b, radius)
                if len(found[0]):
                    yield pa.record_batch({c: pa.array(x.view(np.int64)) for c, x in zip("ab", found)})

    return compare


def _class_code() -> Column:
    """The code of a fingerprint's population counts, as :func:`_codes` gives it."""
    width = 64 // PARTS
    code = F.lit(0).cast("long")
    for i in range(PARTS):
        part = F.shiftrightunsigned("_print", i * width).bitwiseAND(F.lit(2**width - 1).cast("long"))
        code = code + F.bit_count(part) * F.lit(65**i).cast("long")
    return code


def linked_prints(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (_print) within ``radius`` bits of each other.

    The tiles are planned on counts per class of population counts (17 to the power of 4 classes at
    most), the only thing the driver sees. Tiles hold up to ``TILE_ROWS`` fingerprints, 8 bytes each.
    """
    n = prints.count()
    most = min(max(-(-n // TILES), TILE_ROWS[0]), TILE_ROWS[1])
    classes = prints.groupBy(_class_code().alias("_class")).agg(F.count("*").alias("_n")).toArrow()
    codes, weights = (classes.column(c).to_numpy().astype(np.int64) for c in ("_class", "_n"))
    points = codes[:, None] // 65 ** np.arange(PARTS) % 65
    plan = plan_tiles(points, weights, most)
    packed = prints.select("_print").mapInArrow(_packer(plan), "_tile long, _prints binary")
    tiles = keep(packed.groupBy("_tile").agg(F.listagg("_prints").alias("_prints")), "tiles")
    n_tiles = int(plan.chunks.sum())
    n_parts = min(2 * prints.sparkSession.sparkContext.defaultParallelism + n_tiles * n_tiles // 16, 20000)
    left = tiles.mapInArrow(_dealer(plan, radius, True), "_i long, _j long, _a binary")
    right = tiles.mapInArrow(_dealer(plan, radius, False), "_i long, _j long, _b binary")
    left, right = (x.repartition(n_parts, "_i", "_j") for x in (left, right))
    return keep(left.join(right.hint("merge"), ["_i", "_j"]).mapInArrow(_comparer(radius), "a long, b long"), "links")


def simhash_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, row: str | None = None,
    n: int = SHINGLE, radius: int = RADIUS, seed: int = SEED,
) -> DataFrame:
    """The component of each document under fingerprints that differ in at most ``radius`` bits.

    A fingerprint bit is 1 if it is set in over half of the XXH64 values of the text's ``n``-word shingles,
    repeats included (A-Z in lower case; the whole sequence where it has fewer words). Null, blank and
    wordless texts have the fingerprint zero, which is linked like any other.

    Every pair of distinct fingerprints is compared unless the population counts of their parts rule it out;
    a tile pair returns a spanning forest of its links, so a group of copies costs no pairs. Repeated rows
    are rows of their own. An empty table gives an empty result. Columns: ``id_col``, fingerprint (16
    hex digits), component_id (smallest id reachable; null ids only where there is no other),
    n_shingles, and ``row`` where given.
    """
    texts = docs.select(
        row_number(row).alias("_row"), F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")
    )
    schema = "_row long, _id long, n_shingles long, _print long"
    signed = keep(texts.mapInArrow(_fingerprinter(n, seed), schema), "fingerprints")
    classes = keep(signed.groupBy("_print").agg(F.min("_id").alias("_least")), "distinct-prints")
    roots = components(linked_prints(classes.select("_print"), radius))
    rooted = classes.join(roots, classes["_print"] == roots["node"], "left")
    rooted = keep(rooted.select("_print", "_least", F.coalesce("root", "_print").alias("_root")), "rooted")
    lowest = rooted.groupBy("_root").agg(F.min("_least").alias("component_id"))
    named = lookup_join(rooted.select("_print", "_root"), lowest, ["_root"], row_id=["_print"])
    named = keep(named.select("_print", "component_id"), "named")
    return lookup_join(signed, named, ["_print"], row_id=["_row"]).select(
        *([F.col("_row").alias(row)] if row else []),
        F.col("_id").alias(id_col),
        F.lower(F.lpad(F.hex("_print"), 16, "0")).alias("fingerprint"),
        "component_id",
        "n_shingles",
    )
