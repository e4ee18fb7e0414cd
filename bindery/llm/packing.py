"""Best-fit packing: a configuration linear program over the length histogram, then rounding."""

from __future__ import annotations

import base64
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindery.llm.stages import keep, row_number, slices
from bindery.operators.ordered import running_totals

CAPACITY = 1024
END_ID = 2
PHASES = 6
STEPS = 300
RATE = 0.2
PRIOR = 1.5
WASTE = 256


# --- the linear program over lengths ----------------------------------------------------------


def best_configuration(prices: np.ndarray, capacity: int) -> np.ndarray:
    """Knapsack by dynamic programming: how often each length is taken for the highest total price.

    ``prices[l]`` is the price of length l (0: not on offer). Of equal totals the one with the longest
    item wins, so short items are left to fill the last rooms.
    """
    on_offer = np.flatnonzero(prices > 0)[::-1]
    price = prices[on_offer]
    value, taken = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        value[room] = value[room - 1]
        fits = np.searchsorted(-on_offer, -room)
        if fits < len(on_offer):
            total = value[room - on_offer[fits:]] + price[fits:]
            i = int(total.argmax())
            if total[i] > value[room]:
                value[room], taken[room] = total[i], on_offer[fits + i]
    counts, room = np.zeros(len(prices), np.int64), capacity
    while room:
        counts[taken[room]] += taken[room] > 0
        room -= max(int(taken[room]), 1)
    return counts


def fractional_packing(histogram: np.ndarray, capacity: int, steps: int = STEPS, rate: float = RATE):
    """Multiplicative weights for min sum x over configurations that cover the histogram.

    A length's dual price starts a little above its share of the capacity for long items, and falls
    exponentially as the length is covered. Each step prices by knapsack and buys what its scarcest
    length still lacks. Returns [(configuration, amount)].
    """
    lengths = np.arange(len(histogram))
    start = (lengths / capacity) ** PRIOR
    covered = np.zeros(len(histogram))
    bought: list[tuple[np.ndarray, float]] = []
    for _ in range(steps):
        lacking = histogram - covered
        prices = np.where(lacking > 0.5, start * np.exp(-rate * covered / np.maximum(histogram, 1)), 0.0)
        if not (prices > 0).any():
            break
        config = best_configuration(prices, capacity)
        used = config > 0
        amount = max(1.0, float((lacking[used] / config[used]).min()))
        covered += amount * config
        bought.append((config, amount))
    return bought


def pack_histogram(histogram: np.ndarray, capacity: int, phases: int = PHASES, steps: int = STEPS):
    """Whole bins for every item of the histogram: [(configuration, number of bins)].

    Solves the linear program, rounds every amount down to what is left, and solves again for the
    rest, leaving out configurations that waste more than ``capacity / WASTE``; what remains after
    the last phase is packed by best fit, longest first.
    """
    left = histogram.astype(np.int64).copy()
    bins: list[tuple[np.ndarray, int]] = []
    if left[capacity]:  # a full item has a bin of its own
        alone = np.zeros_like(left)
        alone[capacity] = 1
        bins.append((alone, int(left[capacity])))
        left[capacity] = 0
    lengths = np.arange(len(left))
    for _ in range(phases):
        before = left.sum()
        for config, amount in fractional_packing(left, capacity, steps):
            used = config > 0
            times = min(int(amount), int((left[used] // config[used]).min()))
            if times > 0 and (capacity - config @ lengths) * WASTE <= capacity:
                bins.append((config, times))
                left -= times * config
        if left.sum() > 0.9 * before:
            break
    return bins + best_fit(left, capacity)


def best_fit(left: np.ndarray, capacity: int):
    """Bins for the given counts: the longest item opens a bin, and the longest that still fits goes in
    until none does; equal bins are made at once."""
    left, bins = left.copy(), []
    while left.any():
        config, room = np.zeros_like(left), capacity
        while room:
            fits = np.flatnonzero((left - config)[: room + 1] > 0)
            if not len(fits):
                break
            config[fits[-1]] += 1
            room -= int(fits[-1])
        used = config > 0
        times = int((left[used] // config[used]).min())
        bins.append((config, times))
        left -= times * config
    return bins


def places(bins: list[tuple[np.ndarray, int]], lengths: int) -> dict[str, list[np.ndarray]]:
    """Per length, where its items go: runs of places given by first item, items per bin, first bin
    and offset of the run's first item in its bins. An item finds its run by its number."""
    out = {c: [[] for _ in range(lengths)] for c in ("first", "per_bin", "bin", "offset")}
    used, next_bin = np.zeros(lengths, np.int64), 0
    for config, times in bins:
        offset = 0
        for length in np.flatnonzero(config)[::-1]:
            n = int(config[length])
            for column, value in (("first", used[length]), ("per_bin", n), ("bin", next_bin), ("offset", offset)):
                out[column][length].append(int(value))
            used[length] += n * times
            offset += n * int(length)
        next_bin += times
    return {c: [np.array(x, np.int64) for x in v] for c, v in out.items()}


# --- documents to pieces ----------------------------------------------------------------------


def load_encoder(vocabulary: str, pattern: str, specials: Mapping[str, int] | None = None):
    """The byte-level BPE vocabulary as ranks, with the special tokens that texts may hold."""
    import tiktoken

    with open(vocabulary, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(specials or {}))


def _cutter(vocabulary: str, pattern: str, capacity: int, end_id: int, specials: Mapping[str, int]):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        encoder = load_encoder(vocabulary, pattern, specials)
        for batch in slices(batches, "_text"):
            out = {"_row": [], "_id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
            for row, key, text in zip(*(batch.column(c).to_pylist() for c in ("_row", "_id", "_text"))):
                text = text or ""
                marked = any(s in text for s in specials)
                ids = encoder.encode(text, allowed_special="all") if marked else encoder.encode_ordinary(text)
                ids = np.array([*ids, end_id], "<u4")
                first = len(ids) % capacity or capacity
                for piece, end in enumerate(range(first, len(ids) + 1, capacity)):
                    part = ids[max(0, end - capacity) if piece else 0 : end]
                    values = (row, key, piece, end - len(part), len(part), zlib.crc32(part.tobytes()))
                    for column, value in zip(out.values(), values):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.record_batch({c: pa.array(v, k) for (c, v), k in zip(out.items(), kinds)})

    return cut


def _placer(runs: dict[str, list[np.ndarray]]):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", "_number"))
            sequence, offset = np.empty_like(number), np.empty_like(number)
            for size in np.unique(length):
                at = np.flatnonzero(length == size)
                first, per_bin, bins, start = (runs[c][size] for c in ("first", "per_bin", "bin", "offset"))
                run = np.searchsorted(first, number[at], side="right") - 1
                inside = number[at] - first[run]
                sequence[at] = bins[run] + inside // per_bin[run]
                offset[at] = start[run] + inside % per_bin[run] * size
            columns = {c: batch.column(c) for c in batch.schema.names if c != "_number"}
            yield pa.record_batch(columns | {"sequence_id": pa.array(sequence), "offset": pa.array(offset)})

    return place


def cut_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, row: str | None = None,
    vocabulary: str, pattern: str, specials: Mapping[str, int] | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
) -> DataFrame:
    """Pieces of at most ``capacity`` ids: _row, _id, piece, start, length, ids_crc32."""
    texts = docs.select(
        row_number(row).alias("_row"), F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")
    )
    schema = "_row long, _id long, piece int, start long, length long, ids_crc32 long"
    return texts.mapInArrow(_cutter(vocabulary, pattern, capacity, end_id, dict(specials or {})), schema)


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with a unique _row, piece and a length of 1 to ``capacity``) with sequence_id and offset.

    Only the histogram, ``capacity`` numbers, comes to the driver; the runs of places that go back
    depend on the number of configurations, which the steps bound, not on the data.
    """
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    histogram = np.zeros(capacity + 1, np.int64)
    histogram[list(counts)] = list(counts.values())
    runs = places(pack_histogram(histogram, capacity), capacity + 1)
    ranked = running_totals(
        pieces.withColumn("_one", F.lit(1).cast("long")),
        [F.xxhash64("_row", "piece"), F.col("_row"), F.col("piece")],
        ["_one"],
        ["length"],
    )
    numbered = ranked.select(*pieces.columns, (F.col("cum__one") - 1).alias("_number"))
    kinds = ", ".join(f"`{c}` {t}" for c, t in pieces.dtypes)
    return numbered.mapInArrow(_placer(runs), f"{kinds}, sequence_id long, offset long")


def best_fit_pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, row: str | None = None,
    vocabulary: str, pattern: str, specials: Mapping[str, int] | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
) -> DataFrame:
    """Pack all documents into as few sequences of at most ``capacity`` ids as the program finds.

    A document is its ids and ``end_id``; null text counts as empty, so every row has at least one id.
    The ``specials`` (text to id) are single ids wherever a text holds them; all else is ordinary text.
    Only longer documents are cut, into full pieces after a first piece that may be shorter. Pieces of
    a sequence lie without gaps from 0. Repeated rows are packed as often as they occur; an empty table
    gives an empty result. Columns: ``id_col``, piece, start, length, ids_crc32, sequence_id, offset,
    and ``row`` where given.
    """
    pieces = keep(
        cut_documents(
            docs, id_col, text_col, row=row, vocabulary=vocabulary, pattern=pattern, specials=specials,
            capacity=capacity, end_id=end_id,
        ),
        "pieces",
    )
    packed = pack_pieces(pieces, capacity)
    names = [F.col("_row").alias(row)] if row else []
    return packed.select(
        *names, F.col("_id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
