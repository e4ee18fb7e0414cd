"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindery.llm.stages import at_most, keep, row_number, slices
from bindery.llm.words import document_of, mix, split_tokens

BUCKETS = 1 << 14  # hash buckets of tokens
DIM = 48
NONZERO = 4  # entries of +1 or -1 in an index vector
REACH = 2  # words to each side that make up the context
FAN_IN = 64
BLOCK = 256  # buckets per row of partial sums
TRAIN_ROWS = 20000
HIDDEN = 32
EPOCHS = 300
THRESHOLD = 0.3


class Network(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float


# --- word vectors by random indexing -----------------------------------------------------------


def index_vectors(buckets: int = BUCKETS, dim: int = DIM) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the few entries of each bucket's fixed random vector."""
    seed = np.arange(buckets * NONZERO, dtype=np.uint64).reshape(buckets, NONZERO) + np.uint64(1)
    bits = mix(seed * np.uint64(0x9E3779B97F4A7C15))
    return (bits >> np.uint64(8)).astype(np.int64) % dim, np.where(bits & np.uint64(1), 1.0, -1.0)


def _contexts(buckets: int, dim: int):
    """Each task adds up the index vectors of the neighbours of every token, per bucket."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors(buckets, dim)
        sums, seen = np.zeros(buckets * dim), False
        for batch in slices(batches, "_text", 1 << 20):
            tokens = split_tokens(_encoded(batch))
            at, doc = (tokens.hashes % np.uint64(buckets)).astype(np.int64), document_of(tokens.first)
            for step in range(1, REACH + 1):
                same = doc[step:] == doc[:-step]
                for one, other in ((at[step:][same], at[:-step][same]), (at[:-step][same], at[step:][same])):
                    flat = (one[:, None] * dim + places[other]).reshape(-1)
                    sums += np.bincount(flat, signs[other].reshape(-1), buckets * dim)
            seen = True
        if seen:
            rows = sums.astype(np.float32).reshape(-1, BLOCK * dim)
            yield pa.record_batch(
                {
                    "block": pa.array(np.arange(len(rows), dtype=np.int32)),
                    "part": pa.array(np.full(len(rows), TaskContext.get().partitionId(), np.int64)),
                    "sums": pa.array([r.tobytes() for r in rows], pa.binary()),
                }
            )

    return add


def _adder(table: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(x, np.float32) for x in table.column("sums").to_pylist()], axis=0, dtype=np.float64)
    first = table.slice(0, 1)
    return first.set_column(2, "sums", pa.array([total.astype(np.float32).tobytes()], pa.binary()))


def word_vectors(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS, dim: int = DIM) -> np.ndarray:
    """Unit context vectors (buckets x dim) over all texts. Partial sums, one set per task, are added
    up ``FAN_IN`` at a time; the driver receives the one last set, whose size is fixed."""
    texts = docs.select(F.col(text_col).alias("_text"))
    schema = "block int, part long, sums binary"
    sums = keep(texts.mapInArrow(_contexts(buckets, dim), schema), "context-sums")
    parts = int(sums.agg(F.max("part")).first()[0] or 0) + 1
    while True:
        parts = -(-parts // FAN_IN)
        group = F.floor(F.col("part") / FAN_IN).cast("long")
        sums = sums.select("block", group.alias("part"), "sums").groupBy("block", "part").applyInArrow(_adder, schema)
        sums = keep(sums, "context-sums")
        if parts == 1:
            break
    vectors = np.zeros((buckets, dim), np.float32)
    for r in sums.collect():
        vectors[r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = np.frombuffer(r["sums"], np.float32).reshape(-1, dim)
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)


# --- documents to features -----------------------------------------------------------------------


def _encoded(batch: pa.RecordBatch) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in batch.column("_text").to_pylist()]


def pooled(texts: list[bytes], vectors: np.ndarray) -> np.ndarray:
    """Per text: mean and spread of its token vectors, their likeness from token to token, and length."""
    tokens = split_tokens(texts)
    n = np.diff(tokens.first)
    v = vectors[(tokens.hashes % np.uint64(len(vectors))).astype(np.int64)]
    doc = document_of(tokens.first)
    full = np.flatnonzero(n)
    out = np.zeros((len(texts), 2 * vectors.shape[1] + 2), np.float32)
    if len(full):
        head = tokens.first[full]
        mean = np.add.reduceat(v, head, axis=0) / n[full, None]
        square = np.add.reduceat(v * v, head, axis=0) / n[full, None]
        spread = np.sqrt(np.maximum(square - mean * mean, 0))
        alike = np.einsum("ij,ij->i", v[1:], v[:-1]) * (doc[1:] == doc[:-1])
        likeness = np.bincount(doc[1:], alike, len(texts))[full] / np.maximum(n[full] - 1, 1)
        out[full] = np.column_stack([mean, spread, likeness, np.log1p(n[full])])
    return out


def _pooler(shared):
    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", 1 << 20):
            features = pooled(_encoded(batch), shared.value)
            offsets = np.arange(0, features.size + 1, features.shape[1], dtype=np.int32)
            rest = {c: batch.column(c) for c in batch.schema.names if c != "_text"}
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(features.reshape(-1)))
            yield pa.record_batch(rest | {"_features": lists})

    return pool


# --- the network -----------------------------------------------------------------------------------


def _logits(net: Network, x: np.ndarray) -> np.ndarray:
    return np.maximum((x - net.mean) / net.scale @ net.w1 + net.b1, 0) @ net.w2 + net.b2


def probabilities(net: Network, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(_logits(net, x) / net.temperature, -500, 500)))


def train(x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Adam on the log loss over four fifths of the rows; the temperature is the one of a grid with the
    lowest log loss on the last fifth."""
    rng = np.random.default_rng(seed)
    x = x.astype(np.float64)
    held = np.arange(len(y)) % 5 == 4
    net = Network(
        x[~held].mean(axis=0), x[~held].std(axis=0) + 1e-6,
        rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), np.zeros(hidden),
        rng.normal(0, hidden**-0.5, hidden), 0.0, 1.0,
    )
    weights = [net.w1, net.b1, net.w2, np.zeros(())]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    z, t = (x[~held] - net.mean) / net.scale, y[~held]
    for step in range(1, epochs + 1):
        h = np.maximum(z @ weights[0] + weights[1], 0)
        p = 1 / (1 + np.exp(-np.clip(h @ weights[2] + weights[3], -500, 500)))
        d = (p - t) / len(t)
        dh = np.outer(d, weights[2]) * (h > 0)
        grads = [z.T @ dh + 1e-4 * weights[0], dh.sum(axis=0), h.T @ d + 1e-4 * weights[2], d.sum()]
        for i, g in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            weights[i] = weights[i] - 0.01 * first[i] / (1 - 0.9**step) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    net = net._replace(w1=weights[0], b1=weights[1], w2=weights[2], b2=float(weights[3]))

    def loss(temperature: float) -> float:
        p = np.clip(probabilities(net._replace(temperature=temperature), x[held]), 1e-12, 1 - 1e-12)
        return float(-(y[held] * np.log(p) + (1 - y[held]) * np.log(1 - p)).sum())

    return net._replace(temperature=min((float(v) for v in np.geomspace(0.5, 8, 25)), key=loss) if held.any() else 1.0)


def _scorer(net: Network | float):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if isinstance(net, Network):
                flat = batch.column("_features").flatten().to_numpy()
                values = probabilities(net, flat.reshape(batch.num_rows, -1).astype(np.float64))
            else:
                values = np.full(batch.num_rows, net)
            rest = {c: batch.column(c) for c in batch.schema.names if c != "_features"}
            yield pa.record_batch(rest | {"score": pa.array(values.astype(np.float64))})

    return score


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    *,
    row: str | None = None,
    learn_from: Column | None = None,
    train_rows: int = TRAIN_ROWS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The probability that a document's label is 1, for every whole text.

    Word vectors come from all documents. The network learns from about ``train_rows`` labelled
    documents, chosen by the hash of their id among those that ``learn_from`` (a condition on
    ``id_col``) admits; rows of ``labels`` without a 0 or 1, or without a document, teach nothing.
    Null and blank texts have zero vectors and are scored like any other. Where the labels hold one
    value only, every score is that value; without labels it is 1. Repeated rows get equal scores; an
    empty table gives an empty result. Columns: ``id_col``, score, predicted, and ``row`` where given.
    """
    spark = docs.sparkSession
    vectors = spark.sparkContext.broadcast(word_vectors(docs, text_col))
    rows = docs.select(row_number(row).alias("_row"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kinds = ", ".join(f"{c} {t}" for c, t in rows.dtypes if c != "_text")
    features = keep(rows.mapInArrow(_pooler(vectors), f"{kinds}, _features array<float>"), "features")

    admitted = labels.filter(F.col(label_col).isin(0, 1))
    if learn_from is not None:
        admitted = admitted.filter(learn_from)
    chosen = admitted.select(F.col(id_col).alias("_id"), F.col(label_col).cast("double").alias("_y")).distinct()
    chosen = keep(at_most(chosen, train_rows, "_id"), "training-labels")
    taught = keep(features.join(F.broadcast(chosen), "_id"), "training-rows")
    # More than one row per label only where ids repeat. The order makes reruns train alike.
    rows_taught = at_most(taught, train_rows, "_row").orderBy(F.xxhash64("_id"), "_id", "_y", "_row")
    sample = rows_taught.select("_features", "_y").toArrow()
    y = sample.column("_y").to_numpy()
    if len(np.unique(y)) == 2:
        x = sample.column("_features").combine_chunks().flatten().to_numpy().reshape(len(y), -1)
        net = train(x, y)
    else:
        net = float(y[0]) if len(y) else 1.0
    scored = features.mapInArrow(_scorer(net), f"{kinds}, score double")
    return scored.select(
        *([F.col("_row").alias(row)] if row else []),
        F.col("_id").alias(id_col),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
