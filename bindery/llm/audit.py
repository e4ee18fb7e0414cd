"""Filter interaction audit: a stream over the files that keeps part counters right by retraction.

Every micro-batch computes each text's filter mask and folds equal texts before the shuffle. The
state, a table keyed by the text's digest, holds the smallest id seen and the counts of its rows. When a
smaller id arrives, those counts are retracted and counted again as repeats. The sum of all changes is one
table of counters per part and mask, from which every order of the filters is read off.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bindery.llm.stages import keep, slices
from bindery.session import discard, scratch_path

FILTERS = "ABCDE"
REPEAT = 16  # the bit of filter E
MIN_WORDS, DISTINCT_PERCENT, CAPITALS_PERCENT = 50, 65, 5
SIGNS = [bytes([c]) for c in b"#$%&*|"]
CAPITALS = bytes(range(65, 91))
MICRO_BATCHES = 16  # at most about so many, of MICRO_BATCH_BYTES at least
MICRO_BATCH_BYTES = 128 << 20
HELD = 100_000  # texts folded at once in a task

CELL = "_part string, _mask int, _good boolean, _toxic boolean, _n long"


# --- masks ----------------------------------------------------------------------------------------


def text_mask(text: bytes, points: int) -> int:
    """Bits of the filters A to D that the text (UTF-8, of so many code points) fails."""
    words = text.split()  # at exactly [\x20\x09-\x0D]
    capitals = len(text) - len(text.translate(None, CAPITALS))
    fails = (
        len(words) < MIN_WORDS,
        100 * len(set(words)) < DISTINCT_PERCENT * len(words),
        100 * capitals > CAPITALS_PERCENT * points,
        any(c in text for c in SIGNS),
    )
    return sum(1 << i for i, failed in enumerate(fails) if failed)


def _masker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "_text"):
        keys, masks = [], []
        for text in batch.column("_text").to_pylist():
            data = text.encode("utf-8", "surrogatepass")
            keys.append(hashlib.blake2b(data, digest_size=20).digest())
            masks.append(text_mask(data, len(text)))
        columns = {c: batch.column(c) for c in ("_id", "_part")}
        yield pa.record_batch({"_key": pa.array(keys, pa.binary()), "_mask": pa.array(masks, pa.int32())} | columns)


# --- folding before the state ---------------------------------------------------------------------


class _Fold:
    """Rows of one text in one task: what is sure to be a repeat, and what may be its first row."""

    __slots__ = ("mask", "least", "first", "sure")

    def __init__(self, mask: int):
        self.mask, self.least, self.first, self.sure = mask, None, Counter(), Counter()

    def add(self, key: int | None, cell: tuple) -> None:
        if key is None:  # a row without an id is no repeat and makes none
            self.sure[(*cell, False)] += 1
        elif self.least is None or key < self.least:
            for c, n in self.first.items():
                self.sure[(*c, True)] += n
            self.least, self.first = key, Counter({cell: 1})
        elif key == self.least:
            self.first[cell] += 1
        else:
            self.sure[(*cell, True)] += 1


FOLDED = "_key binary, _id long, _part string, _mask int, _good boolean, _toxic boolean, _n long"


def _folder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per text and count; those still in the running carry their id, the others their whole mask."""

    def folded(texts: dict[bytes, _Fold]) -> pa.RecordBatch:
        rows = []
        for key, fold in texts.items():
            rows += [(key, fold.least, p, fold.mask, g, t, n) for (p, g, t), n in fold.first.items()]
            rows += [(key, None, p, fold.mask | (REPEAT if r else 0), g, t, n) for (p, g, t, r), n in fold.sure.items()]
        kinds = [pa.binary(), pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.bool_(), pa.int64()]
        names = ["_key", "_id", "_part", "_mask", "_good", "_toxic", "_n"]
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    texts: dict[bytes, _Fold] = {}
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("_key", "_mask", "_id", "_part", "_good", "_toxic"))
        for key, mask, row_id, part, good, toxic in zip(*columns):
            if (fold := texts.get(key)) is None:
                fold = texts[key] = _Fold(mask)
            fold.add(row_id, (part, good, toxic))
        if len(texts) > HELD:
            yield folded(texts)
            texts = {}
    if texts:
        yield folded(texts)


# --- state ----------------------------------------------------------------------------------------


def judged(running: DataFrame, held: DataFrame) -> DataFrame:
    """The rows of a micro-batch that are in the running, and the state's rows of their texts, per text.

    Both have ``FOLDED``'s columns. Adds _old, _least (smallest id now) and _was (smallest id before).
    Folding has left a few rows per task and text, so no text is a large group here.
    """
    of_batch = held.join(running.select("_key").distinct(), "_key", "left_semi")
    rows = running.withColumn("_old", F.lit(False)).unionByName(of_batch.withColumn("_old", F.lit(True)))
    text = Window.partitionBy("_key")
    was = F.min(F.when(F.col("_old"), F.col("_id"))).over(text)
    return rows.withColumn("_least", F.min("_id").over(text)).withColumn("_was", was)


def changes(rows: DataFrame) -> DataFrame:
    """Changes of the counters, n < 0 to retract, from :func:`judged` rows.

    A new row counts as a repeat unless it has the smallest id. Where a smaller id has come, the
    rows that held it before are retracted and counted again as repeats.
    """
    repeat, n = F.col("_mask").bitwiseOR(F.lit(REPEAT)), F.col("_n")

    def change(mask, number):
        return F.struct(mask.alias("_mask"), number.alias("_n"))

    new = F.array(change(F.when(F.col("_id") == F.col("_least"), F.col("_mask")).otherwise(repeat), n))
    fell = F.col("_old") & (F.col("_id") == F.col("_was")) & (F.col("_least") < F.col("_was"))
    told = F.when(~F.col("_old"), new).when(fell, F.array(change(F.col("_mask"), -n), change(repeat, n)))
    return rows.select("_part", "_good", "_toxic", F.explode(told).alias("_c")).select(
        "_part", "_c._mask", "_good", "_toxic", "_c._n"
    )


def _counted(changed: DataFrame) -> DataFrame:
    return changed.groupBy("_part", "_mask", "_good", "_toxic").agg(F.sum("_n").alias("_n")).filter("_n <> 0")


def _batch_writer(flags: DataFrame, folder: str):
    """Writes the changes and the state rows of one micro-batch under its number.

    A batch that is run again, after a failure, reads the state of the batches before it only and
    replaces what it wrote, so nothing is counted twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        masked = keep(batch, "masked")
        # Rows without an id find no label; they are spread over the join.
        lane = F.when(F.col("_id").isNull(), 1 + F.pmod(F.xxhash64("_key", "_part"), F.lit(4096))).otherwise(0)
        masked_ = masked.withColumn("_slot", lane.cast("int"))
        known = (F.coalesce("_id", F.lit(0)) == F.col("_of")) & (F.col("_slot") == F.col("_lane"))
        labelled = masked_.join(flags, known, "left").select(
            "_key", "_mask", "_id", "_part",
            F.coalesce("_is_good", F.lit(False)).alias("_good"), F.coalesce("_is_toxic", F.lit(False)).alias("_toxic"),
        )
        folded = keep(labelled.mapInArrow(_folder, FOLDED), "folded")
        earlier = [f"{folder}/state/batch={i}" for i in range(number) if _place(spark, f"{folder}/state/batch={i}")[2]]
        held = spark.read.schema(FOLDED).parquet(*earlier) if earlier else spark.createDataFrame([], FOLDED)
        rows = keep(judged(folded.filter("_id is not null"), held), "judged")
        first = rows.filter("not _old and _id = _least").select(*folded.columns)
        first.write.mode("overwrite").parquet(f"{folder}/state/batch={number}")
        sure = folded.filter("_id is null").select("_part", "_mask", "_good", "_toxic", "_n")
        changed = _counted(sure.unionByName(changes(rows)))
        changed.write.mode("overwrite").parquet(f"{folder}/changes/batch={number}")
        discard(masked, folded, rows)

    return write


def count_masks(
    spark: SparkSession, path: str, labels: DataFrame, folder: str, *, id_col: str = "doc_id", text_col: str = "text",
    part_col: str = "source", files_per_batch: int | None = None,
) -> DataFrame:
    """Run the stream over the Parquet files under ``path`` that ``folder`` has not seen yet.

    Returns the counters over all files seen so far: part, mask, good, toxic, n. ``folder`` holds the
    stream's checkpoint, state and changes; a later run with the same folder, after a failure or after more
    files have come, goes on where it stopped and counts nothing twice. Without ``files_per_batch``
    the input is cut into at most about ``MICRO_BATCHES`` batches. The state is a log of some 40 bytes per
    text; a batch reads the part of it that its own texts need.
    """
    source = spark.read.parquet(path)
    limit = ("maxFilesPerTrigger", files_per_batch) if files_per_batch else (
        "maxBytesPerTrigger", max(_bytes(spark, path) // MICRO_BATCHES, MICRO_BATCH_BYTES)
    )
    flags = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("_of")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("_is_good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("_is_toxic"),
    )
    flags = keep(flags.filter("_is_good or _is_toxic").withColumn("_lane", F.lit(0)), "label-flags")
    stream = spark.readStream.schema(source.schema).option(*limit).parquet(_listed(spark, path)).select(
        F.col(id_col).cast("long").alias("_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("_part"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"),
    )
    masked = stream.mapInArrow(_masker, "_key binary, _mask int, _id long, _part string")
    writer = masked.writeStream.foreachBatch(_batch_writer(flags, folder)).trigger(availableNow=True)
    writer.option("checkpointLocation", f"{folder}/checkpoint").start().awaitTermination()
    if not _place(spark, f"{folder}/changes")[2]:
        return spark.createDataFrame([], CELL).toDF("part", "mask", "good", "toxic", "n")
    seen = spark.read.schema(CELL).option("recursiveFileLookup", True).parquet(f"{folder}/changes")
    return _counted(seen).toDF("part", "mask", "good", "toxic", "n")


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return place, files, files.exists(place)


def _bytes(spark: SparkSession, path: str) -> int:
    place, files, _ = _place(spark, path)
    return sum(files.getContentSummary(f.getPath()).getLength() for f in files.globStatus(place) or [])


def _listed(spark: SparkSession, path: str) -> str:
    """A stream reads a folder or a pattern; a single file is given as the pattern that only it matches."""
    place, files, there = _place(spark, path)
    return f"{path[:-1]}[{path[-1]}]" if there and files.getFileStatus(place).isFile() else path


# --- report ---------------------------------------------------------------------------------------


def order_report(cells: DataFrame) -> DataFrame:
    """Per part, order of the filters and step, what the counters say; see :func:`filter_audit`.

    What a step does depends only on its filter and on the set of filters before it: 80 cases, worked
    out once per part and then told to the 600 steps they stand for.
    """
    bit = {f: 1 << i for i, f in enumerate(FILTERS)}
    steps = [
        ("".join(order), i + 1, sum(bit[f] for f in order[:i]), bit[order[i]])
        for order in permutations(FILTERS) for i in range(len(order))
    ]
    cases = sorted({(earlier, own) for _, _, earlier, own in steps})
    case = F.explode(F.array(*[F.struct(F.lit(p).alias("earlier"), F.lit(f).alias("own")) for p, f in cases]))
    n, mask = F.col("n"), F.col("mask")
    per_mask = cells.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), n)).alias("n_good"), F.sum(F.when(F.col("toxic"), n)).alias("n_toxic")
    )
    spread = per_mask.withColumn("_case", case).select("*", "_case.earlier", "_case.own").drop("_case")
    fails, gone = mask.bitwiseAND(F.col("own")) != 0, mask.bitwiseAND(F.col("earlier")) != 0

    def total(condition, value, name):
        return F.coalesce(F.sum(F.when(condition, value)), F.lit(0)).cast("long").alias(name)

    worked = spread.groupBy("part", "earlier", "own").agg(
        total(~fails & ~gone, n, "kept"),
        total(fails & ~gone, n, "removed"),
        total(fails & gone, n, "redundant"),
        total(mask == F.col("own"), n, "unique_fails"),
        total(fails & ~gone, F.col("n_good"), "good_lost"),
        total(fails & ~gone, F.col("n_toxic"), "toxic_lost"),
        # Of the m filters that a document fails, each comes first in 120 / m orders.
        total(fails, n * F.floor(F.lit(len(steps) // len(FILTERS)) / F.bit_count(mask)), "shapley"),
    )
    told = cells.sparkSession.createDataFrame(steps, "filter_order string, step int, earlier int, own int")
    return worked.join(F.broadcast(told), ["earlier", "own"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def filter_audit(spark: SparkSession, path: str, labels: DataFrame, **options) -> DataFrame:
    """How five filters interact, per part, for all 120 orders: one row per part, order and step.

    A: under 50 words; B: under 65 % distinct words; C: over 5 % capitals A-Z; D: a sign of #$%&*|; E: the
    text of a smaller id. Columns: part, filter_order, step, kept (after the step), removed (by it), redundant
    (failing its filter, gone before), unique_fails (failing only its filter), good_lost, toxic_lost
    (removed by it, labelled so), shapley (removed by its filter, summed over all orders).

    A null text is empty, a null part the empty string. Rows without an id never fail E and make no other
    row fail it; rows with one id and text are no repeats of each other. If an id has several labels, one
    that says 1 is enough. Repeated rows count as often as they occur. A table without rows gives
    an empty result. Other columns, whatever their names, don't matter.
    """
    return order_report(count_masks(spark, path, labels, scratch_path(spark, "audit"), **options))
