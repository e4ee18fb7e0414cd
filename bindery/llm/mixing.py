"""Mixing sources to target weights, in DataFrame functions only.

The words of a source form one stream, cut into blocks of fixed length. Every slot of an output shard
draws a source, which gives multinomial counts per shard. A source's draws are numbered along the
shards; numbers beyond its planned draws, all in the last shards that hold it, go to the sources that
were drawn too seldom, as plain draws would miss a small target by the root of its size. Numbers run
through the source's own permutation of block indexes, pass by pass, and blocks are joined by index.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bindery.llm.stages import keep, n_words, row_number
from bindery.operators.keyed import lookup_join
from bindery.operators.ordered import assign_row_id, running_totals

WEIGHTS = (1, 2, 3)
REPEATS = 3
BLOCK = 64
SHARD = 1024
ROUNDS = 4
CELLS = 4096  # parts of the range a slot draws from, to look its source up by
TASK_SLOTS = 1 << 18
FEW_SOURCES = 100_000  # up to so many, the ranges of the sources are broadcast: some 4 MB


def permuted(index: Column, size: Column, seed: Column) -> Column:
    """A pseudorandom permutation of 0..size-1, as an expression.

    A Feistel network with addition on a x b cells, the smallest near-square with at least ``size``
    cells; an index that leaves the range walks on along its cycle, which comes back to it after at
    most all cells out of range. Those are fewer than the root of ``size``, so few indexes walk.
    """
    a = F.greatest(F.ceil(F.sqrt(size.cast("double"))), F.lit(1)).cast("long")
    b = F.ceil(size / a).cast("long")

    def once(x: Column) -> Column:
        left, right = F.floor(x / b).cast("long"), F.pmod(x, b)
        for i in range(ROUNDS):
            if i % 2:
                right = F.pmod(right + F.pmod(F.xxhash64(seed, F.lit(i), left), b), b)
            else:
                left = F.pmod(left + F.pmod(F.xxhash64(seed, F.lit(i), right), a), a)
        return left * b + right

    first = once(index)
    steps = F.sequence(F.lit(1).cast("long"), F.greatest(a * b - size, F.lit(1).cast("long")))
    walk = F.aggregate(steps, first, lambda x, _: F.when(x < size, x).otherwise(once(x)))
    return F.when(first < size, first).otherwise(walk)


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, repeats: float = REPEATS) -> DataFrame:
    """Targets per source from (source, source_size), with the source's number in code-point order.

    Weights repeat along the sources in that order (null last). A target stops at ``repeats`` times
    its source's size, and the excess is shared again by weight until none is above: one round, and
    one row at the driver, per set of sources that reaches its stop.
    """
    ranked = assign_row_id(sizes, [F.col("source").isNull(), F.col("source")], "source_no")
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("source_no", F.lit(len(weights))) + 1).cast("int")
    )
    stop = F.col("source_size") * F.lit(float(repeats))
    table = keep(ranked.select("source_no", "source", "source_size", weight.alias("_w"), stop.alias("_stop")), "sources")
    stopped, level, held = F.lit(False), F.lit(0.0), -1
    while True:
        total, used, open_weight, n = table.agg(
            F.sum("source_size"), F.sum(F.when(stopped, F.col("_stop"))), F.sum(F.when(~stopped, F.col("_w"))),
            F.count(F.when(stopped, 1)),
        ).first()
        if not open_weight or n == held:
            break
        held = n
        level = F.lit((total - (used or 0.0)) / open_weight)
        stopped = F.col("_w") * level > F.col("_stop")
    target = F.when(stopped, F.col("_stop")).otherwise(F.col("_w") * level)
    return table.select("source_no", "source", "source_size", target.alias("target"))


class Mix:
    """A mix of documents: ``rows`` (one per document), ``pieces`` (what each output slot holds).

    rows: _row, id, source_no, source_size, target, size.
    pieces: shard, slot, source_no, pass, block, _row, id, first_word, n_words; a slot's words are
    its pieces in the order of first place in the source's stream.
    """

    def __init__(self, rows: DataFrame, pieces: DataFrame):
        self.rows, self.pieces = rows, pieces

    def taken(self) -> DataFrame:
        """``rows`` with the number of words the mix takes from each, repeats counted."""
        sums = self.pieces.groupBy("_row").agg(F.sum("n_words").alias("taken"))
        return self.rows.join(sums, "_row", "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    *,
    row: str | None = None,
    weights: Sequence[float] = WEIGHTS,
    repeats: float = REPEATS,
    block: int = BLOCK,
    shard: int = SHARD,
    seed: int = 0,
) -> Mix:
    """Mix whole sources to their targets (see :func:`source_targets`) in blocks of ``block`` words.

    A source gives round(target / mean block) draws; each pass over its blocks takes a block once,
    so a block is taken at most ``repeats`` times. Null text has size 0 and gives nothing; a null
    source is a source of its own; repeated rows are rows of their own; an empty table gives an
    empty mix. The same input rows give the same mix.
    """
    key = F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col("source")))
    sized = keep(
        docs.select(
            row_number(row).alias("_row"),
            F.col(id_col).alias("id"),
            F.col(source_col).cast("string").alias("source"),
            n_words(F.col(text_col)).alias("size"),
        ).withColumn("_key", key),
        "sizes",
    )
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sums, weights, repeats).withColumn("_key", key)
    blocks = F.ceil(F.col("source_size") / F.lit(block)).cast("long")
    draws = F.when(F.col("source_size") > 0, F.round(F.col("target") * blocks / F.col("source_size")).cast("long"))
    sources = targets.withColumns({"_blocks": blocks, "_draws": F.coalesce(draws, F.lit(0).cast("long"))})
    dealt = running_totals(sources.select("source_no", "_blocks", "_draws"), [F.col("source_no")], ["_draws"])

    rows = lookup_join(sized, targets.drop("source"), ["_key"], row_id=["_row"]).drop("_key")
    order = [F.xxhash64(F.lit(seed), "id"), F.col("id"), F.col("size"), F.col("_row")]
    placed = running_totals(
        rows.filter("size > 0").select("_row", "id", "source_no", "size"), order, ["size"], ["source_no"]
    ).withColumn("_start", F.col("cum_size") - F.col("size"))
    last = F.col("_start") + F.col("size") - 1
    low = F.greatest(F.col("block") * block, F.col("_start"))
    high = F.least((F.col("block") + 1) * block, F.col("_start") + F.col("size"))
    parts = (
        placed.withColumn(
            "block",
            F.explode(F.sequence(F.floor(F.col("_start") / block).cast("long"), F.floor(last / block).cast("long"))),
        )
        .withColumns({"first_word": low - F.col("_start"), "n_words": high - low})
        .select("source_no", "block", "_row", "id", "first_word", "n_words")
    )
    # The slots come from a table of few rows, which must not pass for their size in a broadcast.
    pieces = _slots(dealt, seed, shard).hint("merge").join(parts, ["source_no", "block"])
    return Mix(
        rows.select("_row", "id", "source", "source_no", "source_size", "target", "size"),
        pieces.select("shard", "slot", "source_no", "pass", "block", "_row", "id", "first_word", "n_words"),
    )


def _slots(dealt: DataFrame, seed: int, shard: int) -> DataFrame:
    """One row per output slot: its source, the pass and the block it holds."""
    spark = dealt.sparkSession
    dealt = keep(dealt.withColumn("_from", F.col("cum__draws") - F.col("_draws")).filter("_draws > 0"), "dealt")
    total, n_sources = dealt.agg(F.coalesce(F.sum("_draws"), F.lit(0)), F.count("*")).first()
    tasks = max(spark.sparkContext.defaultParallelism, total // TASK_SLOTS)
    ranges = keep(_settled(_drawn(dealt, seed, shard, total, n_sources, tasks), dealt), "shard-ranges")
    filled = ranges.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    if filled != total:
        raise RuntimeError(f"{filled} slots are filled, not {total}")
    # A shard has at most ``shard`` ranges, and a few short rows make many slots: dealt to a number of tasks.
    before = Window.partitionBy("shard").orderBy("source_no", "_first").rowsBetween(Window.unboundedPreceding, -1)
    each = (
        ranges.repartition(tasks, "shard")
        .withColumn("_place", F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long")))
        .withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
        .withColumn("_draw", F.col("_first") + F.col("_i"))
    )
    start = F.col("shard") * shard
    here = F.least(F.lit(shard).cast("long"), F.lit(total).cast("long") - start)
    slot = start + permuted(F.col("_place") + F.col("_i"), here, F.xxhash64(F.lit(seed), "shard"))
    turn = F.expr("_draw div _blocks")
    block = permuted(F.pmod("_draw", "_blocks"), F.col("_blocks"), F.xxhash64(F.lit(seed), "source_no", "pass"))
    return (
        each.withColumns({"slot": slot, "pass": turn})
        .withColumn("block", block)
        .select("source_no", "shard", "slot", "pass", "block")
    )


def _drawn(dealt: DataFrame, seed: int, shard: int, total: int, n_sources: int, tasks: int) -> DataFrame:
    """(shard, source_no, _n): every slot draws one of ``total`` places, of which a source has its draws."""
    width = max(1, -(-total // CELLS))
    cells = F.sequence(F.expr(f"_from div {width}"), F.expr(f"(cum__draws - 1) div {width}"))
    guide = dealt.select("source_no", "_from", F.col("cum__draws").alias("_until"), F.explode(cells).alias("_cell"))
    if n_sources <= FEW_SOURCES:
        guide = F.broadcast(guide)
    last = F.least((F.col("id") + 1) * shard, F.lit(total).cast("long")) - 1
    slots = dealt.sparkSession.range(0, -(-total // shard), 1, tasks).select(
        F.col("id").alias("shard"), F.explode(F.sequence(F.col("id") * shard, last)).alias("_slot")
    )
    place = F.pmod(F.xxhash64(F.lit(seed), "_slot"), F.lit(max(total, 1)).cast("long"))
    met = slots.select("shard", place.alias("_at")).withColumn("_in", F.expr(f"_at div {width}"))
    drawn = met.join(guide, (F.col("_in") == F.col("_cell")) & (F.col("_at") >= F.col("_from")) & (F.col("_at") < F.col("_until")))
    return drawn.groupBy("shard", "source_no").agg(F.count("*").alias("_n"))


def _settled(drawn: DataFrame, dealt: DataFrame) -> DataFrame:
    """(shard, source_no, _blocks, _first, _n): draws ``_first`` and on of a source, each draw in one shard.

    What a source was drawn too often, in its last shards, goes to sources drawn too seldom: about the root
    of all slots, unit by unit.
    """
    placed = running_totals(drawn, [F.col("shard")], ["_n"], ["source_no"])
    placed = placed.join(dealt.select("source_no", "_draws", "_blocks"), "source_no")
    first = F.col("cum__n") - F.col("_n")
    fits = F.greatest(F.least("cum__n", "_draws") - first, F.lit(0).cast("long"))
    placed = keep(placed.withColumns({"_first": first, "_fits": fits}), "drawn")
    own = placed.filter("_fits > 0").select("shard", "source_no", "_blocks", "_first", F.col("_fits").alias("_n"))

    units = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n") - F.col("_fits")))
    over = placed.filter("_n > _fits").select("shard", "source_no", units.alias("_unit"))
    over = assign_row_id(over, [F.col("shard"), F.col("source_no"), F.col("_unit")], "_number").select("shard", "_number")
    totals = placed.groupBy("source_no").agg(F.max("tot__n").alias("_had"))
    had = F.coalesce("_had", F.lit(0).cast("long"))
    seldom = dealt.select("source_no", "_draws", "_blocks").join(totals, "source_no", "left").withColumn("_had", had)
    seldom = seldom.withColumn("_lack", F.col("_draws") - F.col("_had")).filter("_lack > 0")
    seldom = running_totals(seldom, [F.col("source_no")], ["_lack"])
    lacking = seldom.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_lack") - 1))).select(
        "source_no",
        "_blocks",
        (F.col("_had") + F.col("_i")).alias("_first"),
        (F.col("cum__lack") - F.col("_lack") + F.col("_i")).alias("_number"),
    )
    given = over.join(lacking.hint("merge"), "_number").withColumn("_n", F.lit(1).cast("long"))
    return own.unionByName(given.select(*own.columns))
