"""Distributed union-find in DataFrame operations: the smallest node each node can reach."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindery.llm.stages import keep
from bindery.operators.bloom import bloom_filter
from bindery.session import discard


CROWD = 64


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``links`` that is not itself the smallest of its component.

    Alternates two steps until every node points straight at its root: each node's larger
    neighbours move to its smallest neighbour, then each node's smaller neighbours do. Both use
    minima per node (combined before the shuffle) and a join whose other side is unique, so a node
    with very many links costs no task more than its share. Every round is written.
    """
    links = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    links = keep(links, "links")
    while not _settled(links):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        moved = both.join(lowest, "u").filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.distinct()
        lowest = moved.groupBy("u").agg(F.min("v").alias("m"))
        ends = F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
        linked = moved.join(lowest, "u").select(ends.alias("e")).select("e.u", "e.v").filter("u <> v")
        links = keep(linked.distinct(), "links")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))


def linked_roots(
    signed: DataFrame,
    verified: Callable[[DataFrame], DataFrame],
    crossed: Callable[[DataFrame, DataFrame, bool], DataFrame] | None = None,
) -> DataFrame:
    """(node, root) as :func:`components` gives it, for rows (_row, _bands) and a check of pairs (a, b).

    Rows that share a band are in one bucket. First every row of a bucket meets the smallest one.
    Then, wherever a bucket still holds several components, all their rows meet: rows that are linked
    to nobody yet meet each other in the first band they share, and components of several rows meet
    the other components of their buckets as a whole: ``crossed`` gets the rows (a, _other) that meet a
    component, the members (_other, b) of those components, and True, as members are connected
    already; it returns links. So do, with False, buckets that hold more than ``CROWD`` rows without
    a link. (Where ``crossed`` is not given, rows are paired one by one.) So all pairs of a bucket are
    checked or connected already, and a bucket of copies costs pairs in proportion to its size.

    Where ``signed`` has the size of a row's set, ``_n``, it goes with the row and pairs have it as ``_nb``, and as
    ``_na`` where that of ``a`` is at hand too.
    """
    size = [c for c in signed.columns if c == "_n"]
    buckets = signed.select("_row", *size, F.explode(F.array_distinct("_bands")).alias("_band"))
    # Most bands are held by one row. A count of 48 bits of each names a superset of the others, and a
    # filter of those keeps the rest out of every later shuffle.
    cell = F.shiftright("_band", 16).alias("_cell")
    cells = buckets.groupBy(cell).agg(F.count("*").alias("_n")).filter("_n > 1").select("_cell")
    cells = keep(cells, "shared-cells")
    likely = bloom_filter(cells, ["_cell"]).possible(buckets.withColumn("_cell", cell), ["_cell"])
    likely = keep(likely.select("_band", "_row", *size), "likely-buckets")
    sizes = likely.groupBy("_band").agg(F.count("*").alias("_size"), F.min("_row").alias("_pivot"))
    shared = sizes.filter("_size > 1").select("_band", "_pivot")
    met = keep(likely.join(shared.hint("merge"), "_band").select("_band", "_row", "_pivot", *size), "buckets")
    discard(likely, cells)
    star = met.filter("_row <> _pivot").select(
        F.col("_pivot").alias("a"), F.col("_row").alias("b"), *[F.col(c).alias("_nb") for c in size]
    ).distinct()
    links = verified(star)
    roots = components(links)

    several = roots.select(F.col("root").alias("_several")).distinct()
    rooted = met.join(roots, met["_row"] == roots["node"], "left").select(
        "_band", "_row", "_pivot", *size, F.coalesce("root", "_row").alias("_root")
    )
    first, linked = F.col("_row") == F.col("_pivot"), F.col("_several").isNotNull()
    rooted = rooted.join(several, rooted["_root"] == several["_several"], "left")
    rooted = keep(rooted.select("_band", "_row", *size, "_root", linked.alias("_linked"), first.alias("_first")), "bucket-roots")
    discard(met)
    alone = rooted.filter("not _linked and not _first").select("_band", "_row", *size)
    sizes = keep(alone.groupBy("_band").agg(F.count("*").alias("_n")).filter("_n > 1"), "alone-sizes")
    crowds = sizes.filter(F.col("_n") > CROWD).select("_band")
    crowd = alone.join(crowds, "_band")
    few = sizes.filter(F.col("_n") <= CROWD).select("_band")
    alone = keep(alone.join(few.hint("merge"), "_band", "left_semi"), "alone")
    # Half of each key tells the first band two rows meet in, at half the bytes.
    half = F.shiftright("_band", 32).cast("int")
    halves = alone.groupBy("_row").agg(F.collect_list(half).alias("_bands"))
    met_alone = alone.join(halves.hint("merge"), "_row")
    own, other = [[F.col(c).alias(to) for c in size] for to in ("_na", "_nb")]
    left = met_alone.select("_band", F.col("_row").alias("a"), *own, F.col("_bands").alias("_x"))
    right = met_alone.select(F.col("_band").alias("_same"), F.col("_row").alias("b"), *other, F.col("_bands").alias("_y"))
    first = F.get(F.array_intersect("_x", "_y"), 0)
    once = (F.col("a") < F.col("b")) & (first == half)
    single = left.join(right, (F.col("_band") == F.col("_same")) & once)
    single = single.select("a", "b", *[c for c in ("_na", "_nb") if size])

    holders = rooted.select("_band", "_root", "_linked").distinct()
    large = holders.filter("_linked").select("_band", F.col("_root").alias("_other"))
    pairs = holders.join(large, "_band").filter("_root <> _other and (not _linked or _root < _other)")
    pairs = keep(pairs.select("_root", "_other").distinct(), "component-pairs")
    nodes = roots.unionByName(several.select(F.col("_several").alias("node"), F.col("_several").alias("root")))
    late = verified(single)
    discard(alone)
    if not crowds.isEmpty():
        a = crowd.select(F.col("_row").alias("a"), F.col("_band").alias("_other"))
        b = crowd.select(F.col("_band").alias("_other"), F.col("_row").alias("b"))
        among = crossed(a, b, False) if crossed else verified(a.join(b, "_other").filter("a < b").select("a", "b").distinct())
        late = late.unionByName(among)
    if not pairs.isEmpty():
        met_by = pairs.join(nodes, pairs["_root"] == nodes["root"], "left").select(
            F.coalesce("node", "_root").alias("a"), "_other"
        )
        members = nodes.join(pairs.select("_other").distinct(), nodes["root"] == F.col("_other")).select(
            "_other", F.col("node").alias("b")
        )
        cross = crossed(met_by, members, True) if crossed else verified(met_by.join(members, "_other").select("a", "b"))
        late = late.unionByName(cross)
    discard(rooted)
    return roots if late.isEmpty() else components(links.unionByName(late))


def _settled(links: DataFrame) -> bool:
    """Whether every node has one parent and no parent has a parent."""
    ends = links.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        links.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    sums = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return sums.filter("up > 1 or (up > 0 and down > 0)").isEmpty()
