"""Step-by-step expansion over an edge table, with lineage cut at every step."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.plans.products import products
from factloom.session import shared_folder


def settled(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared checkpoint folder, with no lineage behind them."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, path: str | None = None, codec: str | None = None) -> DataFrame:
    """The same rows, from a table in the shared folder, packed by ``codec`` or else the session's.

    For loops: unlike a checkpoint the table is known by its own size, so the size estimated
    for a join does not carry over from round to round.
    """
    path = path or f"{shared_folder(df.sparkSession)}/rounds-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Roots that one row of a walk carries, as the bits of a long.
ROOTS_A_ROW = 64
#: A node with so many roots and so many links is a hub.
HUB = 64
#: Nodes that more roots have come to before the last step are none of a hub's own.
KNOWN = 64


def _in_order_of_hubs(seeds: DataFrame, links: DataFrame) -> DataFrame:
    """(root, _id): the distinct roots numbered by the busiest node that they link to, then by root.

    Roots that start alike so lie in one block, and what they reach together is one row of the walk.
    """
    onward = links.groupBy(F.col("_from").alias("_to")).agg(F.count(F.lit(1)).alias("_n"))
    first = seeds.join(links, seeds["node"] == links["_from"], "left").join(onward, "_to", "left")
    hubs = first.groupBy("root").agg(F.max(F.struct(F.coalesce("_n", F.lit(0)), "_to"))["_to"].alias("_hub"))
    return hubs.orderBy("_hub", "root").select("root", F.monotonically_increasing_id().alias("_id"))


def _each_root(rows: DataFrame, bits: str) -> DataFrame:
    """``rows`` with a row per bit, its place in ``_place``; compiled, which a filter of an array is not."""
    places = F.explode(F.sequence(F.lit(0), F.lit(ROOTS_A_ROW - 1))).alias("_place")
    return rows.select("*", places).filter(F.expr(f"getbit({bits}, _place) = 1"))


def _own(level: DataFrame, links: DataFrame, seen: DataFrame) -> DataFrame | None:
    """(node, _hub, _known) of the nodes that a hub of the last step links to, one hub each; None without hubs.

    ``_known`` has the numbers of the roots that have come to the node before.
    """
    roots = level.groupBy("node").agg(F.sum(F.bit_count("bits")).alias("_roots")).filter(F.col("_roots") >= HUB)
    hubs = written(roots.withColumnRenamed("node", "_from"))
    if hubs.isEmpty():
        return None
    busy = links.join(hubs, "_from").groupBy("_from", "_roots").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= HUB)
    hubs = written(busy.drop("_n"))
    if hubs.isEmpty():
        return None
    # Of several hubs the one with most roots.
    own = links.filter(F.col("_to").isNotNull()).join(hubs, "_from").groupBy(F.col("_to").alias("node")).agg(F.max(F.struct("_roots", "_from"))["_from"].alias("_hub"))
    own = written(own)
    before = seen.join(own.select("node"), "node")
    often = before.groupBy("node").agg(F.sum(F.bit_count("_seen")).alias("_n")).filter(F.col("_n") > KNOWN).select("node")
    number = F.expr(f"block * {ROOTS_A_ROW} + _place")
    known = _each_root(before.join(often, "node", "left_anti"), "_seen").groupBy("node").agg(F.collect_list(number).alias("_known"))
    return written(own.join(often, "node", "left_anti").join(known, "node", "left"))


def reach(seeds: DataFrame, links: DataFrame, max_depth: int | None = None, about: DataFrame | None = None) -> DataFrame:
    """(root, node, depth) for every node that can be reached from each root, at its least depth.

    ``seeds`` has (root, node), at depth 0; ``links`` has (_from, _to). Without ``max_depth``
    the walk goes on until a step finds nothing new, so cycles end. With it, a column ``cut``
    tells which nodes at that depth have links onward.

    Roots are numbered, and a row of the walk is a node with the 64 roots of one block as bits:
    a step joins nodes, however many roots have come to them, and leaves out the bits that were
    there before. Each step is written beside those before it; bits become rows at the end, after
    all joins. What the last step of a limited walk finds behind hubs grows with the square of
    the input. It is not written: a hub's roots and the nodes it links to are paired as they come
    out, and of a node that has a hub the step itself finds what other links bring. ``about`` has
    a column node and more: nodes without a row in it are left out, the others get its columns,
    once per row.
    """
    spark = seeds.sparkSession
    links = written(links.select("_from", "_to").distinct())
    folder = f"{shared_folder(spark)}/walk-{uuid.uuid4().hex}"
    # Written, so that a task run again finds the same numbers.
    numbered = written(_in_order_of_hubs(seeds, links))
    own_bit = F.expr(f"shiftleft(1L, cast(_id % {ROOTS_A_ROW} AS int))")
    first = seeds.select(F.col("root").alias("_root"), "node").join(numbered, F.col("_root").eqNullSafe(F.col("root")))
    block = F.expr(f"_id DIV {ROOTS_A_ROW}").alias("block")
    level = written(first.groupBy(block, "node").agg(F.bit_or(own_bit).alias("bits")), f"{folder}/depth=0")
    kind = T.StructType([*level.schema.fields, T.StructField("depth", T.IntegerType())])  # depth is in the folder's name
    depth, own, last = 0, None, None
    while max_depth is None or depth < max_depth:
        depth += 1
        seen = spark.read.schema(kind).parquet(folder).groupBy("block", "node").agg(F.bit_or("bits").alias("_seen"))
        own, last = (_own(level, links, seen) if depth == max_depth else None), level
        if own is None:
            met = level.join(links, level["node"] == links["_from"])
        else:
            hubs = own.select(F.col("_hub").alias("_from")).distinct()
            taken = own.select(F.col("_hub").alias("_from"), F.col("node").alias("_to"))
            others = links.join(hubs, "_from").join(taken, ["_from", "_to"], "left_anti")
            met = level.withColumnRenamed("node", "_from").join(hubs, "_from", "left_anti").join(links, "_from")
            met = met.unionByName(level.withColumnRenamed("node", "_from").join(others, "_from"))
        found = (
            met.groupBy("block", F.col("_to").alias("node"))
            .agg(F.bit_or("bits").alias("bits"))
            .join(seen, ["block", "node"], "left")
            .withColumn("bits", F.col("bits").bitwiseAND(F.bitwise_not(F.coalesce("_seen", F.lit(0)))))
        )
        if own is not None:
            through = level.select("block", F.col("node").alias("_hub"), F.col("bits").alias("_paired"))
            found = found.join(own.select("node", "_hub"), "node", "left").join(through, ["block", "_hub"], "left")
            found = found.withColumn("bits", F.col("bits").bitwiseAND(F.bitwise_not(F.coalesce("_paired", F.lit(0)))))
        level = written(found.select("block", "node", "bits").filter("bits <> 0"), f"{folder}/depth={depth}")
        if level.isEmpty():
            break
    reached = spark.read.schema(kind).parquet(folder)
    more = [] if max_depth is None else ["cut"]
    more += [] if about is None else [c for c in about.columns if c != "node"]

    def told(nodes: DataFrame) -> DataFrame:
        """``nodes`` (node, depth and more) with the columns in ``more``."""
        if max_depth is not None:
            onward = links.select(F.col("_from").alias("node")).distinct().withColumn("_on", F.lit(True))
            cut = F.coalesce(F.col("_on"), F.lit(False)) & (F.col("depth") == max_depth)
            nodes = nodes.join(onward, "node", "left").withColumn("cut", cut)
        return nodes if about is None else nodes.join(about, "node")

    # The numbers of a block begin at its first bit and have no gap.
    entry = F.struct("_id", "root")
    names = numbered.groupBy(block).agg(F.transform(F.array_sort(F.collect_list(entry)), lambda r: r["root"]).alias("_roots"))
    name = F.get("_roots", F.col("_place")).alias("root")
    rows = _each_root(told(reached).join(names, "block"), "bits").select(name, "node", "depth", *more)
    if own is None:
        return rows
    hubs = own.select(F.col("_hub").alias("node")).distinct()
    number = F.expr(f"block * {ROOTS_A_ROW} + _place").alias("_id")
    roots = _each_root(last.join(hubs, "node").join(names, "block"), "bits").select(F.col("node").alias("_hub"), number, name)
    paired = products(roots, told(own.withColumn("depth", F.lit(max_depth))), ["_hub"])
    new = F.col("_known").isNull() | ~F.array_contains("_known", F.col("_id"))
    return rows.unionByName(paired.filter(new).select("root", "node", "depth", *more))


def expand(
    seed: DataFrame,
    step: Callable[[DataFrame, int], DataFrame],
    max_depth: int,
) -> DataFrame:
    """Union of ``seed`` (depth 1) and of ``step(previous, depth)`` for depths 2..max_depth.

    Every level is written once and read by the next level and by the union, so the
    work is one join per level. Expansion stops when a level is empty.
    """
    levels = [written(seed)]
    for depth in range(2, max_depth + 1):
        level = written(step(levels[-1], depth))
        if level.isEmpty():
            break
        levels.append(level)
    return reduce(lambda a, b: a.unionByName(b), levels)
