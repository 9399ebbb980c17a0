"""Near-duplicate vectors by p-stable hashing for Euclidean distance (Datar et al. 2004).

Normalised vectors are projected on Gaussian directions, and each projection is cut into
steps of a fixed width at a random offset; a few such steps together are a bucket of one
table. Vectors that share a bucket of any table are compared exactly. On the unit sphere a
cosine of c is a distance of sqrt(2 - 2c).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.llm.components import components
from factloom.plans.frontier import settled

COSINE = 0.9
#: With distance 0.447 (cosine 0.9) one step of width 2 agrees with probability 0.82, with
#: distance 1.414 (unrelated) 0.49. Twelve steps make a bucket; a pair at cosine 0.9 shares one
#: of 24 tables with probability 0.90, at 0.95 0.995, at 0.97 0.9999.
TABLES, STEPS, WIDTH = 24, 12, 2.0
#: Vectors of a bucket that are compared as one block; larger buckets become pairs of blocks.
BLOCK = 512
SEED = 20_240_501
NAMES = ["number", "copies", "embedding"]


def projections(size: int, tables: int = TABLES, steps: int = STEPS, width: float = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Directions (size, tables * steps), divided by the width, and offsets of the steps."""
    chance = np.random.default_rng([SEED, size])
    return chance.standard_normal((size, tables * steps)) / width, chance.random(tables * steps)


def unit_rows(vectors: pa.Array, size: int) -> np.ndarray:
    """Vectors of one length as rows of unit length, in doubles."""
    rows = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), size)
    top = np.abs(rows).max(1, keepdims=True)  # first to size 1, so that squares neither vanish nor overflow
    rows = rows / top
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def hashed(vectors: DataFrame) -> DataFrame:
    """``vectors`` (number, copies, embedding) with ``keys``, one 32-bit bucket per table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.list_value_length(batch.column("embedding")).to_numpy(zero_copy_only=False)
            for size in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == size))
                directions, offsets = projections(size)
                cells = np.floor(unit_rows(part.column("embedding"), size) @ directions + offsets).astype(np.int64)
                cells = cells.reshape(part.num_rows, TABLES, STEPS)
                keys = np.zeros((part.num_rows, TABLES), dtype=np.uint64)
                for k in range(STEPS):
                    keys = (keys ^ cells[:, :, k].view(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
                    keys ^= keys >> np.uint64(31)
                lists = pa.ListArray.from_arrays(
                    np.arange(0, keys.size + 1, TABLES, dtype=np.int32), keys.astype(np.uint32).view(np.int32).ravel()
                )
                yield pa.record_batch([*(part.column(c) for c in NAMES), lists], names=[*NAMES, "keys"])

    kind = vectors.schema["embedding"].dataType.simpleString()
    return vectors.select(*NAMES).mapInArrow(run, f"number long, copies long, embedding {kind}, keys array<int>")


def linked(near: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray | None) -> list[np.ndarray]:
    """For the rows of either side of a block the least id that links reach inside the block.

    ``ids_b`` is None when a block is compared with itself.
    """
    top = np.iinfo(np.int64).max
    a, b = ids_a, ids_a if ids_b is None else ids_b
    while True:
        to_a = np.minimum(a, np.where(near, b[None, :], top).min(1))
        to_b = to_a if ids_b is None else np.minimum(b, np.where(near, to_a[:, None], top).min(0))
        if (to_a == a).all() and (to_b == b).all():
            return [a] if ids_b is None else [a, b]
        a, b = to_a, to_b


def compare(work: DataFrame, cosine: float) -> DataFrame:
    """(number, n, other): links of each row within each block, and one row it reaches there.

    ``work`` has a row per vector, bucket and pair of blocks (``low``, ``high``; the vector's own
    is ``side``). A pair counts in the first table in which both keys agree, so it counts once
    over all tables.
    """
    block = ["table", "key", "size", "low", "high"]

    def links_of(rows: dict[str, np.ndarray], a: slice, b: slice | None) -> list[tuple]:
        table, other = int(rows["table"][a.start]), b or a
        near = rows["unit"][a] @ rows["unit"][other].T >= cosine
        if b is None:
            np.fill_diagonal(near, False)
        if not near.any():
            return []
        for earlier in range(table):
            near &= rows["keys"][a, earlier][:, None] != rows["keys"][other, earlier][None, :]
        ids_a, ids_b = rows["number"][a], None if b is None else rows["number"][b]
        counts = [near @ rows["copies"][other]] + ([] if b is None else [near.T @ rows["copies"][a]])
        return list(zip([ids_a] if b is None else [ids_a, ids_b], counts, linked(near, ids_a, ids_b), strict=True))

    def blocks(batch: pa.Table, size: int) -> pa.RecordBatch:
        rows = {c: batch.column(c).to_numpy() for c in (*block, "side", "number", "copies")}
        rows["unit"] = unit_rows(batch.column("embedding").combine_chunks(), size)
        rows["keys"] = batch.column("keys").combine_chunks().flatten().to_numpy().reshape(-1, TABLES)
        names = np.stack([rows[c] for c in (*block, "side")])
        cuts = [0, *(np.flatnonzero((names[:, 1:] != names[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
        runs = [slice(a, b) for a, b in zip(cuts, cuts[1:], strict=False)]
        out, at = [], 0
        while at < len(runs):
            first = runs[at]
            low, high = rows["low"][first.start], rows["high"][first.start]
            at += 1
            if low == high:
                out += links_of(rows, first, None)
            elif at < len(runs) and (names[:5, first.start] == names[:5, runs[at].start]).all():
                out += links_of(rows, first, runs[at])
                at += 1
        out = [tuple(x[n > 0] for x in (ids, n, to)) for ids, n, to in out]
        columns = [np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.int64) for k in range(3)]
        return pa.record_batch([pa.array(c.astype(np.int64)) for c in columns], names=["number", "n", "other"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if kept is None else pa.concat_tables([kept, rows])
            last = np.stack([rows.column(c).to_numpy() for c in block])
            open_ = int(np.flatnonzero((last != last[:, -1:]).any(0)).max(initial=-1)) + 1  # the last block may go on
            kept = rows.slice(open_)
            yield from by_size(rows.slice(0, open_))
        if kept is not None:
            yield from by_size(kept)

    def by_size(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        sizes = rows.column("size").to_numpy()
        for size in np.unique(sizes).tolist():
            yield blocks(rows.filter(pa.array(sizes == size)), size)

    sorted_ = work.repartition(*block).sortWithinPartitions(*block, "side")
    return sorted_.mapInArrow(run, "number long, n long, other long")


def near_vectors(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors`` (vec_id, embedding).

    Equal vectors are compared once and weigh by their number, as they link with each other.
    Vectors that are NULL, empty, zero, or hold NULL or non-finite components link with
    nothing; so do vectors of different lengths with each other. component_id is the least vec_id reachable. Repeated ids count
    as rows of their own. A NULL vec_id gets a row without component. Other columns are not read.
    """
    kind = vectors.schema["embedding"].dataType.elementType
    kind = "float" if isinstance(kind, T.FloatType) else "double"  # either is exact
    rows = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), vectors["embedding"].cast(f"array<{kind}>").alias("embedding"))
    usable = F.forall("embedding", lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False))) & F.exists(
        "embedding", lambda x: x != 0
    )
    same = F.sha2(F.array_join(F.transform("embedding", lambda x: (x + F.lit(0).cast(kind)).cast("string")), " "), 256)  # -0 as 0
    keyed = settled(rows.withColumn("same", F.when(F.coalesce(usable, F.lit(False)), same)))
    distinct = settled(
        keyed.filter("same IS NOT NULL")
        .groupBy("same")
        .agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
        .withColumn("number", F.monotonically_increasing_id())
    )
    placed = settled(hashed(distinct))
    buckets = placed.select("number", F.size("embedding").alias("size"), F.posexplode("keys").alias("table", "key"))
    counts = buckets.groupBy("table", "key", "size").agg(F.count("*").alias("in_bucket")).filter("in_bucket > 1")
    shared = buckets.join(counts, ["table", "key", "size"]).withColumn("blocks", F.ceil(F.col("in_bucket") / block).cast("int"))
    side = F.pmod(F.xxhash64("number"), F.col("blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda o: F.struct(F.least("side", o).alias("low"), F.greatest("side", o).alias("high")),
    )
    dealt = shared.withColumn("side", side).select("number", "table", "key", "size", "side", F.explode(pairs).alias("p"))
    work = dealt.select("number", "table", "key", "size", "side", "p.low", "p.high").join(placed, "number")
    found = settled(compare(work, cosine))
    per_vector = found.groupBy("number").agg(F.sum("n").alias("n"))
    parts = components(found.select(F.col("number").alias("a"), F.col("other").alias("b")))
    joined = (
        distinct.select("same", "first_id", "copies", "number")
        .join(per_vector, "number", "left")
        .join(parts.withColumnRenamed("node", "number"), "number", "left")
        .withColumn("part", F.coalesce("component", "number"))
        .withColumn("n", F.coalesce("n", F.lit(0)))
    )
    joined = settled(joined.select("same", "first_id", "copies", "n", "part"))
    least = joined.groupBy("part").agg(F.min("first_id").alias("component_id"))
    by_vector = joined.join(least, "part").select("same", (F.col("n") + F.col("copies") - 1).alias("n_links"), "component_id")
    out = keyed.select("vec_id", "same").join(by_vector, "same", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
