"""Vectors: re-embedding decisions, nearest neighbours, coherence."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions.numeric import round_exact
from factloom.functions.vectors import cosine, dot, unit
from factloom.plans.frontier import settled, written
from factloom.plans.sizes import bounded_batches, rows_if_small

OK_ABOVE = 0.85
WARN_ABOVE = 0.70
LEAST_SAMPLE = 10
# A product of two blocks holds BLOCK_QUERIES x BLOCK_VECTORS numbers in one task.
BLOCK_QUERIES = 1_024
BLOCK_VECTORS = 10_000
# Blocks lie in so many parts at least; a task holds the vectors of one part, of at most about PART_BYTES.
QUERY_PARTS, LEAST_PARTS, PART_BYTES = 64, 4, 64 << 20
PAIR_BYTES = 16 << 20
# Pivots come from a sample of fixed size; there are at most PIVOTS x RINGS cells.
PIVOTS, RINGS = 32, 8
PIVOT_SAMPLE = 1_024
# Allows for similarities being rounded before a distance is taken from them.
BOUND_SLACK = 1e-5


def content_hash(fields: list[str]) -> Column:
    """Digest of the named fields in alphabetical order; a missing value counts as NULL."""
    body = F.to_json(F.struct(*sorted(fields)), {"ignoreNullFields": "false"})
    return F.sha2(body, 256)


def reembed_decisions(
    old: DataFrame, new: DataFrame, key: str, fields: list[str], threshold: float = 0.98
) -> DataFrame:
    """Which changed records need a new vector, and why.

    Both sides have a unique key, the fields and ``embedding``; the embedding of ``new`` is
    that of the new content. A record without an old vector, or with a zero vector, cannot
    be shown stable and counts as changed.
    """
    before = old.select(
        key, content_hash(fields).alias("_old_hash"), F.col("embedding").alias("_old"), F.lit(True).alias("_had")
    )
    after = new.select(key, content_hash(fields).alias("_new_hash"), F.col("embedding").alias("_new"))
    pairs = after.join(before, key, "left")
    same = F.col("_had") & (F.col("_old_hash") == F.col("_new_hash"))
    # Vectors are compared only for records whose content differs.
    likeness = F.when(~F.coalesce(same, F.lit(False)), cosine(F.col("_old"), F.col("_new")))
    judged = pairs.select(key, F.coalesce(same, F.lit(False)).alias("_same"), likeness.alias("_sim"))
    stable = F.coalesce(F.col("_sim") >= threshold, F.lit(False))
    reason = (
        F.when(F.col("_same"), "content_unchanged")
        .when(
            stable,
            F.concat(
                F.lit("embedding_stable (similarity="), F.format_string("%.4f", F.col("_sim")), F.lit(")")
            ),
        )
        .otherwise("content_changed")
    )
    return judged.select(key, (~(F.col("_same") | stable)).alias("should_reembed"), reason.alias("reason"))


def _coherence_columns(mean: Column, size: Column) -> list[Column]:
    enough = size >= LEAST_SAMPLE
    status = F.when(mean > OK_ABOVE, "OK").when(mean > WARN_ABOVE, "WARN").otherwise("FRAGMENTED")
    return [
        F.when(enough, round_exact(mean, 4)).alias("coherence_score"),
        size.alias("sample_size"),
        F.when(enough, status).alias("status"),
        F.when(~enough, "insufficient_sample").alias("warning"),
    ]


def _mean_pairwise(df: DataFrame, by: list[str]) -> DataFrame:
    """Mean off-diagonal cosine per group, from the sum of the unit vectors.

    With unit vectors u the sum over all pairs is |sum u|^2 - sum |u|^2, so one
    aggregation with partial sums replaces the matrix of all pairs.
    """
    units = df.select(*by, unit(F.col("embedding")).alias("_u"))
    sums = units.groupBy(*by).agg(
        vector_to_array(Summarizer.sum(array_to_vector("_u"))).alias("_s"),
        F.sum(dot(F.col("_u"), F.col("_u"))).alias("_self"),
        F.count(F.lit(1)).alias("_n"),
    )
    pairs = F.col("_n").cast("double") * (F.col("_n") - 1)
    mean = F.try_divide(dot(F.col("_s"), F.col("_s")) - F.col("_self"), pairs)
    return sums.select(*by, mean.alias("_mean"), F.col("_n"))


def coherence(
    vectors: DataFrame, query_vec: list[float], k: int = 100, concept: str = "concept", id_col: str = "vec_id"
) -> DataFrame:
    """How alike the ``k`` vectors nearest to a query are. Equal similarities go by id."""
    query = F.array(*[F.lit(float(x)) for x in query_vec])
    nearest = (
        vectors.select(id_col, "embedding", cosine(F.col("embedding"), query).alias("_sim"))
        .orderBy(F.desc_nulls_last("_sim"), id_col)
        .limit(k)
    )
    return _mean_pairwise(nearest, []).select(
        F.lit(concept).alias("concept"), *_coherence_columns(F.col("_mean"), F.col("_n"))
    )


def coherence_by_group(vectors: DataFrame, group: str) -> DataFrame:
    """O04 for every group of vectors at once, over all members of the group."""
    return _mean_pairwise(vectors, [group]).select(
        F.col(group).cast("string").alias("concept"), *_coherence_columns(F.col("_mean"), F.col("_n"))
    )


def _best(scores, who, k: int):
    """The ``k`` highest scores with their ids; equal scores go by id."""
    import numpy as np

    if len(scores) > k:
        # All that tie with the k-th stay until the ids decide.
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        good = scores >= least
        scores, who = scores[good], who[good]
    pick = np.lexsort((who, -scores))[:k]
    return scores[pick], who[pick]


def _unit_rows(vectors):
    """Vectors as a matrix of unit rows, and the mask of those that are finite and not zero."""
    import numpy as np

    matrix = np.asarray(vectors.tolist(), dtype=np.float64)
    lengths = np.linalg.norm(matrix, axis=1)
    good = np.isfinite(lengths) & (lengths > 0)
    return matrix[good] / lengths[good, None], good


#: Similarities are rounded to so many places, so that equal ones tie whatever the block they came from.
SIMILARITY_PLACES = 12


def _pivots(vectors: DataFrame, id_col: str, pivots: int):
    """Up to ``pivots`` unit vectors far from each other, out of PIVOT_SAMPLE rows taken by a hash of their ids."""
    import numpy as np
    import pandas as pd

    rows = vectors.orderBy(F.xxhash64(id_col), id_col).limit(PIVOT_SAMPLE).select("embedding").collect()
    if not rows:
        return np.zeros((0, 0))
    sample, _ = _unit_rows(pd.Series([r[0] for r in rows]))
    chosen: list[int] = []
    nearest = np.full(len(sample), np.inf)
    while len(chosen) < min(pivots, len(sample)):
        chosen.append(int(np.argmax(nearest)))
        nearest = np.minimum(nearest, _distances(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


def _distances(rows, pivots):
    """Distances between unit vectors, from their products."""
    import numpy as np

    return np.sqrt(np.maximum(2.0 - 2.0 * (rows @ pivots.T), 0.0))


def _placed(vectors: DataFrame, id_col: str, pivots) -> DataFrame:
    """(id, embedding, _cell): the nearest pivot of each usable vector and the ring around it."""
    import numpy as np

    def place(batches: Iterator) -> Iterator:
        for batch in batches:
            if not len(batch) or not len(pivots):
                continue
            rows, good = _unit_rows(batch["embedding"])
            far = _distances(rows, pivots)
            near = far.argmin(axis=1)
            ring = np.minimum(far[np.arange(len(far)), near] / 2.0 * RINGS, RINGS - 1).astype(int)
            yield batch[good].assign(_cell=(near * RINGS + ring).astype("int32"))

    fields = vectors.select(id_col, "embedding").schema
    return vectors.select(id_col, "embedding").mapInPandas(place, fields.add("_cell", "integer"))


def _cells(placed: DataFrame, pivots):
    """Per cell the least and greatest distance to every pivot and the number of vectors.

    At most pivots x RINGS rows, whatever the table.
    """
    import numpy as np
    import pandas as pd

    width = len(pivots)

    def summarise(batches: Iterator) -> Iterator:
        low, high, count = {}, {}, {}
        for batch in batches:
            if not len(batch):
                continue
            rows, _ = _unit_rows(batch["embedding"])
            far = _distances(rows, pivots)
            cells = batch["_cell"].to_numpy()
            for cell in np.unique(cells):
                part = far[cells == cell]
                low[cell] = np.minimum(low.get(cell, np.inf), part.min(axis=0))
                high[cell] = np.maximum(high.get(cell, 0.0), part.max(axis=0))
                count[cell] = count.get(cell, 0) + len(part)
        names = list(count)
        yield pd.DataFrame(
            {
                "_cell": pd.Series(names, dtype="int32"),
                "low": pd.Series([low[c].tolist() for c in names], dtype=object),
                "high": pd.Series([high[c].tolist() for c in names], dtype=object),
                "n": pd.Series([count[c] for c in names], dtype="int64"),
            }
        )

    parts = placed.mapInPandas(summarise, "_cell int, low array<double>, high array<double>, n bigint")
    merged = parts.groupBy("_cell").agg(
        F.array(*[F.min(F.col("low")[i]) for i in range(width)]).alias("low"),
        F.array(*[F.max(F.col("high")[i]) for i in range(width)]).alias("high"),
        F.sum("n").alias("n"),
    )
    rows = sorted(merged.collect(), key=lambda r: r["_cell"])
    number = np.array([r["_cell"] for r in rows], dtype=np.int32)
    shape = (len(rows), width)
    low = np.array([r["low"] for r in rows], dtype=np.float64).reshape(shape)
    high = np.array([r["high"] for r in rows], dtype=np.float64).reshape(shape)
    return number, low, high, np.array([r["n"] for r in rows], dtype=np.int64)


def _routed(asked: DataFrame, query_col: str, pivots, cells, k: int) -> DataFrame:
    """(query, embedding, home, far): the cells to look at first, and the others with their bounds.

    By the triangle inequality no vector of a cell is nearer to the query than the greatest gap,
    over all pivots, between the query's distance to the pivot and those of the cell. ``home``
    are the cells of least bounds that hold ``k`` vectors together, ``far`` all others as
    (cell, bound).
    """
    import numpy as np

    number, low, high, count = cells

    def route(batches: Iterator) -> Iterator:
        for batch in batches:
            if not len(batch) or not len(number):
                continue
            rows, good = _unit_rows(batch["embedding"])
            if not good.any():
                continue
            home, far = [], []
            for away in _distances(rows, pivots):
                bound = np.maximum(np.maximum(away - high, low - away).max(axis=1), 0.0)
                # Of equal bounds, the cell whose middle lies nearest.
                order = np.lexsort((np.abs((low + high) / 2 - away).max(axis=1), bound))
                enough = int(np.searchsorted(np.cumsum(count[order]), k)) + 1
                home.append(number[order[:enough]].tolist())
                far.append([{"cell": int(number[i]), "bound": float(bound[i])} for i in order[enough:]])
            yield batch[good].assign(home=home, far=far)

    kind = asked.schema["embedding"].dataType.simpleString()
    name = asked.schema[query_col].dataType.simpleString()
    return asked.mapInPandas(
        route,
        f"`{query_col}` {name}, embedding {kind}, home array<int>, far array<struct<cell: int, bound: double>>",
    )


def _as_rows(cells, width: int):
    """Lists of cell numbers as a mask of queries x cells."""
    import numpy as np

    mask = np.zeros((len(cells), width), dtype=bool)
    if len(cells):
        mask[np.repeat(np.arange(len(cells)), [len(c) for c in cells]), np.concatenate([np.asarray(c, dtype=int) for c in cells])] = True
    return mask


def _vector_blocks(placed: DataFrame, counts: dict[int, int], id_col: str, block_vectors: int, dimensions: int) -> DataFrame:
    """(_cell, _ids, _matrix): a row per block of about ``block_vectors`` unit vectors of one cell."""
    import pyarrow as pa

    pieces = {c: -(-n // block_vectors) for c, n in counts.items()}
    salts = F.create_map(*[F.lit(x) for pair in pieces.items() for x in pair])
    parts = max(min(sum(pieces.values()), LEAST_PARTS), -(-sum(counts.values()) * dimensions * 8 // PART_BYTES))
    rows = placed.select(
        F.col(id_col).alias("_id"), "embedding", "_cell", F.pmod(F.xxhash64(id_col), salts[F.col("_cell")]).cast("int").alias("_s")
    )

    def pack(part: pa.Table) -> pa.Table:
        matrix, good = _unit_rows(part.column("embedding").to_pandas())
        ids = part.column("_id").filter(pa.array(good)).combine_chunks()
        held = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
        return pa.table({"_cell": part.column("_cell").slice(0, 1), "_ids": held, "_matrix": pa.array([matrix.tobytes()], pa.binary())})

    id_type = placed.schema[id_col].dataType.simpleString()
    by = ["_cell", "_s"]
    return settled(rows.repartition(parts, *by).groupBy(*by).applyInArrow(pack, f"_cell int, _ids array<{id_type}>, _matrix binary"))


def _query_blocks(asked: DataFrame, width: int, query_col: str, block_queries: int) -> DataFrame:
    """(_block, _names, _rows, _least, _mask, _cells): a row per block of about ``block_queries`` queries.

    Queries are numbered by the first cell that they meet, so those of a block want much the
    same cells. ``_mask`` has a bit per query and cell, ``_cells`` are those that any of them wants.
    """
    import numpy as np
    import pyarrow as pa

    first = F.col("home")[0]
    sizes = sorted((r["c"], r["count"]) for r in asked.groupBy(first.alias("c")).count().collect())  # a row per cell
    total = sum(n for _, n in sizes)
    starts = dict(zip([c for c, _ in sizes], np.cumsum([0] + [n for _, n in sizes]).tolist()))
    start = F.create_map(*[F.lit(x) for c, at in starts.items() for x in (c, at)])
    size = F.create_map(*[F.lit(x) for pair in sizes for x in pair])
    place = start[first] + F.pmod(F.xxhash64(query_col), size[first])
    parts = max(1, min(-(-total // block_queries), QUERY_PARTS))
    rows = asked.select(
        F.floor(place / F.lit(block_queries)).cast("int").alias("_block"), F.col(query_col).alias("_name"), "embedding", "cells", "least"
    ) if sizes else asked.select(F.lit(0).alias("_block"), F.col(query_col).alias("_name"), "embedding", "cells", "least")

    def pack(part: pa.Table) -> pa.Table:
        matrix, good = _unit_rows(part.column("embedding").to_pandas())
        names = part.column("_name").filter(pa.array(good)).combine_chunks()
        mask = _as_rows(part.column("cells").to_pandas()[good].tolist(), width)
        least = part.column("least").to_numpy()[good]
        whole = lambda x: pa.array([x], pa.binary())
        return pa.table(
            {
                "_block": part.column("_block").slice(0, 1),
                "_names": pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names),
                "_rows": whole(matrix.tobytes()),
                "_least": whole(least.tobytes()),
                "_mask": whole(np.packbits(mask, axis=1).tobytes()),
                "_cells": pa.array([np.flatnonzero(mask.any(axis=0)).tolist()], pa.list_(pa.int32())),
            }
        )

    kind = asked.schema[query_col].dataType.simpleString()
    made = f"_block int, _names array<{kind}>, _rows binary, _least binary, _mask binary, _cells array<int>"
    return settled(rows.repartition(parts, "_block").groupBy("_block").applyInArrow(pack, made))


def _looked_up(asked: DataFrame, blocks: DataFrame, width: int, id_col: str, query_col: str, k: int) -> DataFrame:
    """The best ``k`` of every query among the blocks of its cells, per part of the blocks.

    ``asked`` are blocks of queries (``_query_blocks``), ``blocks`` those of vectors. A task reads
    some of each from the shared folder and pairs them, so pairs are not shuffled, and it carries
    the best so far of the queries of a block from one block of vectors to the next.
    """
    import numpy as np
    import pyarrow as pa

    kinds = {c.name: c.dataType.elementType.simpleString() for c in (asked.schema["_names"], blocks.schema["_ids"])}
    pairs = asked.join(blocks.hint("shuffle_replicate_nl"), F.array_contains("_cells", F.col("_cell")))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        now, names, rows, least, mask, kept, kind = None, None, None, None, None, {}, None

        def result():
            who = [w for _, ids in kept.values() for w in ids.tolist()]
            if pa.types.is_integer(kind):
                who = [None if w != w else int(w) for w in who]
            asked_by = np.repeat(np.fromiter(kept, dtype=np.int64), [len(s) for s, _ in kept.values()])
            return pa.record_batch(
                {
                    query_col: names.take(pa.array(asked_by)),
                    id_col: pa.array(who, kind, from_pandas=True),
                    "similarity": pa.array(np.concatenate([s for s, _ in kept.values()])),
                    "_part": pa.array(np.full(len(who), part), pa.int32()),
                }
            )

        for batch in batches:
            for at in range(batch.num_rows):
                one = lambda column: batch.column(column)[at]  # noqa: B023, E731
                if one("_block").as_py() != now:
                    if kept:
                        yield result()
                    now, kept, names = one("_block").as_py(), {}, one("_names").values
                    least = np.frombuffer(one("_least").as_py()).copy()
                    rows = np.frombuffer(one("_rows").as_py()).reshape(len(least), -1)
                    bits = np.frombuffer(one("_mask").as_py(), dtype=np.uint8).reshape(len(least), -1)
                    mask = np.unpackbits(bits, axis=1, count=width).astype(bool)
                values = one("_ids").values
                kind, ids = values.type, values.to_pandas().to_numpy()
                if not len(ids):
                    continue
                vectors = np.frombuffer(one("_matrix").as_py()).reshape(len(ids), -1)
                meet = np.flatnonzero(mask[:, one("_cell").as_py()])
                for begin in range(0, len(meet), BLOCK_QUERIES):
                    some = meet[begin : begin + BLOCK_QUERIES]
                    scores = rows[some] @ vectors.T
                    # Rounding moves a similarity by less than this.
                    better = scores.max(axis=1) + 10.0**-SIMILARITY_PLACES >= least[some]
                    for query, score in zip(some[better].tolist(), np.round(scores[better], SIMILARITY_PLACES)):
                        near = score >= least[query]
                        score, who = score[near], ids[near]
                        if query in kept:
                            score, who = np.concatenate([kept[query][0], score]), np.concatenate([kept[query][1], who])
                        if not len(score):
                            continue
                        kept[query] = score, who = _best(score, who, k)
                        if len(score) == k:
                            least[query] = max(least[query], score[-1])
        if kept:
            yield result()

    kinds = f"`{query_col}` {kinds['_names']}, `{id_col}` {kinds['_ids']}, similarity double, _part int"
    with bounded_batches(asked.sparkSession, PAIR_BYTES):
        return written(pairs.mapInArrow(search, kinds))


def _ranked(found: DataFrame, k: int, id_col: str, query_col: str) -> DataFrame:
    """The best ``k`` per query in two steps, so that no task sees all parts of a query."""
    order = [F.desc("similarity"), F.col(id_col)]
    local = F.row_number().over(Window.partitionBy(query_col, F.pmod("_part", F.lit(256))).orderBy(*order))
    short = found.withColumn("_r", local).filter(F.col("_r") <= k)
    final = F.row_number().over(Window.partitionBy(query_col).orderBy(*order))
    return short.withColumn("rank", final).filter(F.col("rank") <= k).drop("_r", "_part")


def knn_search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    id_col: str = "vec_id",
    query_col: str = "query_id",
    block_queries: int = BLOCK_QUERIES,
    block_vectors: int = BLOCK_VECTORS,
    pivots: int = PIVOTS,
) -> tuple[DataFrame, DataFrame]:
    """The exact ``k`` nearest vectors by cosine of every query, and what was looked at for it.

    Vectors lie in cells: their nearest pivot and a ring around it. A query first meets the
    cells most likely to hold its neighbours. The ``k``-th best of these is a bound; of the
    other cells only those follow that, by the triangle inequality over all pivots, can hold
    something as near. Cells are cut by hash into blocks of about ``block_vectors``, queries, in
    the order of their first cells, into blocks of about ``block_queries``. Each block is written
    once; each pair that is needed is one product of two bounded matrices, in a task that reads
    both and keeps the best ``k`` per query. So what is moved and written grows with the tables,
    not with the pairs. Both steps run here.

    The first table is that of ``knn``. The second has one row per query: its ``cells_looked``
    out of ``cells``, and ``vectors_looked`` out of ``vectors``. ``query_col`` is unique.
    """
    asked = queries.select(query_col, "embedding").filter(F.col("embedding").isNotNull())
    wanted = vectors.select(id_col, "embedding").filter(F.col("embedding").isNotNull())
    # Cells much smaller than a block would cost more than they spare.
    middle = _pivots(wanted, id_col, max(1, min(pivots, -(-wanted.count() * 8 // block_vectors))))
    placed = written(_placed(wanted, id_col, middle))
    cells = _cells(placed, middle)
    counts = dict(zip(cells[0].tolist(), cells[3].tolist()))
    if not counts:
        kinds = f"`{query_col}` {asked.schema[query_col].dataType.simpleString()}"
        found = f"{kinds}, `{id_col}` {wanted.schema[id_col].dataType.simpleString()}, similarity double, rank int"
        looks = f"{kinds}, cells_looked bigint, cells bigint, vectors_looked bigint, vectors bigint"
        return vectors.sparkSession.createDataFrame([], found), vectors.sparkSession.createDataFrame([], looks)
    routed = written(_routed(asked, query_col, middle, cells, k))
    width = max(counts) + 1
    blocks = _vector_blocks(placed, counts, id_col, block_vectors, middle.shape[1])
    step = lambda rows: _looked_up(
        _query_blocks(rows, width, query_col, block_queries), blocks, width, id_col, query_col, k
    )
    first = step(routed.select(query_col, "embedding", "home", F.col("home").alias("cells"), F.lit(-2.0).alias("least")))
    bounds = _ranked(first, k, id_col, query_col).filter(F.col("rank") == k).select(query_col, F.col("similarity").alias("_kth"))
    known = F.coalesce("_kth", F.lit(-2.0))
    limit = F.sqrt(F.greatest(2.0 - 2.0 * known, F.lit(0.0))) + BOUND_SLACK
    rest = routed.join(bounds, query_col, "left").select(
        query_col,
        "embedding",
        "home",
        F.transform(F.filter("far", lambda x: x["bound"] <= limit), lambda x: x["cell"]).alias("cells"),
        known.alias("least"),
    )
    rest = written(rest)
    second = step(rest.filter(F.size("cells") > 0))
    size = F.create_map(*[F.lit(x) for pair in counts.items() for x in pair])
    seen = F.concat("home", "cells")
    looks = rest.select(
        query_col,
        F.size(seen).cast("bigint").alias("cells_looked"),
        F.lit(len(counts)).cast("bigint").alias("cells"),
        F.aggregate(seen, F.lit(0).cast("bigint"), lambda t, c: t + size[c].cast("bigint")).alias("vectors_looked"),
        F.lit(sum(counts.values())).cast("bigint").alias("vectors"),
    )
    found = _ranked(first.unionByName(second), k, id_col, query_col)
    return found.select(query_col, id_col, "similarity", "rank"), looks


def _scanned(vectors: DataFrame, few: list, id_col: str, query_col: str, query_type: str, k: int) -> DataFrame:
    """The best ``k`` of every task for each of the queries ``few``, in one pass that moves no vector."""
    import numpy as np
    import pandas as pd

    block = pd.DataFrame({"q": [r[query_col] for r in few], "embedding": [r["embedding"] for r in few]})
    matrix, usable = _unit_rows(block["embedding"]) if len(block) else (None, [])
    names = block["q"][usable].tolist() if len(block) else []

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        kept = [(np.empty(0), np.empty(0, dtype=object))] * len(names)
        for batch in batches:
            if not len(batch) or not names:
                continue
            rows, good = _unit_rows(batch["embedding"])
            ids = batch[id_col].to_numpy()[good]
            scores = np.round(matrix @ rows.T, SIMILARITY_PLACES)
            kept = [
                _best(np.concatenate([score, new]), np.concatenate([who, ids]), k)
                for (score, who), new in zip(kept, scores)
            ]
        part = TaskContext.get().partitionId()
        for name, (score, who) in zip(names, kept):
            if len(score):
                yield pd.DataFrame({query_col: name, id_col: who, "similarity": score, "_part": part})

    id_type = vectors.schema[id_col].dataType.simpleString()
    return vectors.mapInPandas(scan, f"`{query_col}` {query_type}, `{id_col}` {id_type}, similarity double, _part int")


def knn(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    id_col: str = "vec_id",
    query_col: str = "query_id",
    block_queries: int = BLOCK_QUERIES,
    block_vectors: int = BLOCK_VECTORS,
) -> DataFrame:
    """The exact ``k`` nearest vectors by cosine of every query, with their rank.

    Up to ``block_queries`` queries go to every task and one pass over the vectors answers them,
    which is less than building cells would cost; more queries are answered by ``knn_search``.
    ``query_col`` is unique. Zero, NULL and non-finite vectors are not neighbours and get none;
    ranks of equal similarity go by id.
    """
    asked = queries.select(query_col, "embedding").filter(F.col("embedding").isNotNull())
    few = rows_if_small(asked, block_queries)
    if few is None:
        return knn_search(vectors, queries, k, id_col, query_col, block_queries, block_vectors)[0]
    wanted = vectors.select(id_col, "embedding").filter(F.col("embedding").isNotNull())
    found = _scanned(wanted, few, id_col, query_col, asked.schema[query_col].dataType.simpleString(), k)
    return _ranked(found, k, id_col, query_col).select(query_col, id_col, "similarity", "rank")
