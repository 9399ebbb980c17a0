"""Keeping a surface in step with its tables without building it anew (E01, IO4)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.operators.etl import denormalise
from factloom.plans.frontier import written
from factloom.sources.rewrite import delete_path, folder_of

Dimension = tuple[DataFrame, str | list[str]]


def changed_keys(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """The keys whose rows differ between two states: inserted, deleted, updated, or repeated another number of times."""
    rows = [
        df.select(*keys, F.xxhash64(*after.columns).alias("_h")).groupBy(*keys).agg(F.sum(F.col("_h").cast("decimal(38,0)")).alias("_h"), F.count("*").alias("_n"))
        for df in (before.select(*after.columns), after)
    ]
    both = rows[0].withColumn("_sign", F.lit(1)).unionByName(rows[1].withColumn("_sign", F.lit(-1)))
    differ = (F.count("*") < 2) | (F.sum(F.col("_h") * F.col("_sign")) != 0) | (F.sum(F.col("_n") * F.col("_sign")) != 0)
    return both.groupBy(*keys).agg(differ.alias("_differ")).filter("_differ").select(*keys)


def affected_keys(facts: DataFrame, dims: list[Dimension], keys: list[str], changed: DataFrame | None, changed_dims: dict[int, DataFrame]) -> DataFrame:
    """The keys of facts whose surface rows may differ: changed ones, and those that meet a changed dimension row.

    ``changed_dims`` gives, by the place of a dimension in ``dims``, the keys of its rows that
    differ. Facts are taken as far as that dimension only, and by their keys; one that met
    another row before has itself changed, or a dimension before this one has.
    """
    parts = [] if changed is None else [changed.select(*keys)]
    for place, rows in changed_dims.items():
        on = [dims[place][1]] if isinstance(dims[place][1], str) else dims[place][1]
        met = denormalise(facts, dims[:place]).join(rows.select(*on).distinct(), on, "left_semi")
        parts.append(met.select(*keys))
    if not parts:
        return facts.select(*keys).limit(0)
    return reduce(DataFrame.unionByName, parts).distinct()


def _same(values: dict[str, object]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in values.items()])


def refresh_surface(
    spark: SparkSession,
    path: str,
    facts: DataFrame,
    dims: list[Dimension],
    keys: list[str],
    partition_by: list[str],
    changed: DataFrame | None = None,
    changed_dims: dict[int, DataFrame] | None = None,
    build: Callable[[DataFrame, list[Dimension]], DataFrame] = denormalise,
) -> dict[str, int]:
    """E01 / IO4: bring a partitioned surface up to its tables, by the rows that differ.

    ``facts`` and ``dims`` are the tables as they are now, ``changed`` and ``changed_dims`` the keys
    that differ from when the surface was written (see ``changed_keys``, ``affected_keys``).
    Only affected facts are joined with the dimensions. Of the surface, keys are read to find
    the partitions with affected rows; these and the partitions of the new rows are written
    anew from their other rows and the new ones, a partition without rows goes, and others are
    not touched. Keys need not be unique. Running it again, or after it stopped half-way, has
    the same outcome. Returns the numbers of affected keys, partitions written and removed,
    and rows written.
    """
    asked = written(affected_keys(facts, dims, keys, changed, changed_dims or {}))
    affected = asked.count()
    if not affected:
        return {"keys_affected": 0, "partitions_written": 0, "partitions_removed": 0, "rows_written": 0}
    surface = spark.read.parquet(path)
    delta = written(build(facts.join(asked, keys, "left_semi"), dims).select(*surface.columns))
    # As many rows as the surface has partitions, which the driver lists anyway.
    old = surface.select(*keys, *partition_by, F.col("_metadata.file_path").alias("_file")).join(asked, keys, "left_semi")
    held = old.groupBy(*partition_by).agg(F.min("_file").alias("_file")).collect()
    new = delta.select(*partition_by).distinct().collect()
    touched = {tuple(r[c] for c in partition_by): r["_file"] for r in held} | {tuple(r): None for r in new if tuple(r) not in {tuple(h[c] for c in partition_by) for h in held}}
    inside = [_same(dict(zip(partition_by, p, strict=True))) for p in touched]
    carried = surface.filter(reduce(lambda a, b: a | b, inside)).join(asked, keys, "left_anti")
    # Written aside first: a surface is not read while it is overwritten.
    staged = written(carried.unionByName(delta))
    filled = {tuple(r) for r in staged.select(*partition_by).distinct().collect()}
    staged.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    emptied = [file for p, file in touched.items() if p not in filled and file is not None]
    for file in emptied:
        delete_path(spark, folder_of(spark, file))
    return {"keys_affected": affected, "partitions_written": len(filled), "partitions_removed": len(emptied), "rows_written": staged.count()}
