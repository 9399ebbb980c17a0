"""Writing surfaces, tables that are replaced as a whole, and tables of appended batches (IO4).

``publish_version`` never overwrites what a reader may be reading. Data goes to
``<root>/data/in_version=N``; a row appended to ``<root>/manifest`` then makes it visible. The
current content is the version with the highest number in the manifest.

``append_delta``, ``newest`` and ``compact`` keep a table of the newest row per key as the
batches that were appended: a batch writes in proportion to itself, readers take the newest
row of each key, and compaction writes these as one more batch before older ones go.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST_SCHEMA = "version bigint"


def write_surface(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """IO4: write Parquet, replacing only the partitions that the rows belong to.

    The rebalance hint gathers the rows of a partition value and splits a value with very
    many rows over several files.
    """
    writer = df.hint("rebalance", *(partition_by or [])).write.mode("overwrite")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(path)


def _manifest(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(MANIFEST_SCHEMA).json(f"{root}/manifest")
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def current_version(spark: SparkSession, root: str) -> int | None:
    """The visible version; None when nothing was published."""
    manifest = _manifest(spark, root)
    return None if manifest is None else manifest.agg(F.max("version")).first()[0]


def read_current(spark: SparkSession, root: str) -> DataFrame | None:
    """The current rows; None when nothing was published."""
    version = current_version(spark, root)
    return None if version is None else spark.read.parquet(f"{root}/data/in_version={version}")


def stage_version(df: DataFrame, root: str, version: int) -> DataFrame:
    """Write a whole new version without making it visible, and return it as read from there.

    ``reveal_version`` makes it visible; a version that is not revealed has no effect.
    """
    path = f"{root}/data/in_version={version}"
    df.hint("rebalance").write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def reveal_version(spark: SparkSession, root: str, version: int) -> None:
    """Make a staged version the current one."""
    spark.createDataFrame([(version,)], MANIFEST_SCHEMA).coalesce(1).write.mode("append").json(f"{root}/manifest")


def publish_version(df: DataFrame, root: str, version: int) -> None:
    """Replace the whole table by a new version; readers keep the old one until it is complete."""
    stage_version(df, root, version)
    reveal_version(df.sparkSession, root, version)


def append_delta(rows: DataFrame, root: str, run: str, number: int) -> None:
    """Add a batch to a table of deltas. The same batch of the same run replaces itself."""
    rows.write.mode("overwrite").parquet(f"{root}/run={run}/batch={number}")


def read_deltas(spark: SparkSession, root: str, without: tuple[str, int] | None = None) -> DataFrame | None:
    """The rows of all batches, but for a run's batch named by ``without``; None when there is none."""
    try:
        deltas = spark.read.option("basePath", root).parquet(root)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    if without is not None:
        deltas = deltas.filter(~((F.col("run") == without[0]) & (F.col("batch") == without[1])))
    return deltas.drop("run", "batch")


def newest(
    spark: SparkSession,
    root: str,
    key: str,
    order: list[Column],
    only: DataFrame | None = None,
    without: tuple[str, int] | None = None,
) -> DataFrame | None:
    """The row of each key that is greatest by ``order``; None when there is no delta.

    ``only`` (a column named like the key) restricts the keys before rows are compared, and ``without`` leaves a
    run's batch out. The winner is found with partial results, so a key with very many rows
    meets no single task.
    """
    rows = read_deltas(spark, root, without)
    if rows is None:
        return None
    return _greatest(rows if only is None else rows.join(only.select(key).distinct(), key, "left_semi"), key, order)


def _greatest(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    rest = [c for c in rows.columns if c != key]
    best = rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*[F.col(key) if c == key else F.col("_row")[c].alias(c) for c in rows.columns])


def compact(spark: SparkSession, root: str, key: str, order: list[Column]) -> None:
    """Write the newest rows as one delta in place of those that there are."""
    gather(spark, root, lambda rows: _greatest(rows, key, order))


def gather(spark: SparkSession, root: str, gathered: Callable[[DataFrame], DataFrame]) -> None:
    """Write ``gathered(rows of all deltas)`` as one delta, then remove the deltas that it was made from.

    What is gathered must mean the same beside the deltas it was made from. Then a run that
    stops half-way leaves the table as it was, and batches appended meanwhile are not touched.
    """
    files = spark._jvm.org.apache.hadoop.fs
    base = files.Path(root)
    system = base.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(base):
        return
    old = [d.getPath() for run in system.listStatus(base) if run.isDirectory() for d in system.listStatus(run.getPath())]
    append_delta(gathered(read_deltas(spark, root)).hint("rebalance"), root, f"compact-{uuid.uuid4().hex}", 0)
    for path in old:
        system.delete(path, True)
