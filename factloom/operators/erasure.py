"""Right to erasure across all tables that were made from a record."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.sources.rewrite import FILE, ROW, delete_path, file_numbers, rows_with_place, without_rows


@dataclass(frozen=True)
class Held:
    """A Parquet table that may hold rows made from a record.

    ``key`` names its rows, if others are made from them. ``made_from`` says which columns, single
    ids or arrays of ids, name rows of which table; a table may be made from its own rows.
    """

    name: str
    path: str
    key: str | None = None
    made_from: tuple[tuple[str, str], ...] = ()


def _ids(rows: DataFrame, column: str, *more: str) -> DataFrame:
    """(_id, more) with a row per id; ids are compared as text."""
    value = F.col(column)
    if isinstance(rows.schema[column].dataType, T.ArrayType):
        value = F.explode(value)
    return rows.select(value.alias("_v"), *more).select(F.col("_v").cast("string").alias("_id"), *more).filter("_id IS NOT NULL")


def _rows_of(found: DataFrame, names: list[tuple[str, str]], ids: dict[str, DataFrame], *more: str) -> DataFrame:
    """``more`` of the rows that name one of the ids of another table, or of their own."""
    hits = [_ids(found, column, *more).join(ids[table], "_id", "left_semi").select(*more) for column, table in names if table in ids]
    return reduce(DataFrame.unionByName, hits)


def made_from(spark: SparkSession, tables: Sequence[Held], requests: DataFrame, journal: str) -> dict[str, DataFrame]:
    """Per table the ids (_id) that fall with the requested records (table_name, record_id).

    From step to step only tables made from those with new ids are read, and of them only keys
    and the columns that name others. Ids found before are not carried on, so cycles end. The
    ids are kept at ``journal``: a run that is repeated after some tables have lost their rows
    still knows all of them.
    """
    root = f"{journal.rstrip('/')}/ids"

    def kept(table: str) -> DataFrame:
        return spark.read.schema("_id string").parquet(f"{root}/table={table}/*")

    def found_before() -> list[str] | None:
        try:
            return spark.read.json(f"{journal}/closed").first()["tables"]
        except AnalysisException as missing:
            if missing.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    done = found_before()
    if done is not None:
        return {t: kept(t) for t in done}
    delete_path(spark, root)  # of a run that did not come to its end
    level = {}
    asked = requests.select(F.col("table_name"), F.col("record_id").cast("string").alias("_id")).filter("_id IS NOT NULL").distinct()
    named = {n for t in tables for n in (t.name, *[table for _, table in t.made_from])}
    for table in sorted(r["table_name"] for r in asked.select("table_name").distinct().collect()):
        if table not in named:
            raise ValueError(f"nothing is known to be held of {table}")
        asked.filter(F.col("table_name") == table).select("_id").write.parquet(f"{root}/table={table}/step=0")
        level[table] = spark.read.schema("_id string").parquet(f"{root}/table={table}/step=0")
    reached, step = set(level), 0
    while level:
        step += 1
        following = {}
        for table in tables:
            names = [(c, t) for c, t in table.made_from if t in level]
            if table.key is None or not names:
                continue
            rows = spark.read.parquet(table.path).withColumn("_key", F.col(table.key).cast("string"))
            new = _rows_of(rows, names, level, "_key").select(F.col("_key").alias("_id")).filter("_id IS NOT NULL").distinct()
            if table.name in reached:
                new = new.join(kept(table.name), "_id", "left_anti")
            path = f"{root}/table={table.name}/step={step}"
            new.write.parquet(path)
            ids = spark.read.schema("_id string").parquet(path)
            if not ids.isEmpty():
                following[table.name] = ids
        reached.update(following)
        level = following
    spark.createDataFrame([(sorted(reached),)], "tables array<string>").coalesce(1).write.mode("overwrite").json(f"{journal}/closed")
    return {t: kept(t) for t in sorted(reached)}


def erase_everywhere(spark: SparkSession, tables: Sequence[Held], requests: DataFrame, journal: str) -> DataFrame:
    """Take the requested records, and all rows made from them, out of every table.

    ``requests`` has table_name and record_id. A row made from several records goes when one of
    them goes. Only files that hold such a row are rewritten. ``journal`` is a folder of this
    request: the run may be repeated with it at any time, and what is done already has no
    effect. Returns (table_name, rows_erased, files_touched, files_removed), a row per table.
    """
    ids = made_from(spark, tables, requests, journal)
    report = []
    for table in tables:
        names = [(c, t) for c, t in table.made_from if t in ids]
        if table.key is not None and table.name in ids:
            names.append((table.key, table.name))
        done = {"rows_erased": 0, "files_touched": 0, "files_removed": 0}
        if names:
            place = f"{journal}/rows/table={table.name}"
            rows = rows_with_place(spark, table.path)
            files = F.broadcast(file_numbers(rows))  # a row per file
            hits = _rows_of(rows.join(files, FILE), names, ids, "_number", ROW).distinct()
            hits.join(files, "_number").select(FILE, ROW).write.mode("overwrite").parquet(place)
            done = without_rows(spark, table.path, spark.read.schema(f"{FILE} string, {ROW} bigint").parquet(place))
        report.append((table.name, *done.values()))
    return spark.createDataFrame(report, "table_name string, rows_erased long, files_touched long, files_removed long")
