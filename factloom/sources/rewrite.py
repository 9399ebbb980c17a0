"""Taking rows out of Parquet tables by rewriting only the files that hold them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.plans.frontier import written

FILE, ROW = "_file", "_row_index"


def rows_with_place(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table with the file and the row number in it that hold them."""
    return spark.read.parquet(path).withColumns({FILE: F.col("_metadata.file_path"), ROW: F.col("_metadata.row_index")})


def file_numbers(rows: DataFrame) -> DataFrame:
    """(_file, _number): the files that ``rows`` lie in. Names are long, so a number per row is moved in their place."""
    names = sorted(r[FILE] for r in rows.select(FILE).distinct().collect())  # a row per file
    return rows.sparkSession.createDataFrame(list(enumerate(names)), f"_number int, {FILE} string")


def _hadoop(spark: SparkSession, path: str):
    files = spark._jvm.org.apache.hadoop.fs
    base = files.Path(path)
    return files, base.getFileSystem(spark._jsc.hadoopConfiguration())


def delete_path(spark: SparkSession, path: str) -> None:
    files, system = _hadoop(spark, path)
    system.delete(files.Path(path), True)


def folder_of(spark: SparkSession, file: str) -> str:
    """The folder of a file, named by its URI as ``_metadata.file_path`` gives it."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file)).getParent().toString()


def without_rows(spark: SparkSession, path: str, hits: DataFrame) -> dict[str, int]:
    """Take the rows at ``hits`` (_file, _row_index) out of the table; other files are not touched.

    Of every touched file the rows that stay are written, in their order, to one new file,
    which then takes the old one's name in one step. A run that stops half-way leaves each file
    as it was or as it is to be, so the next run finds only what is left to do. What comes to
    the driver is one name per touched file. Returns the numbers of rows, files touched and
    files removed because no row stays.
    """
    counts = hits.select(FILE, ROW).distinct().groupBy(FILE).agg(F.count(F.lit(1)).alias("n")).collect()
    if not counts:
        return {"rows_erased": 0, "files_touched": 0, "files_removed": 0}
    jvm = spark._jvm
    files, system = _hadoop(spark, path)
    names = sorted(r[FILE] for r in counts)
    places = [files.Path(jvm.java.net.URI(n)) for n in names]
    # Read file by file, a table has the columns that the files hold, without those of its folders.
    touched = spark.read.parquet(*[p.toString() for p in places])
    columns = touched.columns
    numbers = spark.createDataFrame(list(enumerate(names)), f"_number int, {FILE} string")
    own = lambda rows: rows.join(F.broadcast(numbers), FILE).drop(FILE)  # noqa: E731  a row per touched file
    gone = written(own(hits.select(FILE, ROW)))  # so that the join knows its size
    kept = own(touched.withColumns({FILE: F.col("_metadata.file_path"), ROW: F.col("_metadata.row_index")})).join(
        gone, ["_number", ROW], "left_anti"
    )
    stage = f"{path.rstrip('/')}/.rewritten-{uuid.uuid4().hex}"
    placed = kept.repartitionById(len(names), F.col("_number")).sortWithinPartitions("_number", ROW)
    placed.select(*columns, "_number").write.option("maxRecordsPerFile", 0).partitionBy("_number").parquet(stage)
    context = files.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    rename = getattr(files, "Options$Rename")
    overwrite = spark.sparkContext._gateway.new_array(rename, 1)
    overwrite[0] = rename.OVERWRITE
    removed = []
    for number, place in enumerate(places):
        folder = files.Path(f"{stage}/_number={number}")
        new = [s.getPath() for s in system.listStatus(folder) if s.getPath().getName().startswith("part-")] if system.exists(folder) else []
        if new:
            context.rename(new[0], place, overwrite)
        else:
            removed.append(place)
    if len(removed) == len(spark.read.parquet(path).inputFiles()):
        touched.limit(0).write.mode("append").parquet(path)  # the table stays, without rows
    for place in removed:
        system.delete(place, False)
    system.delete(files.Path(stage), True)
    return {"rows_erased": sum(r["n"] for r in counts), "files_touched": len(names), "files_removed": len(removed)}
