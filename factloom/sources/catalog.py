"""Reading tables, catalogue columns and table properties (IO1-IO3, IO6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMN_SCHEMA = (
    "table_schema string, table_name string, column_name string, ordinal int, data_type string, "
    "comment string, table_type string"
)
RELATIONSHIP_COLUMNS = [
    "relationship_id",
    "subject_id",
    "subject_type",
    "predicate",
    "object_id",
    "object_type",
    "valid_from",
    "valid_to",
    "confidence",
    "source_system",
]


def read_table(spark: SparkSession, path_or_name: str, fmt: str = "parquet") -> DataFrame:
    """IO1: a table by path (anything with a slash) or by catalogue name."""
    if "/" in path_or_name:
        return spark.read.format(fmt).load(path_or_name)
    return spark.table(path_or_name)


def catalog_columns(
    spark: SparkSession, frames: dict[str, DataFrame], schema: str = "default", table_type: str = "BASE TABLE"
) -> DataFrame:
    """IO2: the columns of tables as rows. Comments come from the column metadata."""
    rows = [
        (schema, name, f.name, i, f.dataType.simpleString(), (f.metadata or {}).get("comment"), table_type)
        for name, df in frames.items()
        for i, f in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(rows, COLUMN_SCHEMA)


def database_columns(spark: SparkSession, database: str) -> DataFrame:
    """IO2: the same for a database of the session catalogue. Only metadata is read."""
    rows = []
    for table in spark.catalog.listTables(database):
        if table.isTemporary:
            continue
        kind = "VIEW" if table.tableType == "VIEW" else "BASE TABLE"
        fields = spark.table(f"{database}.{table.name}").schema.fields
        for i, f in enumerate(fields):
            comment = (f.metadata or {}).get("comment")
            rows.append((database, table.name, f.name, i, f.dataType.simpleString(), comment, kind))
    return spark.createDataFrame(rows, COLUMN_SCHEMA)


def catalog_tables(cols: DataFrame) -> DataFrame:
    """IO2: one row per table of a column catalogue."""
    return cols.select("table_schema", "table_name", "table_type").distinct()


def active_relationships(df: DataFrame, predicates: list[str] | None = None) -> DataFrame:
    """IO3: the columns of active relationships; both filters reach the scan."""
    rows = df.filter(F.col("valid_to").isNull())
    if predicates:
        rows = rows.filter(F.col("predicate").isin(predicates))
    return rows.select(*RELATIONSHIP_COLUMNS)


def jdbc_relationships(
    spark: SparkSession,
    url: str,
    partition_column: str,
    lower: str,
    upper: str,
    partitions: int,
    table: str = "entity_relationships",
    predicates: list[str] | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """IO3: the same from a relational store, read in ``partitions`` parallel ranges."""
    reader = (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("partitionColumn", partition_column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", str(partitions))
        .options(**(options or {}))
    )
    return active_relationships(reader.load(), predicates)


def properties_df(spark: SparkSession, tables: dict[str, dict[str, str]]) -> DataFrame:
    """IO6: table properties as (table_name, key, value) rows."""
    rows = [(t, k, v) for t, pairs in tables.items() for k, v in pairs.items()]
    return spark.createDataFrame(rows, "table_name string, key string, value string")


def properties_wide(props: DataFrame, keys: list[str]) -> DataFrame:
    """IO6: one row per table, one column per named property."""
    return props.groupBy("table_name").pivot("key", keys).agg(F.max("value"))
