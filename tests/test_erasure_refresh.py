"""Erasure through derived tables, and surfaces refreshed by what changed."""

import os

import pytest
from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql import functions as F

from factloom.operators.erasure import Held, erase_everywhere
from factloom.operators.etl import denormalise
from factloom.operators.refresh import changed_keys, refresh_surface
from factloom.sources.rewrite import rows_with_place, without_rows
from factloom.sources.surface import write_surface


def contents(path):
    """What every data file of a table holds, by its name."""
    found = {}
    for folder, _, names in os.walk(path):
        for name in names:
            if name.endswith(".parquet") and "/." not in folder and "/_" not in folder:
                with open(f"{folder}/{name}", "rb") as file:
                    found[os.path.relpath(f"{folder}/{name}", path)] = file.read()
    return found


def in_files(df, path, files, by, partition=None):
    placed = df.repartitionByRange(files, by).sortWithinPartitions(by).write
    (placed.partitionBy(partition) if partition else placed).parquet(path)


@pytest.fixture
def held(spark, tmp_path):
    """customers -> facts -> chunks (arrays, made of each other too) -> an index in folders, and a log without a key."""
    root = str(tmp_path)
    in_files(spark.range(100).selectExpr("id AS fact_id", "concat('c', id % 10) AS customer", "id AS n"), f"{root}/facts", 5, "fact_id")
    facts = "CASE WHEN id = 300 THEN array() WHEN id = 301 THEN NULL ELSE array(id % 100, (id * 7) % 100) END AS facts"
    links = "CASE WHEN id = 250 THEN 3L WHEN id = 3 THEN 250L WHEN id = 260 THEN 250L END AS copied_from"
    in_files(spark.range(310).selectExpr("id AS chunk_id", facts, links), f"{root}/chunks", 8, "chunk_id")
    in_files(spark.range(310).selectExpr("concat('d', id) AS id", "CAST(id AS STRING) AS source_record_id", "id % 3 AS day"), f"{root}/index", 6, "source_record_id", "day")
    in_files(spark.range(30).selectExpr("concat('c', id) AS who", "id AS n"), f"{root}/log", 3, "n")
    return root, [
        Held("facts", f"{root}/facts", "fact_id", (("customer", "customers"),)),
        Held("chunks", f"{root}/chunks", "chunk_id", (("facts", "facts"), ("copied_from", "chunks"))),
        Held("index", f"{root}/index", "id", (("source_record_id", "chunks"),)),
        Held("log", f"{root}/log", None, (("who", "customers"),)),
    ]


def plain(customer):
    facts = {i for i in range(100) if f"c{i % 10}" == customer}
    chunks = {i for i in range(310) if i not in (300, 301) and {i % 100, i * 7 % 100} & facts}
    copies = {250: 3, 3: 250, 260: 250}
    while more := {a for a, b in copies.items() if b in chunks} - chunks:
        chunks |= more
    return facts, chunks


def test_erasure_everywhere(spark, held, tmp_path):
    root, tables = held
    before = {t.name: contents(t.path) for t in tables}
    requests = spark.createDataFrame([("customers", "c4"), ("customers", "c4"), ("customers", None)], "table_name string, record_id string")
    report = {r["table_name"]: r for r in erase_everywhere(spark, tables, requests, f"{root}/journal").collect()}
    facts, chunks = plain("c4")
    left = {t.name: spark.read.parquet(t.path) for t in tables}
    assert {r["fact_id"] for r in left["facts"].collect()} == set(range(100)) - facts
    assert {r["chunk_id"] for r in left["chunks"].collect()} == set(range(310)) - chunks
    assert {(r["id"], r["day"]) for r in left["index"].collect()} == {(f"d{i}", i % 3) for i in range(310) if i not in chunks}
    assert {r["who"] for r in left["log"].collect()} == {f"c{i}" for i in range(30)} - {"c4"}
    assert (report["facts"]["rows_erased"], report["chunks"]["rows_erased"], report["index"]["rows_erased"], report["log"]["rows_erased"]) == (len(facts), len(chunks), len(chunks), 1)
    assert report["log"]["files_touched"] == 1
    after = {t.name: contents(t.path) for t in tables}
    for name in before:
        changed = sum(after[name].get(f) != data for f, data in before[name].items())
        assert set(after[name]) <= set(before[name]) and changed == report[name]["files_touched"]
    assert not [d for d, _, _ in os.walk(root) if ".rewritten" in d]
    again = erase_everywhere(spark, tables, requests, f"{root}/journal").collect()
    assert all(r["rows_erased"] == 0 for r in again)
    assert {t.name: contents(t.path) for t in tables} == after


def test_a_run_that_stopped_half_way_is_finished(spark, held):
    """Facts are gone already, so only the journal still knows which chunks were made from them."""
    root, tables = held
    requests = spark.createDataFrame([("customers", "c4")], "table_name string, record_id string")
    erase_everywhere(spark, tables[:1], requests, f"{root}/other")
    lost = Held("chunks", f"{root}/nowhere", "chunk_id", tables[1].made_from)
    facts, chunks = plain("c4")
    assert spark.read.parquet(tables[0].path).count() == 100 - len(facts)
    # A second request, whose run ends before its last table.
    requests = spark.createDataFrame([("customers", "c5")], "table_name string, record_id string")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        erase_everywhere(spark, [tables[0], lost], requests, f"{root}/journal")
    erase_everywhere(spark, tables, requests, f"{root}/journal")
    assert not {r["chunk_id"] for r in spark.read.parquet(tables[1].path).collect()} & plain("c5")[1]
    with pytest.raises(ValueError, match="nothing is known"):
        erase_everywhere(spark, tables, requests.withColumn("table_name", F.lit("orders")), f"{root}/third")


def test_files_and_tables_that_lose_all_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    in_files(spark.range(40).withColumn("text", F.lit("é")), path, 4, "id")
    rows = rows_with_place(spark, path)
    assert without_rows(spark, path, rows.filter("id < 10"))["files_removed"] == 1
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == list(range(10, 40))
    assert without_rows(spark, path, rows_with_place(spark, path)) == {"rows_erased": 30, "files_touched": 3, "files_removed": 3}
    assert spark.read.parquet(path).count() == 0 and spark.read.parquet(path).columns == ["id", "text"]


def state(spark, facts, nations, regions):
    return (
        spark.createDataFrame(facts, "id int, nation int, v int"),
        [(spark.createDataFrame(nations, "nation int, name string, region int"), "nation"), (spark.createDataFrame(regions, "region int, area string"), "region")],
    )


def rows(df):
    return sorted(map(str, df.select("id", "nation", "v", "name", "region", "area").collect()))


def test_refresh_equals_a_full_rebuild(spark, tmp_path):
    path = str(tmp_path / "s")
    facts = [(i, i % 7, i) for i in range(70)] + [(3, 3, 4), (99, 8, 1), (98, None, 1)]
    nations = [(n, f"n{n}", n % 3) for n in range(7)] + [(8, None, None)]
    regions = [(r, f"area {r}") for r in range(3)]
    old_facts, old_dims = state(spark, facts, nations, regions)
    write_surface(denormalise(old_facts, old_dims), path, ["nation"])
    before = contents(path)
    # An insert, an update, a delete, a repeat less, a move to another partition, one that empties a partition,
    # a nation that changes its name and one that appears.
    facts = [f for f in facts if f not in ((3, 3, 4), (11, 4, 11)) and f[1] != 6] + [(200, 1, 5), (201, 9, 5)]
    facts = [(i, n, 1_000 if i == 7 else v) for i, n, v in facts]
    facts = [(i, 1 if i == 14 else n, v) for i, n, v in facts]
    nations = [(n, "new" if n == 2 else name, r) for n, name, r in nations] + [(9, "n9", 0)]
    new_facts, new_dims = state(spark, facts, nations, regions)
    changed = changed_keys(old_facts, new_facts, ["id"])
    assert {r["id"] for r in changed.collect()} == {3, 7, 11, 14, 200, 201, *range(6, 70, 7)}
    dims = {0: changed_keys(old_dims[0][0], new_dims[0][0], ["nation"])}
    done = refresh_surface(spark, path, new_facts, new_dims, ["id"], ["nation"], changed, dims)
    assert rows(spark.read.parquet(path)) == rows(denormalise(new_facts, new_dims))
    after = contents(path)
    same = {n for n in range(7) if [f for f in before if f.startswith(f"nation={n}/")] == [f for f in after if f.startswith(f"nation={n}/")]}
    assert same == {5} and not any(f.startswith("nation=6/") for f in after)
    assert done["partitions_removed"] == 1 and done["partitions_written"] == 6 and done["rows_written"] < 62
    again = refresh_surface(spark, path, new_facts, new_dims, ["id"], ["nation"], changed, dims)
    assert again["partitions_removed"] == 0 and rows(spark.read.parquet(path)) == rows(denormalise(new_facts, new_dims))


def test_refresh_by_a_far_dimension_or_by_nothing(spark, tmp_path):
    path = str(tmp_path / "s")
    facts, nations, regions = [(i, i % 6, i) for i in range(60)], [(n, f"n{n}", n % 3) for n in range(6)], [(r, f"area {r}") for r in range(3)]
    table, dims = state(spark, facts, nations, regions)
    write_surface(denormalise(table, dims), path, ["nation"])
    before = contents(path)
    assert refresh_surface(spark, path, table, dims, ["id"], ["nation"])["rows_written"] == 0
    assert contents(path) == before
    # Region 1 goes, region 2 is renamed.
    new_table, new_dims = state(spark, facts, nations, [(0, "area 0"), (2, "renamed")])
    changed = changed_keys(dims[1][0], new_dims[1][0], ["region"])
    done = refresh_surface(spark, path, new_table, new_dims, ["id"], ["nation"], None, {1: changed})
    assert done == {"keys_affected": 40, "partitions_written": 2, "partitions_removed": 2, "rows_written": 20}
    assert rows(spark.read.parquet(path)) == rows(denormalise(new_table, new_dims))
    assert {f: d for f, d in contents(path).items() if f[:8] in ("nation=0", "nation=3")} == {f: d for f, d in before.items() if f[:8] in ("nation=0", "nation=3")}


def test_every_touched_file_is_sorted_by_a_task_of_its_own(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    for first in range(0, 80, 10):
        spark.range(first, first + 10, 1, 1).write.mode("append").parquet(path)
    tasks = []
    sort = DataFrame.sortWithinPartitions

    def noted(df, *columns, **more):
        tasks.extend(df.groupBy(F.spark_partition_id().alias("p")).agg(F.countDistinct("_number").alias("n")).collect())
        assert "_file" not in df.columns
        return sort(df, *columns, **more)

    monkeypatch.setattr(DataFrame, "sortWithinPartitions", noted)
    without_rows(spark, path, rows_with_place(spark, path).filter("id % 10 = 3"))
    assert len(tasks) == 8 and {r["n"] for r in tasks} == {1}
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [i for i in range(80) if i % 10 != 3]
