"""What reaches the scan, and which joins and shuffles a plan has."""

import pytest
from pyspark.sql import functions as F

from factloom.operators import access, contracts, temporal
from factloom.sources.catalog import active_relationships

SF = "/root/testdata/sf0.001"


@pytest.fixture
def plan(capsys):
    def text(df):
        capsys.readouterr()
        df.explain("formatted")
        return capsys.readouterr().out

    return text


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("facts") / "facts")
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    orders.select(
        F.col("o_custkey").alias("canonical_id"),
        F.col("o_orderdate").alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        "o_totalprice",
        "o_orderstatus",
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_point_in_time_filters_reach_the_scan(plan, stored):
    text = plan(temporal.as_of(stored, "1998-01-01", {"canonical_id": [1, 2]}).select("o_totalprice"))
    pushed = next(line for line in text.splitlines() if line.startswith("PushedFilters"))
    assert "LessThanOrEqual(valid_from" in pushed and "In(canonical_id" in pushed
    assert "Exchange" not in text
    schema = next(line for line in text.splitlines() if line.startswith("ReadSchema"))
    assert "o_orderstatus" not in schema


def test_projection_prunes_columns(plan, stored):
    text = plan(access.project_surface(stored, ["o_totalprice", "unknown"]))
    assert next(x for x in text.splitlines() if x.startswith("ReadSchema")) == "ReadSchema: struct<o_totalprice:double>"


def test_active_relationships_filters_reach_the_scan(plan, spark, tmp_path):
    path = str(tmp_path / "rels")
    spark.createDataFrame(
        [],
        "relationship_id string, subject_id string, subject_type string, predicate string, object_id string, "
        "object_type string, valid_from timestamp_ntz, valid_to timestamp_ntz, confidence double, source_system string, other string",
    ).write.parquet(path)
    text = plan(active_relationships(spark.read.parquet(path), ["owned_by"]))
    pushed = next(line for line in text.splitlines() if line.startswith("PushedFilters"))
    assert "IsNull(valid_to)" in pushed and "EqualTo(predicate,owned_by)" in pushed
    assert "other" not in next(x for x in text.splitlines() if x.startswith("ReadSchema"))


def test_all_rules_of_a_contract_take_one_scan(plan, stored):
    spec = {
        "schema": {"columns": [{"name": "canonical_id", "nullable": False}, {"name": "o_orderstatus", "valid_values": ["F"]}]},
        "quality": [{"column": "o_totalprice", "max_null_rate": 0.1, "value_range": {"min": 0, "max": 1}}],
    }
    tree = plan(contracts.check_contract(stored, spec)).split("\n\n")[0]
    assert tree.count("Scan parquet") == 1


def test_versions_without_hot_keys_take_one_shuffle(plan, stored):
    tree = plan(temporal.open_ended(stored.drop("valid_to"), ["canonical_id"], "valid_from", "valid_to")).split("\n\n")[0]
    assert tree.count("Exchange") == 1 and "Join" not in tree


def test_asof_join_has_no_join(plan, stored):
    events = stored.select("canonical_id", F.col("valid_from").alias("ts"), F.monotonically_increasing_id().alias("id"))
    tree = plan(temporal.asof_join(events, stored, ["canonical_id"], "ts", ["id"], ["o_totalprice"])).split("\n\n")[0]
    assert tree.count("Exchange") == 1 and "Join" not in tree
