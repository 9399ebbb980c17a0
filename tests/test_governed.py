"""Audits, confidence, access, lineage, contracts, monitoring: rules at their edges."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from factloom.functions.confidence import confidence_band, source_confidence
from factloom.functions.numeric import percent
from factloom.operators import access, audits, confidence, contracts, etl, governance, migration, observability
from factloom.sources import catalog
from factloom.sources.schemas import TABLES

D = dt.datetime


def rows(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def one_column(spark, values, kind):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def test_catalogue_and_audits(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "id int, cust_id string, balance double")
    df = df.withMetadata("balance", {"comment": "outstanding balance in dollars"}).withMetadata("id", {"comment": "short"})
    cols = catalog.catalog_columns(spark, {"accounts": df}, "db").unionByName(
        catalog.catalog_columns(spark, {"seen": spark.sql("SELECT 1 AS updated_at")}, "db")
    )
    graded = audits.audit_descriptions(cols, schema="db")
    assert rows(graded, "column_name", "description_quality") == [
        ("balance", "OK"), ("cust_id", "MISSING"), ("id", "TOO_SHORT"), ("updated_at", "MISSING"),
    ]
    assert [r["description_quality"] for r in graded.collect()] == ["MISSING", "MISSING", "OK", "TOO_SHORT"]
    risk = dict(rows(audits.audit_abbreviations(cols), "column_name", "naming_risk"))
    assert risk == {"id": "LIKELY_ABBREVIATION", "cust_id": "OK", "balance": "POSSIBLE_ABBREVIATION", "updated_at": "OK"}
    bracket = dict(rows(audits.audit_abbreviations(cols, bracket_pattern=True), "column_name", "naming_risk"))
    assert bracket["cust_id"] == "POSSIBLE_ABBREVIATION"
    debt = audits.audit_temporal(cols, catalog.catalog_tables(cols), "db")
    assert rows(debt, "table_name", "temporal_pattern", "total_columns") == [
        ("accounts", "NO_TEMPORAL_METADATA", 3), ("seen", "OVERWRITE_PATTERN_ONLY", 1),
    ]


def test_database_columns(spark):
    spark.range(1).createOrReplaceTempView("some_view")
    assert catalog.database_columns(spark, "default") is not None
    assert catalog.read_table(spark, "some_view").count() == 1


def test_properties(spark):
    props = catalog.properties_df(
        spark,
        {
            "a": {"ai_ready": "true", "ai_ready_valid_until": "2025-02-01"},
            "b": {"ai_ready": "true", "ai_ready_valid_until": "2024-11-01"},
            "c": {"ai_ready": "false"},
            "d": {"ai_ready": "true"},
            "e": {"ai_ready": "true", "ai_ready_valid_until": "2024-11-20"},
        },
    )
    status = dict(rows(governance.certification_status(props, "2024-11-15"), "table_name", "certification_status"))
    assert status == {"a": "CERTIFIED", "b": "EXPIRED", "c": "NOT_CERTIFIED", "d": "NO_EXPIRY_DATE", "e": "EXPIRING_SOON"}


def test_decay_counts_whole_days_and_is_not_clamped_above(spark):
    facts = spark.createDataFrame(
        [
            ("whole", "fast", 1.0, D(2024, 1, 1, 12)),
            ("future", "fast", 1.0, D(2024, 1, 20)),
            ("floor", "fast", 1.0, D(2020, 1, 1)),
            ("other", "Fast", 1.0, D(2020, 1, 1)),
            ("none", "slow", None, D(2024, 1, 1)),
            ("undated", "medium", 1.0, None),
        ],
        "canonical_id string, rate_of_change_class string, confidence double, asserted_at timestamp_ntz",
    ).selectExpr("*", "'' AS legal_name", "1 AS employee_count", "CAST(NULL AS TIMESTAMP_NTZ) AS valid_to")
    got = dict(rows(confidence.effective_confidence(facts, "2024-01-11"), "canonical_id", "effective_confidence"))
    assert got == {"whole": 0.7, "future": 1.3, "floor": 0.1, "other": 0.95, "none": None, "undated": 0.3}


def test_bands_and_sources(spark):
    df = one_column(spark, [0.80, 0.79, 0.5, 0.4999, None], "double")
    assert [r[0] for r in df.select(confidence_band(F.col("v"))).collect()] == [
        "assertive", "hedged", "hedged", "uncertain", None,
    ]
    kinds = one_column(spark, ["government_registry", "user_submitted_form", "?", None], "string")
    assert [r[0] for r in kinds.select(source_confidence(F.col("v"))).collect()] == [0.95, 0.4, 0.4, 0.4]


def test_visibility(spark):
    df = spark.createDataFrame(
        [(1, 7, "N", ["a"]), (2, None, "N", None), (3, 8, None, ["b", None]), (4, None, None, None)],
        "id int, assigned_manager_id int, territory_code string, visibility_roles array<string>",
    )
    see = lambda user: [r[0] for r in rows(access.visible_rows(df, user), "id")]
    assert see({"user_id": 8, "territory": "N", "role": "zzz"}) == [1, 2, 3]
    assert see({"role": "b"}) == [3]
    assert see({}) == []
    users = spark.createDataFrame(
        [(8, "N", "zzz"), (9, None, "b"), (10, None, None)], "user_id int, territory string, role string"
    )
    assert rows(access.visible_counts(df, users), "user_id", "visible_rows") == [(8, 3), (9, 1), (10, 0)]
    assert rows(access.visible_pairs(df, users, "id"), "user_id", "id") == [(8, 1), (8, 2), (8, 3), (9, 3)]


def test_columns_of_roles(spark):
    sens = spark.createDataFrame(
        [("t", "p", "PUBLIC", None, False), ("t", "i", "INTERNAL", ["x"], True), ("t", "n", "INTERNAL", None, True), ("u", "p", "PUBLIC", None, False)],
        "table_name string, column_name string, classification string, access_roles array<string>, log_access boolean",
    )
    assert rows(access.allowed_columns(sens, "t", ["x"]), "column_name") == [("i",), ("p",)]
    assert rows(access.allowed_columns(sens, "t", []), "column_name") == [("p",)]


def test_permitted_fields_keep_order_and_fall_back(spark):
    sets = access.field_set_rows(spark, {"account_identity": ["a", "b"], "other": ["z", "a", "y"]})
    sens = spark.createDataFrame(
        [("s", "a", "PUBLIC", None), ("s", "z", "RESTRICTED", ["boss"]), ("s", "b", "RESTRICTED", ["boss"])],
        "table_name string, column_name string, classification string, access_roles array<string>",
    )
    grants = spark.createDataFrame([(1, "boss"), (2, "clerk")], "user_id int, role string")
    asked = spark.createDataFrame([(10, 1, "other"), (11, 2, "other"), (12, 1, "?")], "request_id int, user_id int, category string")
    got = access.permitted_fields(asked, sets, sens, grants, "s")
    assert rows(got, "request_id", "position", "field") == [(10, 0, "z"), (10, 1, "a"), (11, 1, "a"), (12, 0, "a"), (12, 1, "b")]
    surface = spark.createDataFrame([(1, 2, 3)], "a int, b int, z int")
    assert access.project_surface(surface, got.filter("request_id = 10")).columns == ["z", "a"]


def lineage(spark, edges):
    data = [("t", a, "t", b, None if b != "src" else "erp", "direct_copy", "p", "1") for a, b in edges]
    return spark.createDataFrame(
        data,
        "target_table string, target_column string, source_table string, source_column string, source_system string, "
        "transform_type string, transform_pipeline string, pipeline_version string",
    )


def test_lineage_counts_every_path_and_stops_at_the_limit(spark):
    target = spark.createDataFrame([("t", "a")], "target_table string, target_column string")
    diamond = lineage(spark, [("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("d", "src")])
    got = rows(governance.lineage_trace(diamond, target), "depth", "source_field", "node_type", "paths", "cut")
    assert (3, "t.src", "OPERATIONAL SOURCE", 2, False) in got
    assert [g[3] for g in got if g[:2] == (2, "t.d")] == [1, 1]
    assert sum(g[3] for g in got) == 6
    loop = lineage(spark, [("a", "b"), ("b", "a")])
    depths = rows(governance.lineage_trace(loop, target), "depth", "cut")
    assert depths == [(d, d == 10) for d in range(1, 11)]
    down = spark.createDataFrame([("t", "src")], "source_table string, source_column string")
    assert len(rows(governance.lineage_trace(diamond, down, direction="down"), "depth")) == 5


def test_succession_edges(spark):
    own = spark.createDataFrame(
        [("t", "a", None, None), ("t", "b", "x", dt.date(2024, 1, 31)), ("t", "c", "x", dt.date(2024, 2, 29)), ("t", "d", "x", None), ("dev", "e", None, None)],
        "table_name string, column_name string, successor_role string, succession_reviewed_at date",
    ).selectExpr("*", "'r' AS steward_role", "'n' AS steward_name")
    manifest = spark.createDataFrame([("t", "prod"), ("t", "prod"), ("dev", "dev")], "table_name string, environment string")
    got = dict(rows(governance.succession_health(own, manifest, "2024-08-31"), "column_name", "succession_status"))
    assert got == {"a": "NO_SUCCESSION_PLAN", "b": "SUCCESSION_PLAN_STALE", "c": "OK", "d": "OK"}


SPEC = {
    "id": "c",
    "version": "1",
    "schema": {"columns": [{"name": "k", "nullable": False}, {"name": "v", "valid_values": ["x", "y"]}]},
    "quality": [{"column": "v", "max_null_rate": 0.25}, {"column": "n", "value_range": {"min": 0, "max": 10}}, {}],
}


def test_contract(spark):
    good = spark.createDataFrame([("a", "x", 0), ("b", "y", 10), ("c", None, None), ("d", "x", 5)], "k string, v string, n int")
    assert all(r["passed"] for r in contracts.check_contract(good, SPEC).collect())
    contracts.enforce_contract(good, SPEC)
    bad = spark.createDataFrame([(None, "z", 11), ("b", None, -1), ("c", None, 3)], "k string, v string, n int")
    failed = rows(contracts.check_contract(bad, SPEC).filter("NOT passed"), "rule", "column", "evaluated", "failed")
    assert failed == [("not_null", "k", 3, 1), ("null_rate", "v", 3, 2), ("value_in_set", "v", 1, 1), ("value_range", "n", 3, 2)]
    with pytest.raises(contracts.ContractViolation, match="not_null"):
        contracts.enforce_contract(bad, SPEC)
    accepted, rejected = contracts.quarantine(bad, SPEC)
    assert rows(accepted, "k") == [("c",)]
    assert sorted(r["reject_reasons"] for r in rejected.collect()) == [["not_null:k", "value_in_set:v", "value_range:n"], ["value_range:n"]]


def test_contract_on_nothing(spark):
    empty = spark.createDataFrame([], "k string, v string, n int")
    assert all(r["passed"] for r in contracts.check_contract(empty, SPEC).collect())
    none = contracts.validate_column(empty.selectExpr("*", "CAST(NULL AS DATE) AS valid_to"), "v", ["x"]).first()
    assert (none["total_rows"], none["null_rate_pct"]) == (0, None)
    assert contracts.check_contract(empty, {"schema": {"columns": []}}).isEmpty()


def test_drift_edges(spark):
    day = dt.date(2024, 1, 31)
    old = [(dt.date(2024, 1, 1), c) for c in ["a"] * 50 + ["b"] * 45 + [None] * 5] + [(dt.date(2023, 12, 31), "zz")] * 40
    new = [(day, c) for c in ["a"] * 55 + ["b"] * 42 + [None] * 3]
    make = lambda data: spark.createDataFrame(data, "snapshot_date date, v string").selectExpr("*", "CAST(NULL AS DATE) AS valid_to")
    got = contracts.category_drift(make(old + new), make(new), "v", day).collect()
    table = {(r["v"], r["pct_30d"], r["pct_today"]): r["drift_status"] for r in got}
    assert table == {
        ("a", 50.0, 55.0): "WARN: MODERATE_DRIFT",
        ("b", 45.0, 42.0): "WARN: MODERATE_DRIFT",
        (None, 5.0, None): "WARN: MODERATE_DRIFT",
        (None, None, 3.0): "WARN: MODERATE_DRIFT",
    }


def test_declared_tables(spark):
    for name, table in TABLES.items():
        empty = spark.createDataFrame([], table["ddl"])
        named = [*table["not_null"], *table["enums"], *[c for key in table["unique"] for c in key]]
        assert set(named) <= set(empty.columns), name
        assert {r["violations"] for r in contracts.check_schema(empty, table).collect()} == {0}
    df = spark.createDataFrame([(1, "x"), (1, "y"), (1, None), (None, "z"), (None, "z")], "k int, e string")
    got = rows(contracts.check_schema(df, {"unique": [["k"]], "not_null": ["k"], "enums": {"e": ["x", "y"]}}), "check", "violations")
    assert got == [("ENUM", 2), ("NOT_NULL", 2), ("UNIQUE", 2)]


@pytest.mark.parametrize(("hours", "status"), [(24, "OK"), (25, "WARNING: APPROACHING_SLA"), (30, "WARNING: APPROACHING_SLA"), (31, "VIOLATION: EXCEEDS_SLA"), (100, "VIOLATION: EXCEEDS_SLA")])
def test_freshness_is_true_elapsed_time(spark, hours, status):
    df = spark.createDataFrame([(D(2024, 1, 1), None), (D(2025, 1, 1), dt.date(2024, 1, 1))], "updated_at timestamp_ntz, valid_to date")
    got = observability.freshness_status(df, D(2024, 1, 1) + dt.timedelta(hours=hours)).first()
    assert (got["hours_since_update"], got["freshness_status"]) == (hours, status)


def test_lag_of_nothing(spark):
    empty = spark.createDataFrame([], "updated_at timestamp_ntz, valid_to date")
    lag = observability.freshness_lag(empty, "2024-01-01")
    assert lag.first()["pct_beyond_sla"] is None
    assert observability.freshness_alert(lag).first()["severity"] == "OK"


@pytest.mark.parametrize(("pct", "want"), [(5.0, ("OK", False)), (5.01, ("P2", False)), (20.0, ("P2", False)), (20.01, ("P1", True))])
def test_alert_edges(spark, pct, want):
    lag = spark.createDataFrame([("t", pct)], "surface_table string, pct_beyond_sla double")
    got = observability.freshness_alert(lag).first()
    assert (got["severity"], got["trip_breaker"]) == want


@pytest.mark.parametrize(("surface", "gate"), [(9950, "PASS"), (9949, "WARN"), (9500, "WARN"), (9499, "FAIL"), (10001, "PASS")])
def test_completeness_edges(spark, surface, gate):
    legacy = spark.range(10000).selectExpr("'active' AS status").union(spark.sql("SELECT 'deleted' UNION ALL SELECT NULL"))
    df = spark.range(surface).selectExpr("CAST(NULL AS DATE) AS valid_to")
    got = migration.completeness_gate(legacy, df).first()
    assert got["completeness_gate"].startswith(gate)
    assert got["missing_entity_count"] == 10000 - surface


def test_phase_gates(spark):
    gates = spark.createDataFrame([("p", 2, "second"), ("p", 1, "first")], "phase string, position int, requirement string")
    asked = spark.createDataFrame([("a", "p"), ("b", "p"), ("a", "?")], "surface string, phase string")
    ticks = spark.createDataFrame([("b", "first", True), ("b", "second", True), ("a", "first", None)], "surface string, requirement string, confirmed boolean")
    got = {(r["surface"], r["phase"]): (r["passed"], r["missing"]) for r in migration.phase_gates(asked, gates, ticks).collect()}
    assert got == {("a", "p"): (False, ["first", "second"]), ("b", "p"): (True, []), ("a", "?"): (None, [])}


def test_triage_spreads_the_pairs_of_one_keyword(spark, monkeypatch):
    monkeypatch.setattr(migration, "ASKED_ROWS", 30)
    monkeypatch.setattr(migration, "HIT_ROWS", 7)
    asked = spark.range(300).selectExpr("nullif(id, 0) AS incident_id", "'de' AS keyword")
    hits = spark.range(40).selectExpr("id AS pattern_id", "if(id < 35, 'de', 'fr') AS keyword")
    pairs = migration._pairs_in_pieces(asked, hits, "incident_id", "pattern_id", pairs_per_task=500)
    tasks = [r["n"] for r in pairs.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(tasks) == 300 * 35 == pairs.distinct().count() and max(tasks) < 2_500


def test_triage(spark):
    patterns = spark.createDataFrame(
        [("1", "One", "Temporal failure", "no Change detection", [1, 2], "f"), ("2", "Two", "Access", "stale", [2], "g")],
        "pattern_id string, title string, failure_mode string, root_cause string, tags array<int>, key_fix string",
    )
    cases = [("a", ["CHANGE"]), ("b", []), ("c", [""]), ("d", ["title", "One"]), ("e", ["e"]), ("f", ["lure no"]), ("g", ["al"])]
    incidents = spark.createDataFrame(cases, "incident_id string, keywords array<string>")
    got = rows(migration.triage(incidents, patterns), "incident_id", "pattern_id")
    assert got == [("a", "1"), ("c", "1"), ("c", "2"), ("e", "1"), ("e", "2"), ("f", "1"), ("g", "1"), ("g", "2")]
    assert rows(migration.patterns_for(patterns, 1), "pattern_id") == [("1",)]


@pytest.mark.parametrize("sizes", [(1_000_000, 16_000_000), (40, 60)])
def test_keywords_are_searched_in_batches(spark, sizes):
    import random

    rng = random.Random(4)
    texts = ["".join(rng.choices("abc \u00e9\U0001f600", k=rng.randrange(30))) for _ in range(40)] + [None, ""]
    words = sorted({"".join(rng.choices("abc \u00e9\U0001f600", k=rng.randrange(4))) for _ in range(60)}) + [None, "a"]
    got = migration.keyword_hits(
        spark.createDataFrame([(w,) for w in words], "keyword string"),
        spark.createDataFrame(list(enumerate(texts)), "id int, _text string"),
        "id",
        *sizes,
    )
    want = {(w, i) for w in words if w is not None for i, t in enumerate(texts) if t is not None and w in t}
    pairs = [(r["keyword"], r["id"]) for r in got.collect()]
    assert set(pairs) == want and len(pairs) == len(want)
    none = spark.createDataFrame([], "keyword string")
    assert migration.keyword_hits(none, spark.createDataFrame([(1, "a")], "id int, _text string"), "id").count() == 0


def test_surface_building(spark):
    df = spark.createDataFrame([("1", "O"), ("9", None)], "tp_cd string, stat string")
    with pytest.raises(ValueError, match="cr_lmt"):
        etl.rename_columns(df)
    renamed = etl.rename_columns(df, strict=False)
    assert renamed.columns == ["account_type", "account_status"]
    vocab = {"account_type": {"1": "Enterprise"}, "account_status": {"O": "open"}, "absent": {"x": "y"}}
    done = etl.canonicalise(renamed, vocab)
    assert rows(done, "account_type") == [("9",), ("Enterprise",)]
    assert rows(etl.vocab_violations(done, vocab), "field", "values", "violations") == [("account_status", 1, 0), ("account_type", 2, 1)]


def test_change_classes(spark):
    schema = "contract_id string, column_name string, data_type string, nullable boolean, valid_values array<string>"
    old = spark.createDataFrame([("m", "a", "int", True, None), ("n", "a", "string", True, ["x"]), ("p", "a", "int", True, None), ("q", "a", "int", False, None)], schema)
    new = spark.createDataFrame([("m", "b", "int", True, None), ("n", "a", "string", True, ["x", "y"]), ("p", "a", "int", False, None), ("q", "a", "int", False, None)], schema)
    got = rows(contracts.classify_change(old, new), "contract_id", "change_class", "notice_days", "dual_publish", "migration_window_days_min")
    assert got == [("m", "major", 60, True, 30), ("n", "minor", 7, False, 0), ("p", "patch", 1, False, 0)]


def test_percentages_of_very_large_rises(spark):
    df = spark.createDataFrame([(1, 200_000_000), (3, 8), (0, 5)], "old long, new long")
    got = [r[0] for r in df.select(percent(F.col("new"), F.col("old"))).collect()]
    assert got == [20_000_000_000.0, 266.67, None]
