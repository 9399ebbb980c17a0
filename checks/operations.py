"""Contracts, monitoring, surface building, migration."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks.registry import case, pct, rounded
from checks.samples import c, ntz, text
from factloom.operators import contracts, etl, migration, observability, publishing
from factloom.operators.breaker import breaker_states
from factloom.sources import catalog
from factloom.sources.surface import write_surface

SEGMENTS = ["BUILDING", "MACHINERY", "HOUSEHOLD"]
CONTRACT = {
    "id": "account_ai_surface",
    "version": "2.1.0",
    "schema": {
        "columns": [
            {"name": "account_id", "nullable": False},
            {"name": "account_type", "valid_values": [*SEGMENTS, "FURNITURE"]},
            {"name": "status", "nullable": False, "valid_values": ["active", "deleted"]},
        ]
    },
    "quality": [
        {"column": "account_type", "max_null_rate": 0.05},
        {"column": "adjusted_balance_usd", "value_range": {"min": -500, "max": 9000}},
    ],
}


@case(
    "q01_validate_column",
    "acc",
    f"""SELECT 'account_type' AS column_name, total - known AS null_count, known - allowed AS invalid_value_count, total AS total_rows,
    {pct("total - known", "total")} AS null_rate_pct
    FROM (SELECT COUNT(*) AS total, COUNT(account_type) AS known, COUNT(*) FILTER (list_contains({SEGMENTS}, account_type)) AS allowed
      FROM acc WHERE valid_to IS NULL)""",
)
def _(s):
    return contracts.validate_column(s.acc, "account_type", SEGMENTS)


def _rule(rule: str, column: str, evaluated: str, failed: str, limit: float) -> str:
    return f"""SELECT '{rule}' AS rule, '{column}' AS "column", {evaluated} AS evaluated, {failed} AS failed,
    COALESCE(CAST({failed} AS DOUBLE) / NULLIF({evaluated}, 0), 0) AS observed, {limit}::DOUBLE AS "limit",
    COALESCE(CAST({failed} AS DOUBLE) / NULLIF({evaluated}, 0), 0) <= {limit} AS passed FROM acc"""


@case(
    "q02_check_contract",
    "acc",
    " UNION ALL ".join(
        [
            _rule("not_null", "account_id", "COUNT(*)", "COUNT(*) - COUNT(account_id)", 0),
            _rule("value_in_set", "account_type", "COUNT(account_type)", "COUNT(*) FILTER (WHERE account_type = 'AUTOMOBILE')", 0),
            _rule("not_null", "status", "COUNT(*)", "COUNT(*) - COUNT(status)", 0),
            _rule("value_in_set", "status", "COUNT(status)", "COUNT(*) FILTER (WHERE status NOT IN ('active', 'deleted'))", 0),
            _rule("null_rate", "account_type", "COUNT(*)", "COUNT(*) - COUNT(account_type)", 0.05),
            _rule("value_range", "adjusted_balance_usd", "COUNT(adjusted_balance_usd)", "COUNT(*) FILTER (WHERE adjusted_balance_usd < -500 OR adjusted_balance_usd > 9000)", 0),
        ]
    ),
)
def _(s):
    return contracts.check_contract(s.acc, CONTRACT)


BAD_ROW = """COALESCE(account_type = 'AUTOMOBILE', FALSE) OR status IS NULL OR adjusted_balance_usd < -500 OR adjusted_balance_usd > 9000"""


@case("q03_quarantine_accepted", "acc", f"SELECT account_id, account_type, status FROM acc WHERE NOT ({BAD_ROW})")
def _(s):
    return contracts.quarantine(s.acc, CONTRACT)[0].select("account_id", "account_type", "status")


@case(
    "q03_quarantine_rejected",
    "acc",
    f"""SELECT account_id, concat_ws(';', CASE WHEN account_type = 'AUTOMOBILE' THEN 'value_in_set:account_type' END,
    CASE WHEN status IS NULL THEN 'not_null:status' END,
    CASE WHEN adjusted_balance_usd < -500 OR adjusted_balance_usd > 9000 THEN 'value_range:adjusted_balance_usd' END) AS reasons FROM acc WHERE {BAD_ROW}""",
)
def _(s):
    rejected = contracts.quarantine(s.acc, CONTRACT)[1]
    return rejected.select("account_id", F.concat_ws(";", "reject_reasons").alias("reasons"))


@case(
    "q04_category_drift",
    "hist",
    f"""SELECT account_type, pct_30d, pct_today, drift_pct,
    ['OK', 'WARN: MODERATE_DRIFT', 'ALERT: SIGNIFICANT_DRIFT'][1 + (drift_pct > 2)::INT + (drift_pct > 5)::INT] AS drift_status
    FROM (SELECT *, ROUND(ABS(COALESCE(pct_today, 0) - COALESCE(pct_30d, 0)), 2) AS drift_pct
      FROM (SELECT account_type, {pct("NULLIF(n30, 0)", "SUM(n30) OVER ()")} AS pct_30d, {pct("NULLIF(n1, 0)", "SUM(n1) OVER ()")} AS pct_today
        FROM (SELECT account_type, COUNT(*) FILTER (days BETWEEN 1 AND 30) AS n30, COUNT(*) FILTER (days = 0) AS n1
          FROM (SELECT account_type, DATE '2024-01-30' - snapshot_date AS days FROM hist)
          GROUP BY account_type, IF(account_type IS NULL, days = 0, NULL))  -- an unknown category matches no other
        WHERE n30 + n1 > 0))""",
)
def _(s):
    today = s.hist.filter(c("snapshot_date") == F.lit("2024-01-30").cast("date"))
    return contracts.category_drift(s.hist, today, "account_type", "2024-01-30")


BREAKER = (
    """SELECT contract_id, run_id, "at", CASE WHEN ok THEN 'pass' ELSE 'fail' END AS result,
    CASE st WHEN 0 THEN 'closed' WHEN 1 THEN 'open' ELSE 'half_open' END AS state, f AS failure_count, CAST(p AS INTEGER) AS pass_count,
    allowed, NOT ok AND f >= 1 AS notified FROM walk""",
    """seq AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY contract_id ORDER BY "at", run_id) AS n FROM runs),
    walk AS (SELECT contract_id, run_id, "at", ok, n, CASE WHEN ok THEN 0 ELSE 1 END AS st, CAST(CASE WHEN ok THEN 0 ELSE 1 END AS BIGINT) AS f, 0 AS p,
      TRUE AS allowed, CASE WHEN NOT ok THEN "at" END AS lf FROM seq WHERE n = 1
    UNION ALL SELECT s.contract_id, s.run_id, s."at", s.ok, s.n,
      CASE WHEN NOT s.ok THEN 1 WHEN r = 2 AND rp + 1 >= 3 THEN 0 ELSE r END,
      CASE WHEN NOT s.ok THEN f + 1 WHEN r = 0 THEN 0 ELSE f END,
      CASE WHEN s.ok AND r = 2 THEN rp + 1 ELSE rp END, r <> 1, CASE WHEN NOT s.ok THEN s."at" ELSE lf END
    FROM (SELECT w.*, x."at" AS nat, CASE WHEN w.st = 1 AND x."at" - w.lf > INTERVAL 60 MINUTE THEN 2 ELSE w.st END AS r,
      CASE WHEN w.st = 1 AND x."at" - w.lf > INTERVAL 60 MINUTE THEN 0 ELSE w.p END AS rp
      FROM walk w JOIN seq x ON x.contract_id = w.contract_id AND x.n = w.n + 1) w
    JOIN seq s ON s.contract_id = w.contract_id AND s.n = w.n + 1)""",
)


@case("q05_breaker_states", "runs", BREAKER[0], recursive=BREAKER[1])
def _(s):
    return breaker_states(s.runs).drop("last_failure_micros")


@case("q06_gated_write", "acc", "SELECT account_id, account_type, adjusted_balance_usd FROM acc WHERE status IS NOT NULL")
def _(s):
    """A run that meets the contract is published; the next one fails and leaves it in place."""
    root = s.folder()
    spec = {"id": "accounts", "version": "1", "schema": {"columns": [{"name": "status", "nullable": False}]}}
    publishing.gated_write(s.acc.filter(c("status").isNotNull()), spec, root, dt.datetime(2024, 1, 1, 8))
    publishing.gated_write(s.acc, spec, root, dt.datetime(2024, 1, 1, 9))
    return publishing.current_surface(s.spark, root).select("account_id", "account_type", "adjusted_balance_usd")


@case(
    "q07_check_schema",
    "",
    """SELECT 'NOT_NULL' AS "check", 'l_partkey' AS columns, COUNT(*) - COUNT(l_partkey) AS violations FROM lineitem
    UNION ALL SELECT 'ENUM', 'l_returnflag', COUNT(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')) FROM lineitem
    UNION ALL SELECT 'UNIQUE', 'l_orderkey,l_linenumber', COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem""",
)
def _(s):
    spec = {
        "unique": [["l_orderkey", "l_linenumber"]],
        "not_null": ["l_partkey"],
        "enums": {"l_returnflag": ["A", "N"]},
    }
    return contracts.check_schema(s.t("lineitem"), spec)


def _contract_columns(s):
    size = c("p_size")
    values = F.when(size >= 40, F.array(F.lit("a"), F.lit("b")))
    base = [c("p_brand").alias("contract_id"), text("c", c("p_partkey")).alias("column_name")]
    old = s.t("part").select(
        *base,
        F.when(size <= 25, "string").otherwise("bigint").alias("data_type"),
        (size % 2 == 0).alias("nullable"),
        values.alias("valid_values"),
    )
    kept = s.t("part").filter(size > 2).select(
        *base,
        F.when(size <= 24, "string").otherwise("bigint").alias("data_type"),
        ((size % 2 == 0) & (size != 30)).alias("nullable"),
        F.when(size == 45, F.array(F.lit("a"), F.lit("b"), F.lit("c"))).otherwise(values).alias("valid_values"),
    )
    added = s.t("part").filter(c("p_type") == "PROMO").select(
        c("p_brand").alias("contract_id"),
        text("n", c("p_partkey")).alias("column_name"),
        F.lit("string").alias("data_type"),
        (size > 3).alias("nullable"),
        F.lit(None).cast("array<string>").alias("valid_values"),
    )
    return old, kept.unionByName(added)


CHANGES = """SELECT p_brand AS contract_id, 'c' || p_partkey AS column_name, CASE WHEN p_size <= 2 THEN 'COLUMN_REMOVED'
    WHEN p_size = 25 THEN 'TYPE_CHANGED' WHEN p_size = 45 THEN 'VALUE_ADDED' WHEN p_size = 30 THEN 'NULLS_RULED_OUT' END AS change,
    CASE WHEN p_size <= 2 OR p_size = 25 THEN 'major' WHEN p_size = 45 THEN 'minor' ELSE 'patch' END AS change_class
    FROM part WHERE p_size <= 2 OR p_size IN (25, 30, 45)
    UNION ALL SELECT p_brand, 'n' || p_partkey, CASE WHEN p_size > 3 THEN 'OPTIONAL_COLUMN_ADDED' ELSE 'REQUIRED_COLUMN_ADDED' END,
    CASE WHEN p_size > 3 THEN 'minor' ELSE 'major' END FROM part WHERE p_type = 'PROMO'"""


@case("q08_column_changes", "", CHANGES)
def _(s):
    return contracts.column_changes(*_contract_columns(s))


@case(
    "q08_classify_change",
    "",
    f"""SELECT contract_id, CASE r WHEN 2 THEN 'major' WHEN 1 THEN 'minor' ELSE 'patch' END AS change_class, changed_columns,
    CASE r WHEN 2 THEN 60 WHEN 1 THEN 7 ELSE 1 END AS notice_days, r = 2 AS dual_publish, CASE r WHEN 2 THEN 30 ELSE 0 END AS migration_window_days_min
    FROM (SELECT contract_id, MAX(CASE change_class WHEN 'major' THEN 2 WHEN 'minor' THEN 1 ELSE 0 END) AS r, COUNT(*) AS changed_columns
    FROM ({CHANGES}) GROUP BY contract_id)""",
)
def _(s):
    return contracts.classify_change(*_contract_columns(s))


@case(
    "q09_lineage_expectations",
    "acc",
    """SELECT source_column, 'mart' AS target_table, source_column AS target_column, expected_type, expected_null_rate, observed_type, observed_null_rate,
    CASE WHEN observed_type IS NULL THEN 'COLUMN_MISSING' WHEN observed_type <> expected_type THEN 'TYPE_DIFFERS'
    WHEN observed_null_rate > expected_null_rate THEN 'TOO_MANY_NULLS' ELSE 'OK' END AS status
    FROM (VALUES ('account_id', 'bigint', 0.0), ('account_type', 'string', 0.01), ('status', 'string', 0.9), ('account_name', 'bigint', 0.5), ('lost', 'string', 0.5))
      AS e(source_column, expected_type, expected_null_rate)
    LEFT JOIN (SELECT 'account_id' AS n, 'bigint' AS observed_type, (COUNT(*) - COUNT(account_id)) / COUNT(*)::DOUBLE AS observed_null_rate FROM acc
      UNION ALL SELECT 'account_type', 'string', (COUNT(*) - COUNT(account_type)) / COUNT(*)::DOUBLE FROM acc
      UNION ALL SELECT 'status', 'string', (COUNT(*) - COUNT(status)) / COUNT(*)::DOUBLE FROM acc
      UNION ALL SELECT 'account_name', 'string', (COUNT(*) - COUNT(account_name)) / COUNT(*)::DOUBLE FROM acc) ON n = source_column""",
)
def _(s):
    expected = [
        ("account_id", "bigint", 0.0),
        ("account_type", "string", 0.01),
        ("status", "string", 0.9),
        ("account_name", "bigint", 0.5),
        ("lost", "string", 0.5),
    ]
    lineage = s.spark.createDataFrame(
        [("accounts", n, "mart", n, kind, rate) for n, kind, rate in expected],
        "source_table string, source_column string, target_table string, target_column string, "
        "expected_source_type string, expected_null_rate double",
    )
    return contracts.lineage_expectations(s.acc, lineage, "accounts")


LATE = "2001-08-03 06:00:00"


@case(
    "o01_freshness_status",
    "acc",
    f"""SELECT 'account_ai_surface' AS table_name, u AS last_updated, {rounded("h", 4)} AS hours_since_update, 30 AS freshness_sla_hours,
    CASE WHEN h > 30 THEN 'VIOLATION: EXCEEDS_SLA' WHEN h > 24 THEN 'WARNING: APPROACHING_SLA' ELSE 'OK' END AS freshness_status
    FROM (SELECT MAX(updated_at) AS u, (epoch_us(TIMESTAMP '{LATE}') - epoch_us(MAX(updated_at))) / 3600000000.0::DOUBLE AS h FROM acc WHERE valid_to IS NULL)""",
)
def _(s):
    return observability.freshness_status(s.acc, LATE)


LAG = f"""SELECT 'account_ai_surface' AS surface_table, COUNT(*) AS total_entities, {rounded("AVG(m)", 4)} AS mean_lag_minutes,
    {rounded("MAX(m)", 4)} AS max_lag_minutes, 1800 AS sla_minutes, COUNT(*) FILTER (WHERE m > 1800) AS entities_beyond_sla,
    {pct("COUNT(*) FILTER (WHERE m > 1800)", "COUNT(*)")} AS pct_beyond_sla
    FROM (SELECT (epoch_us(TIMESTAMP '{LATE}') - epoch_us(updated_at)) / 60000000.0::DOUBLE AS m FROM acc WHERE valid_to IS NULL)"""


@case("o02_freshness_lag", "acc", LAG)
def _(s):
    return observability.freshness_lag(s.acc, LATE)


@case(
    "o03_freshness_alert",
    "acc",
    f"""SELECT surface_table, pct_beyond_sla, CASE WHEN pct_beyond_sla > 20 THEN 'P1' WHEN pct_beyond_sla > 5 THEN 'P2' ELSE 'OK' END AS severity,
    pct_beyond_sla > 20 AS trip_breaker FROM ({LAG})""",
)
def _(s):
    return observability.freshness_alert(observability.freshness_lag(s.acc, LATE))


def _rules_sql() -> str:
    return ", ".join(f"('{m}', '{d}', {x}::DOUBLE, '{p}', '{a}')" for m, d, x, p, a in observability.ALERT_RULES)


@case(
    "o06_evaluate_alerts",
    "",
    f"""SELECT table_name, m.metric, dimension, value, r.lim AS "limit", severity, action, as_of
    FROM (SELECT c_name AS table_name, CASE c_mktsegment WHEN 'BUILDING' THEN 'row_count_drop_pct' WHEN 'MACHINERY' THEN 'failed_reembed_pct'
      WHEN 'HOUSEHOLD' THEN 'orphan_relationships' WHEN 'FURNITURE' THEN 'category_shift_pct' ELSE 'unknown_metric' END AS metric,
      c_acctbal / 500.0::DOUBLE AS value, DATE '2024-01-01' AS as_of FROM customer) m
    JOIN (VALUES {_rules_sql()}) AS r(metric, dimension, lim, severity, action) ON r.metric = m.metric WHERE value > r.lim""",
    as_text="as_of",
)
def _(s):
    names = {
        "BUILDING": "row_count_drop_pct",
        "MACHINERY": "failed_reembed_pct",
        "HOUSEHOLD": "orphan_relationships",
        "FURNITURE": "category_shift_pct",
    }
    metric = F.coalesce(
        F.try_element_at(F.create_map(*[F.lit(x) for p in names.items() for x in p]), c("c_mktsegment")),
        F.lit("unknown_metric"),
    )
    metrics = s.t("customer").select(
        c("c_name").alias("table_name"),
        metric.alias("metric"),
        (c("c_acctbal") / 500.0).alias("value"),
        F.lit("2024-01-01").cast("date").alias("as_of"),
    )
    return observability.evaluate_alerts(metrics, observability.alert_rules(s.spark))


@case(
    "o07_cadence_breach",
    "",
    f"""SELECT * FROM (SELECT 'C' || c_custkey AS table_name, u AS last_updated,
    CASE c_mktsegment WHEN 'BUILDING' THEN 24 WHEN 'MACHINERY' THEN 168 WHEN 'HOUSEHOLD' THEN 720 WHEN 'FURNITURE' THEN 1 END::DOUBLE AS cadence_hours,
    {rounded(f"(epoch_us(TIMESTAMP '{LATE}') - epoch_us(u)) / 3600000000.0::DOUBLE", 4)} AS age_hours
    FROM customer JOIN (SELECT o_custkey, MAX(o_orderdate) AS u FROM orders GROUP BY 1) ON o_custkey = c_custkey) WHERE age_hours > cadence_hours * 2""",
)
def _(s):
    freq = (
        F.when(c("c_mktsegment") == "BUILDING", "daily")
        .when(c("c_mktsegment") == "MACHINERY", "Weekly")
        .when(c("c_mktsegment") == "HOUSEHOLD", "monthly")
        .when(c("c_mktsegment") == "FURNITURE", "hourly")
        .otherwise("on demand")
    )
    lineage = s.t("customer").select(text("C", c("c_custkey")).alias("source_table"), freq.alias("expected_update_freq"))
    tables = (
        s.t("orders")
        .groupBy(text("C", c("o_custkey")).alias("table_name"))
        .agg(F.max("o_orderdate").alias("last_updated"))
    )
    return observability.cadence_breach(tables, lineage, LATE)


@case(
    "o08_index_staleness",
    "index_docs source_docs",
    f"""SELECT *, mismatch_pct > 5 AS breach FROM (SELECT i.source_table, COUNT(*) AS indexed,
    COUNT(*) FILTER (WHERE source_version IS DISTINCT FROM updated_at) AS mismatched,
    {pct("COUNT(*) FILTER (WHERE source_version IS DISTINCT FROM updated_at)", "COUNT(*)")} AS mismatch_pct
    FROM index_docs i JOIN source_docs d ON d.source_record_id = i.source_record_id GROUP BY i.source_table)""",
)
def _(s):
    return observability.index_staleness(s.index_docs, s.source_docs, "source_record_id", "source_table")


@case(
    "o09_duplicate_rate",
    "",
    f"""SELECT *, COALESCE(change_points > 2, FALSE) AS breach FROM (SELECT *, ROUND(duplicate_pct - LAG(duplicate_pct) OVER (ORDER BY week), 2) AS change_points FROM (
    SELECT CAST(date_trunc('week', ts) AS DATE) AS week, COUNT(*) AS rows, COUNT(DISTINCT (user_id, event_type)) AS distinct_entities,
    {pct("COUNT(*) - COUNT(DISTINCT (user_id, event_type))", "COUNT(*)")} AS duplicate_pct FROM events GROUP BY 1))""",
    as_text="week",
)
def _(s):
    return observability.duplicate_rate(s.t("events"), ["user_id", "event_type"], "ts")


@case(
    "o10_volume_drop",
    "hist",
    f"""SELECT snapshot_date, row_count, previous_count, {pct("previous_count - row_count", "previous_count")} AS drop_pct,
    COALESCE({pct("previous_count - row_count", "previous_count")} > 5, FALSE) AS breach
    FROM (SELECT *, LAG(row_count) OVER (ORDER BY snapshot_date) AS previous_count FROM (SELECT snapshot_date, COUNT(*) AS row_count FROM hist GROUP BY 1))""",
    as_text="snapshot_date previous_count",
)
def _(s):
    return observability.volume_drop(s.hist)


TREND = ["1996-01-01", "1998-01-01", "2000-01-01", "2001-11-10"]


@case(
    "o11_vertex_trend",
    "rels",
    """SELECT as_of, vertex_count, vertex_count - before AS change, COALESCE(vertex_count < before, FALSE) AS breach
    FROM (SELECT as_of, COUNT(DISTINCT v) AS vertex_count, LAG(COUNT(DISTINCT v)) OVER (ORDER BY as_of) AS before
      FROM (SELECT UNNEST([subject_id, object_id]) AS v, valid_from, valid_to FROM rels)
      JOIN (VALUES (DATE '1996-01-01'), (DATE '1998-01-01'), (DATE '2000-01-01'), (DATE '2001-11-10')) d(as_of)
      ON valid_from <= as_of AND COALESCE(valid_to > as_of, TRUE) GROUP BY as_of)""",
    as_text="as_of change",
)
def _(s):
    edges = s.rels.select(c("subject_id").alias("src"), c("object_id").alias("dst"), "valid_from", "valid_to")
    return observability.vertex_trend(edges, TREND)


@case(
    "o12_reconcile",
    "index_docs source_docs",
    """SELECT CASE WHEN i IS NULL THEN 'MISSING_FROM_INDEX' WHEN n IS NULL THEN 'NOT_IN_SOURCE' WHEN i <> n THEN 'COUNT_DIFFERS' ELSE 'MATCHED' END AS status,
    COUNT(*) AS id_count, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS source_rows, CAST(COALESCE(SUM(i), 0) AS BIGINT) AS index_rows
    FROM (SELECT source_record_id, COUNT(*) AS n FROM source_docs GROUP BY 1) FULL OUTER JOIN (SELECT source_record_id, COUNT(*) AS i FROM index_docs GROUP BY 1)
    USING (source_record_id) GROUP BY 1""",
)
def _(s):
    return observability.reconcile(s.source_docs, s.index_docs, "source_record_id")


@case(
    "o13_reembed_failure_rate",
    "",
    f"""SELECT *, failure_pct > 1 AS breach FROM (SELECT user_id, COUNT(*) AS attempts, COUNT(*) FILTER (WHERE value < 1) AS failures,
    {pct("COUNT(*) FILTER (WHERE value < 1)", "COUNT(*)")} AS failure_pct FROM events GROUP BY user_id)""",
)
def _(s):
    return observability.reembed_failure_rate(s.t("events").withColumn("succeeded", c("value") >= 1), "user_id")


@case(
    "o14_stale_chunks",
    "index_docs source_docs",
    """SELECT chunk_id, i.source_record_id, CASE WHEN d.source_record_id IS NULL THEN 'SOURCE_GONE' ELSE 'SOURCE_CHANGED' END AS reason
    FROM index_docs i LEFT JOIN source_docs d ON d.source_record_id = i.source_record_id
    WHERE d.source_record_id IS NULL OR d.content_hash IS DISTINCT FROM i.content_hash""",
)
def _(s):
    return observability.stale_chunks(s.index_docs, s.source_docs)


def _denormalised(s):
    accounts, types, customers = s.ops
    return etl.denormalise(accounts, [(types, "account_type_code"), (customers, "customer_id")])


RENAMED = """account_id, account_type_code, customer_id, stat AS account_status, cr_lmt AS credit_limit_usd, adj_bal AS adjusted_balance_usd,
    flg_prm AS is_premium_account, flg_rev AS is_under_manual_review, src_sys AS source_system, lst_txn_dt AS last_transaction_date,
    tp_cd AS account_type, customer_name, customer_industry"""
VOCAB = {
    "account_status": {"O": "open", "F": "fulfilled"},
    "account_type": {"1": "urgent", "2": "high", "3": "medium", "5": "low"},
}


@case("e01_denormalise", "ops", "SELECT * FROM ops")
def _(s):
    return _denormalised(s)


@case("e02_rename_columns", "ops", f"SELECT {RENAMED} FROM ops")
def _(s):
    return etl.rename_columns(_denormalised(s))


CANONICAL = f"""SELECT * REPLACE (CASE account_status WHEN 'O' THEN 'open' WHEN 'F' THEN 'fulfilled' ELSE account_status END AS account_status,
    CASE account_type WHEN '1' THEN 'urgent' WHEN '2' THEN 'high' WHEN '3' THEN 'medium' WHEN '5' THEN 'low' ELSE account_type END AS account_type)
    FROM (SELECT {RENAMED} FROM ops)"""


@case("e03_canonicalise", "ops", CANONICAL)
def _(s):
    return etl.canonicalise(etl.rename_columns(_denormalised(s)), VOCAB)


@case("e03_canonicalise_table", "ops", CANONICAL)
def _(s):
    rows = [(f, code, term) for f, m in VOCAB.items() for code, term in m.items()]
    vocab = s.spark.createDataFrame(rows, "field string, code string, term string")
    return etl.canonicalise(etl.rename_columns(_denormalised(s)), vocab, list(VOCAB))


@case(
    "e04_vocab_violations",
    "ops",
    f"""SELECT 'account_status' AS field, COUNT(stat) AS "values", COUNT(*) FILTER (WHERE stat = 'P') AS violations,
    {pct("COUNT(*) FILTER (WHERE stat = 'P')", "COUNT(stat)")} AS violation_pct FROM ops
    UNION ALL SELECT 'account_type', COUNT(tp_cd), COUNT(*) FILTER (WHERE tp_cd = '4'),
    {pct("COUNT(*) FILTER (WHERE tp_cd = '4')", "COUNT(tp_cd)")} FROM ops""",
)
def _(s):
    return etl.vocab_violations(etl.canonicalise(etl.rename_columns(_denormalised(s)), VOCAB), VOCAB)


@case("io4_write_surface", "acc", "SELECT account_id, account_type, adjusted_balance_usd, territory_code FROM acc")
def _(s):
    path = f"{s.folder()}/surface"
    rows = s.acc.select("account_id", "account_type", "adjusted_balance_usd", "territory_code")
    write_surface(rows, path, ["territory_code"])
    # A second write of some territories replaces only those.
    write_surface(rows.filter(c("territory_code") == "NATION_3"), path, ["territory_code"])
    return catalog.read_table(s.spark, path)


@case(
    "m01_schema_divergence",
    "lin lin_cols lin_manifest",
    """SELECT * FROM (SELECT l.source_table, l.source_column, CASE WHEN column_name IS NULL THEN 'MISSING: column no longer exists in legacy schema'
    WHEN data_type <> expected_source_type THEN 'TYPE_MISMATCH: expected ' || expected_source_type || ', found ' || data_type END AS divergence_status,
    target_table, target_column, transform_pipeline FROM lin l LEFT JOIN lin_cols c ON c.table_name = l.source_table AND c.column_name = l.source_column
    WHERE target_table IN (SELECT table_name FROM lin_manifest WHERE environment = 'prod')) WHERE divergence_status IS NOT NULL""",
)
def _(s):
    return migration.schema_divergence(s.lin, s.lin_cols, s.lin_manifest)


@case(
    "m02_completeness_gate",
    "acc",
    f"""SELECT 'account_ai_surface' AS surface_table, old AS legacy_entity_count, new AS surface_entity_count, share AS coverage_pct,
    old - new AS missing_entity_count, ['FAIL: migration incomplete; do not go live', 'WARN: investigate missing entities before go-live',
      'PASS'][1 + (share >= 95)::INT + (share >= 99.5)::INT] AS completeness_gate
    FROM (SELECT *, {pct("new", "old")} AS share
      FROM (SELECT COUNT(*) FILTER (status <> 'deleted') AS old, COUNT(*) FILTER (valid_to IS NULL) AS new FROM acc))""",
)
def _(s):
    return migration.completeness_gate(s.acc, s.acc)


@case(
    "m05_missing_entities",
    "acc",
    "SELECT account_id FROM acc WHERE status <> 'deleted' AND account_id NOT IN (SELECT account_id FROM acc WHERE valid_to IS NULL)",
)
def _(s):
    return migration.missing_entities(s.acc, s.acc, "account_id")


@case(
    "m03_phase_gates",
    "",
    """SELECT c_name AS surface, r_name AS phase, COUNT(*) FILTER (WHERE NOT ok) = 0 AS passed,
    COALESCE(string_agg(n_name, '|' ORDER BY n_nationkey) FILTER (WHERE NOT ok), '') AS missing
    FROM (SELECT c_name, r_name, g.n_nationkey, g.n_name, COALESCE(done, FALSE) AS ok FROM customer
      JOIN nation h ON h.n_nationkey = c_nationkey JOIN region ON r_regionkey = h.n_regionkey JOIN nation g ON g.n_regionkey = h.n_regionkey
      LEFT JOIN (SELECT o_custkey, o_orderkey % 25 AS req, bool_or(o_orderstatus = 'F') AS done FROM orders GROUP BY 1, 2) ON o_custkey = c_custkey AND req = g.n_nationkey)
    GROUP BY c_name, r_name""",
)
def _(s):
    nation = s.t("nation").join(s.t("region"), c("n_regionkey") == c("r_regionkey"))
    gates = nation.select(
        c("r_name").alias("phase"), c("n_nationkey").alias("position"), c("n_name").alias("requirement")
    )
    customer = s.t("customer")
    requests = customer.join(nation, c("c_nationkey") == c("n_nationkey")).select(
        c("c_name").alias("surface"), c("r_name").alias("phase")
    )
    checklist = (
        s.t("orders")
        .join(customer, c("o_custkey") == c("c_custkey"))
        .select(
            c("c_name").alias("surface"),
            text("NATION_", c("o_orderkey") % 25).alias("requirement"),
            (c("o_orderstatus") == "F").alias("confirmed"),
        )
    )
    found = migration.phase_gates(requests, gates, checklist)
    return found.select("surface", "phase", "passed", F.array_join("missing", "|").alias("missing"))


def _patterns(s):
    return s.t("benchmark").select(
        c("item_id").alias("pattern_id"),
        text("pattern ", c("item_id")).alias("title"),
        F.lit("drift").alias("failure_mode"),
        c("text").alias("root_cause"),
        F.array(c("item_id") % 7, c("item_id") % 5).alias("tags"),
        text("fix ", c("item_id")).alias("key_fix"),
    )


@case(
    "m04_triage",
    "",
    """SELECT DISTINCT page_id AS incident_id, item_id AS pattern_id, 'pattern ' || item_id AS title, 'fix ' || item_id AS key_fix
    FROM (SELECT page_id, UNNEST(string_split(regexp_replace(url, '[^A-Za-z]+', ' ', 'g'), ' ')) AS word FROM pages)
    JOIN benchmark ON word <> '' AND contains(lower('drift ' || text), lower(word))""",
)
def _(s):
    words = F.filter(F.split(F.regexp_replace("url", "[^A-Za-z]+", " "), " "), lambda w: w != "")
    incidents = s.t("pages").select(c("page_id").alias("incident_id"), words.alias("keywords"))
    return migration.triage(incidents, _patterns(s)).select("incident_id", "pattern_id", "title", "key_fix")


@case(
    "m04_patterns_for",
    "",
    "SELECT item_id AS pattern_id, 'pattern ' || item_id AS title, 'drift' AS failure_mode FROM benchmark WHERE item_id % 7 = 3 OR item_id % 5 = 3",
)
def _(s):
    return migration.patterns_for(_patterns(s), 3)
