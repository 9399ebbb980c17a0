"""Audits, confidence, provenance, versioned facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import case, rounded
from checks.samples import c, text
from factloom.functions.confidence import confidence_band, source_confidence
from factloom.operators import audits, confidence, context, temporal
from factloom.sources import catalog

NOW = "2001-08-02 12:30:00"
DAYS = f"trunc((epoch_us(TIMESTAMP '{NOW}') - epoch_us(asserted_at)) / 86400000000.0::DOUBLE)"
DECAYED = rounded(
    f"""confidence * CASE rate_of_change_class WHEN 'fast' THEN greatest(0.1::DOUBLE, 1.0::DOUBLE - {DAYS} / 30.0::DOUBLE)
    WHEN 'medium' THEN greatest(0.3::DOUBLE, 1.0::DOUBLE - {DAYS} / 365.0::DOUBLE)
    WHEN 'slow' THEN greatest(0.6::DOUBLE, 1.0::DOUBLE - {DAYS} / 1825.0::DOUBLE) ELSE 0.95::DOUBLE END"""
)


@case(
    "a01_audit_descriptions",
    "cat",
    """SELECT table_name, column_name, data_type, comment AS catalog_description,
    ['MISSING', 'TOO_SHORT', 'OK'][1 + (n > 0)::INT + (n >= 20)::INT] AS description_quality
    FROM (SELECT *, length(COALESCE(comment, '')) AS n FROM cat) WHERE table_schema = 'operational_db'""",
)
def _(s):
    return audits.audit_descriptions(s.cat, schema="operational_db")


@case(
    "a02_audit_abbreviations",
    "cat",
    """SELECT table_name, column_name, CAST(length(column_name) AS INTEGER) AS name_length,
    CASE WHEN length(column_name) <= 4 THEN 'LIKELY_ABBREVIATION'
    WHEN position('_' IN column_name) = 0 AND length(column_name) <= 8 THEN 'POSSIBLE_ABBREVIATION' ELSE 'OK' END AS naming_risk
    FROM cat WHERE table_schema = 'operational_db'""",
)
def _(s):
    return audits.audit_abbreviations(s.cat, schema="operational_db")


@case(
    "a03_audit_temporal",
    "cat",
    """SELECT table_name, ['NO_TEMPORAL_METADATA', 'OVERWRITE_PATTERN_ONLY', 'HAS_TEMPORAL_METADATA'][1 + greatest(
      2 * list_has_any(names, ['valid_from', 'valid_to', 'valid_time_start', 'valid_time_end'])::INT,
      list_has_any(names, ['updated_at', 'modified_at', 'last_modified'])::INT)] AS temporal_pattern, len(names) AS total_columns
    FROM (SELECT table_name, list(column_name) AS names FROM cat WHERE table_type = 'BASE TABLE' GROUP BY table_schema, table_name)""",
)
def _(s):
    return audits.audit_temporal(s.cat, catalog.catalog_tables(s.cat), schema="operational_db")


@case(
    "p01_effective_confidence",
    "fact",
    f"""SELECT canonical_id, legal_name, employee_count, asserted_at, confidence AS base_confidence, {DECAYED} AS effective_confidence
    FROM fact WHERE valid_to IS NULL""",
)
def _(s):
    return confidence.effective_confidence(s.fact, NOW)


@case(
    "p02_confidence_band",
    "fact",
    f"""SELECT canonical_id, CASE WHEN e >= 0.80 THEN 'assertive' WHEN e >= 0.50 THEN 'hedged' ELSE 'uncertain' END AS band
    FROM (SELECT canonical_id, {DECAYED} AS e FROM fact WHERE valid_to IS NULL)""",
)
def _(s):
    scored = confidence.effective_confidence(s.fact, NOW)
    return scored.select("canonical_id", confidence_band(c("effective_confidence")).alias("band"))


FIELDS = {"legal_name": "name_confidence", "employee_count": "emp_confidence", "annual_revenue_usd": "rev_confidence"}


def _field_sql(only: str) -> str:
    """One row of exceptions per fact, a list per field; facts listed several times repeat."""
    lists = ", ".join(f"list(field_confidence) FILTER (field_name = '{f}') AS l{i}" for i, f in enumerate(FIELDS))
    values = ", ".join(f"{f}, COALESCE(v{i}, record_confidence) AS {out}" for i, (f, out) in enumerate(FIELDS.items()))
    each = ", ".join(f"UNNEST(COALESCE(l{i}, [NULL])) AS u{i}(v{i})" for i in range(len(FIELDS)))
    return f"""SELECT canonical_id, {values}
    FROM (SELECT * FROM fact LEFT JOIN (SELECT fact_id, {lists} FROM exceptions WHERE {only} GROUP BY fact_id) ON fact_id = canonical_id
      WHERE valid_to IS NULL), {each}"""


@case("p03_field_confidence", "fact exceptions", _field_sql("fact_table = 'fact_customer_core'"))
def _(s):
    return confidence.field_confidence(s.fact, s.exceptions, FIELDS)


@case("p03_field_confidence_any_table", "fact exceptions", _field_sql("TRUE"))
def _(s):
    return confidence.field_confidence(s.fact, s.exceptions, FIELDS, match_table=None)


@case(
    "p04_source_confidence",
    "",
    """SELECT o_orderkey AS fact_id, CASE o_orderpriority WHEN '1-URGENT' THEN 0.92 WHEN '2-HIGH' THEN 0.60 WHEN '3-MEDIUM' THEN 0.50
    WHEN '5-LOW' THEN 0.30 ELSE 0.40 END::DOUBLE AS base_confidence FROM orders""",
)
def _(s):
    kind = (
        F.when(c("o_orderpriority") == "1-URGENT", "signed_legal_document")
        .when(c("o_orderpriority") == "2-HIGH", "manual_crm_entry")
        .when(c("o_orderpriority") == "3-MEDIUM", "web_scraping")
        .when(c("o_orderpriority") == "5-LOW", "free_text_extraction")
    )
    return s.t("orders").select(c("o_orderkey").alias("fact_id"), source_confidence(kind).alias("base_confidence"))


@case(
    "p05_provenance_chain",
    "prov",
    """SELECT root_fact_id, n.fact_id, n.depth, source_type, source_document, transform_name, CAST(derivation_depth AS INTEGER) AS derivation_depth
    FROM (SELECT root_fact_id, fact_id, MIN(depth) AS depth FROM walk GROUP BY 1, 2) n JOIN prov p ON p.fact_id = n.fact_id""",
    recursive="""walk AS (SELECT fact_id AS root_fact_id, fact_id, 0 AS depth FROM prov UNION
    SELECT w.root_fact_id, i.input_id, w.depth + 1 FROM walk w JOIN (SELECT fact_id, UNNEST(input_fact_ids) AS input_id FROM prov) i
    ON i.fact_id = w.fact_id)""",
)
def _(s):
    return confidence.provenance_chain(s.prov, s.prov.select("fact_id"))


@case(
    "p06_unprovenanced_facts",
    "fact",
    """SELECT canonical_id, valid_from, record_confidence AS confidence,
    CASE WHEN k IS NULL AND record_confidence IS NULL THEN 'NO_PROVENANCE+NO_CONFIDENCE' WHEN k IS NULL THEN 'NO_PROVENANCE' ELSE 'NO_CONFIDENCE' END AS gap
    FROM fact LEFT JOIN (SELECT c_custkey AS k FROM customer WHERE c_mktsegment <> 'BUILDING') ON k = canonical_id
    WHERE valid_to IS NULL AND (k IS NULL OR record_confidence IS NULL)""",
)
def _(s):
    prov = s.t("customer").filter(c("c_mktsegment") != "BUILDING").select(c("c_custkey").alias("fact_id"))
    facts = s.fact.withColumn("confidence", c("record_confidence"))
    return confidence.unprovenanced_facts(facts, prov)


@case(
    "x01_overdue_context",
    "ctx",
    """SELECT entity_id, entity_type, context_type, context_value, assessed_by, assessed_at, review_due,
    CAST(DATE '2024-07-01' - review_due AS INTEGER) AS days_overdue,
    CASE WHEN context_type <> 'renewal_risk' THEN context_type || '@example.org' END AS steward_email
    FROM ctx WHERE valid_to IS NULL AND review_due IS NOT NULL AND review_due < DATE '2024-07-01'""",
    as_text="review_due",
)
def _(s):
    return context.overdue_context(s.ctx, s.ctx_owners, "2024-07-01")


@case(
    "x02_overdue_ownership",
    "ownership",
    """SELECT table_name, column_name, next_review_date AS review_due, CAST(DATE '2024-07-01' - next_review_date AS INTEGER) AS days_overdue
    FROM ownership WHERE next_review_date < DATE '2024-07-01'""",
    as_text="review_due",
)
def _(s):
    return context.overdue_reviews(s.ownership, "next_review_date", "2024-07-01", ["table_name", "column_name"])


VERSION = "canonical_id, legal_name, employee_count, annual_revenue_usd, valid_from, valid_to, confidence, rate_of_change_class"


@case(
    "t01_scd2_apply",
    "fact_rows",
    f"""SELECT canonical_id, employee_count, annual_revenue_usd, valid_from, nxt AS valid_to,
    CASE WHEN fresh THEN 'slow' ELSE rate_of_change_class END AS rate_of_change_class,
    CASE WHEN fresh THEN NULL ELSE record_confidence END AS record_confidence,
    CASE WHEN fresh OR nxt IS DISTINCT FROM old_to THEN TIMESTAMP '{NOW}' ELSE asserted_at END AS updated_at
    FROM (SELECT *, LEAD(valid_from) OVER (PARTITION BY canonical_id ORDER BY valid_from) AS nxt FROM (
      SELECT *, FALSE AS fresh, LEAD(valid_from) OVER (PARTITION BY canonical_id ORDER BY valid_from) AS old_to FROM fact_rows WHERE status <> 'O'
      UNION ALL SELECT *, TRUE, NULL FROM fact_rows WHERE status = 'O'))""",
)
def _(s):
    columns = ["canonical_id", "employee_count", "annual_revenue_usd", "valid_from", "rate_of_change_class"]
    known = s.fact_rows.filter(c("status") != "O").select(
        *columns, "record_confidence", c("asserted_at").alias("updated_at")
    )
    current = temporal.open_ended(known, ["canonical_id"], "valid_from", "valid_to")
    changes = s.fact_rows.filter(c("status") == "O").select(*columns[:4])
    return temporal.scd2_apply(
        current, changes, ["canonical_id"], now=NOW, defaults={"rate_of_change_class": "slow"}
    )


@case(
    "t01_refused_changes",
    "fact_rows",
    """SELECT DISTINCT key AS canonical_id, day AS valid_from, price AS annual_revenue_usd,
    CASE WHEN f.canonical_id IS NULL THEN 'SAME_START' ELSE 'HELD_START' END AS reason
    FROM (SELECT o_custkey AS key, o_orderdate AS day, o_totalprice AS price, dense_rank() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_totalprice) AS place FROM orders) o
    LEFT JOIN (SELECT * FROM fact_rows WHERE status <> 'O') f ON f.canonical_id = key AND f.valid_from = day
    WHERE CASE WHEN f.canonical_id IS NULL THEN place > 1 ELSE annual_revenue_usd <> price END""",
)
def _(s):
    """Every order as a change, against a history that holds one version per customer and day."""
    current = s.fact_rows.filter(c("status") != "O").select("canonical_id", "valid_from", "annual_revenue_usd")
    changes = s.t("orders").select(
        c("o_custkey").alias("canonical_id"), c("o_orderdate").alias("valid_from"), c("o_totalprice").alias("annual_revenue_usd")
    )
    return temporal.refused_changes(current, changes, ["canonical_id"])


@case(
    "t02_as_of",
    "fact",
    f"""SELECT {VERSION} FROM fact WHERE valid_from <= TIMESTAMP '1998-06-15' AND (valid_to IS NULL OR valid_to > TIMESTAMP '1998-06-15')""",
)
def _(s):
    return temporal.as_of(s.fact, "1998-06-15").select(*VERSION.split(", "))


@case("t03_bt_current", "bi", "SELECT * FROM bi WHERE valid_to IS NULL AND recorded_to IS NULL")
def _(s):
    return temporal.bt_current(s.bi)


@case(
    "t04_bt_valid_at",
    "bi",
    "SELECT * FROM bi WHERE valid_from <= TIMESTAMP '1999-03-15' AND (valid_to IS NULL OR valid_to > TIMESTAMP '1999-03-15') AND recorded_to IS NULL",
)
def _(s):
    return temporal.bt_valid_at(s.bi, "1999-03-15")


@case(
    "t05_bt_as_believed",
    "bi",
    """SELECT * FROM bi WHERE valid_from <= TIMESTAMP '1999-03-15' AND (valid_to IS NULL OR valid_to > TIMESTAMP '1999-03-15')
    AND recorded_from <= TIMESTAMP '1999-04-01' AND (recorded_to IS NULL OR recorded_to > TIMESTAMP '1999-04-01')""",
)
def _(s):
    return temporal.bt_as_believed(s.bi, "1999-03-15", "1999-04-01")


@case(
    "t06_bt_correct",
    "fact_rows",
    """SELECT canonical_id, valid_from, annual_value_usd, recorded_from, correction_reason,
    LEAD(recorded_from) OVER (PARTITION BY canonical_id, valid_from ORDER BY recorded_from) AS recorded_to
    FROM (SELECT canonical_id, valid_from, annual_revenue_usd AS annual_value_usd, asserted_at AS recorded_from, NULL AS correction_reason FROM fact_rows
    UNION ALL SELECT o_custkey, o_orderdate, MAX(l_extendedprice), l_shipdate + INTERVAL 30 DAY, 'shipped'
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE (o_custkey, o_orderdate, l_shipdate + INTERVAL 30 DAY) NOT IN (SELECT (canonical_id, valid_from, asserted_at) FROM fact_rows)
    GROUP BY o_custkey, o_orderdate, l_shipdate)""",
)
def _(s):
    believed = s.fact_rows.select(
        "canonical_id",
        "valid_from",
        c("annual_revenue_usd").alias("annual_value_usd"),
        c("asserted_at").alias("recorded_from"),
        F.lit(None).cast("timestamp_ntz").alias("recorded_to"),
        F.lit(None).cast("string").alias("correction_reason"),
    )
    corrections = (
        s.t("lineitem")
        .join(s.t("orders"), c("l_orderkey") == c("o_orderkey"))
        .groupBy(c("o_custkey").alias("canonical_id"), c("o_orderdate").alias("valid_from"), "l_shipdate")
        .agg(F.max("l_extendedprice").alias("annual_value_usd"))
        .withColumn("recorded_from", c("l_shipdate") + F.make_dt_interval(days=F.lit(30)))
        .withColumn("correction_reason", F.lit("shipped"))
    )
    return temporal.bt_correct(believed, corrections, ["canonical_id"])


@case(
    "t07_event_store_issues",
    "bad_evt",
    """SELECT 'DUPLICATE_EVENT_ID' AS issue, NULL::BIGINT AS stream_id, NULL::BIGINT AS sequence_no, event_id, COUNT(*) AS occurrences
    FROM bad_evt GROUP BY event_id HAVING COUNT(*) > 1
    UNION ALL SELECT 'DUPLICATE_SEQUENCE', stream_id, sequence_no, NULL, COUNT(*) FROM bad_evt GROUP BY stream_id, sequence_no HAVING COUNT(*) > 1
    UNION ALL SELECT 'GAP_AFTER', stream_id, sequence_no, NULL, 1 FROM (SELECT stream_id, sequence_no,
      LEAD(sequence_no) OVER (PARTITION BY stream_id ORDER BY sequence_no) AS nxt FROM (SELECT DISTINCT stream_id, sequence_no FROM bad_evt))
      WHERE nxt > sequence_no + 1
    UNION ALL SELECT 'RECORDED_BEFORE_OCCURRED', stream_id, sequence_no, event_id, 1 FROM bad_evt WHERE recorded_at < occurred_at""",
    as_text="stream_id sequence_no event_id",
)
def _(s):
    return temporal.event_store_issues(s.bad_evt)


@case(
    "t08_event_state",
    "evt",
    """SELECT stream_id, MAX(sequence_no) AS last_sequence_no, COUNT(*) AS event_count, arg_max(event_type, sequence_no) AS event_type,
    arg_max(event_data, sequence_no) AS event_data, arg_max(occurred_at, sequence_no) AS occurred_at
    FROM evt WHERE recorded_at <= TIMESTAMP '2024-01-20' GROUP BY stream_id""",
)
def _(s):
    return temporal.event_state(s.evt, "2024-01-20")


@case(
    "t09_snapshots_to_scd2",
    "",
    """SELECT user_id, snapshot_date AS valid_from, event_type, LEAD(snapshot_date) OVER (PARTITION BY user_id ORDER BY snapshot_date) AS valid_to
    FROM (SELECT *, LAG(event_type) OVER (PARTITION BY user_id ORDER BY snapshot_date) AS before FROM (
      SELECT user_id, CAST(ts AS DATE) AS snapshot_date, arg_max(event_type, ts) AS event_type FROM events GROUP BY 1, 2))
    WHERE before IS DISTINCT FROM event_type""",
    as_text="valid_from valid_to",
)
def _(s):
    daily = (
        s.t("events")
        .groupBy("user_id", c("ts").cast("date").alias("snapshot_date"))
        .agg(F.max_by("event_type", "ts").alias("event_type"))
    )
    return temporal.snapshots_to_scd2(daily, ["user_id"], ["event_type"])


@case(
    "t09_complete_snapshots",
    "",
    """SELECT user_id, MIN(day) AS valid_from, event_type, CASE WHEN COUNT(*) = COUNT(until) THEN MAX(until) END AS valid_to FROM (
      SELECT *, SUM(fresh) OVER (PARTITION BY user_id ORDER BY day) AS version FROM (
        SELECT *, (LAG(event_type) OVER w IS DISTINCT FROM event_type OR LAG(until) OVER w IS DISTINCT FROM day)::INT AS fresh
        FROM (SELECT user_id, event_type, day, next_day AS until
          FROM (SELECT user_id, CAST(ts AS DATE) AS day, arg_max(event_type, ts) AS event_type FROM events GROUP BY 1, 2)
          JOIN (SELECT day, LEAD(day) OVER (ORDER BY day) AS next_day FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events)) USING (day))
        WINDOW w AS (PARTITION BY user_id ORDER BY day))) GROUP BY user_id, event_type, version""",
    as_text="valid_from valid_to",
)
def _(s):
    """A user without an event on a day is gone on that day."""
    daily = (
        s.t("events")
        .groupBy("user_id", c("ts").cast("date").alias("snapshot_date"))
        .agg(F.max_by("event_type", "ts").alias("event_type"))
    )
    return temporal.snapshots_to_scd2(daily, ["user_id"], ["event_type"], complete=True)


@case(
    "t10_asof_join",
    "fact",
    """SELECT o.o_custkey AS canonical_id, shipment, l_shipdate, l_quantity, f.valid_from AS fact_valid_from,
    f.employee_count AS fact_employee_count, f.confidence AS fact_confidence
    FROM (SELECT o_custkey, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS shipment, l_shipdate, l_quantity
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey) o
    LEFT JOIN fact f ON f.canonical_id = o.o_custkey AND f.valid_from <= l_shipdate AND (f.valid_to IS NULL OR f.valid_to > l_shipdate)""",
    as_text="fact_employee_count",
)
def _(s):
    shipments = (
        s.t("lineitem")
        .join(s.t("orders"), c("l_orderkey") == c("o_orderkey"))
        .select(
            c("o_custkey").alias("canonical_id"),
            text(c("l_orderkey"), "-", c("l_linenumber"), "-", c("l_partkey"), "-", c("l_suppkey")).alias("shipment"),
            "l_shipdate",
            "l_quantity",
        )
    )
    return temporal.asof_join(
        shipments, s.fact, ["canonical_id"], "l_shipdate", ["shipment"], ["employee_count", "confidence"]
    )
