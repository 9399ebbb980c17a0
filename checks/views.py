"""The sample tables of ``checks/samples.py`` in SQL, as common table expressions."""

from __future__ import annotations

VIEWS: dict[str, tuple[list[str], str]] = {
    "fact_rows": (
        [],
        """
SELECT canonical_id, 'Customer ' || canonical_id AS legal_name, CAST(o_orderkey % 1000 AS INTEGER) AS employee_count,
       o_totalprice AS annual_revenue_usd, valid_from, valid_from + to_hours(o_orderkey % 24) AS asserted_at,
       CASE o_orderpriority WHEN '1-URGENT' THEN 0.95 WHEN '2-HIGH' THEN 0.85 WHEN '3-MEDIUM' THEN 0.75
            WHEN '5-LOW' THEN 0.35 ELSE 0.40 END::DOUBLE AS confidence,
       CASE WHEN o_orderstatus <> 'P' THEN CASE o_orderpriority WHEN '1-URGENT' THEN 0.95 WHEN '2-HIGH' THEN 0.85
            WHEN '3-MEDIUM' THEN 0.75 WHEN '5-LOW' THEN 0.35 ELSE 0.40 END END::DOUBLE AS record_confidence,
       o_orderstatus AS status,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'stable' WHEN o_orderstatus = 'O' THEN 'fast'
            WHEN o_orderstatus = 'P' THEN 'medium' ELSE 'slow' END AS rate_of_change_class
FROM (SELECT o_custkey AS canonical_id, o_orderdate AS valid_from, * ,
             ROW_NUMBER() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
    ),
    "fact": (
        ["fact_rows"],
        "SELECT *, LEAD(valid_from) OVER (PARTITION BY canonical_id ORDER BY valid_from) AS valid_to FROM fact_rows",
    ),
    "exceptions": (
        [],
        """
SELECT 'fact_customer_core' AS fact_table, c_custkey AS fact_id, 'legal_name' AS field_name, 0.55::DOUBLE AS field_confidence
FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
UNION ALL SELECT 'fact_customer_core', c_custkey, 'employee_count', 0.35::DOUBLE FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT 'fact_customer_core', c_custkey, 'annual_revenue_usd', 0.2::DOUBLE FROM customer WHERE c_acctbal < 0
UNION ALL SELECT 'fact_contract', c_custkey, 'legal_name', 0.9::DOUBLE FROM customer WHERE c_mktsegment = 'MACHINERY'""",
    ),
    "prov": (
        [],
        """
SELECT p_partkey AS fact_id,
       CASE WHEN p_partkey > 0 THEN list_distinct([CAST(floor(p_partkey / 2) AS BIGINT), CAST(floor(p_partkey / 3) AS BIGINT)])
            ELSE [] END AS input_fact_ids,
       CASE WHEN p_partkey > 0 THEN 'transformation' ELSE 'source_system' END AS source_type,
       CASE WHEN p_size <= 25 THEN 'doc-' || p_brand END AS source_document,
       CASE WHEN p_partkey > 0 THEN 'step-' || p_type END AS transform_name,
       CASE WHEN p_partkey > 0 THEN 1 ELSE 0 END AS derivation_depth
FROM part""",
    ),
    "rels": (
        [],
        """
SELECT 'U' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS relationship_id,
       'C' || o_custkey AS subject_id, 'Customer' AS subject_type, 'uses_product' AS predicate,
       'P' || l_partkey AS object_id, 'Product' AS object_type, FALSE AS is_bidirectional,
       o_orderdate AS valid_from, CASE WHEN l_returnflag = 'R' THEN l_shipdate END AS valid_to,
       CASE WHEN l_discount = 0 THEN NULL WHEN l_tax = 0 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE - l_discount END AS confidence,
       'orders' AS source_system
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
UNION ALL
SELECT 'L' || c_custkey, 'C' || c_custkey, 'Customer', 'located_in', 'N' || c_nationkey, 'Location', TRUE,
       TIMESTAMP '1995-01-01', NULL, 0.9::DOUBLE, 'crm' FROM customer
UNION ALL
SELECT 'S' || l_partkey || '-' || l_suppkey, 'P' || l_partkey, 'Product', 'supplied_by', 'S' || l_suppkey, 'Supplier', FALSE,
       MIN(l_shipdate), NULL, 0.7::DOUBLE, 'stock' FROM lineitem GROUP BY l_partkey, l_suppkey""",
    ),
    "customers_now": (
        [],
        "SELECT 'C' || c_custkey AS canonical_id, CASE WHEN c_acctbal <= 0 THEN TIMESTAMP '2001-01-01' END AS valid_to FROM customer",
    ),
    "ctx": (
        [],
        """
SELECT d.doc_id AS entity_id, 'document' AS entity_type,
       CASE WHEN toxic = 1 THEN 'sensitivity' WHEN quality = 1 THEN 'strategic_tier' ELSE 'renewal_risk' END AS context_type,
       lang AS context_value, 'by-' || source AS assessed_by, TIMESTAMP '2024-01-01' AS assessed_at,
       CASE WHEN lang <> 'es' THEN CAST(DATE '2024-01-01' + CAST(d.doc_id % 400 AS INTEGER) AS DATE) END AS review_due,
       CASE WHEN lang = 'fr' THEN TIMESTAMP '2024-03-01' END AS valid_to
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    ),
    "chained_ctx": (
        [],
        """
SELECT d.doc_id AS context_id,
       CASE WHEN lang = 'es' THEN d.doc_id + 1000000000
            WHEN d.doc_id > 0 AND COALESCE(quality, 0) = 0 THEN CAST(floor(d.doc_id / 2) AS BIGINT) END AS superseded_by
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    ),
    "bi": (
        [],
        """
SELECT o_custkey AS canonical_id, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS version_id,
       l_extendedprice AS annual_value_usd, o_orderdate AS valid_from,
       CASE WHEN l_returnflag = 'R' THEN l_shipdate END AS valid_to, l_shipdate AS recorded_from,
       CASE WHEN l_linestatus = 'F' THEN l_shipdate + INTERVAL 90 DAY END AS recorded_to
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    ),
    "evt": (
        [],
        """
SELECT event_id, user_id AS stream_id, event_type, props AS event_data, ts AS occurred_at,
       ts + to_seconds(event_id % 60) AS recorded_at,
       ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sequence_no FROM events""",
    ),
    "bad_evt": (
        [],
        """
SELECT l_orderkey * 10 + l_linenumber AS event_id, l_orderkey AS stream_id, CAST(l_linenumber AS BIGINT) AS sequence_no,
       l_shipdate AS occurred_at, l_shipdate + to_days(CAST(l_quantity - 3 AS INTEGER)) AS recorded_at FROM lineitem""",
    ),
    "acc": (
        [],
        """
SELECT c_custkey AS account_id, c_name AS account_name, CASE WHEN c_nationkey <> 7 THEN c_mktsegment END AS account_type,
       n_name AS territory_code, c_custkey % 50 AS assigned_manager_id,
       CASE c_nationkey % 3 WHEN 1 THEN ['sales', 'support'] WHEN 2 THEN ['finance'] END AS visibility_roles,
       CASE WHEN c_acctbal > 9000 THEN TIMESTAMP '2001-06-01' END AS valid_to, updated_at,
       c_acctbal AS adjusted_balance_usd,
       CASE WHEN c_acctbal < 0 THEN 'deleted' WHEN c_nationkey <> 3 THEN 'active' END AS status
FROM customer JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN (SELECT o_custkey, MAX(o_orderdate) AS updated_at FROM orders GROUP BY 1) ON o_custkey = c_custkey""",
    ),
    "ops": (
        [],
        """
SELECT o_orderkey AS account_id, o_orderpriority AS account_type_code, o_custkey AS customer_id, o_orderstatus AS stat,
       o_totalprice AS cr_lmt, o_totalprice - 1000 AS adj_bal, o_totalprice > 250000 AS flg_prm,
       o_orderpriority = '1-URGENT' AS flg_rev, 'orders' AS src_sys, o_orderdate AS lst_txn_dt,
       substr(o_orderpriority, 1, 1) AS tp_cd, c_name AS customer_name, c_mktsegment AS customer_industry
FROM orders JOIN customer ON o_custkey = c_custkey""",
    ),
    "hist": (
        [],
        "SELECT CAST(ts AS DATE) AS snapshot_date, CASE WHEN value >= 1 THEN event_type END AS account_type FROM events",
    ),
    "ownership": (
        [],
        """
SELECT p_type AS table_name, 'c' || p_partkey AS column_name, 'steward ' || p_size AS steward_name,
       'role-' || (p_size % 4) AS steward_role, p_brand AS producer_team,
       CASE WHEN p_size <= 25 THEN 'monthly' ELSE 'quarterly' END AS review_frequency,
       CAST(DATE '2024-01-01' + CAST(p_partkey % 365 AS INTEGER) AS DATE) AS next_review_date,
       p_brand || '@example.org' AS escalation_contact, CASE WHEN p_size <= 30 THEN 'next-' || p_size END AS successor_role,
       CASE WHEN p_size % 7 <> 0 THEN CAST(DATE '2023-06-01' + p_size * 10 AS DATE) END AS succession_reviewed_at
FROM part""",
    ),
    "sens": (
        [],
        """
SELECT p_type AS table_name, 'c' || p_partkey AS column_name,
       CASE WHEN p_size <= 10 THEN 'PUBLIC' WHEN p_size <= 25 THEN 'INTERNAL' WHEN p_size <= 40 THEN 'CONFIDENTIAL'
            ELSE 'RESTRICTED' END AS classification,
       CASE WHEN p_size <= 25 THEN ['AUTOMOBILE', 'BUILDING'] WHEN p_size <= 35 THEN ['BUILDING', 'FURNITURE'] END AS access_roles,
       CASE WHEN p_size > 40 THEN 'pii-' || p_brand END AS pii_category, p_size > 35 AS log_access
FROM part""",
    ),
    "manifest": (
        [],
        """
SELECT s_name AS system_name, 'v' || (s_suppkey % 5) AS system_version,
       CASE WHEN s_acctbal > 0 THEN 'prod' ELSE 'dev' END AS environment,
       CASE s_nationkey % 6 WHEN 0 THEN 'ECONOMY' WHEN 1 THEN 'LARGE' WHEN 2 THEN 'MEDIUM' WHEN 3 THEN 'PROMO' WHEN 4 THEN 'SMALL' END AS table_name,
       ['c' || s_suppkey, 'c' || (s_suppkey * 3), 'c' || (s_suppkey * 7)] AS columns_accessed,
       CASE WHEN s_suppkey % 4 <> 0 THEN CAST(s_suppkey % 40 AS INTEGER) END AS max_acceptable_staleness_hours,
       CASE WHEN s_suppkey % 3 <> 0 THEN (s_suppkey % 10) / 10.0::DOUBLE END AS min_confidence_threshold,
       'team-' || s_nationkey AS system_owner_team
FROM supplier""",
    ),
    "lin_pairs": (
        [],
        """
SELECT *, CAST(floor(p_partkey / 2) AS BIGINT) AS s FROM part WHERE p_partkey > 0
UNION ALL SELECT *, CAST(floor(p_partkey / 2) AS BIGINT) + 1 FROM part WHERE p_partkey > 0 AND p_size <= 5
UNION ALL SELECT *, 3 FROM part WHERE p_partkey = 1""",
    ),
    "lin": (
        ["lin_pairs"],
        """
SELECT 'T' || (p_partkey % 5) AS target_table, 'c' || p_partkey AS target_column, 'T' || (s % 5) AS source_table,
       'c' || s AS source_column, CASE WHEN s % 2 = 0 THEN 'erp' END AS source_system,
       CASE WHEN p_size <= 20 THEN 'direct_copy' ELSE 'aggregation' END AS transform_type,
       'pipe-' || p_brand AS transform_pipeline, '1.' || p_size AS pipeline_version,
       CASE WHEN p_size > 10 THEN CASE WHEN p_size <= 30 THEN 'string' ELSE 'bigint' END END AS expected_source_type
FROM lin_pairs""",
    ),
    "lin_cols": (
        [],
        """
SELECT 'operational_db' AS table_schema, 'T' || (p_partkey % 5) AS table_name, 'c' || p_partkey AS column_name,
       CASE WHEN p_size <= 25 THEN 'string' ELSE 'bigint' END AS data_type FROM part WHERE p_size > 3""",
    ),
    "lin_manifest": (
        [],
        "SELECT CASE WHEN s_acctbal > 0 THEN 'prod' ELSE 'dev' END AS environment, 'T' || (s_suppkey % 4) AS table_name FROM supplier",
    ),
    "cat": (
        [],
        """
SELECT 'operational_db' AS table_schema, p_brand || ' ' || p_type AS table_name,
       CASE WHEN p_size = 1 THEN 'valid_from' WHEN p_size = 2 THEN 'updated_at' WHEN p_size < 15 THEN 'c' || p_partkey
            WHEN p_size < 20 THEN 'col' || p_partkey ELSE replace(p_name, ' ', '_') || '_' || p_partkey END AS column_name,
       CASE WHEN p_size <= 25 THEN 'string' ELSE 'bigint' END AS data_type,
       CASE p_size % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN p_name ELSE p_name || ' in the range of ' || p_brand END AS comment,
       CASE WHEN p_type = 'PROMO' THEN 'VIEW' ELSE 'BASE TABLE' END AS table_type
FROM part""",
    ),
    "glossary": (
        [],
        """
SELECT s_name AS canonical_term, 'maker ' || s_suppkey || ' in nation ' || s_nationkey AS definition,
       CASE WHEN s_acctbal > 5000 THEN 'sum of amounts' END AS calculation,
       ['syn' || s_suppkey, 'NATION_' || s_nationkey] AS synonyms,
       CASE WHEN s_acctbal > 5000 THEN ['not ' || s_suppkey] END AS excludes, 'trade' AS business_context,
       CASE WHEN s_acctbal < 0 THEN 'deprecated' ELSE 'active' END AS status,
       CASE WHEN s_suppkey > 0 THEN 'Supplier#' || lpad(CAST(CAST(floor(s_suppkey / 2) AS BIGINT) AS VARCHAR), 9, '0') END AS is_a
FROM supplier""",
    ),
    "descriptions": (
        [],
        """
SELECT source AS table_name, 'c' || doc_id AS column_name,
       'uses [syn' || (doc_id % 150) || '] and [NATION_' || (doc_id % 25) || '] in ' || lang AS description FROM documents""",
    ),
    "refs": (
        ["descriptions"],
        """
SELECT table_name, column_name, CAST(i - 1 AS INTEGER) AS ref_position, names[i] AS term
FROM (SELECT *, regexp_extract_all(description, '\\[([^\\]]+)\\]', 1) AS names FROM descriptions), generate_series(1, 2) AS g(i)""",
    ),
    "data_refs": (
        ["refs"],
        """
SELECT table_name, CASE WHEN n % 40 = 0 THEN 'lang' WHEN n % 40 = 1 THEN 'n_chars' ELSE column_name END AS column_name, term
FROM (SELECT *, CAST(substr(column_name, 2) AS BIGINT) AS n FROM refs)""",
    ),
    "claims": (
        ["glossary"],
        """
SELECT canonical_term AS term, 0 AS rnk, * FROM glossary WHERE status = 'active'
UNION ALL SELECT UNNEST(synonyms), 1, * FROM glossary WHERE status = 'active'""",
    ),
    "names": (
        ["claims"],
        "SELECT * FROM claims QUALIFY ROW_NUMBER() OVER (PARTITION BY term ORDER BY rnk, canonical_term) = 1",
    ),
    "vec": ([], "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS embedding, label FROM embeddings"),
    "new_vec": (
        ["vec"],
        """
SELECT vec_id, CASE WHEN label IN (1, 4, 7) THEN label + 100 ELSE label END AS label,
       CASE label WHEN 1 THEN list_transform(embedding, lambda x: x * 2) WHEN 4 THEN list_reverse(embedding)
            WHEN 7 THEN list_transform(embedding, lambda x: x + 0.02::DOUBLE) ELSE embedding END AS embedding
FROM vec""",
    ),
    "source_docs": (
        [],
        "SELECT doc_id AS source_record_id, source AS source_table, n_chars AS updated_at, md5(text) AS content_hash FROM documents",
    ),
    "index_docs": (
        [],
        """
SELECT 'k' || d.doc_id AS chunk_id, d.doc_id AS source_record_id, source AS source_table,
       CASE WHEN COALESCE(toxic, 0) = 1 THEN n_chars - 1 ELSE n_chars END AS source_version,
       CASE WHEN COALESCE(toxic, 0) = 1 THEN md5(text || '!') ELSE md5(text) END AS content_hash
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE lang <> 'es'
UNION ALL SELECT 'g' || doc_id, doc_id + 1000000000, source, n_chars, md5(text) FROM documents WHERE lang = 'de'""",
    ),
    "runs": (
        [],
        '''SELECT user_id AS contract_id, event_id AS run_id, ts AS "at", event_type <> 'error' AS ok FROM events''',
    ),
    "usable": (
        [],
        "SELECT * FROM events WHERE value >= 4 QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
    ),
}


def with_views(names: list[str], body: str, recursive: str = "") -> str:
    """A query with the views it needs in front. ``recursive`` is one more expression."""
    done: dict[str, str] = {}

    def add(name: str) -> None:
        needs, sql = VIEWS[name]
        for need in needs:
            add(need)
        done.setdefault(name, sql)

    for name in names:
        add(name)
    parts = [f"{name} AS ({sql})" for name, sql in done.items()]
    if recursive:
        parts.append(recursive)
    head = f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n" if parts else ""
    return head + body
