"""Graph, access, lineage and ownership."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import case
from checks.samples import c, text
from factloom.operators import access, governance, graph
from factloom.sources import catalog

LIVE = "(SELECT canonical_id FROM customers_now WHERE valid_to IS NULL)"


@case(
    "g01_orphan_relationships",
    "rels customers_now",
    f"""SELECT COUNT(*) AS orphan_count, predicate, 'subject' AS orphan_side FROM rels
    WHERE valid_to IS NULL AND subject_id NOT IN {LIVE} GROUP BY predicate
    UNION ALL SELECT COUNT(*), predicate, 'object' FROM rels WHERE valid_to IS NULL AND object_id NOT IN {LIVE} GROUP BY predicate""",
)
def _(s):
    return graph.orphan_relationships(s.rels, s.customers_now)


@case(
    "g02_graph_vertices",
    "rels",
    "SELECT DISTINCT subject_id AS canonical_id, subject_type AS type FROM rels WHERE valid_to IS NULL "
    "UNION SELECT object_id, object_type FROM rels WHERE valid_to IS NULL",
)
def _(s):
    return graph.build_graph(s.rels)[0]


@case(
    "g02_graph_edges",
    "rels",
    """SELECT subject_id AS src, object_id AS dst, predicate AS label, valid_from, valid_to,
    CASE WHEN confidence IS NULL OR confidence = 0 THEN 0.8::DOUBLE ELSE confidence END AS confidence, source_system AS source
    FROM rels WHERE valid_to IS NULL AND predicate IN ('uses_product', 'located_in')""",
)
def _(s):
    return graph.build_graph(s.rels, ["uses_product", "located_in"])[1]


@case("g02_graph_counts", "rels", "SELECT COUNT(*) AS ingested, COUNT(*) AS total FROM rels WHERE valid_to IS NULL")
def _(s):
    return graph.graph_counts(s.rels)


@case(
    "g03_edge_confidence",
    "rels",
    """SELECT relationship_id, CASE WHEN confidence IS NULL OR confidence = 0 THEN 0.8::DOUBLE ELSE confidence END AS filled,
    COALESCE(confidence, 0.8::DOUBLE) AS filled_keep_zero FROM rels""",
)
def _(s):
    given = c("confidence")
    return s.rels.select(
        "relationship_id",
        graph.edge_confidence(given).alias("filled"),
        graph.edge_confidence(given, keep_zero=True).alias("filled_keep_zero"),
    )


ENTITIES = """SELECT event_id AS reply_id, 'U' || user_id AS id, 'Customer' AS type, 'user ' || user_id AS name, NULL AS canonical_id_hint
    FROM events WHERE event_type <> 'error' UNION ALL
    SELECT event_id, 'E' || event_id, CASE WHEN event_type = 'signup' THEN 'Alien' ELSE 'Event' END, event_type, CAST(event_id AS VARCHAR)
    FROM events WHERE event_type <> 'error'"""
LINKS = """SELECT event_id AS reply_id, 'U' || user_id AS subject_id, CASE WHEN event_type = 'view' THEN 'likes' ELSE 'involves' END AS predicate,
    'E' || event_id AS object_id, CASE WHEN value < 20 THEN 0.9 ELSE 0.6 END::DOUBLE AS confidence FROM events WHERE event_type <> 'error'"""


@case("g04_parse_entities", "", ENTITIES)
def _(s):
    return graph.parse_extractions(s.replies)[0]


@case("g04_parse_relationships", "", LINKS)
def _(s):
    return graph.parse_extractions(s.replies)[1]


@case("g04_parse_rejects", "", "SELECT event_id AS reply_id, '{\"entities\": [' AS reply FROM events WHERE event_type = 'error'")
def _(s):
    return graph.parse_extractions(s.replies)[2]


@case(
    "g05_validate_entities",
    "",
    f"SELECT *, CASE WHEN type = 'Alien' THEN 'UNKNOWN_TYPE' END AS problem FROM ({ENTITIES})",
)
def _(s):
    entities, links, _ = graph.parse_extractions(s.replies)
    return graph.validate_extractions(entities, links)[0]


@case(
    "g05_validate_relationships",
    "",
    f"""SELECT l.*, CASE WHEN predicate = 'likes' THEN 'UNKNOWN_PREDICATE' WHEN confidence = 0.6 THEN 'UNKNOWN_LEVEL'
    WHEN event_type = 'signup' THEN 'UNKNOWN_OBJECT' END AS problem FROM ({LINKS}) l JOIN events ON event_id = reply_id""",
)
def _(s):
    entities, links, _ = graph.parse_extractions(s.replies)
    return graph.validate_extractions(entities, links)[1]


@case(
    "g06_k_hop",
    "rels",
    """SELECT seed, vertex, MIN(hops) AS hops FROM walk GROUP BY 1, 2""",
    recursive="""steps AS (SELECT subject_id AS src, object_id AS dst FROM rels
        WHERE valid_from <= TIMESTAMP '1998-01-01' AND (valid_to IS NULL OR valid_to > TIMESTAMP '1998-01-01')
      UNION SELECT object_id, subject_id FROM rels WHERE is_bidirectional AND valid_from <= TIMESTAMP '1998-01-01'),
    walk AS (SELECT 'C' || c_custkey AS seed, 'C' || c_custkey AS vertex, 0 AS hops FROM customer WHERE c_acctbal < 0
      UNION SELECT seed, dst, hops + 1 FROM walk JOIN steps ON src = vertex WHERE hops < 2)""",
)
def _(s):
    """What lies within two steps of the customers in debt."""
    seeds = s.t("customer").filter(c("c_acctbal") < 0).select(text("C", c("c_custkey")).alias("seed"))
    edges = s.rels.select(
        c("subject_id").alias("src"), c("object_id").alias("dst"), "valid_from", "valid_to", "is_bidirectional"
    )
    return graph.k_hop(edges, seeds, 2, "1998-01-01")


@case(
    "g07_cascade_close",
    "rels customers_now",
    f"""SELECT relationship_id, predicate, CASE WHEN r IS NOT NULL THEN TIMESTAMP '2001-07-01' ELSE valid_to END AS valid_to, r AS close_reason
    FROM (SELECT *, CASE WHEN valid_to IS NULL AND valid_from <= TIMESTAMP '2001-07-01' THEN
      CASE WHEN subject_id NOT IN {LIVE} AND object_id NOT IN {LIVE} THEN 'BOTH_ENDS_GONE'
      WHEN subject_id NOT IN {LIVE} THEN 'SUBJECT_GONE' WHEN object_id NOT IN {LIVE} THEN 'OBJECT_GONE' END END AS r FROM rels)""",
)
def _(s):
    closed = graph.cascade_close(s.rels, s.customers_now, "2001-07-01")
    return closed.select("relationship_id", "predicate", "valid_to", "close_reason")


@case(
    "g08_resolve_superseded",
    "chained_ctx",
    """SELECT c.context_id, c.superseded_by, w.here AS surviving_id, d.context_id IS NOT NULL AS resolved
    FROM chained_ctx c JOIN walk w ON w.context_id = c.context_id
    LEFT JOIN chained_ctx d ON d.context_id = w.here
    WHERE d.superseded_by IS NULL""",
    recursive="""walk AS (SELECT context_id, context_id AS here FROM chained_ctx UNION ALL
    SELECT w.context_id, c.superseded_by FROM walk w JOIN chained_ctx c ON c.context_id = w.here WHERE c.superseded_by IS NOT NULL)""",
    as_text="superseded_by",
)
def _(s):
    return graph.resolve_superseded(s.chained_ctx)


@case(
    "s01_visible_rows",
    "acc",
    """SELECT account_id, account_name, territory_code, assigned_manager_id FROM acc
    WHERE assigned_manager_id = 7 OR territory_code = 'NATION_3' OR list_contains(visibility_roles, 'finance')""",
)
def _(s):
    user = {"user_id": 7, "territory": "NATION_3", "role": "finance"}
    return access.visible_rows(s.acc, user).select(
        "account_id", "account_name", "territory_code", "assigned_manager_id"
    )


@case(
    "s01_visible_counts",
    "acc",
    """SELECT user_id, COUNT(account_id) AS visible_rows FROM
    (SELECT s_suppkey AS user_id, 'NATION_' || s_nationkey AS territory, CASE WHEN s_acctbal > 5000 THEN 'sales' WHEN s_acctbal < 0 THEN 'finance' END AS role FROM supplier)
    LEFT JOIN acc ON assigned_manager_id = user_id OR territory_code = territory OR list_contains(visibility_roles, role) GROUP BY user_id""",
)
def _(s):
    role = F.when(c("s_acctbal") > 5000, "sales").when(c("s_acctbal") < 0, "finance")
    users = s.t("supplier").select(
        c("s_suppkey").alias("user_id"), text("NATION_", c("s_nationkey")).alias("territory"), role.alias("role")
    )
    return access.visible_counts(s.acc, users)


def _registry_sql() -> str:
    rows = []
    for i, field in enumerate(_registry_fields()):
        kind, roles = _registry_row(i)
        listed = "NULL::VARCHAR[]" if roles is None else "[" + ", ".join(f"'{r}'" for r in roles) + "]"
        rows.append(f"('{field}', '{kind}', {listed})")
    return "registry(field, classification, access_roles) AS (VALUES " + ", ".join(rows) + ")"


def _registry_fields() -> list[str]:
    """Registered columns; the last field of every set is left out of the registry."""
    return list(dict.fromkeys(f for fields in access.FIELD_SETS.values() for f in fields[:-1]))


def _registry_row(i: int) -> tuple[str, list[str] | None]:
    kinds = ["PUBLIC", "CONFIDENTIAL", "INTERNAL", "RESTRICTED"]
    roles = [["BUILDING"], ["BUILDING", "MACHINERY"], ["FURNITURE"], None]
    return kinds[i % 4], roles[(i // 2) % 4]


def _sets_sql() -> str:
    rows = [f"('{k}', {i}, '{f}')" for k, fields in access.FIELD_SETS.items() for i, f in enumerate(fields)]
    return "sets(category, position, field) AS (VALUES " + ", ".join(rows) + ")"


@case(
    "s02_permitted_fields",
    "",
    f"""WITH {_registry_sql()}, {_sets_sql()}, asked AS (SELECT o_orderkey AS request_id, o_custkey AS user_id,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'account_commercial' WHEN '2-HIGH' THEN 'account_strategic' WHEN '3-MEDIUM' THEN 'account_contact' ELSE 'account_identity' END AS category
      FROM orders)
    SELECT request_id, CAST(position AS INTEGER) AS position, s.field FROM asked a JOIN customer ON c_custkey = user_id
    JOIN sets s ON s.category = a.category JOIN registry r ON r.field = s.field
    WHERE classification = 'PUBLIC' OR COALESCE(list_contains(access_roles, c_mktsegment), FALSE)""",
)
def _(s):
    rows = [
        ("account_ai_surface", f, *_registry_row(i)) for i, f in enumerate(_registry_fields())
    ]
    registry = s.spark.createDataFrame(
        rows, "table_name string, column_name string, classification string, access_roles array<string>"
    )
    kind = (
        F.when(c("o_orderpriority") == "1-URGENT", "account_commercial")
        .when(c("o_orderpriority") == "2-HIGH", "account_strategic")
        .when(c("o_orderpriority") == "3-MEDIUM", "account_contact")
        .otherwise("something_else")
    )
    requests = s.t("orders").select(
        c("o_orderkey").alias("request_id"), c("o_custkey").alias("user_id"), kind.alias("category")
    )
    grants = s.t("customer").select(c("c_custkey").alias("user_id"), c("c_mktsegment").alias("role"))
    return access.permitted_fields(requests, access.field_set_rows(s.spark), registry, grants)


@case(
    "s03_allowed_columns",
    "sens",
    """SELECT table_name, column_name, classification, log_access FROM sens WHERE table_name = 'PROMO'
    AND (classification = 'PUBLIC' OR COALESCE(list_has_any(access_roles, ['FURNITURE', 'AUTOMOBILE']), FALSE))""",
)
def _(s):
    return access.allowed_columns(s.sens, "PROMO", ["FURNITURE", "AUTOMOBILE"])


@case(
    "s03_column_access_matrix",
    "sens",
    """SELECT s_suppkey AS user_id, table_name, column_name FROM supplier JOIN sens
    ON classification <> 'PUBLIC' AND list_contains(access_roles, CASE WHEN s_acctbal > 9000 THEN 'AUTOMOBILE' WHEN s_acctbal < 0 THEN 'FURNITURE' END)""",
)
def _(s):
    role = F.when(c("s_acctbal") > 9000, "AUTOMOBILE").when(c("s_acctbal") < 0, "FURNITURE")
    return access.column_access_matrix(s.sens, s.t("supplier").select(c("s_suppkey").alias("user_id"), role.alias("role")))


@case(
    "s04_logged_columns",
    "sens",
    """SELECT DISTINCT request_id, user_id, a.table_name, a.column_name, classification, pii_category FROM (
      SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS request_id, l_orderkey AS user_id, p_type AS table_name,
      UNNEST(['c' || l_partkey, 'c' || l_suppkey]) AS column_name FROM lineitem JOIN part ON p_partkey = l_partkey) a
    JOIN sens s ON s.table_name = a.table_name AND s.column_name = a.column_name WHERE log_access""",
)
def _(s):
    requests = (
        s.t("lineitem")
        .join(s.t("part"), c("l_partkey") == c("p_partkey"))
        .select(
            text(c("l_orderkey"), "-", c("l_linenumber"), "-", c("l_partkey"), "-", c("l_suppkey")).alias("request_id"),
            c("l_orderkey").alias("user_id"),
            c("p_type").alias("table_name"),
            F.array(text("c", c("l_partkey")), text("c", c("l_suppkey"))).alias("columns"),
        )
    )
    return access.logged_columns(requests, s.sens)


def _erasure(s):
    asked = s.t("customer").filter(c("c_acctbal") < 0).select(c("c_custkey").alias("o_custkey"))
    return access.erase(s.t("orders").select("o_orderkey", "o_custkey"), asked, ["o_custkey"])


@case("s05_erase_kept", "", "SELECT o_orderkey, o_custkey FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_acctbal >= 0")
def _(s):
    return _erasure(s)[0]


@case("s05_erase_erased", "", "SELECT o_orderkey, o_custkey FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_acctbal < 0")
def _(s):
    return _erasure(s)[1]


def _trace(here: str, there: str) -> tuple[str, str]:
    walk = f"""walk AS (SELECT l.{here}_table AS root_table, l.{here}_column AS root_column, 1 AS depth, l.* FROM lin l UNION ALL
    SELECT w.root_table, w.root_column, w.depth + 1, l.* FROM walk w JOIN lin l
    ON w.{there}_table = l.{here}_table AND w.{there}_column = l.{here}_column WHERE w.depth < 10)"""
    body = f"""SELECT root_table, root_column, depth, {there}_table || '.' || {there}_column AS {there}_field, transform_type, transform_pipeline,
    pipeline_version AS documented_version, source_system,
    CASE WHEN source_system IS NOT NULL THEN 'OPERATIONAL SOURCE' ELSE 'PIPELINE TRANSFORMATION' END AS node_type, COUNT(*) AS paths,
    depth = 10 AND ({there}_table, {there}_column) IN (SELECT ({here}_table, {here}_column) FROM lin) AS cut FROM walk GROUP BY ALL"""
    return walk, body


UP, DOWN = _trace("target", "source"), _trace("source", "target")


@case("l01_lineage_trace", "lin", UP[1], recursive=UP[0])
def _(s):
    return governance.lineage_trace(s.lin)


@case("l07_downstream_trace", "lin", DOWN[1], recursive=DOWN[0])
def _(s):
    return governance.lineage_trace(s.lin, direction="down")


@case(
    "l02_impact",
    "manifest ownership",
    """SELECT DISTINCT system_name, system_version, system_owner_team, escalation_contact
    FROM (SELECT *, UNNEST(columns_accessed) AS read FROM manifest WHERE environment = 'prod' AND table_name IS NOT NULL) m JOIN ownership o USING (table_name)
    WHERE (m.table_name, read) = (SELECT MIN((table_name, read)) FROM
      (SELECT table_name, UNNEST(columns_accessed) AS read FROM manifest WHERE environment = 'prod' AND table_name IS NOT NULL))""",
)
def _(s):
    """The impact of the first column, by name, that a live system reads."""
    read = s.manifest.filter("environment = 'prod' AND table_name IS NOT NULL").select("table_name", F.explode("columns_accessed").alias("read"))
    first = read.agg(F.min(F.struct("table_name", "read")).alias("m")).select("m.*").first()
    return governance.impact(s.manifest, s.ownership, first["table_name"], first["read"])


@case(
    "l02_impact_bulk",
    "manifest ownership",
    """SELECT DISTINCT c.table_name, c.column_name, system_name, system_version, system_owner_team, o.escalation_contact
    FROM (SELECT table_name, column_name FROM ownership WHERE review_frequency = 'monthly') c
    JOIN manifest m ON m.table_name = c.table_name AND list_contains(columns_accessed, c.column_name) AND environment = 'prod'
    JOIN ownership o ON o.table_name = c.table_name""",
)
def _(s):
    changes = s.ownership.filter(c("review_frequency") == "monthly").select("table_name", "column_name")
    return governance.impact_bulk(changes, s.manifest, s.ownership)


@case(
    "l03_succession_health",
    "manifest ownership",
    """SELECT table_name, column_name, steward_role, steward_name, successor_role,
    ['OK', 'SUCCESSION_PLAN_STALE', 'NO_SUCCESSION_PLAN'][1 + greatest(2 * (successor_role IS NULL)::INT, stale)] AS succession_status
    FROM (SELECT *, COALESCE((succession_reviewed_at < DATE '2024-01-01')::INT, 0) AS stale FROM ownership)
    SEMI JOIN (SELECT table_name FROM manifest WHERE environment = 'prod') USING (table_name)""",
)
def _(s):
    return governance.succession_health(s.ownership, s.manifest, "2024-07-01")


PRINT = "md5(producer_team || '|' || steward_role || '|' || classification || '|' || review_frequency)"


@case(
    "l04_ownership_fingerprint",
    "ownership sens",
    f"""SELECT table_name, column_name, producer_team, steward_role, classification AS sensitivity, pii_category, review_frequency,
    {PRINT} AS ownership_domain_fingerprint FROM ownership JOIN sens USING (table_name, column_name)""",
)
def _(s):
    return governance.ownership_fingerprint(s.ownership, s.sens)


@case(
    "l05_ownership_domains",
    "ownership sens",
    f"""SELECT {PRINT} AS ownership_domain_fingerprint, producer_team, steward_role, classification AS sensitivity, review_frequency,
    COUNT(*) AS column_count, COUNT(DISTINCT table_name) AS table_count FROM ownership JOIN sens USING (table_name, column_name)
    GROUP BY ALL""",
)
def _(s):
    return governance.ownership_domains(s.ownership, s.sens)


@case(
    "l06_version_mismatch",
    "lin",
    """SELECT target_table, target_column, source_table, source_column, transform_pipeline, pipeline_version AS documented_version, deployed_version
    FROM lin JOIN (SELECT 'pipe-' || p_brand AS pipe, '1.' || MAX(p_size) AS deployed_version FROM part GROUP BY p_brand) ON pipe = transform_pipeline
    WHERE pipeline_version <> deployed_version""",
)
def _(s):
    deployed = (
        s.t("part")
        .groupBy(text("pipe-", c("p_brand")).alias("transform_pipeline"))
        .agg(text("1.", F.max("p_size")).alias("deployed_version"))
    )
    return governance.version_mismatch(s.lin, deployed)


@case(
    "l08_manifest_compliance",
    "manifest",
    """SELECT system_name, table_name, CASE WHEN last_updated IS NULL THEN 'NO_DATA' WHEN stale AND weak THEN 'STALE_AND_LOW_CONFIDENCE'
    WHEN stale THEN 'STALE' WHEN weak THEN 'LOW_CONFIDENCE' ELSE 'OK' END AS compliance_status FROM (
    SELECT system_name, m.table_name, last_updated,
    COALESCE((epoch_us(TIMESTAMP '2024-01-04') - epoch_us(last_updated)) / 3600000000.0::DOUBLE > max_acceptable_staleness_hours, FALSE) AS stale,
    COALESCE(min_confidence < min_confidence_threshold, FALSE) AS weak
    FROM manifest m LEFT JOIN (SELECT p_type, TIMESTAMP '2024-01-01' + to_hours(CAST(MAX(p_size) AS INTEGER)) AS last_updated, MIN(p_retailprice) / 2000.0::DOUBLE AS min_confidence
      FROM part GROUP BY 1) ON p_type = m.table_name)""",
)
def _(s):
    stats = (
        s.t("part")
        .groupBy(c("p_type").alias("table_name"))
        .agg(
            (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=F.max("p_size"))).alias("last_updated"),
            (F.min("p_retailprice") / 2000.0).alias("min_confidence"),
        )
    )
    return governance.manifest_compliance(s.manifest, stats, "2024-01-04")


def _props(s):
    rows = F.array(
        F.struct(F.lit("ai_ready").alias("key"), F.when(c("c_acctbal") > 0, "true").otherwise("false").alias("value")),
        F.struct(
            F.lit("ai_ready_valid_until").alias("key"),
            F.when(c("c_nationkey") != 4, F.date_add(F.lit("2024-01-01").cast("date"), (c("c_custkey") % 365).cast("int")).cast("string")).alias("value"),
        ),
        F.struct(F.lit("data_domain").alias("key"), c("c_mktsegment").alias("value")),
    )
    return s.t("customer").select(c("c_name").alias("table_name"), F.inline(rows))


UNTIL = "CASE WHEN c_nationkey <> 4 THEN CAST(DATE '2024-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE) END"


@case(
    "l09_certification_status",
    "",
    f"""SELECT c_name AS table_name, u AS valid_until, CAST(u - DATE '2024-07-01' AS INTEGER) AS days_left,
    CASE WHEN c_acctbal <= 0 THEN 'NOT_CERTIFIED' WHEN u IS NULL THEN 'NO_EXPIRY_DATE' WHEN u < DATE '2024-07-01' THEN 'EXPIRED'
    WHEN u <= DATE '2024-07-31' THEN 'EXPIRING_SOON' ELSE 'CERTIFIED' END AS certification_status
    FROM (SELECT *, {UNTIL} AS u FROM customer)""",
    as_text="valid_until days_left",
)
def _(s):
    return governance.certification_status(_props(s), "2024-07-01")


@case(
    "io6_properties_wide",
    "",
    f"""SELECT c_name AS table_name, CASE WHEN c_acctbal > 0 THEN 'true' ELSE 'false' END AS ai_ready,
    CAST({UNTIL} AS VARCHAR) AS ai_ready_valid_until, c_mktsegment AS data_domain FROM customer""",
)
def _(s):
    return catalog.properties_wide(_props(s), ["ai_ready", "ai_ready_valid_until", "data_domain"])


@case(
    "io3_active_relationships",
    "rels",
    """SELECT relationship_id, subject_id, subject_type, predicate, object_id, object_type, valid_from, valid_to, confidence, source_system
    FROM rels WHERE valid_to IS NULL AND predicate = 'uses_product'""",
)
def _(s):
    return catalog.active_relationships(s.rels, ["uses_product"])
