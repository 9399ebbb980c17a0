"""Tables kept in step with their sources: erasure, refresh, two-time lookups, running streams, near-equal entities."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.meaning import _prepared as prepared
from checks.registry import case, pct
from checks.samples import c, text
from factloom.operators import similarity, temporal
from factloom.operators.bitemporal import bt_asof
from factloom.operators.erasure import Held, erase_everywhere
from factloom.operators.etl import denormalise
from factloom.operators.refresh import changed_keys, refresh_surface
from factloom.sources import catalog
from factloom.sources.surface import write_surface
from factloom.streaming import seen, windows

GIVEN = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@case(
    "s05_erase_everywhere",
    "",
    """WITH gone_facts AS (SELECT o_orderkey FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_acctbal < -950),
    gone_chunks AS (SELECT l_orderkey * 10 + l_linenumber AS chunk_id FROM lineitem WHERE l_orderkey IN (FROM gone_facts)),
    digests AS (SELECT l_partkey AS digest_id, array_agg(DISTINCT l_orderkey * 10 + l_linenumber) AS chunk_ids FROM lineitem GROUP BY 1)
    SELECT 'facts' AS held_in, o_orderkey AS id, COUNT(*) AS n FROM orders WHERE o_orderkey NOT IN (FROM gone_facts) GROUP BY 2
    UNION ALL SELECT 'chunks', l_orderkey * 10 + l_linenumber, COUNT(*) FROM lineitem WHERE l_orderkey * 10 + l_linenumber NOT IN (FROM gone_chunks) GROUP BY 2
    UNION ALL SELECT 'digests', digest_id, 1 FROM digests
      WHERE digest_id NOT IN (SELECT l_partkey FROM lineitem WHERE l_orderkey * 10 + l_linenumber IN (FROM gone_chunks))""",
)
def _(s):
    """Orders as facts of customers, their lines as chunks, and per part a digest of its chunks; customers deep in debt are forgotten."""
    root = s.folder()
    chunk = (c("l_orderkey") * 10 + c("l_linenumber")).alias("chunk_id")
    chunks = s.t("lineitem").select(chunk, c("l_orderkey").alias("fact_id"), "l_partkey", "l_quantity")
    facts = s.t("orders").select(c("o_orderkey").alias("fact_id"), "o_custkey", "o_totalprice")
    digests = chunks.groupBy(c("l_partkey").alias("digest_id")).agg(F.collect_set("chunk_id").alias("chunk_ids"))
    for name, rows, key in (("facts", facts, "fact_id"), ("chunks", chunks, "chunk_id"), ("digests", digests, "digest_id")):
        rows.repartitionByRange(8, key).write.parquet(f"{root}/{name}")
    tables = [
        Held("facts", f"{root}/facts", "fact_id", (("o_custkey", "customer"),)),
        Held("chunks", f"{root}/chunks", "chunk_id", (("fact_id", "facts"),)),
        Held("digests", f"{root}/digests", None, (("chunk_ids", "chunks"),)),
    ]
    asked = s.t("customer").filter(c("c_acctbal") < -950).select(F.lit("customer").alias("table_name"), c("c_custkey").alias("record_id"))
    erase_everywhere(s.spark, tables, asked, f"{root}/journal")
    left = [s.spark.read.parquet(f"{root}/{n}").groupBy(F.lit(n).alias("held_in"), c(k).alias("id")).count() for n, k in (("facts", "fact_id"), ("chunks", "chunk_id"), ("digests", "digest_id"))]
    return left[0].unionByName(left[1]).unionByName(left[2]).withColumnRenamed("count", "n")


@case(
    "io4_incremental_refresh",
    "",
    "SELECT c_nationkey, c_custkey, c_name, c_acctbal, n_name, n_regionkey, r_name FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey",
)
def _(s):
    """A surface written from an older state of its tables, brought up to the given one by what differs."""
    path = f"{s.folder()}/surface"
    accounts = s.t("customer").select("c_custkey", "c_name", "c_acctbal", "c_nationkey")
    nations = s.t("nation").select(c("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    regions = s.t("region").select(c("r_regionkey").alias("n_regionkey"), "r_name")
    # Then: some accounts were not there, some held other values or belonged elsewhere, some are gone now.
    key, nation = c("c_custkey"), c("c_nationkey")
    then = accounts.filter(~((nation == 2) & (key % 5 == 0))).withColumns(
        {
            "c_acctbal": F.when((nation == 7) & (key % 3 == 0), c("c_acctbal") - 1).otherwise(c("c_acctbal")),
            "c_nationkey": F.when((nation == 9) & (key % 4 == 0), F.lit(11)).otherwise(nation),
        }
    )
    then = then.unionByName(accounts.filter(nation == 4).withColumn("c_custkey", -1 - key))
    nations_then = nations.withColumn("n_name", F.when(c("c_nationkey") == 5, "OLD NAME").otherwise(c("n_name")))
    write_surface(denormalise(then, [(nations_then, "c_nationkey"), (regions, "n_regionkey")]), path, ["c_nationkey"])
    refresh_surface(
        s.spark,
        path,
        accounts,
        [(nations, "c_nationkey"), (regions, "n_regionkey")],
        ["c_custkey"],
        ["c_nationkey"],
        changed_keys(then, accounts, ["c_custkey"]),
        {0: changed_keys(nations_then, nations, ["c_nationkey"])},
    )
    return s.spark.read.parquet(path)


@case(
    "t05_bt_asof_requests",
    "bi",
    """SELECT o_orderkey, canonical_id, valid_at, known_at, CASE WHEN open_still THEN valid_from END AS version_valid_from,
    CASE WHEN open_still THEN version_id END AS version_version_id, CASE WHEN open_still THEN annual_value_usd END AS version_annual_value_usd
    FROM (SELECT q.*, b.* EXCLUDE (canonical_id), b.valid_to IS NULL OR b.valid_to > valid_at AS open_still
      FROM (SELECT o_orderkey, o_custkey AS canonical_id, o_orderdate + to_days(CAST(o_orderkey % 200 AS INTEGER)) AS valid_at,
        o_orderdate + to_days(CAST(o_orderkey % 200 + o_orderkey % 77 AS INTEGER)) AS known_at FROM orders) q
      LEFT JOIN bi b ON b.canonical_id = q.canonical_id AND b.valid_from <= valid_at AND b.recorded_from <= known_at AND (b.recorded_to IS NULL OR b.recorded_to > known_at)
      QUALIFY ROW_NUMBER() OVER (PARTITION BY o_orderkey ORDER BY b.valid_from DESC NULLS LAST, b.recorded_from DESC, version_id DESC) = 1)""",
)
def _(s):
    """For every order, the line believed at one time to hold at another."""
    days = (c("o_orderkey") % 200).cast("int")
    requests = s.t("orders").select(
        "o_orderkey",
        c("o_custkey").alias("canonical_id"),
        (c("o_orderdate") + F.make_dt_interval(days=days)).alias("valid_at"),
        (c("o_orderdate") + F.make_dt_interval(days=days + (c("o_orderkey") % 77).cast("int"))).alias("known_at"),
    )
    return bt_asof(requests, s.bi, ["canonical_id"], ["version_id", "annual_value_usd"], ["version_id"])


def _folded_sql(seen: str) -> str:
    return f"""SELECT u.user_id AS stream_id, n AS event_count, '{{' || COALESCE(state, '') || '}}' AS state
    FROM (SELECT user_id, COUNT(*) AS n FROM events WHERE {seen} GROUP BY 1) u LEFT JOIN (
      SELECT stream_id, string_agg('"' || attribute || '":"' || value || '"', ',' ORDER BY attribute) AS state
      FROM ({_last_sql(seen)}) WHERE value IS NOT NULL GROUP BY 1) s ON s.stream_id = u.user_id"""


def _last_sql(seen: str) -> str:
    """The last write of each attribute, also if it took the attribute away."""
    rows = f"""SELECT user_id AS stream_id, event_id, ts, event_type AS attribute, CASE WHEN value >= 3 THEN json_extract_string(props, '$.k') END AS value FROM events WHERE {seen}
    UNION ALL SELECT user_id, event_id, ts, 'last_kind', event_type FROM events WHERE {seen}"""
    return f"SELECT * FROM ({rows}) QUALIFY ROW_NUMBER() OVER (PARTITION BY stream_id, attribute ORDER BY ts DESC, event_id DESC) = 1"


def _writes(s):
    """Events that write an attribute named by their kind, or take it away, and the last kind."""
    k = F.get_json_object("event_data", "$.k")
    small = s.t("events").select("event_id", c("value").alias("_value"))
    value = F.when(c("_value") < 3, "null").otherwise(k)
    data = text('{"', c("event_type"), '": ', value, ', "last_kind": "', c("event_type"), '"}')
    return s.evt.join(small, "event_id").withColumn("event_data", data)


@case("t08_event_fold", "", _folded_sql("TRUE"))
def _(s):
    return temporal.event_fold(_writes(s)).select("stream_id", "event_count", F.to_json("state").alias("state"))


@case("t08_event_fold_as_of", "", _folded_sql("ts + to_seconds(event_id % 60) <= TIMESTAMP '2024-01-12 12:00:00'"))
def _(s):
    return temporal.event_fold(_writes(s), "2024-01-12 12:00:00").select("stream_id", "event_count", F.to_json("state").alias("state"))


WORDS = r"list_sort(list_distinct(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')))"


@case(
    "o09_near_duplicate_rate",
    "",
    f"""WITH words AS (SELECT doc_id, {WORDS} AS w FROM documents),
    sets AS (SELECT w, MIN(doc_id) AS set_id, len(w) AS n, row_number() OVER () AS k FROM words GROUP BY w),
    tokens AS (SELECT set_id, n, UNNEST(w) AS t FROM sets),
    rare AS (SELECT *, row_number() OVER (PARTITION BY set_id ORDER BY f, t) AS p FROM (SELECT *, COUNT(*) OVER (PARTITION BY t) AS f FROM tokens)),
    first AS (SELECT set_id, n, t FROM rare WHERE p <= n - CAST(ceil(0.9 * n - 1e-9) AS BIGINT) + 1),
    met AS (SELECT DISTINCT a.set_id AS low, b.set_id AS high FROM first a JOIN first b ON a.t = b.t AND a.set_id < b.set_id AND a.n >= 0.9 * b.n - 1e-9 AND b.n >= 0.9 * a.n - 1e-9),
    near AS (SELECT low, high FROM met JOIN sets a ON a.set_id = low JOIN sets b ON b.set_id = high
      WHERE len(list_intersect(a.w, b.w)) >= 0.9 * (a.n + b.n - len(list_intersect(a.w, b.w))) - 1e-9),
    judged AS (SELECT doc_id, set_id < doc_id OR set_id IN (SELECT high FROM near) OR COALESCE(m.low < doc_id, FALSE) AS again
      FROM words JOIN sets USING (w) LEFT JOIN (SELECT set, MIN(other) AS low FROM (SELECT low AS set, high AS other FROM near UNION ALL SELECT high, low FROM near) GROUP BY 1) m ON m.set = set_id),
    weeks AS (SELECT CAST(date_trunc('week', DATE '2024-01-01' + CAST(doc_id % 60 AS INTEGER)) AS DATE) AS week, COUNT(*) AS rows, COUNT(*) FILTER (WHERE again) AS repeats
      FROM judged GROUP BY 1)
    SELECT *, COALESCE(change_points > 2, FALSE) AS breach FROM (SELECT *, ROUND(duplicate_pct - LAG(duplicate_pct) OVER (ORDER BY week), 2) AS change_points
      FROM (SELECT *, {pct("repeats", "rows")} AS duplicate_pct FROM weeks))""",
    as_text="week",
)
def _(s):
    docs = s.t("documents").withColumn("at", F.date_add(F.lit("2024-01-01").cast("date"), (c("doc_id") % 60).cast("int")))
    return similarity.near_duplicate_rate(docs, "doc_id", "text", "at")


#: Rows come in three batches by time; every fiftieth is a batch late, or two.
BATCH = """LEAST(2, CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 0 WHEN ts < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END + CASE WHEN event_id % 50 = 0 THEN 1 + event_id % 100 // 50 ELSE 0 END)"""
WINDOWED = f"""WITH come AS (SELECT *, {BATCH} AS batch FROM events),
    marks AS (SELECT b.batch, (SELECT MAX(ts) FROM come WHERE come.batch < b.batch) - INTERVAL 2 HOURS AS mark FROM (SELECT DISTINCT batch FROM come) b),
    placed AS (SELECT come.*, date_trunc('hour', ts) AS window_start, COALESCE(date_trunc('hour', ts) + INTERVAL 1 HOUR <= mark, FALSE) AS late FROM come JOIN marks USING (batch))"""


def _late_events(s):
    """Events in three files, in time but for some."""
    turn = F.when(c("ts") < F.lit("2024-01-11").cast("timestamp_ntz"), 0).when(c("ts") < F.lit("2024-01-21").cast("timestamp_ntz"), 1).otherwise(2)
    behind = F.when(c("event_id") % 50 == 0, 1 + F.floor(c("event_id") % 100 / 50)).otherwise(0)
    return F.least(F.lit(2), turn + behind).cast("int")


@case(
    "o13_failure_rate_stream",
    "",
    f"""{WINDOWED} SELECT window_start, SUM(1) FILTER (WHERE NOT late)::BIGINT AS attempts, SUM(CASE WHEN value < 1 THEN 1 ELSE 0 END) FILTER (WHERE NOT late)::BIGINT AS failures,
    COUNT(*) FILTER (WHERE late) AS late_rows FROM placed GROUP BY 1""",
    as_text="attempts failures",
)
def _(s):
    """Windows of a stream and the rows too late for them, which together are the input."""
    root = s.folder()
    rows = s.t("events").withColumn("succeeded", c("value") >= 1)
    windows.failure_rate_stream(s.in_files(rows, _late_events(s), 3, f"{root}/in"), root, f"{root}/progress", "ts").awaitTermination()
    found = windows.read_failure_rates(s.spark, root).select("window_start", "attempts", "failures")
    late = windows.read_late(s.spark, root).groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("window_start")).agg(F.count("*").alias("late_rows"))
    return found.join(late, "window_start", "full").select("window_start", "attempts", "failures", F.coalesce("late_rows", F.lit(0)).alias("late_rows"))


@case(
    "o02_freshness_stream",
    "",
    f"""{WINDOWED} SELECT window_start, event_type, COUNT(*) AS updates, ROUND(SUM(event_id % 60) * 1000000.0::DOUBLE / (COUNT(*) * 60000000), 4) AS mean_lag_minutes,
    COUNT(*) FILTER (WHERE event_id % 60 > 30) AS beyond_sla FROM placed WHERE NOT late GROUP BY 1, 2""",
)
def _(s):
    """How long before they were seen things changed, in seconds up to a minute; half a minute is allowed here."""
    root = s.folder()
    rows = s.t("events").withColumn("changed", c("ts") - F.make_dt_interval(secs=(c("event_id") % 60).cast("decimal(18,6)")))
    stream = s.in_files(rows, _late_events(s), 3, f"{root}/in")
    windows.freshness_stream(stream, root, f"{root}/progress", "changed", "ts", 0.5, ["event_type"]).awaitTermination()
    return windows.read_freshness(s.spark, root, ["event_type"]).select("window_start", "event_type", "updates", "mean_lag_minutes", "beyond_sla")


COSINE = """(length(a) * length(b) + CAST(user_id AS DOUBLE) * user_id + 1.0::DOUBLE) /
    (sqrt(length(a) * length(a) + CAST(user_id AS DOUBLE) * user_id + 1.0::DOUBLE) * sqrt(length(b) * length(b) + CAST(user_id AS DOUBLE) * user_id + 1.0::DOUBLE))"""


@case(
    "st2_seen_stream",
    "",
    f"""SELECT 'account#' || user_id AS id, 'account ' || user_id || ' ' || now AS text FROM walk WHERE through""",
    recursive=f"""newest AS (SELECT user_id, event_type, batch FROM (SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 0 WHEN ts < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END AS batch FROM events WHERE value >= 4)
      QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id, batch ORDER BY ts DESC) = 1),
    turns AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY batch) AS turn FROM newest),
    walk AS (SELECT user_id, turn, event_type AS now, event_type AS held, TRUE AS through FROM turns WHERE turn = 1
      UNION ALL SELECT user_id, turn, b AS now, CASE WHEN differs THEN b ELSE a END, differs FROM (
        SELECT w.user_id, t.turn, w.held AS a, t.event_type AS b, a <> b AND {COSINE.replace("user_id", "w.user_id")} < 0.98 AS differs
        FROM walk w JOIN turns t ON t.user_id = w.user_id AND t.turn = w.turn + 1))""",
)
def _(s):
    """Significant changes in three batches, the last after a restart; what was seen is Spark's state."""
    root = s.folder()
    third = F.when(c("ts") < F.lit("2024-01-11").cast("timestamp_ntz"), 0).when(c("ts") < F.lit("2024-01-21").cast("timestamp_ntz"), 1).otherwise(2)
    stream = s.queue(s.in_files(s.t("events"), third, 2, f"{root}/in"))
    seen.seen_stream(stream, root, f"{root}/progress", prepared).awaitTermination()
    s.in_files(s.t("events"), third - 2, 1, f"{root}/in")
    seen.seen_stream(stream, root, f"{root}/progress", prepared).awaitTermination()
    return s.spark.read.parquet(f"{root}/index").select("id", "text")


@case(
    "io2_catalog_columns",
    "",
    f"""SELECT table_name, column_name, CAST(ordinal_position - 1 AS INTEGER) AS ordinal,
    CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'FLOAT[]' THEN 'array<float>'
      WHEN 'DOUBLE[]' THEN 'array<double>' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'DATE' THEN 'date' ELSE lower(data_type) END AS data_type
    FROM information_schema.columns WHERE table_name IN ({", ".join(f"'{t}'" for t in GIVEN)})""",
)
def _(s):
    return catalog.catalog_columns(s.spark, {t: s.t(t) for t in GIVEN}).select("table_name", "column_name", "ordinal", "data_type")
