"""Glossary, embeddings, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.operations import BREAKER
from checks.registry import case, rounded
from checks.samples import c, text
from factloom.functions.vectors import cosine
from factloom.operators import embeddings, semantic
from factloom.operators.temporal import open_ended
from factloom.streaming import changes, stateful

ENTRY = "canonical_term, definition, calculation, array_to_string(synonyms, '|') AS synonyms, COALESCE(array_to_string(excludes, '|'), '') AS excludes, business_context"


@case("k01_term_references", "refs", "SELECT * FROM refs")
def _(s):
    return semantic.term_references(s.descriptions)


@case(
    "k02_resolve_terms",
    "refs names",
    f"SELECT table_name, column_name, ref_position, r.term, {ENTRY} FROM refs r JOIN names n ON n.term = r.term",
)
def _(s):
    found = semantic.resolve_terms(semantic.term_references(s.descriptions), s.glossary)
    return found.withColumn("synonyms", F.array_join("synonyms", "|")).withColumn(
        "excludes", F.array_join("excludes", "|")
    )


# Only terms of columns that the records have: lang and n_chars.
RECORD_TERMS = """SELECT DISTINCT table_name, r.term, canonical_term, definition FROM data_refs r JOIN names n ON n.term = r.term
    WHERE column_name IN ('lang', 'n_chars')"""


@case(
    "k03_enrich",
    "data_refs names",
    f"""SELECT doc_id AS record_id, lang, n_chars, terms, COALESCE(n, 0) AS total_terms_expanded FROM documents LEFT JOIN (
    SELECT table_name, string_agg(term || '=' || canonical_term, '|' ORDER BY term) AS terms, CAST(COUNT(*) AS INTEGER) AS n
    FROM ({RECORD_TERMS}) GROUP BY table_name) ON table_name = source""",
)
def _(s):
    found = semantic.enrich(s.records, s.data_descriptions, s.glossary)
    terms = F.transform(
        F.array_sort(F.map_entries("semantic_context")), lambda e: text(e["key"], "=", e["value"]["canonical_term"])
    )
    return found.select(
        "record_id", "data_values.lang", "data_values.n_chars", F.array_join(terms, "|").alias("terms"), "total_terms_expanded"
    )


@case(
    "v03_assemble_text",
    "data_refs names",
    f"""SELECT source AS table_name, doc_id AS record_id, concat_ws(chr(10), concat_ws(', ', 'lang: ' || lang, 'n_chars: ' || n_chars), notes) AS text
    FROM documents LEFT JOIN (SELECT table_name, string_agg(term || ' = ' || definition, '; ' ORDER BY term) AS notes
    FROM ({RECORD_TERMS}) GROUP BY table_name) ON table_name = source""",
)
def _(s):
    return semantic.assemble_text(s.records, s.data_descriptions, s.glossary)


def _upsert(s):
    rows = s.t("customer").select(
        c("c_name").alias("canonical_term"),
        c("c_mktsegment").alias("definition"),
        F.when(c("c_acctbal") < 0, "under_review").alias("status"),
    )
    repeated = s.t("supplier").select(
        c("s_name").alias("canonical_term"), F.lit("again").alias("definition"), F.lit("active").alias("status")
    )
    return semantic.glossary_upsert(s.glossary, rows.unionByName(repeated), "2024-01-01")


@case(
    "k04_glossary_upsert",
    "glossary",
    """SELECT canonical_term, definition, status FROM glossary UNION ALL
    SELECT c_name, c_mktsegment, CASE WHEN c_acctbal < 0 THEN 'under_review' ELSE 'active' END FROM customer""",
)
def _(s):
    return _upsert(s)[0].select("canonical_term", "definition", "status")


@case("k04_glossary_refused", "", "SELECT s_name AS canonical_term, 'again' AS definition FROM supplier")
def _(s):
    return _upsert(s)[1].select("canonical_term", "definition")


@case(
    "k05_glossary_issues",
    "refs claims names",
    """SELECT 'UNDEFINED_REFERENCE' AS issue, term, COUNT(*) AS occurrences FROM refs WHERE term NOT IN (SELECT term FROM names) GROUP BY term
    UNION ALL SELECT 'AMBIGUOUS_NAME', term, COUNT(DISTINCT canonical_term) FROM claims GROUP BY term HAVING COUNT(DISTINCT canonical_term) > 1""",
)
def _(s):
    return semantic.glossary_issues(s.descriptions, s.glossary)


@case(
    "k05_term_closure",
    "glossary",
    "SELECT canonical_term, related_term, MIN(depth) AS depth FROM walk GROUP BY 1, 2",
    recursive="""walk AS (SELECT canonical_term, is_a AS related_term, 1 AS depth FROM glossary WHERE is_a IS NOT NULL UNION
    SELECT w.canonical_term, g.is_a, depth + 1 FROM walk w JOIN glossary g ON g.canonical_term = w.related_term WHERE g.is_a IS NOT NULL)""",
)
def _(s):
    return semantic.term_closure(s.glossary)


SIM = "list_dot_product(o.embedding, n.embedding) / (sqrt(list_dot_product(o.embedding, o.embedding)) * sqrt(list_dot_product(n.embedding, n.embedding)))"


@case(
    "v01_reembed_decisions",
    "vec new_vec",
    f"""SELECT vec_id, NOT (same OR sim >= 0.98) AS should_reembed, CASE WHEN same THEN 'content_unchanged'
    WHEN sim >= 0.98 THEN 'embedding_stable (similarity=' || printf('%.4f', sim) || ')' ELSE 'content_changed' END AS reason
    FROM (SELECT n.vec_id, o.label = n.label AS same, {SIM} AS sim FROM new_vec n JOIN vec o ON o.vec_id = n.vec_id)""",
)
def _(s):
    return embeddings.reembed_decisions(s.vec, s.new_vec, "vec_id", ["label"])


@case(
    "v02_cosine",
    "vec new_vec",
    f"SELECT n.vec_id, {rounded(SIM, 6)} AS similarity FROM new_vec n JOIN vec o ON o.vec_id = n.vec_id",
)
def _(s):
    old = s.vec.select("vec_id", c("embedding").alias("o"))
    pairs = s.new_vec.join(old, "vec_id")
    return pairs.select("vec_id", F.round(cosine(c("embedding"), c("o")).cast("decimal(20,10)"), 6).cast("double").alias("similarity"))


UNITS = """(SELECT vec_id, label, list_transform(embedding, lambda x: x / greatest(sqrt(list_dot_product(embedding, embedding)), 1e-9)) AS u FROM {t})"""


def _coherence_sql(pairs: str, concept: str, group: str) -> str:
    return f"""SELECT {concept} AS concept, CASE WHEN n >= 10 THEN {rounded("m", 4)} END AS coherence_score, n AS sample_size,
    CASE WHEN n >= 10 THEN CASE WHEN m > 0.85 THEN 'OK' WHEN m > 0.70 THEN 'WARN' ELSE 'FRAGMENTED' END END AS status,
    CASE WHEN n < 10 THEN 'insufficient_sample' END AS warning
    FROM (SELECT {concept}, COUNT(DISTINCT a.vec_id) AS n, AVG(list_dot_product(a.u, b.u)) AS m FROM {pairs} a JOIN {pairs} b ON a.vec_id <> b.vec_id {group})"""


@case(
    "o04_coherence_by_group",
    "vec",
    _coherence_sql("units", "concept", "AND a.label = b.label GROUP BY concept").replace(
        "SELECT concept, COUNT", "SELECT CAST(a.label AS VARCHAR) AS concept, COUNT"
    ).replace("units", UNITS.format(t="vec")),
)
def _(s):
    return embeddings.coherence_by_group(s.vec, "label")


TOP = f"""(SELECT v.vec_id, v.label, v.embedding FROM vec v, (SELECT embedding AS q FROM vec WHERE vec_id = (SELECT MIN(vec_id) FROM vec))
    ORDER BY list_dot_product(v.embedding, q) / (sqrt(list_dot_product(v.embedding, v.embedding)) * sqrt(list_dot_product(q, q))) DESC, v.vec_id LIMIT 100)"""


@case(
    "o04_coherence",
    "vec",
    _coherence_sql("units", "'first'", "").replace("SELECT 'first', COUNT", "SELECT COUNT").replace(
        "units", UNITS.format(t=TOP)
    ),
)
def _(s):
    query = s.vec.agg(F.min_by("embedding", "vec_id")).first()[0]
    return embeddings.coherence(s.vec, query, concept="first")


@case(
    "o05_knn",
    "vec",
    f"""SELECT query_id, vec_id, {rounded("sim", 6)} AS similarity, CAST(rank AS INTEGER) AS rank FROM (
    SELECT n.label AS query_id, o.vec_id, {SIM} AS sim, ROW_NUMBER() OVER (PARTITION BY n.label ORDER BY {SIM} DESC, o.vec_id) AS rank
    FROM (SELECT * FROM vec QUALIFY ROW_NUMBER() OVER (PARTITION BY label ORDER BY vec_id) = 1) n, vec o) WHERE rank <= 20""",
)
def _(s):
    """The 20 vectors of the whole table nearest to the first vector of every label."""
    first = s.vec.groupBy(c("label").alias("query_id")).agg(F.min_by("embedding", "vec_id").alias("embedding"))
    found = embeddings.knn(s.vec, first, 20)
    return found.withColumn("similarity", F.round(c("similarity").cast("decimal(20,10)"), 6).cast("double"))


@case(
    "o05_knn_all",
    "vec",
    f"""SELECT query_id, vec_id, {rounded("sim", 6)} AS similarity, CAST(rank AS INTEGER) AS rank FROM (
    SELECT n.vec_id AS query_id, o.vec_id, {SIM} AS sim, ROW_NUMBER() OVER (PARTITION BY n.vec_id ORDER BY {SIM} DESC, o.vec_id) AS rank
    FROM vec n, vec o) WHERE rank <= 5""",
)
def _(s):
    """The 5 vectors nearest to every vector of the table, by cells around pivots."""
    found, _ = embeddings.knn_search(s.vec, s.vec.select(c("vec_id").alias("query_id"), "embedding"), 5)
    return found.withColumn("similarity", F.round(c("similarity").cast("decimal(20,10)"), 6).cast("double"))


STAMP = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')"


@case(
    "st1_parse_changes",
    "",
    f"""SELECT event_id, CASE WHEN value >= 2 THEN 'account' END AS source_table, CASE WHEN value >= 4 THEN CAST(user_id AS VARCHAR) END AS entity_id,
    CASE WHEN value >= 4 THEN {STAMP} END AS source_version,
    CASE WHEN value < 2 THEN 'MALFORMED' WHEN value < 4 THEN 'NO_KEY' END AS problem FROM events""",
)
def _(s):
    """The queue is read as a stream to its end and the parsed messages are stored."""
    root = s.folder()
    parsed = changes.parse_changes(s.queue(s.stream("events"))).drop("body", "source_record")
    parsed = parsed.withColumn("source_table", F.when(c("problem").isNull() | (c("problem") == "NO_KEY"), c("source_table")))
    query = (
        parsed.writeStream.format("parquet")
        .option("path", f"{root}/parsed")
        .option("checkpointLocation", f"{root}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return s.spark.read.schema(parsed.schema).parquet(f"{root}/parsed")


def _prepared(batch):
    kind = F.get_json_object("source_record", "$.kind")
    return batch.withColumn("text", text("account ", c("entity_id"), " ", kind)).withColumn(
        "embedding", F.array(F.length(kind).cast("double"), c("entity_id").cast("double"), F.lit(1.0))
    )


@case(
    "st2_significant_changes",
    "",
    f"""SELECT 'account#' || n.user_id AS id, 'account ' || n.user_id || ' ' || n.event_type AS text FROM
    (SELECT * FROM events WHERE value >= 4 QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) n
    LEFT JOIN (SELECT * FROM events WHERE value >= 4 AND ts < TIMESTAMP '2024-01-29' QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) o
    ON o.user_id = n.user_id WHERE o.user_id IS NULL OR (o.event_type <> n.event_type AND
    (length(o.event_type) * length(n.event_type) + CAST(n.user_id AS DOUBLE) * n.user_id + 1.0::DOUBLE) /
    (sqrt(length(o.event_type) * length(o.event_type) + CAST(n.user_id AS DOUBLE) * n.user_id + 1.0::DOUBLE) * sqrt(length(n.event_type) * length(n.event_type) + CAST(n.user_id AS DOUBLE) * n.user_id + 1.0::DOUBLE)) < 0.98)""",
)
def _(s):
    def documents(events):
        good, _ = changes.split_changes(changes.parse_changes(s.queue(events)))
        return changes.as_documents(_prepared(changes.latest_changes(good, ["event_id"])), F.lit(0))

    before = documents(s.t("events").filter(c("ts") < F.lit("2024-01-29").cast("timestamp_ntz")))
    return changes.significant_changes(documents(s.t("events")), before).select("id", "text")


@case(
    "st3_index_stream",
    "usable",
    f"""SELECT 'account#' || user_id AS id, 'account ' || user_id || ' ' || event_type AS text, CAST(user_id AS VARCHAR) AS entity_id,
    'account' AS entity_type, {STAMP} AS source_version, CAST(user_id AS VARCHAR) AS source_record_id, 'account' AS source_table FROM usable""",
)
def _(s):
    root = s.folder()
    changes.index_stream(
        s.queue(s.stream("events")), root, f"{root}/progress", _prepared, tiebreak=["event_id"]
    ).awaitTermination()
    return changes.read_index(s.spark, f"{root}/index").drop("embedding", "indexed_at", "semantic_context")


@case(
    "st3_index_outcomes",
    "",
    "SELECT COUNT(*) FILTER (WHERE value >= 4) AS succeeded, COUNT(*) FILTER (WHERE value < 4) AS failed FROM events",
)
def _(s):
    root = s.folder()
    changes.index_stream(
        s.queue(s.stream("events")), root, f"{root}/progress", _prepared, tiebreak=["event_id"]
    ).awaitTermination()
    outcomes = s.spark.read.parquet(f"{root}/outcomes")
    return outcomes.agg(F.sum("succeeded").alias("succeeded"), F.sum("failed").alias("failed"))


@case("st4_breaker_stream", "runs", BREAKER[0], recursive=BREAKER[1])
def _(s):
    """Results in three batches by time; the last one comes with a new checkpoint."""
    root = s.folder()
    third = F.when(c("at") < F.lit("2024-01-11").cast("timestamp_ntz"), 0).when(c("at") < F.lit("2024-01-21").cast("timestamp_ntz"), 1).otherwise(2)
    stateful.breaker_stream(s.in_files(s.runs, third, 2, f"{root}/in"), root, f"{root}/progress").awaitTermination()
    stateful.breaker_stream(s.in_files(s.runs, third - 2, 1, f"{root}/late"), root, f"{root}/new").awaitTermination()
    return s.spark.read.parquet(f"{root}/states").drop("run", "batch", "last_failure_micros")


def _versions(s):
    """Orders in three batches by the rest of their key, the last one with a new checkpoint."""
    root = s.folder()
    rows = s.t("orders").select("o_custkey", c("o_orderdate").alias("valid_from"), "o_orderkey", "o_totalprice")
    third = (c("o_orderkey") % 3).cast("int")
    stateful.scd2_stream(s.in_files(rows, third, 2, f"{root}/in"), f"{root}/out", f"{root}/progress").awaitTermination()
    stateful.scd2_stream(s.in_files(rows, third - 2, 1, f"{root}/late"), f"{root}/out", f"{root}/new").awaitTermination()
    return f"{root}/out"


FIRST = "ROW_NUMBER() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey % 3, o_orderkey)"


@case(
    "st5_scd2_stream",
    "",
    f"""SELECT *, LEAD(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from) AS valid_to
    FROM (SELECT o_custkey, o_orderdate AS valid_from, o_orderkey, o_totalprice FROM orders QUALIFY {FIRST} = 1)""",
)
def _(s):
    return stateful.read_versions(s.spark, _versions(s), ["o_custkey"])


@case(
    "st5_refused_changes",
    "",
    f"""SELECT o_custkey, o_orderdate AS valid_from, o_orderkey, o_totalprice,
    CASE WHEN o_orderkey % 3 > FIRST_VALUE(o_orderkey % 3) OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey % 3, o_orderkey)
    THEN 'HELD_START' ELSE 'SAME_START' END AS reason FROM orders QUALIFY {FIRST} > 1""",
)
def _(s):
    return stateful.read_refused(s.spark, _versions(s), ["o_custkey"])
