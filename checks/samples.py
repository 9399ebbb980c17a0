"""Governed sample tables built on Spark from the driver's Parquet tables.

``checks/views.py`` holds the same tables in SQL for the comparison engine.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions.confidence import source_confidence
from factloom.operators.temporal import open_ended
from factloom.plans.sequence import numbered
from factloom.session import configure, shared_folder


def text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def c(name: str) -> Column:
    return F.col(name)


def choose(column: Column, table: dict, otherwise=None) -> Column:
    out = F.when(F.lit(False), F.lit(None))
    for key, value in table.items():
        out = out.when(column == key, F.lit(value))
    return out.otherwise(F.lit(otherwise))


def ntz(value: str) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def half(n: Column, by: int = 2) -> Column:
    return F.floor(n / F.lit(by)).cast("long")


class Samples:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = configure(spark)
        self.dir = sf_dir

    def t(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def stream(self, name: str) -> DataFrame:
        schema = self.t(name).schema
        return (
            self.spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(self.dir)
        )

    def in_files(self, rows: DataFrame, by: Column, files: int, path: str) -> DataFrame:
        """``rows`` as a stream that brings a file a batch: those with ``by`` 0, then 1, up to ``files`` - 1."""
        for number in range(files):
            rows.filter(by == number).coalesce(1).write.mode("append").parquet(path)
        return self.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)

    def folder(self) -> str:
        """A new folder that every executor can reach."""
        return f"{shared_folder(self.spark)}/run-{uuid.uuid4().hex}"

    # facts -------------------------------------------------------------------------------

    @cached_property
    def fact_rows(self) -> DataFrame:
        """One version per customer and order date, without its end."""
        kept = F.struct("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
        day = (
            self.t("orders")
            .groupBy(c("o_custkey").alias("canonical_id"), c("o_orderdate").alias("valid_from"))
            .agg(F.max_by(kept, "o_orderkey").alias("o"))
        )
        source = choose(
            c("o.o_orderpriority"),
            {
                "1-URGENT": "government_registry",
                "2-HIGH": "operational_system",
                "3-MEDIUM": "third_party_data_provider",
                "5-LOW": "ml_model_inference",
            },
            "rumour",
        )
        rows = day.select(
            "canonical_id",
            text("Customer ", c("canonical_id")).alias("legal_name"),
            (c("o.o_orderkey") % 1000).cast("int").alias("employee_count"),
            c("o.o_totalprice").alias("annual_revenue_usd"),
            "valid_from",
            (c("valid_from") + F.make_dt_interval(hours=(c("o.o_orderkey") % 24).cast("int"))).alias(
                "asserted_at"
            ),
            source.alias("source_type"),
            c("o.o_orderstatus").alias("status"),
            F.when(c("o.o_orderpriority") == "5-LOW", "stable")
            .otherwise(choose(c("o.o_orderstatus"), {"O": "fast", "P": "medium"}, "slow"))
            .alias("rate_of_change_class"),
        )
        return rows.withColumn("confidence", source_confidence(c("source_type"))).withColumn(
            "record_confidence", F.when(c("status") != "P", c("confidence"))
        )

    @cached_property
    def fact(self) -> DataFrame:
        return open_ended(self.fact_rows, ["canonical_id"], "valid_from", "valid_to")

    @cached_property
    def exceptions(self) -> DataFrame:
        customer = self.t("customer")

        def part(table: str, field: str, value: float, where: Column) -> DataFrame:
            return customer.filter(where).select(
                F.lit(table).alias("fact_table"),
                c("c_custkey").alias("fact_id"),
                F.lit(field).alias("field_name"),
                F.lit(value).alias("field_confidence"),
            )

        building, machinery = c("c_mktsegment") == "BUILDING", c("c_mktsegment") == "MACHINERY"
        return (
            part("fact_customer_core", "legal_name", 0.55, building | machinery)
            .unionByName(part("fact_customer_core", "employee_count", 0.35, building))
            .unionByName(part("fact_customer_core", "annual_revenue_usd", 0.2, c("c_acctbal") < 0))
            .unionByName(part("fact_contract", "legal_name", 0.9, machinery))
        )

    @cached_property
    def prov(self) -> DataFrame:
        key = c("p_partkey")
        return self.t("part").select(
            key.alias("fact_id"),
            F.when(key > 0, F.array_distinct(F.array(half(key), half(key, 3))))
            .otherwise(F.array().cast("array<bigint>"))
            .alias("input_fact_ids"),
            F.when(key > 0, "transformation").otherwise("source_system").alias("source_type"),
            F.when(c("p_size") <= 25, text("doc-", c("p_brand"))).alias("source_document"),
            F.when(key > 0, text("step-", c("p_type"))).alias("transform_name"),
            F.when(key > 0, 1).otherwise(0).alias("derivation_depth"),
        )

    # relationships -----------------------------------------------------------------------

    @cached_property
    def rels(self) -> DataFrame:
        item = self.t("lineitem")
        uses = item.join(self.t("orders"), c("l_orderkey") == c("o_orderkey")).select(
            text("U", c("l_orderkey"), "-", c("l_linenumber"), "-", c("l_partkey"), "-", c("l_suppkey")).alias(
                "relationship_id"
            ),
            text("C", c("o_custkey")).alias("subject_id"),
            F.lit("Customer").alias("subject_type"),
            F.lit("uses_product").alias("predicate"),
            text("P", c("l_partkey")).alias("object_id"),
            F.lit("Product").alias("object_type"),
            F.lit(False).alias("is_bidirectional"),
            c("o_orderdate").alias("valid_from"),
            F.when(c("l_returnflag") == "R", c("l_shipdate")).alias("valid_to"),
            F.when(c("l_discount") == 0, F.lit(None).cast("double"))
            .when(c("l_tax") == 0, F.lit(0.0))
            .otherwise(F.lit(1.0) - c("l_discount"))
            .alias("confidence"),
            F.lit("orders").alias("source_system"),
        )
        located = self.t("customer").select(
            text("L", c("c_custkey")).alias("relationship_id"),
            text("C", c("c_custkey")).alias("subject_id"),
            F.lit("Customer").alias("subject_type"),
            F.lit("located_in").alias("predicate"),
            text("N", c("c_nationkey")).alias("object_id"),
            F.lit("Location").alias("object_type"),
            F.lit(True).alias("is_bidirectional"),
            ntz("1995-01-01").alias("valid_from"),
            F.lit(None).cast("timestamp_ntz").alias("valid_to"),
            F.lit(0.9).alias("confidence"),
            F.lit("crm").alias("source_system"),
        )
        supplied = (
            item.groupBy("l_partkey", "l_suppkey")
            .agg(F.min("l_shipdate").alias("valid_from"))
            .select(
                text("S", c("l_partkey"), "-", c("l_suppkey")).alias("relationship_id"),
                text("P", c("l_partkey")).alias("subject_id"),
                F.lit("Product").alias("subject_type"),
                F.lit("supplied_by").alias("predicate"),
                text("S", c("l_suppkey")).alias("object_id"),
                F.lit("Supplier").alias("object_type"),
                F.lit(False).alias("is_bidirectional"),
                "valid_from",
                F.lit(None).cast("timestamp_ntz").alias("valid_to"),
                F.lit(0.7).alias("confidence"),
                F.lit("stock").alias("source_system"),
            )
        )
        return uses.unionByName(located).unionByName(supplied)

    @cached_property
    def customers_now(self) -> DataFrame:
        return self.t("customer").select(
            text("C", c("c_custkey")).alias("canonical_id"),
            F.when(c("c_acctbal") <= 0, ntz("2001-01-01")).alias("valid_to"),
        )

    @cached_property
    def replies(self) -> DataFrame:
        kind = c("event_type")
        body = text(
            '{"entities": [{"id": "U', c("user_id"), '", "type": "Customer", "name": "user ', c("user_id"),
            '", "canonical_id_hint": null}, {"id": "E', c("event_id"), '", "type": "',
            F.when(kind == "signup", "Alien").otherwise("Event"), '", "name": "', kind,
            '", "canonical_id_hint": "', c("event_id"), '"}], "relationships": [{"subject_id": "U',
            c("user_id"), '", "predicate": "', F.when(kind == "view", "likes").otherwise("involves"),
            '", "object_id": "E', c("event_id"), '", "confidence": ',
            F.when(c("value") < 20, "0.9").otherwise("0.6"), "}]}",
        )
        return self.t("events").select(
            c("event_id").alias("reply_id"),
            F.when(kind == "error", '{"entities": [')
            .when(kind == "click", text("```json\n", body, "\n```"))
            .otherwise(body)
            .alias("reply"),
        )

    # context, bi-temporal, events --------------------------------------------------------

    @cached_property
    def ctx(self) -> DataFrame:
        return (
            self.t("documents")
            .join(self.t("labels"), "doc_id", "left")
            .select(
                c("doc_id").alias("entity_id"),
                F.lit("document").alias("entity_type"),
                F.when(c("toxic") == 1, "sensitivity")
                .when(c("quality") == 1, "strategic_tier")
                .otherwise("renewal_risk")
                .alias("context_type"),
                c("lang").alias("context_value"),
                text("by-", c("source")).alias("assessed_by"),
                ntz("2024-01-01").alias("assessed_at"),
                F.when(c("lang") != "es", F.date_add(F.lit("2024-01-01").cast("date"), (c("doc_id") % 400).cast("int"))).alias("review_due"),
                F.when(c("lang") == "fr", ntz("2024-03-01")).alias("valid_to"),
            )
        )

    @cached_property
    def ctx_owners(self) -> DataFrame:
        kinds = self.ctx.select("context_type").distinct().filter(c("context_type") != "renewal_risk")
        return kinds.select(
            F.lit("entity_context").alias("table_name"),
            c("context_type").alias("column_name"),
            text(c("context_type"), "@example.org").alias("steward_email"),
        )

    @cached_property
    def chained_ctx(self) -> DataFrame:
        target = F.when(c("lang") == "es", c("doc_id") + 1_000_000_000).when(
            (c("doc_id") > 0) & (F.coalesce(c("quality"), F.lit(0)) == 0), half(c("doc_id"))
        )
        return (
            self.t("documents")
            .join(self.t("labels"), "doc_id", "left")
            .select(c("doc_id").alias("context_id"), target.alias("superseded_by"))
        )

    @cached_property
    def bi(self) -> DataFrame:
        return (
            self.t("lineitem")
            .join(self.t("orders"), c("l_orderkey") == c("o_orderkey"))
            .select(
                c("o_custkey").alias("canonical_id"),
                text(c("l_orderkey"), "-", c("l_linenumber"), "-", c("l_partkey"), "-", c("l_suppkey")).alias(
                    "version_id"
                ),
                c("l_extendedprice").alias("annual_value_usd"),
                c("o_orderdate").alias("valid_from"),
                F.when(c("l_returnflag") == "R", c("l_shipdate")).alias("valid_to"),
                c("l_shipdate").alias("recorded_from"),
                F.when(c("l_linestatus") == "F", c("l_shipdate") + F.make_dt_interval(days=F.lit(90))).alias(
                    "recorded_to"
                ),
            )
        )

    @cached_property
    def evt(self) -> DataFrame:
        rows = self.t("events").select(
            "event_id",
            c("user_id").alias("stream_id"),
            "event_type",
            c("props").alias("event_data"),
            c("ts").alias("occurred_at"),
            (c("ts") + F.make_dt_interval(secs=(c("event_id") % 60).cast("decimal(18,6)"))).alias("recorded_at"),
        )
        return numbered(rows, ["stream_id"], ["occurred_at", "event_id"], "sequence_no")

    @cached_property
    def bad_evt(self) -> DataFrame:
        return self.t("lineitem").select(
            (c("l_orderkey") * 10 + c("l_linenumber")).alias("event_id"),
            c("l_orderkey").alias("stream_id"),
            c("l_linenumber").cast("long").alias("sequence_no"),
            c("l_shipdate").alias("occurred_at"),
            (c("l_shipdate") + F.make_dt_interval(days=(c("l_quantity") - 3).cast("int"))).alias("recorded_at"),
        )

    # accounts ----------------------------------------------------------------------------

    @cached_property
    def acc(self) -> DataFrame:
        last = self.t("orders").groupBy(c("o_custkey").alias("c_custkey")).agg(
            F.max("o_orderdate").alias("updated_at")
        )
        roles = F.when(c("c_nationkey") % 3 == 1, F.array(F.lit("sales"), F.lit("support"))).when(
            c("c_nationkey") % 3 == 2, F.array(F.lit("finance"))
        )
        return (
            self.t("customer")
            .join(self.t("nation"), c("c_nationkey") == c("n_nationkey"))
            .join(last, "c_custkey", "left")
            .select(
                c("c_custkey").alias("account_id"),
                c("c_name").alias("account_name"),
                F.when(c("c_nationkey") != 7, c("c_mktsegment")).alias("account_type"),
                c("n_name").alias("territory_code"),
                (c("c_custkey") % 50).alias("assigned_manager_id"),
                roles.alias("visibility_roles"),
                F.when(c("c_acctbal") > 9000, ntz("2001-06-01")).alias("valid_to"),
                "updated_at",
                c("c_acctbal").alias("adjusted_balance_usd"),
                F.when(c("c_acctbal") < 0, "deleted").when(c("c_nationkey") != 3, "active").alias("status"),
            )
        )

    @cached_property
    def ops(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        accounts = self.t("orders").select(
            c("o_orderkey").alias("account_id"),
            c("o_orderpriority").alias("account_type_code"),
            c("o_custkey").alias("customer_id"),
            c("o_orderstatus").alias("stat"),
            c("o_totalprice").alias("cr_lmt"),
            (c("o_totalprice") - 1000).alias("adj_bal"),
            (c("o_totalprice") > 250000).alias("flg_prm"),
            (c("o_orderpriority") == "1-URGENT").alias("flg_rev"),
            F.lit("orders").alias("src_sys"),
            c("o_orderdate").alias("lst_txn_dt"),
        )
        types = self.t("orders").select(c("o_orderpriority").alias("account_type_code")).distinct()
        types = types.withColumn("tp_cd", F.substring("account_type_code", 1, 1))
        customers = self.t("customer").select(
            c("c_custkey").alias("customer_id"),
            c("c_name").alias("customer_name"),
            c("c_mktsegment").alias("customer_industry"),
        )
        return accounts, types, customers

    @cached_property
    def hist(self) -> DataFrame:
        return self.t("events").select(
            c("ts").cast("date").alias("snapshot_date"),
            F.when(c("value") >= 1, c("event_type")).alias("account_type"),
            F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        )

    # registries --------------------------------------------------------------------------

    @cached_property
    def ownership(self) -> DataFrame:
        size = c("p_size")
        return self.t("part").select(
            c("p_type").alias("table_name"),
            text("c", c("p_partkey")).alias("column_name"),
            text("steward ", size).alias("steward_name"),
            text("role-", size % 4).alias("steward_role"),
            c("p_brand").alias("producer_team"),
            F.when(size <= 25, "monthly").otherwise("quarterly").alias("review_frequency"),
            F.date_add(F.lit("2024-01-01").cast("date"), (c("p_partkey") % 365).cast("int")).alias(
                "next_review_date"
            ),
            text(c("p_brand"), "@example.org").alias("escalation_contact"),
            F.when(size <= 30, text("next-", size)).alias("successor_role"),
            F.when(size % 7 != 0, F.date_add(F.lit("2023-06-01").cast("date"), size * 10)).alias(
                "succession_reviewed_at"
            ),
        )

    @cached_property
    def sens(self) -> DataFrame:
        size = c("p_size")
        return self.t("part").select(
            c("p_type").alias("table_name"),
            text("c", c("p_partkey")).alias("column_name"),
            F.when(size <= 10, "PUBLIC")
            .when(size <= 25, "INTERNAL")
            .when(size <= 40, "CONFIDENTIAL")
            .otherwise("RESTRICTED")
            .alias("classification"),
            F.when(size <= 25, F.array(F.lit("AUTOMOBILE"), F.lit("BUILDING")))
            .when(size <= 35, F.array(F.lit("BUILDING"), F.lit("FURNITURE")))
            .alias("access_roles"),
            F.when(size > 40, text("pii-", c("p_brand"))).alias("pii_category"),
            (size > 35).alias("log_access"),
        )

    @cached_property
    def manifest(self) -> DataFrame:
        kinds = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
        key = c("s_suppkey")
        return self.t("supplier").select(
            c("s_name").alias("system_name"),
            text("v", key % 5).alias("system_version"),
            F.when(c("s_acctbal") > 0, "prod").otherwise("dev").alias("environment"),
            choose(c("s_nationkey") % 6, dict(enumerate(kinds[:5])), None).alias("table_name"),
            F.array(text("c", key), text("c", key * 3), text("c", key * 7)).alias("columns_accessed"),
            F.when(key % 4 != 0, (key % 40).cast("int")).alias("max_acceptable_staleness_hours"),
            F.when(key % 3 != 0, (key % 10) / 10.0).alias("min_confidence_threshold"),
            text("team-", c("s_nationkey")).alias("system_owner_team"),
        )

    @cached_property
    def lin(self) -> DataFrame:
        key, size = c("p_partkey"), c("p_size")
        sources = F.array_compact(
            F.array(half(key), F.when(size <= 5, half(key) + 1), F.when(key == 1, F.lit(3).cast("long")))
        )
        rows = self.t("part").filter(key > 0).withColumn("s", F.explode(sources))
        return rows.select(
            text("T", key % 5).alias("target_table"),
            text("c", key).alias("target_column"),
            text("T", c("s") % 5).alias("source_table"),
            text("c", c("s")).alias("source_column"),
            F.when(c("s") % 2 == 0, "erp").alias("source_system"),
            F.when(size <= 20, "direct_copy").otherwise("aggregation").alias("transform_type"),
            text("pipe-", c("p_brand")).alias("transform_pipeline"),
            text("1.", size).alias("pipeline_version"),
            F.when(size > 10, F.when(size <= 30, "string").otherwise("bigint")).alias("expected_source_type"),
        )

    @cached_property
    def lin_cols(self) -> DataFrame:
        key = c("p_partkey")
        return (
            self.t("part")
            .filter(c("p_size") > 3)
            .select(
                F.lit("operational_db").alias("table_schema"),
                text("T", key % 5).alias("table_name"),
                text("c", key).alias("column_name"),
                F.when(c("p_size") <= 25, "string").otherwise("bigint").alias("data_type"),
            )
        )

    @cached_property
    def lin_manifest(self) -> DataFrame:
        return self.t("supplier").select(
            F.when(c("s_acctbal") > 0, "prod").otherwise("dev").alias("environment"),
            text("T", c("s_suppkey") % 4).alias("table_name"),
        )

    @cached_property
    def cat(self) -> DataFrame:
        key, size = c("p_partkey"), c("p_size")
        name = F.replace(c("p_name"), F.lit(" "), F.lit("_"))
        return self.t("part").select(
            F.lit("operational_db").alias("table_schema"),
            text(c("p_brand"), " ", c("p_type")).alias("table_name"),
            F.when(size == 1, "valid_from")
            .when(size == 2, "updated_at")
            .when(size < 15, text("c", key))
            .when(size < 20, text("col", key))
            .otherwise(text(name, "_", key))
            .alias("column_name"),
            F.when(size <= 25, "string").otherwise("bigint").alias("data_type"),
            F.when(size % 5 == 1, "")
            .when(size % 5 == 2, c("p_name"))
            .when(size % 5 > 2, text(c("p_name"), " in the range of ", c("p_brand")))
            .alias("comment"),
            F.when(c("p_type") == "PROMO", "VIEW").otherwise("BASE TABLE").alias("table_type"),
        )

    # semantics ---------------------------------------------------------------------------

    @cached_property
    def glossary(self) -> DataFrame:
        key = c("s_suppkey")
        parent = text("Supplier#", F.lpad(half(key).cast("string"), 9, "0"))
        return self.t("supplier").select(
            c("s_name").alias("canonical_term"),
            text("maker ", key, " in nation ", c("s_nationkey")).alias("definition"),
            F.when(c("s_acctbal") > 5000, "sum of amounts").alias("calculation"),
            F.array(text("syn", key), text("NATION_", c("s_nationkey"))).alias("synonyms"),
            F.when(c("s_acctbal") > 5000, F.array(text("not ", key))).alias("excludes"),
            F.lit("trade").alias("business_context"),
            F.when(c("s_acctbal") < 0, "deprecated").otherwise("active").alias("status"),
            F.when(key > 0, F.array(parent)).alias("is_a"),
        )

    @cached_property
    def descriptions(self) -> DataFrame:
        return self.t("documents").select(
            c("source").alias("table_name"),
            text("c", c("doc_id")).alias("column_name"),
            text("uses [syn", c("doc_id") % 150, "] and [NATION_", c("doc_id") % 25, "] in ", c("lang")).alias(
                "description"
            ),
        )

    @cached_property
    def data_descriptions(self) -> DataFrame:
        """Descriptions of which some are about the columns of ``records``."""
        n = F.substring("column_name", 2, 20).cast("long") % 40
        return self.descriptions.withColumn(
            "column_name", F.when(n == 0, "lang").when(n == 1, "n_chars").otherwise(c("column_name"))
        )

    @cached_property
    def records(self) -> DataFrame:
        return self.t("documents").select(
            c("source").alias("table_name"), c("doc_id").alias("record_id"), "lang", "n_chars"
        )

    # vectors and indexes -----------------------------------------------------------------

    @cached_property
    def vec(self) -> DataFrame:
        return self.t("embeddings").select(
            "vec_id", c("embedding").cast("array<double>").alias("embedding"), "label"
        )

    @cached_property
    def new_vec(self) -> DataFrame:
        changed = c("label").isin(1, 4, 7)
        moved = (
            F.when(c("label") == 1, F.transform("embedding", lambda x: x * 2))
            .when(c("label") == 4, F.reverse("embedding"))
            .when(c("label") == 7, F.transform("embedding", lambda x: x + 0.02))
            .otherwise(c("embedding"))
        )
        return self.vec.select(
            "vec_id", moved.alias("embedding"), F.when(changed, c("label") + 100).otherwise(c("label")).alias("label")
        )

    @cached_property
    def source_docs(self) -> DataFrame:
        return self.t("documents").select(
            c("doc_id").alias("source_record_id"),
            c("source").alias("source_table"),
            c("n_chars").alias("updated_at"),
            F.md5("text").alias("content_hash"),
        )

    @cached_property
    def index_docs(self) -> DataFrame:
        """Index of the documents: Spanish ones are missing, toxic ones are out of date, and
        German ones were also indexed under an id that the source no longer has."""
        docs = self.t("documents").join(self.t("labels").select("doc_id", "toxic"), "doc_id", "left")
        bad = F.coalesce(c("toxic"), F.lit(0)) == 1
        here = docs.filter(c("lang") != "es").select(
            text("k", c("doc_id")).alias("chunk_id"),
            c("doc_id").alias("source_record_id"),
            c("source").alias("source_table"),
            F.when(bad, c("n_chars") - 1).otherwise(c("n_chars")).alias("source_version"),
            F.when(bad, F.md5(F.concat(c("text"), F.lit("!")))).otherwise(F.md5("text")).alias("content_hash"),
        )
        gone = docs.filter(c("lang") == "de").select(
            text("g", c("doc_id")).alias("chunk_id"),
            (c("doc_id") + 1_000_000_000).alias("source_record_id"),
            c("source").alias("source_table"),
            c("n_chars").alias("source_version"),
            F.md5("text").alias("content_hash"),
        )
        return here.unionByName(gone)

    def queue(self, events: DataFrame) -> DataFrame:
        """Queue messages from events, batch or stream; some are cut off, some lack a key."""
        body = text(
            '{"table": "account", "entity_id": "', c("user_id"), '", "source_record": {"updated_at": "',
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), '", "kind": "', c("event_type"), '"}}',
        )
        return events.select(
            "event_id",
            F.when(c("value") < 2, '{"table": "account", "entity_id"')
            .when(c("value") < 4, '{"table": "account", "source_record": {}}')
            .otherwise(body)
            .alias("body"),
        )

    @cached_property
    def runs(self) -> DataFrame:
        return self.t("events").select(
            c("user_id").alias("contract_id"),
            c("event_id").alias("run_id"),
            c("ts").alias("at"),
            (c("event_type") != "error").alias("ok"),
        )
