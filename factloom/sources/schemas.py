"""Declared tables: column types, unique keys, required columns, enumerations.

Identifiers are strings, times carry no zone. Lengths and fixed-width padding of text are
not enforced. The values below are fixed by the data model.
"""

from __future__ import annotations

TABLES = {
    "fact_customer_core": {
        "ddl": "canonical_id string, source_system string, source_record_id string, legal_name string, "
        "registration_no string, incorporation_country string, employee_count int, "
        "annual_revenue_usd decimal(15,2), valid_from timestamp_ntz, valid_to timestamp_ntz, "
        "as_of_date date, asserted_by string, asserted_at timestamp_ntz, confidence decimal(3,2), "
        "record_confidence decimal(3,2), rate_of_change_class string, created_at timestamp_ntz, "
        "updated_at timestamp_ntz",
        "unique": [["canonical_id", "valid_from"]],
        "not_null": [
            "canonical_id", "source_system", "source_record_id", "legal_name", "incorporation_country",
            "valid_from", "asserted_by", "asserted_at", "rate_of_change_class", "created_at", "updated_at",
        ],
        "enums": {"rate_of_change_class": ["fast", "medium", "slow", "stable"]},
    },
    "entity_relationships": {
        "ddl": "relationship_id string, subject_id string, subject_type string, predicate string, "
        "object_id string, object_type string, is_bidirectional boolean, valid_from timestamp_ntz, "
        "valid_to timestamp_ntz, confidence decimal(3,2), source_system string, source_record_id string, "
        "asserted_by string, asserted_at timestamp_ntz, weight decimal(5,2), created_at timestamp_ntz, "
        "updated_at timestamp_ntz",
        "unique": [["relationship_id"]],
        "not_null": [
            "relationship_id", "subject_id", "subject_type", "predicate", "object_id", "object_type",
            "is_bidirectional", "valid_from", "source_system", "asserted_by", "asserted_at", "created_at",
            "updated_at",
        ],
        "enums": {},
    },
    "entity_context": {
        "ddl": "context_id string, entity_id string, entity_type string, context_type string, "
        "context_value string, context_rationale string, audience_scope string, assessed_by string, "
        "assessed_at timestamp_ntz, assessment_method string, criteria_version string, "
        "valid_from timestamp_ntz, valid_to timestamp_ntz, review_due date, confidence decimal(3,2), "
        "superseded_by string, created_at timestamp_ntz",
        "unique": [["context_id"]],
        "not_null": [
            "context_id", "entity_id", "entity_type", "context_type", "context_value", "assessed_by",
            "assessed_at", "assessment_method", "valid_from", "created_at",
        ],
        "enums": {"assessment_method": ["human", "ml_model", "rule_engine"]},
    },
    "entity_events": {
        "ddl": "event_id string, stream_id string, entity_type string, sequence_no bigint, event_type string, "
        "event_data string, occurred_at timestamp_ntz, recorded_at timestamp_ntz, initiated_by string, "
        "causation_id string, correlation_id string",
        "unique": [["event_id"], ["stream_id", "sequence_no"]],
        "not_null": [
            "event_id", "stream_id", "entity_type", "sequence_no", "event_type", "event_data", "occurred_at",
            "recorded_at", "initiated_by",
        ],
        "enums": {},
    },
    "fact_contract_bitemporal": {
        "ddl": "canonical_id string, version_id string, annual_value_usd decimal(15,2), payment_terms string, "
        "sla_tier string, valid_from timestamp_ntz, valid_to timestamp_ntz, recorded_from timestamp_ntz, "
        "recorded_to timestamp_ntz, asserted_by string, correction_reason string",
        "unique": [["version_id"]],
        "not_null": [
            "canonical_id", "version_id", "annual_value_usd", "payment_terms", "sla_tier", "valid_from",
            "recorded_from", "asserted_by",
        ],
        "enums": {},
    },
    "fact_provenance": {
        "ddl": "provenance_id string, fact_id string, fact_table string, source_type string, "
        "source_system string, source_record_id string, source_document string, source_field string, "
        "transform_name string, transform_version string, input_fact_ids array<string>, "
        "occurred_at timestamp_ntz, derivation_depth smallint, executed_by string",
        "unique": [["provenance_id"]],
        "not_null": [
            "provenance_id", "fact_id", "fact_table", "source_type", "occurred_at", "derivation_depth",
            "executed_by",
        ],
        "enums": {"source_type": ["source_system", "transformation", "inference"]},
    },
    "fact_confidence_exceptions": {
        "ddl": "fact_table string, fact_id string, field_name string, field_confidence decimal(3,2), reason string",
        "unique": [["fact_table", "fact_id", "field_name"]],
        "not_null": ["fact_table", "fact_id", "field_name", "field_confidence"],
        "enums": {},
    },
    "column_sensitivity": {
        "ddl": "table_name string, column_name string, classification string, access_roles array<string>, "
        "pii_category string, log_access boolean, rationale string, classified_by string, "
        "classified_at timestamp_ntz, review_due date",
        "unique": [["table_name", "column_name"]],
        "not_null": [
            "table_name", "column_name", "classification", "log_access", "rationale", "classified_by",
            "classified_at",
        ],
        "enums": {"classification": ["PUBLIC", "INTERNAL", "CONFIDENTIAL", "RESTRICTED"]},
    },
    "column_lineage": {
        "ddl": "target_table string, target_column string, source_table string, source_column string, "
        "source_system string, transform_type string, transform_logic string, transform_pipeline string, "
        "pipeline_version string, expected_source_type string, expected_null_rate decimal(5,4), "
        "expected_update_freq string, registered_by string, registered_at timestamp_ntz, "
        "last_verified_at timestamp_ntz",
        "unique": [["target_table", "target_column", "source_table", "source_column"]],
        "not_null": [
            "target_table", "target_column", "source_table", "source_column", "transform_type",
            "transform_pipeline", "pipeline_version", "registered_by", "registered_at",
        ],
        "enums": {
            "transform_type": [
                "direct_copy", "join_resolution", "code_expansion", "semantic_enrichment", "aggregation",
                "ml_inference",
            ]
        },
    },
    "column_ownership": {
        "ddl": "table_name string, column_name string, steward_name string, steward_email string, "
        "steward_role string, producer_team string, producer_system string, producer_contact string, "
        "accuracy_sla string, freshness_sla string, review_frequency string, next_review_date date, "
        "escalation_contact string, escalation_sla_hours int, successor_role string, successor_name string, "
        "successor_email string, succession_reviewed_at date, registered_at timestamp_ntz, "
        "last_confirmed_at timestamp_ntz",
        "unique": [["table_name", "column_name"]],
        "not_null": [
            "table_name", "column_name", "steward_name", "steward_email", "steward_role", "producer_team",
            "review_frequency", "escalation_contact", "escalation_sla_hours", "registered_at",
        ],
        "enums": {},
    },
    "ai_system_data_manifest": {
        "ddl": "manifest_id string, system_name string, system_version string, environment string, "
        "table_name string, columns_accessed array<string>, permission_tier string, access_pattern string, "
        "max_acceptable_staleness_hours int, min_confidence_threshold decimal(3,2), "
        "system_owner_team string, registered_by string, registered_at timestamp_ntz, approved_by string, "
        "approved_at timestamp_ntz",
        "unique": [["manifest_id"]],
        "not_null": [
            "manifest_id", "system_name", "system_version", "environment", "table_name", "columns_accessed",
            "permission_tier", "access_pattern", "system_owner_team", "registered_by", "registered_at",
        ],
        "enums": {},
    },
    "semantic_glossary": {
        "ddl": "term_id string, canonical_term string, domain string, term_type string, definition string, "
        "business_context string, calculation string, source_fields array<string>, synonyms array<string>, "
        "related_terms array<string>, antonyms array<string>, is_a array<string>, has_parts array<string>, "
        "excludes array<string>, steward_role string, reviewed_at timestamp_ntz, review_due date, "
        "status string, created_at timestamp_ntz",
        "unique": [["term_id"], ["canonical_term"]],
        "not_null": [
            "term_id", "canonical_term", "domain", "term_type", "definition", "steward_role", "reviewed_at",
            "status", "created_at",
        ],
        "enums": {
            "term_type": ["concept", "metric", "process", "business_rule", "role"],
            "status": ["active", "deprecated", "under_review"],
        },
    },
}
