"""The operators of this package over the whole given tables, one query each."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm import (
    decontaminate,
    euclid_lsh,
    exact_copies,
    hmm,
    language,
    packing,
    periodic,
    preferences,
    resampling,
    secret_scan,
    simhash,
    token_counts,
    toxicity,
)
from factloom.llm.text import in_fold
from factloom.session import configure

#: Where the public tokenizer files lie is a parameter of the operators; this is the installed one.
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), in_fold("doc_id", 3, 1)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    models = language.learn_languages(docs.filter(~in_fold("doc_id", 4, 2)))
    found = language.identify(docs.select("doc_id", "text"), models)
    return found.select("doc.doc_id", in_fold("doc.doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


@query
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), BYTE_BPE)


@query
def op5_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = in_fold("doc_id", 7, 2)
    scored = hmm.score(docs, ~held_out).withColumn("held_out", held_out)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"), path="source")


@query
def op8_vector_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return euclid_lsh.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op9_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    formatted = preferences.format_pairs(preferences.answered_elsewhere(table(spark, sf_dir, "conversations")))

    def written(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["begin"], s["end"])), " ")

    return formatted.withColumns({c: written(c) for c in ("chosen_spans", "rejected_spans")})


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), BYTE_BPE)


@query
def op11_exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_copies.exact_copies(table(spark, sf_dir, "documents"))


@query
def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(periodic.echoed(table(spark, sf_dir, "documents")))
    order = F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period"))))
    best = F.get(order, F.lit(0))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        (-best["l"]).alias("length"),
        best["period"].alias("period"),
        F.floor(F.lit(-1000) * best["l"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


ORACLES["op9_preferences"] = """
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS k
    FROM conversations WHERE conv_id IS NOT NULL
), answers AS (
    SELECT conv_id, max(k) AS k FROM turns WHERE role = 'assistant' GROUP BY conv_id
), lent AS (
    SELECT t.conv_id - 1 AS conv_id, t.role, t.text FROM turns t JOIN answers a USING (conv_id, k)
), sides AS (
    SELECT conv_id, 'c' AS side, k, role, text FROM turns
    UNION ALL
    SELECT t.conv_id, 'r', t.k, t.role, t.text
    FROM turns t LEFT JOIN answers a USING (conv_id)
    WHERE a.k IS NULL OR t.k <> a.k
    UNION ALL
    SELECT a.conv_id, 'r', a.k, l.role, l.text FROM answers a JOIN lent l USING (conv_id)
), placed AS (
    SELECT conv_id, side, role, text, row_number() OVER (PARTITION BY conv_id, side ORDER BY k) AS k FROM sides
), compared AS (
    SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.k, r.k) AS k,
           coalesce(c.role = r.role AND c.text = r.text, false) AS same
    FROM (SELECT * FROM placed WHERE side = 'c') c
    FULL JOIN (SELECT * FROM placed WHERE side = 'r') r ON c.conv_id = r.conv_id AND c.k = r.k
), prefix AS (
    SELECT conv_id, coalesce(min(k) FILTER (NOT same), max(k) + 1) - 1 AS n FROM compared GROUP BY conv_id
), lines AS (
    SELECT p.conv_id, p.side, p.k, x.n, p.role, '<|' || p.role || '|>' || chr(10) || p.text || '<|end|>' || chr(10) AS line
    FROM placed p JOIN prefix x USING (conv_id)
), spans AS (
    SELECT *, sum(CASE WHEN k > n THEN length(line) ELSE 0 END) OVER (PARTITION BY conv_id, side ORDER BY k) AS stop
    FROM lines
)
SELECT conv_id AS pair_id, CAST(any_value(n) AS INTEGER) AS n_prompt_turns,
       coalesce(string_agg(line, '' ORDER BY k) FILTER (side = 'c' AND k <= n), '') AS prompt,
       coalesce(string_agg(line, '' ORDER BY k) FILTER (side = 'c' AND k > n), '') AS chosen,
       coalesce(string_agg(line, '' ORDER BY k) FILTER (side = 'r' AND k > n), '') AS rejected,
       coalesce(string_agg((stop - length(line) + length(role) + 5) || '-' || stop, ' ' ORDER BY k)
           FILTER (side = 'c' AND k > n AND role = 'assistant'), '') AS chosen_spans,
       coalesce(string_agg((stop - length(line) + length(role) + 5) || '-' || stop, ' ' ORDER BY k)
           FILTER (side = 'r' AND k > n AND role = 'assistant'), '') AS rejected_spans,
       count(*) FILTER (k > n) = 0 AS tied
FROM spans GROUP BY conv_id
"""

ORACLES["op11_exact_copies"] = r"""
WITH texts AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(text) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY text)
"""
