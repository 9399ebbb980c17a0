import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from factloom.functions.text import without_code_fence
from factloom.operators import confidence, embeddings, graph, semantic

D = dt.datetime


def rows(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def test_vertices_take_the_earliest_type_and_zero_confidence_is_filled(spark):
    rels = spark.createDataFrame(
        [
            ("r1", "a", "Customer", "uses", "b", "Product", D(2024, 1, 2), None, 0.0, "s"),
            ("r2", "b", "Contract", "uses", "a", "Customer", D(2024, 1, 1), None, None, "s"),
            ("r3", "c", "Event", "uses", "a", "Customer", D(2024, 1, 1), D(2024, 2, 1), 0.5, "s"),
        ],
        "relationship_id string, subject_id string, subject_type string, predicate string, object_id string, object_type string, "
        "valid_from timestamp_ntz, valid_to timestamp_ntz, confidence double, source_system string",
    )
    vertices, edges = graph.build_graph(rels, [])
    assert rows(vertices, "canonical_id", "type") == [("a", "Customer"), ("b", "Contract")]
    assert rows(edges, "src", "dst", "confidence") == [("a", "b", 0.8), ("b", "a", 0.8)]
    assert rows(graph.build_graph(rels, keep_zero=True)[1], "confidence") == [(0.0,), (0.8,)]
    assert graph.build_graph(rels, ["other"])[1].isEmpty()


def test_replies(spark):
    good = '{"entities":[{"id":"1","type":"Customer","name":"n"}],"relationships":[]}'
    df = spark.createDataFrame(
        [(1, good), (2, f"  ```json\n{good}\n```\nthanks"), (3, "```\n{bad\n```"), (4, "sorry"), (5, None), (6, '{"entities":[]}')],
        "reply_id int, reply string",
    )
    entities, relations, rejects = graph.parse_extractions(df)
    assert rows(entities, "reply_id") == [(1,), (2,)]
    assert relations.isEmpty()
    assert rows(rejects, "reply_id") == [(3,), (4,), (5,)]
    assert df.filter("reply_id = 2").select(without_code_fence(F.col("reply"))).first()[0] == good


def test_k_hop_with_a_cycle(spark):
    edges = spark.createDataFrame(
        [("a", "b", False), ("b", "c", False), ("c", "a", False), ("d", "a", True)], "src string, dst string, is_bidirectional boolean"
    )
    seeds = spark.createDataFrame([("a",)], "seed string")
    assert rows(graph.k_hop(edges, seeds, 9), "vertex", "hops") == [("a", 0), ("b", 1), ("c", 2), ("d", 1)]


def test_superseded_chains(spark):
    df = spark.createDataFrame(
        [(1, 2), (2, 3), (3, 4), (4, 5), (5, None), (6, 7), (7, 6), (8, 99), (9, None), (10, 6)], "context_id int, superseded_by int"
    )
    got = {r["context_id"]: (r["surviving_id"], r["resolved"]) for r in graph.resolve_superseded(df).collect()}
    assert {k: got[k] for k in (1, 2, 3, 4, 5)} == dict.fromkeys((1, 2, 3, 4, 5), (5, True))
    assert got[9] == (9, True)
    assert got[8] == (99, False)
    assert {k: got[k] for k in (6, 7, 10)} == {k: (k, False) for k in (6, 7, 10)}


def test_long_chains_are_complete(spark):
    chain = spark.createDataFrame([(k, k + 1 if k < 999 else None) for k in range(1000)], "context_id int, superseded_by int")
    got = graph.resolve_superseded(chain).filter("surviving_id <> 999 OR NOT resolved")
    assert got.count() == 0
    prov = spark.createDataFrame([(k, [k + 1]) for k in range(25)], "fact_id int, input_fact_ids array<int>").selectExpr(
        "*", "'x' AS source_type", "NULL AS source_document", "NULL AS transform_name", "0 AS derivation_depth"
    )
    root = spark.createDataFrame([(0,)], "fact_id int")
    assert sorted(r["depth"] for r in confidence.provenance_chain(prov, root).collect()) == list(range(25))
    some = {r["depth"]: r["cut"] for r in confidence.provenance_chain(prov, root, 3).collect()}
    assert some == {0: False, 1: False, 2: False, 3: True}


def test_term_closure_on_a_cycle(spark):
    names = spark.createDataFrame([("a", ["b"]), ("b", ["c"]), ("c", ["a"])], "canonical_term string, is_a array<string>")
    got = {(r["canonical_term"], r["related_term"]): r["depth"] for r in semantic.term_closure(names).collect()}
    assert len(got) == 9 and got["a", "a"] == 3 and got["a", "c"] == 2


def test_glossary_upsert_loses_nothing(spark):
    glossary = spark.createDataFrame([("t", "old")], "canonical_term string, definition string")
    new = spark.createDataFrame([("t", "new"), ("u", "b"), ("u", "a"), ("u", "a"), ("v", None)], glossary.schema)
    kept, refused = semantic.glossary_upsert(glossary, new, "2024-01-01")
    assert rows(kept, "canonical_term", "definition") == [("t", "old"), ("u", "a"), ("v", None)]
    assert rows(refused, "canonical_term", "definition") == [("t", "new"), ("u", "a"), ("u", "b")]


def test_provenance_walk(spark):
    prov = spark.createDataFrame(
        [("a", ["b", "c"]), ("b", ["d"]), ("c", ["d", "a"]), ("d", None)], "fact_id string, input_fact_ids array<string>"
    ).selectExpr("*", "'x' AS source_type", "NULL AS source_document", "NULL AS transform_name", "0 AS derivation_depth")
    got = confidence.provenance_chain(prov, spark.createDataFrame([("a",)], "fact_id string"))
    assert rows(got, "fact_id", "depth") == [("a", 0), ("b", 1), ("c", 1), ("d", 2)]


@pytest.fixture(scope="module")
def glossary(spark):
    return spark.createDataFrame(
        [
            ("Monthly Revenue", "sum of months", "SUM(m)", ["MRR", "shared"], None, None, "active", ["Revenue"]),
            ("Annual Revenue", "sum of years", None, ["ARR", "shared"], ["MRR"], "b", "active", ["Revenue"]),
            ("ARR", "an own entry", None, None, None, None, "active", None),
            ("Old", "gone", None, ["old one"], None, None, "deprecated", None),
            ("Revenue", "money", None, None, None, None, "active", ["Money"]),
        ],
        "canonical_term string, definition string, calculation string, synonyms array<string>, excludes array<string>, "
        "business_context string, status string, is_a array<string>",
    )


def test_terms(spark, glossary):
    descriptions = spark.createDataFrame(
        [("t", "a", "see [MRR] and [Monthly Revenue], [shared]"), ("t", "b", "[ARR] [MRR] [Old] [nothing] []"), ("u", "c", None)],
        "table_name string, column_name string, description string",
    )
    refs = semantic.term_references(descriptions)
    assert rows(refs.filter("column_name = 'a'"), "ref_position", "term") == [(0, "MRR"), (1, "Monthly Revenue"), (2, "shared")]
    resolved = dict(rows(semantic.resolve_terms(refs, glossary).select("term", "canonical_term").distinct(), "term", "canonical_term"))
    assert resolved == {"MRR": "Monthly Revenue", "Monthly Revenue": "Monthly Revenue", "shared": "Annual Revenue", "ARR": "ARR"}
    records = spark.createDataFrame([("t", 1, "x", 1), ("u", 2, None, 1)], "table_name string, record_id int, a string, b int")
    projected = semantic.enrich(records.drop("b"), descriptions, glossary).filter("record_id = 1").first()
    assert set(projected["semantic_context"]) == {"MRR", "Monthly Revenue", "shared"}
    done = {r["record_id"]: r for r in semantic.enrich(records, descriptions, glossary).collect()}
    assert done[1]["total_terms_expanded"] == 4
    assert done[1]["semantic_context"]["MRR"]["excludes"] == []
    assert done[2]["total_terms_expanded"] == 0
    text = {r["record_id"]: r["text"] for r in semantic.assemble_text(records, descriptions, glossary).collect()}
    assert text[1].startswith("a: x, b: 1\nARR = an own entry; MRR = sum of months")
    issues = rows(semantic.glossary_issues(descriptions, glossary), "issue", "term", "occurrences")
    assert issues == [
        ("AMBIGUOUS_NAME", "ARR", 2), ("AMBIGUOUS_NAME", "shared", 2), ("UNDEFINED_REFERENCE", "Old", 1), ("UNDEFINED_REFERENCE", "nothing", 1),
    ]
    assert ("Annual Revenue", "Money", 2) in rows(semantic.term_closure(glossary), "canonical_term", "related_term", "depth")


def test_glossary_insert(spark, glossary):
    new = spark.createDataFrame([("Old", "x"), ("New", "b"), ("New", "a")], "canonical_term string, definition string")
    merged, refused = semantic.glossary_upsert(glossary, new, "2024-01-01")
    assert merged.count() == 6
    assert rows(merged.filter("canonical_term = 'New'"), "definition", "status") == [("a", "active")]
    assert rows(refused, "canonical_term", "definition") == [("New", "b"), ("Old", "x")]


def test_reembed(spark):
    schema = "id int, a string, b int, embedding array<double>"
    old = spark.createDataFrame([(1, "x", None, [1.0, 0.0]), (2, "x", 1, [1.0, 0.0]), (3, "x", 1, [1.0, 0.0]), (4, "x", 1, None), (5, "x", 1, [0.0, 0.0])], schema)
    new = spark.createDataFrame([(1, "x", None, [0.0, 1.0]), (2, "y", 1, [1.0, 0.01]), (3, "x", None, [0.0, 1.0]), (4, "y", 1, [1.0, 0.0]), (5, "y", 1, [1.0, 0.0]), (6, "n", 1, [1.0, 0.0])], schema)
    got = {r["id"]: (r["should_reembed"], r["reason"]) for r in embeddings.reembed_decisions(old, new, "id", ["b", "a"]).collect()}
    assert got == {
        1: (False, "content_unchanged"),
        2: (False, "embedding_stable (similarity=1.0000)"),
        3: (True, "content_changed"),
        4: (True, "content_changed"),
        5: (True, "content_changed"),
        6: (True, "content_changed"),
    }


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(1)
    data = [(i, rng.normal(size=8).tolist(), i % 3) for i in range(120)]
    data += [(200, data[0][1], 0), (201, [0.0] * 8, 0), (202, data[5][1], 9)]
    return spark.createDataFrame(data, "vec_id long, embedding array<double>, label int").repartition(5)


def test_coherence_is_the_mean_of_the_matrix(vectors):
    pdf = vectors.toPandas()
    for r in embeddings.coherence_by_group(vectors, "label").collect():
        m = np.array(pdf[pdf.label == int(r["concept"])].embedding.tolist())
        if len(m) < 10:
            assert r["coherence_score"] is None and r["warning"] == "insufficient_sample"
            continue
        u = m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-9)
        mean = (u @ u.T)[~np.eye(len(u), dtype=bool)].mean()
        assert r["coherence_score"] == pytest.approx(mean, abs=6e-5)
        assert r["sample_size"] == len(m)


@pytest.mark.parametrize(("angle", "status"), [(0.0, "OK"), (0.75, "WARN"), (3.0, "FRAGMENTED")])
def test_coherence_status(spark, angle, status):
    rng = random.Random(3)
    data = [(i, [np.cos(a), np.sin(a)]) for i, a in enumerate(rng.uniform(-angle, angle) for _ in range(200))]
    data = [(i, [float(x) for x in v]) for i, v in data]
    df = spark.createDataFrame(data, "vec_id int, embedding array<double>")
    assert embeddings.coherence(df, [1.0, 0.0], k=200).first()["status"] == status


@pytest.mark.parametrize("blocks", [(1000, 50_000), (7, 11)])
def test_knn_is_exact(spark, vectors, blocks):
    pdf = vectors.toPandas()
    m = np.array(pdf.embedding.tolist())
    norms = np.linalg.norm(m, axis=1)
    queries = vectors.filter("vec_id % 4 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    got = {}
    for r in embeddings.knn(vectors, queries, 6, block_queries=blocks[0], block_vectors=blocks[1]).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    assert len(got) == queries.count()
    for q, found in got.items():
        v = m[list(pdf.vec_id).index(q)]
        ranked = sorted(
            (-round(float(a @ v / (n * np.linalg.norm(v))), 12), i) for a, n, i in zip(m, norms, pdf.vec_id) if n > 0
        )[:6]
        assert [i for _, i in sorted(found)] == [i for _, i in ranked]


def test_knn_skips_what_cannot_be_near(spark):
    rng = np.random.default_rng(5)
    middles = rng.normal(size=(12, 16))
    data = [(i, (middles[i % 12] + rng.normal(scale=0.02, size=16)).tolist()) for i in range(900)]
    data += [(900, None), (901, [float("nan")] * 16), (902, [0.0] * 16), (903, data[7][1])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(3)
    queries = df.select(F.col("vec_id").alias("query_id"), "embedding")
    found, looks = embeddings.knn_search(df, queries, 9, block_queries=100, block_vectors=50)
    m = np.array([v for i, v in data[:900]] + [data[7][1]])
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    ids = np.array([*range(900), 903])
    near = np.round(u @ u.T, 12)
    want = {(int(q), int(ids[j]), r + 1) for q, row in zip(ids, near) for r, j in enumerate(np.lexsort((ids, -row))[:9])}
    got = {(r["query_id"], r["vec_id"], r["rank"]) for r in found.collect()}
    assert got == want
    seen = looks.agg(F.sum("vectors_looked"), F.sum("vectors"), F.count("*")).first()
    assert seen[2] == 901 and seen[0] < 0.3 * seen[1]


def test_knn_pairs_blocks_without_a_shuffle(spark, monkeypatch):
    rng = np.random.default_rng(6)
    data = [(i, rng.normal(size=4).tolist()) for i in range(300)] + [(None, [1.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    plans = []
    write = embeddings.written

    def noted(rows):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return write(rows)

    monkeypatch.setattr(embeddings, "written", noted)
    queries = df.select(F.col("vec_id").alias("query_id"), "embedding")
    found, _ = embeddings.knn_search(df, queries, 400, block_queries=40, block_vectors=30)
    assert not [p for p in plans if "CoGroup" in p]
    pairs = [p for p in plans if "CartesianProduct" in p]
    assert len(pairs) == 2 and not [p for p in pairs if "Exchange" in p]
    per_query = found.groupBy("query_id").agg(F.count("*").alias("n"), F.count("vec_id").alias("named")).collect()
    assert {(r["n"], r["named"]) for r in per_query} == {(301, 300)} and len(per_query) == 301


def test_knn_of_nothing(spark):
    none = spark.createDataFrame([(1, [0.0, 0.0]), (2, None)], "vec_id long, embedding array<double>")
    some = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0])], "query_id long, embedding array<double>")
    assert embeddings.knn(none, some, 3).count() == 0
    few = spark.createDataFrame([(1, [0.0, 2.0]), (2, [-1.0, 0.0])], "vec_id long, embedding array<double>")
    assert [r["vec_id"] for r in embeddings.knn(few, some, 3).orderBy("rank").collect()] == [1, 2]
