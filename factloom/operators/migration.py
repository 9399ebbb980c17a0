"""Migration gates and incident triage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions.numeric import percent
from factloom.operators.governance import in_production
from factloom.plans.frontier import written

#: Bytes of keywords in one automaton, and of texts that it is run over in one task.
KEYWORD_BYTES = 1_000_000
TEXT_BYTES = 16_000_000
#: Rows of one keyword in a piece, on either side, and pairs that one task makes on average.
ASKED_ROWS, HIT_ROWS, PAIRS_A_TASK = 10_000, 100, 1_000_000


def schema_divergence(
    lineage: DataFrame, cols: DataFrame, manifest: DataFrame, schema: str = "operational_db"
) -> DataFrame:
    """Lineage sources of production targets that are missing or of another type."""
    found = cols.filter(F.col("table_schema") == schema).select(
        F.col("table_name").alias("source_table"),
        F.col("column_name").alias("source_column"),
        F.lower("data_type").alias("_type"),
        F.lit(True).alias("_there"),
    )
    expected = F.lower("expected_source_type")
    status = F.when(
        F.col("_there").isNull(), "MISSING: column no longer exists in legacy schema"
    ).when(
        F.col("_type") != expected,
        F.concat(F.lit("TYPE_MISMATCH: expected "), expected, F.lit(", found "), F.col("_type")),
    )
    return (
        in_production(lineage, manifest, "target_table")
        .join(found, ["source_table", "source_column"], "left")
        .select(
            "source_table",
            "source_column",
            status.alias("divergence_status"),
            "target_table",
            "target_column",
            "transform_pipeline",
        )
        .filter(F.col("divergence_status").isNotNull())
        .orderBy("divergence_status", "source_table", "source_column", "target_table", "target_column")
    )


def completeness_gate(
    legacy: DataFrame, surface: DataFrame, table: str = "account_ai_surface", status_col: str = "status"
) -> DataFrame:
    """Rows of the surface against live rows of the legacy table. Both sides are counted
    in one aggregation over their union; a NULL status is not live.
    """
    live = legacy.filter(F.col(status_col) != "deleted").select(F.lit(1).alias("l"), F.lit(0).alias("s"))
    here = surface.filter(F.col("valid_to").isNull()).select(F.lit(0).alias("l"), F.lit(1).alias("s"))
    counts = live.unionByName(here).agg(
        F.coalesce(F.sum("l"), F.lit(0)).alias("legacy_entity_count"),
        F.coalesce(F.sum("s"), F.lit(0)).alias("surface_entity_count"),
    )
    gate = (
        F.when(F.col("coverage_pct") >= 99.5, "PASS")
        .when(F.col("coverage_pct") >= 95.0, "WARN: investigate missing entities before go-live")
        .otherwise("FAIL: migration incomplete; do not go live")
    )
    return (
        counts.withColumn(
            "coverage_pct", percent(F.col("surface_entity_count"), F.col("legacy_entity_count"))
        )
        .select(
            F.lit(table).alias("surface_table"),
            "legacy_entity_count",
            "surface_entity_count",
            "coverage_pct",
            (F.col("legacy_entity_count") - F.col("surface_entity_count")).alias("missing_entity_count"),
            gate.alias("completeness_gate"),
        )
    )


def missing_entities(legacy: DataFrame, surface: DataFrame, key: str, status_col: str = "status") -> DataFrame:
    """Live legacy entities that the surface does not hold."""
    here = surface.filter(F.col("valid_to").isNull()).select(key).distinct()
    return legacy.filter(F.col(status_col) != "deleted").select(key).distinct().join(here, key, "left_anti")


def phase_gates(requests: DataFrame, gates: DataFrame, checklist: DataFrame) -> DataFrame:
    """Which requirements of a phase are not confirmed for a surface.

    ``requests`` has surface and phase; ``gates`` has phase, position and requirement;
    ``checklist`` has surface, requirement and confirmed. ``missing`` keeps the order of the
    gate and is at most as long as the gate. An unknown phase has a NULL result.
    """
    ticked = (
        checklist.groupBy("surface", "requirement")
        .agg(F.max(F.coalesce("confirmed", F.lit(False))).alias("_ok"))
    )
    item = F.struct("position", "requirement")
    open_items = F.collect_list(
        F.when(F.col("requirement").isNotNull() & ~F.coalesce("_ok", F.lit(False)), item)
    )
    return (
        requests.select("surface", "phase")
        .distinct()
        .join(gates, "phase", "left")
        .join(ticked, ["surface", "requirement"], "left")
        .groupBy("surface", "phase")
        .agg(open_items.alias("_open"), F.count("requirement").alias("_asked"))
        .select(
            "surface",
            "phase",
            F.when(F.col("_asked") > 0, F.size("_open") == 0).alias("passed"),
            F.transform(F.array_sort("_open"), lambda x: x["requirement"]).alias("missing"),
        )
    )


def keyword_hits(
    words: DataFrame,
    texts: DataFrame,
    id_col: str,
    batch_bytes: int = KEYWORD_BYTES,
    slice_bytes: int = TEXT_BYTES,
) -> DataFrame:
    """(keyword, id): which of the distinct ``words`` (keyword) each of ``texts`` (id, _text) holds.

    The words are cut by hash into batches of about ``batch_bytes``, the texts into slices of
    about ``slice_bytes``, whatever their number. A batch becomes one automaton, which is run
    over each text of a slice once, so a text costs its length and its matches for the whole
    batch. An empty word is in every text; NULL words and texts match nothing.
    """

    def parts(df: DataFrame, column: str, limit: int) -> int:
        size = df.agg(F.sum(F.octet_length(column).cast("long") + 16)).first()[0]
        return max(1, -(-(size or 0) // limit))

    words = words.select("keyword").filter("keyword IS NOT NULL").distinct()
    texts = texts.select(id_col, "_text").filter("_text IS NOT NULL")
    batches, slices = parts(words, "keyword", batch_bytes), parts(texts, "_text", slice_bytes)
    own = lambda column, n: F.pmod(F.xxhash64(column), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = words.select("keyword", own("keyword", batches).alias("_batch"), every(slices).alias("_slice"))
    read = texts.select(
        F.col(id_col).alias("_id"), "_text", every(batches).alias("_b"), own(id_col, slices).alias("_s")
    )

    def search(batch, part):
        import ahocorasick
        import pandas as pd

        machine = ahocorasick.Automaton()
        for word in batch["keyword"]:
            if word:
                machine.add_word(word, word)
        everywhere = [""] if (batch["keyword"] == "").any() else []
        if len(machine):
            machine.make_automaton()
        found: tuple[list, list] = ([], [])
        for key, text in zip(part["_id"], part["_text"]):
            held = {word for _, word in machine.iter(text)} if len(machine) else set()
            found[0].extend([*held, *everywhere])
            found[1].extend([key] * (len(held) + len(everywhere)))
        return pd.DataFrame({"keyword": found[0], id_col: found[1]}, dtype=object)

    kind = texts.schema[id_col].dataType.simpleString()
    pairs = asked.groupBy("_batch", "_slice").cogroup(read.groupBy("_b", "_s"))
    return pairs.applyInPandas(search, f"keyword string, `{id_col}` {kind}")


def triage(incidents: DataFrame, patterns: DataFrame) -> DataFrame:
    """Failure patterns whose mode or cause contains a keyword of the incident.

    ``incidents`` has incident_id and keywords (array); ``patterns`` has pattern_id (unique),
    title, failure_mode, root_cause, tags and key_fix. Matching ignores case; an empty keyword
    matches every pattern, an empty list none. All distinct keywords are searched at once
    (``keyword_hits``); incidents and patterns then join the matches by equality.
    """
    asked = incidents.select(
        "incident_id", F.explode(F.transform("keywords", F.lower)).alias("keyword")
    ).distinct()
    texts = patterns.select("pattern_id", F.lower(F.concat_ws(" ", "failure_mode", "root_cause")).alias("_text"))
    hits = written(keyword_hits(asked, texts, "pattern_id").filter("pattern_id IS NOT NULL"))
    return (
        _pairs_in_pieces(asked, hits, "incident_id", "pattern_id")
        .distinct()
        .join(patterns.select("pattern_id", "title", "tags", "key_fix"), "pattern_id")
        .select("incident_id", "pattern_id", "title", "tags", "key_fix")
    )


def _pairs_in_pieces(asked: DataFrame, hits: DataFrame, one: str, other: str, pairs_per_task: int = PAIRS_A_TASK) -> DataFrame:
    """(one, other) for every row of ``asked`` and of ``hits`` with the same keyword, spread evenly over tasks.

    The rows of a keyword are counted on both sides, and cut by hash so that a piece of ASKED_ROWS
    meets one of HIT_ROWS; only a common keyword has more than one piece. Each row is repeated
    once per piece of the other side, which is little next to the pairs it is in. Both sides lie
    in as many parts as the number of pairs asks for, whichever of them Spark then reads whole.
    """
    count = lambda df, name: df.groupBy("keyword").agg(F.count(F.lit(1)).alias(name))
    sizes = count(asked, "_asked").join(count(hits, "_held"), "keyword")
    cuts = written(
        sizes.select(
            "keyword",
            (F.col("_asked").cast("double") * F.col("_held")).alias("_pairs"),
            F.ceil(F.col("_asked") / F.lit(ASKED_ROWS)).cast("int").alias("_is"),
            F.ceil(F.col("_held") / F.lit(HIT_ROWS)).cast("int").alias("_js"),
        )
    )
    pairs = cuts.agg(F.sum("_pairs")).first()[0] or 0
    own = lambda column, pieces: F.pmod(F.xxhash64(column), F.col(pieces)).cast("int")
    every = lambda pieces: F.explode(F.sequence(F.lit(0), F.col(pieces) - 1))
    left = asked.join(cuts, "keyword").select(one, "keyword", own(one, "_is").alias("_i"), every("_js").alias("_j"))
    right = hits.join(cuts, "keyword").select(other, "keyword", every("_is").alias("_i"), own(other, "_js").alias("_j"))
    on, parts = ["keyword", "_i", "_j"], max(1, int(-(-pairs // pairs_per_task)))
    return left.repartition(parts, *on).join(right.repartition(parts, *on), on).select(one, other)


def patterns_for(patterns: DataFrame, tag) -> DataFrame:
    """Patterns that carry a tag."""
    return patterns.filter(F.array_contains("tags", F.lit(tag))).select("pattern_id", "title", "failure_mode")
