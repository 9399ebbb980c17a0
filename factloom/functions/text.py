"""Small text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a glossary term reference is any non-empty text between square brackets.
TERM_REFERENCE = r"\[([^\]]+)\]"


def term_names(description: Column) -> Column:
    """All bracketed term names in order of appearance."""
    return F.regexp_extract_all(F.coalesce(description, F.lit("")), F.lit(TERM_REFERENCE), F.lit(1))


def without_code_fence(reply: Column) -> Column:
    """Text inside a leading code fence: drop the first line and all from the last fence on."""
    trimmed = F.regexp_replace(reply, r"^\s+|\s+$", "")
    body = F.regexp_replace(trimmed, r"(?s)\A```[^\n]*\n", "")
    inner = F.when(body.contains("```"), F.regexp_extract(body, r"(?s)\A(.*)```", 1)).otherwise(body)
    return F.when(trimmed.startswith("```"), F.regexp_replace(inner, r"^\s+|\s+$", "")).otherwise(trimmed)


def joined(parts: list[Column], separator: str = "") -> Column:
    """Concatenation in which NULL counts as empty text and separators are kept."""
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i and separator:
            pieces.append(F.lit(separator))
        pieces.append(F.coalesce(part.cast("string"), F.lit("")))
    return F.concat(*pieces)
