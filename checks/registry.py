"""Registry of checked queries: a Spark function and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.samples import Samples
from checks.views import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def case(name: str, views: str = "", sql: str | None = None, recursive: str = "", as_text: str = ""):
    """Register a query under a name, with its SQL over the named views.

    Dates and whole numbers that may be NULL come out of the two engines as different client
    types; the columns in ``as_text`` are turned into text on both sides.
    """
    texts = as_text.split()

    def register(build: Callable[[Samples], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            found = build(Samples(spark, sf_dir))
            return found.withColumns({t: F.col(t).cast("string") for t in texts}) if texts else found

        QUERIES[name] = run
        if sql is not None:
            body = sql
            if texts:
                casts = ", ".join(f"CAST({t} AS VARCHAR) AS {t}" for t in texts)
                body = f"SELECT * REPLACE ({casts}) FROM ({sql})"
            ORACLES[name] = with_views(views.split(), body, recursive)
        return build

    return register


def rounded(expression: str, places: int = 2) -> str:
    return f"CAST(ROUND(CAST({expression} AS DECIMAL(20,10)), {places}) AS DOUBLE)"


def pct(part: str, whole: str) -> str:
    return rounded(f"(100.0::DOUBLE * ({part}) / NULLIF({whole}, 0))")
