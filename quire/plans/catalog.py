"""Query catalogue: name -> Spark job (and, where SQL can say it, a DuckDB oracle).

Each job takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables.  Oracle SQL reads the same tables as pre-registered views.  Column
names and the rendering of arrays (joined to strings) match on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def _load_all():
    # Importing the modules registers their queries.
    from quire.plans import (  # noqa: F401
        q_extract, q_text, q_corpus, q_splits, q_annotations, q_features,
        q_ocr, q_reports, q_models, q_files, q_stream,
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLES)
