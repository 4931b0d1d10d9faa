"""Named queries: a Spark builder and, where SQL can express it, the DuckDB oracle text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from logsmith.operators.common import ntz_timestamps, round_doubles
from logsmith.operators.parsing import parse_logs
from logsmith.session import apply_defaults
from logsmith.sources.fixtures import event_log_lines


@dataclass(frozen=True)
class NamedQuery:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None
    survey_id: str


_REGISTRY: dict[str, NamedQuery] = {}


def register(name: str, survey_id: str, oracle: str | None = None, shape: bool = True):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``shape`` applies the output boundary (instants to UTC ``timestamp_ntz``,
    doubles rounded to 6 places) so results compare exactly with the oracle.
    """
    def wrap(fn: Callable[[SparkSession, str], DataFrame]):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_defaults(spark)
            df = fn(spark, sf_dir)
            return round_doubles(ntz_timestamps(df)) if shape else df
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = NamedQuery(name, build, oracle, survey_id)
        return fn
    return wrap


def registered_oracles() -> dict[str, str]:
    """DuckDB texts of the queries registered so far (by the modules imported before)."""
    return {name: q.oracle for name, q in _REGISTRY.items() if q.oracle}


def registry() -> dict[str, NamedQuery]:
    # Importing the query modules fills the registry.
    from logsmith.plans import (  # noqa: F401
        anomaly_queries, export_queries, graph_queries, kpi_queries, metric_queries,
        parse_queries, stream_queries)
    return dict(_REGISTRY)


def logs_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parsed ``logs`` table of the fixture lines of ``sf_dir``."""
    return parse_logs(event_log_lines(spark, sf_dir))
