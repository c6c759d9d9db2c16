"""Registry of named queries, each with its DuckDB oracle text.

A query is ``fn(fx: Fixtures) -> DataFrame``; its oracle is DuckDB SQL over the
driver's tables, with fixture CTEs added by ``duckdb_with``. Doubles are rounded
to ``digits`` on the Spark side; oracles round the same columns explicitly.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from taxaframe.functions.util import round_doubles
from taxaframe.plans.fixtures import PLANNED, Fixtures, duckdb_with


@dataclass
class Query:
    name: str
    fn: Callable[[Fixtures], DataFrame]
    oracle: str | None
    digits: int = 9

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return round_doubles(self.fn(Fixtures(spark, sf_dir, PLANNED)), self.digits)

    def oracle_sql(self) -> str | None:
        return duckdb_with(self.oracle) if self.oracle else None


REGISTRY: dict[str, Query] = {}


def query(name: str, oracle: str | None = None, digits: int = 9):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, oracle, digits)
        return fn

    return deco


def load_all() -> dict[str, Query]:
    # importing the modules registers their queries
    from taxaframe.plans import (  # noqa: F401
        q_kmer,
        q_markers,
        q_mock,
        q_plots,
        q_profiles,
        q_qc,
        q_reads,
        q_sources,
    )

    return REGISTRY
