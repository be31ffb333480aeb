"""All registered queries and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from shopledger.plans.adapters import Inputs
from shopledger.session import ship

GROUPS = ["erp", "clock", "bonus", "pay", "sources", "sales", "stream"]


def _groups():
    return [import_module(f"shopledger.plans.queries_{g}") for g in GROUPS]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        def run(spark, sf_dir):
            ship(spark)
            return fn(Inputs(spark, sf_dir))

        return run

    return {name: bind(fn) for g in _groups() for name, fn in g.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for g in _groups() for name, sql in g.ORACLES.items()}
