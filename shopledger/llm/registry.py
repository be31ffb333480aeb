"""The registered queries of the training-data operators, and the SQL of those that can be stated as SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

QUERIES = {
    "op1_bpe": "bpe",
    "op2_topk": "topk",
    "op3_rules": "rules",
    "op4_quality": "classifier",
    "op6_lines": "lines",
    "op7_langid": "langid",
    "op5_pii": "pii",
    "op8_packing": "packing",
    "op9_suffix": "suffix",
    "op10_simhash": "simhash",
    "op11_spelling": "spelling",
    "op12_bytebpe": "bytebpe",
    "op13_ranking": "ranking",
}

SQL = {"op11_spelling": "SPELLING_SQL", "op13_ranking": "RANKING_SQL"}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: getattr(import_module(f"shopledger.llm.{module}"), name) for name, module in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: getattr(import_module(f"shopledger.llm.{QUERIES[name]}"), sql) for name, sql in SQL.items()}
