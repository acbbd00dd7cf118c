"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MODULES = ("minhash", "licenses", "packing", "token_files", "chat", "pii", "quality", "decontaminate", "sharding", "media", "mixing", "manifest", "vectors")


def _modules() -> list:
    return [importlib.import_module(f"labelloom.llm.{m}") for m in MODULES]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for m in _modules():
        out |= m.QUERIES
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _modules():
        out |= m.ORACLE
    return out
