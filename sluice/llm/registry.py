"""Queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MODULES = ("decontaminate", "suffix", "language", "similar", "bpe", "lm", "quality", "chat", "lines", "secrets", "repair", "codes", "tokencount")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {}
    for name in MODULES:
        module = importlib.import_module(f"sluice.llm.{name}")
        found[module.NAME] = module.query
    found["pipeline"] = importlib.import_module("corpus_pipeline").run
    return found


def oracle_sql() -> dict[str, str]:
    found = {}
    for name in MODULES:
        module = importlib.import_module(f"sluice.llm.{name}")
        if getattr(module, "SQL", None):
            found[module.NAME] = module.SQL
    return found
