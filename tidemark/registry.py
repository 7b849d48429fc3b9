"""All session queries by name, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

PLANS = ("sessions", "bars", "signals", "feeds", "ledger", "capture", "payloads", "streams", "stores")


def _collect(name: str) -> dict:
    out: dict = {}
    for plan in PLANS:
        out |= getattr(import_module(f"tidemark.plans.{plan}"), name)
    return out


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _collect("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _collect("ORACLES")
