"""Registered queries over the test tables."""

import importlib

from workload.registry import QUERIES, SQL


def load():
    for module in ("measures", "comparisons", "domain", "reports", "upkeep"):
        importlib.import_module(f"workload.{module}")
    return QUERIES, SQL
