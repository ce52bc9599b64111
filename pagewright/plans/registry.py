"""Registered queries: name → DataFrame builder and, where SQL can say it, an oracle."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.plans.fixtures import Fixtures
from pagewright.plans.oracle import compose

_QUERIES: dict[str, Callable[[Fixtures], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under its name; ``sql`` may use the fixture tables of ``oracle``."""
    def register(build: Callable[[Fixtures], DataFrame]):
        _QUERIES[name] = build
        if sql is not None:
            _ORACLES[name] = compose(sql.strip())
        return build

    return register


def label(path: str = "path"):
    """A path as one comparable string."""
    return F.array_join(path, "/")


def load() -> None:
    from pagewright.plans import (  # noqa: F401  registration happens on import
        q_attachments, q_dom, q_markdown, q_phases, q_sources, q_status, q_sync, q_text, q_tree)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    load()

    def bind(build):
        return lambda spark, sf_dir: build(Fixtures(spark, sf_dir))

    return {name: bind(build) for name, build in _QUERIES.items()}


def oracles() -> dict[str, str]:
    load()
    return dict(_ORACLES)
