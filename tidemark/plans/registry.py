"""Named queries with, where SQL can say the same, an independent check in SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.frames import Frames
from tidemark.plans.oracle_views import ORACLE_VIEWS
from tidemark.plans.views import TABLES, VIEWS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[Callable[[Frames], DataFrame]], Callable]:
    """Register ``build(frames)`` under a name, with its check if there is one."""

    def add(build: Callable[[Frames], DataFrame]) -> Callable[[Frames], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Frames(spark, folder))
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return add


def oracle_text(body: str) -> str:
    """The check as one statement: the views it names become common table expressions."""
    defined: dict[str, str] = {}

    def resolve(sql: str) -> str:
        def replace(match: re.Match) -> str:
            name = match.group(1)
            if name in TABLES:
                return name
            if name.startswith("n_") and name[2:] in TABLES:
                return f"(SELECT count(*) FROM {name[2:]})"
            if name not in defined:
                text = ORACLE_VIEWS.get(name) or VIEWS[name]
                defined[name] = resolve(text)
            return name

        return re.sub(r"\{([a-z_]+)\}", replace, sql)

    final = resolve(body)
    views = ",\n".join(f"{name} AS MATERIALIZED (\n{sql}\n)" for name, sql in defined.items())
    if not views:
        return final
    own = re.match(r"\s*WITH\s", final)
    return f"WITH {views},\n{final[own.end():]}" if own else f"WITH {views}\n{final}"
