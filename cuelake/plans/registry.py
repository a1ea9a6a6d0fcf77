from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cuelake.plans.views import VIEWS
from cuelake.sources.tables import Tables

PLANS: dict[str, Callable[[Tables], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def plan(name: str, sql: str | None = None, same_as: str | None = None):
    """Register a query under `name`; `sql` may use the derived views as tables. `same_as` names a
    query whose rows this one must give by another way (a stream, or files written and read back)."""

    def keep(build: Callable[[Tables], DataFrame]):
        if name in PLANS:
            raise ValueError(f"Query {name} is registered twice")
        PLANS[name] = build
        if sql is not None:
            # Text that opens with a comma adds views of its own.
            kind = "WITH RECURSIVE" if "/*recursive*/" in sql else "WITH"
            CHECKS[name] = f"{kind} {VIEWS}\n{sql.replace('/*recursive*/', '').strip()}"
        if same_as is not None:
            CHECKS[name] = CHECKS[same_as]
        return build

    return keep


def runner(build: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: build(Tables(spark, folder))
