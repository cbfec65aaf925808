"""Registered queries: each has a Spark plan over the given tables and, where SQL can say it, the
equivalent SQL text that another engine runs on the same tables."""

from collections.abc import Callable
from dataclasses import dataclass


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple
    plan: Callable
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, covers: str, sql: str | None = None, ints: str = ""):
    """Register a plan ``(views) -> DataFrame``; ``covers`` names inventory rows.

    ``ints`` lists result columns that are 32-bit in Spark and wider in the SQL twin.
    """
    if sql is not None and ints:
        casts = ", ".join(f"CAST({c} AS INTEGER) AS {c}" for c in ints.split())
        sql = f"SELECT * REPLACE ({casts}) FROM ({sql})"

    def register(plan):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(name, tuple(covers.split()), plan, sql)
        return plan
    return register
