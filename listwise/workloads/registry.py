"""Where workloads register a query and, where SQL can say it, its SQL."""

from functools import wraps

from listwise.session import tune

QUERIES: dict = {}
SQL: dict = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        @wraps(fn)
        def run(spark, sf):
            return fn(tune(spark), sf)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn
    return register
