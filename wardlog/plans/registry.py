"""Named queries over the sample tables, each with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlog.plans.views import duckdb_views
from wardlog.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def naive(df: DataFrame) -> DataFrame:
    """Timestamps as zone-less values, so results do not depend on the client's zone."""
    zoned = {n: F.col(f"`{n}`").cast("timestamp_ntz") for n, t in df.dtypes if t == "timestamp"}
    return df.withColumns(zoned) if zoned else df


def query(name: str, sql: str | None = None, views: tuple[str, ...] = (), ctes: str = "") -> Callable[[Query], Query]:
    """Register a query; ``sql`` is the final select over ``views`` and ``ctes``."""
    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return naive(fn(configure(spark), sf_dir.rstrip("/")))
        QUERIES[name] = run
        if sql is not None:
            parts = [p for p in (duckdb_views(*views), ctes.strip().rstrip(",")) if p]
            final = sql.strip()
            if parts and final.startswith("with "):  # the text brings definitions of its own
                start = "with recursive " if final.startswith("with recursive ") else "with "
                final = start + ",\n".join(parts) + ",\n" + final.removeprefix(start)
            elif parts:
                final = "with " + ",\n".join(parts) + "\n" + final
            ORACLES[name] = final
        return run
    return register
