"""Registered queries: operator id -> (Spark query, DuckDB twin).

Every query reads the test tables under ``sf_dir`` (through the fixture
mapping) and returns a DataFrame. Outputs are normalised for comparison:
integers as long, doubles rounded to 6 places, no nested values in the
compared columns (arrays and maps are rendered as text).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, oracle_sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # Timestamps of the fixtures and the oracle are UTC wall clock;
            # epoch values (F7, T8) need the session zone to agree.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return normalize(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        run.__module__ = fn.__module__
        _QUERIES[name] = run
        if oracle_sql is not None:
            _ORACLE[name] = oracle_sql
        return run
    return deco


def normalize(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), 6)
        elif isinstance(f.dataType, T.DecimalType):
            c = F.round(c.cast("double"), 6)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLE)


def _load() -> None:
    # Query modules register themselves on import.
    from topicspark.plans import registered  # noqa: F401
