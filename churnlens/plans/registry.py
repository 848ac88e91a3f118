"""Query registry: one entry per operator of the inventory.

Each entry is ``(spark_fn(spark, sf_dir) -> DataFrame, sql_fn() -> str | None)``.
Spark results are canonicalised for comparison only (doubles rounded half-even to 6 dp,
-0.0 folded), mirroring ``oracle.r6`` on the SQL side.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..sources import fixtures as FX
from . import oracle as O

AS_OF = "2001-01-01"
COHORTS = ["1999-01-01", "2000-01-01", "2001-01-01"]

_REGISTRY: dict[str, tuple[Callable, Callable | None]] = {}


def canon(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append((F.bround(F.col(f"`{f.name}`").cast("double"), 6) + F.lit(0.0)).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def register(key: str, sql: Callable | None = None):
    def deco(fn):
        _REGISTRY[key] = (fn, sql)
        return fn
    return deco


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {k: (lambda fn: (lambda spark, sf_dir: canon(fn(spark, sf_dir))))(fn) for k, (fn, _) in _REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: sql() for k, (_, sql) in _REGISTRY.items() if sql is not None}


def _load():
    from . import registered  # noqa: F401  (populates _REGISTRY)


# shared inputs -------------------------------------------------------------

def members(spark, sf_dir, T=AS_OF):
    return FX.memberships(spark, sf_dir, T)


def att_year(spark, sf_dir, T=AS_OF):
    return FX.attendance(spark, sf_dir, O.prev_year(T), T)
