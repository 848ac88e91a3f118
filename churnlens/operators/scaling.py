"""Column standardisation with population sigma: global mean / std come from one
aggregate (a single row), applied as literals — no window over the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def standardize(df: DataFrame, cols: list[str], suffix: str = "_z") -> DataFrame:
    """(x - mean) / stddev_pop. Action: one aggregate returning 2 numbers per column."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.avg(F.col(f"`{c}`").cast("double")).alias(f"m{i}"),
                 F.stddev_pop(F.col(f"`{c}`").cast("double")).alias(f"s{i}")]
    row = df.agg(*aggs).collect()[0]
    out = df
    for i, c in enumerate(cols):
        m, s = row[f"m{i}"], row[f"s{i}"]
        z = (F.col(f"`{c}`").cast("double") - F.lit(m)) / F.lit(s) if s else F.lit(None).cast("double")
        out = out.withColumn(c + suffix, z)
    return out
