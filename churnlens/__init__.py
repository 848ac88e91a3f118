"""churnlens: membership-retention analytics written as Spark DataFrame jobs.

Layout
------
sources/    fixture adapters over the test tables, typed readers, sinks
functions/  column expressions (as-of filters, labels, bands, reasons, engineered features)
operators/  DataFrame -> DataFrame building blocks (weekly windows, profile, ranking,
            snapshot, outreach, evaluation, thresholds, reports, cohorts, MLlib)
plans/      end-to-end jobs, the query registry and its DuckDB SQL twins
streaming/  micro-batch publishing of staged predictions through the idempotent sink
"""

__version__ = "0.1.0"
