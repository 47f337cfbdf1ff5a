"""fieldmart: asset-telemetry and logistics analytics expressed as Spark plans.

Layout
------
sources/    table readers (parquet, JDBC), SQL text reads, mart writers
functions/  scalar column expressions and aggregate helpers
operators/  reusable DataFrame operators (cleaning, windows, joins, ML, checks)
plans/      jobs that compose operators into marts (production, forecast,
            anomaly, logistics, reports) and the driver-table views
streaming/  the incremental (Structured Streaming) form of the reading cleaner
"""

__version__ = "0.1.0"
