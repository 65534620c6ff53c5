"""strata: a Spark-native layered batch engine.

Raw feeds are landed as partitioned tables with lineage columns, keyed
upserts and high-water marks; they are cleaned with deterministic keep-latest
deduplication, standardisation and classification; joined and aggregated into
coverage, existence-flag and demand tables; and checked with a one-pass
data-quality suite. Everything is DataFrame / Spark SQL.
"""

__version__ = "0.1.0"
