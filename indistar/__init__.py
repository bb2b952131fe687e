"""indistar: public-indicator analytics expressed as Spark DataFrame jobs.

Landed nested-JSON / CSV extracts are flattened into a long layer, typed
(locale numbers, period codes), reshaped into star-schema facts and
dimensions with declared contracts, published as Parquet snapshots and
queried through report functions.  Every step is a lazy DataFrame plan.
"""

__all__ = ["functions", "operators", "sources", "plans", "streaming", "session"]
