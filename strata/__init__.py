"""strata: a Spark-native layered commerce warehouse.

Raw CSV extracts are ingested under strict contracts (``sources``), cleaned and
deduplicated into typed Silver tables, modelled into a Gold snowflake schema
with a daily sales mart (``plans``), queried (``plans.analytics``) and gated by
data-quality checks (``operators.quality``). Everything is DataFrame code that
Catalyst plans; no Python UDF runs on the data path.
"""

__version__ = "0.1.0"
