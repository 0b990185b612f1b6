"""orderlake — order-data operators for PySpark.

Scalar column cleaners live in ``orderlake.functions``; DataFrame operators
(dedupe, upsert, sequencing, calendars, reconciliation, enrichment, quality
metrics, header matching, schema conformance) in ``orderlake.operators``;
file sources and table sinks in ``orderlake.sources``; incremental ingest in
``orderlake.streaming``; per-marketplace wiring and the registered checks in
``orderlake.plans``.
"""

__version__ = "0.1.0"
