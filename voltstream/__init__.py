"""voltstream: charger-log (OCPP) analytics as composable PySpark DataFrame operators.

Layers (each a DataFrame-in / DataFrame-out function):

* ``sources``    – CSV / parquet readers and writers, snapshot tables
* ``streaming``  – Structured Streaming file ingest with checkpoints
* ``functions``  – column expressions (frame parsing, payload schemas)
* ``operators``  – bronze conform, silver parse/pair/enrich/conform, upsert,
                   de-duplication, as-of pairing, high-water-mark loads
* ``plans``      – the six analytics views, the end-to-end pipeline and the
                   driver-table fixtures used by tests and benchmarks
"""

__version__ = "0.1.0"
