"""dealwise — CRM sync and BI operators expressed as Spark DataFrame plans.

Sub-packages:
  functions/  Column-level functions (slugs, tolerant parsing, custom-field
              explosion).  Pure ``Column -> Column`` builders, JVM-side.
  operators/  DataFrame operators (upsert, schema evolution, enrichment,
              de-duplication, stage history, BI fact, run statistics).
  sources/    Scans: page-envelope landing, paged Python data sources,
              CSV staging, driver tables.
  streaming/  Incremental state (watermarks, cursors) and resumable
              Structured Streaming backfills.
  plans/      Whole jobs composed from the above (entity sync, the query
              catalogue over the driver tables).
"""

__version__ = "0.1.0"
