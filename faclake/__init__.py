"""faclake: a Spark-native facility-compliance lake.

Typed CSV ingest under declared schemas, a program-id crosswalk, 23 enrichment
views, data-quality gates, guarded SQL access and landing-side change
detection, all written as DataFrame jobs.
"""

__version__ = "0.1.0"
