"""Audited, schema-enforced ingestion and refinement as PySpark DataFrame jobs."""
