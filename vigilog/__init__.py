"""Operational-log analytics expressed as Spark DataFrame jobs."""
