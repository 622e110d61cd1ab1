"""Shared-cost accounting over many buildings, as Spark DataFrame jobs."""
