"""Retail star-schema warehouse built as Spark DataFrame jobs."""
