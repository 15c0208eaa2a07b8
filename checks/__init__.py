"""Registered queries: Spark jobs over the test tables with their SQL counterparts."""
