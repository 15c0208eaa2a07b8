"""Repeat-buyer analytics for marketplace orders, written as PySpark DataFrame jobs."""
