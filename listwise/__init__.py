"""Listing identity and valuation as Spark DataFrame jobs."""
