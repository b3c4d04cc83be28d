"""Crawl analytics on Spark: link extraction, bounded walks, incremental state, reports."""

__version__ = "0.1.0"
