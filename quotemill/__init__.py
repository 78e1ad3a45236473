"""quotemill: market pages -> typed, audited market tables, as Spark DataFrame jobs."""

__version__ = "0.1.0"
