"""crawlframe: web-crawl data processing as Spark DataFrame jobs."""

__version__ = "0.1.0"
