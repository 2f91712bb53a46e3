"""Whole jobs: the page store, the frontier, the crawl; the query catalog."""
