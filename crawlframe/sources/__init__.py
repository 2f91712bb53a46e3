"""Reading the given tables, seeds and code lists; writing the crawl store."""
