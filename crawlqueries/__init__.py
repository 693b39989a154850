"""Registered queries: the crawl that the given tables stand for, the Spark queries, and their SQL twins."""
