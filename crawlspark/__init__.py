"""Web-crawl analytics as PySpark DataFrame jobs."""
