"""gazette: news-digest data work as Spark DataFrame, SQL and Structured Streaming jobs.

Every edition (niche, run_date) is a column, so one job builds every digest at once.
"""

__version__ = "0.1.0"
