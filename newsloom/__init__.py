"""Bulk news-article processing on Spark DataFrames."""
