"""Data-quality and sales-analytics reports on Spark DataFrames."""
