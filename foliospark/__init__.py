"""Recommendation analytics on Spark DataFrames: ETL, features, models, audits, monitoring."""
