"""Retail data-quality and analytics on Spark DataFrames."""
