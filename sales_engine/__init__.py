"""Retail-sales analytics on Spark DataFrames: land, clean, conform, report."""
