"""Retail analytics as plain functions from Spark DataFrames to DataFrames."""
