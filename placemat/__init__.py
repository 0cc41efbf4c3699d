"""Listing analytics on PySpark: plain functions over DataFrames and Columns."""
