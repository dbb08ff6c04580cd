"""Warehouse-loading operators on Spark DataFrames and the warehouse they make up."""
