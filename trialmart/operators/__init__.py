"""Cleaning, staging, warehouse, quality and report operators on DataFrames."""
