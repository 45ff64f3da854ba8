"""Recruiting analytics on Spark DataFrames.

Layout
------
sources    readers and writers (keyed JSON, Parquet, JSONL, CSV, documents, state tables)
functions  Column -> Column expressions
operators  DataFrame -> DataFrame steps
plans      whole jobs built from the operators
streaming  the stateless jobs as Structured Streaming queries
"""
