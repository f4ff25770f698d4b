"""Lakehouse loading, sales queries, a sales mart and their checks on PySpark.

Every operator takes DataFrames and returns a DataFrame. Comments give the ids
"""
