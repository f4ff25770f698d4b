"""Operators on training text: one module per operator, see the README.

Nothing else in the library imports this package. Every operator takes
DataFrames and names of columns and returns a DataFrame with the columns it
states, whatever else its input holds.
"""
