"""Operators of a training-data pipeline over the tables ``documents`` and ``embeddings``.

Nothing else in the library imports this subpackage. Each operator takes DataFrames and column
names, uses only the columns named, and returns defined columns; extra columns of the input are
neither read nor needed.
"""
